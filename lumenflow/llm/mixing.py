"""Mixing sources to target weights, by budgets down a domain-language-source tree.

``allocate``  the token budget goes down the tree level by level.  A node's
budget is shared among its children by weight; a child whose texts (times
``max_epochs``) hold less than its share takes what it has, and the shortage is
shared again among its siblings.  As a node's capacity is the sum below it, a
shortage reaches the siblings of an ancestor only once all of a node's children
are used up.  The shares are solved in closed form with running sums over the
children in the order of capacity / weight, in whole tokens.

``select``  a leaf's quota is whole epochs of all its texts plus a prefix of one
more epoch, whose order is a hash of seed, epoch and text.  The order is cut
into ``RANGES`` ranges by the hash's first digits: sums per range find the one
where the quota ends, and only the texts of that range are put in order, so no
task sorts a whole source.

Defined results: tokens are words ``[^\\x20\\x09-\\x0D]+``; a null or empty text has
none, costs nothing and is chosen with every epoch it falls in, ``max_epochs`` at most;
null language or source is the
empty name; rows that repeat id, text and leaf are chosen together; children of
weight 0 get nothing; an empty table gives none; ``mix`` keeps all columns and
repeats a row once an epoch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.session import materialize

HEX_DIGITS = 3
RANGES = 16 ** HEX_DIGITS
MAX_EPOCHS = 2
SEED = 7


@dataclass(frozen=True)
class Level:
    """``key`` and integer ``weight`` are expressions over the documents' columns."""
    name: str
    key: Column
    weight: Column


def source_tree(domains: int = 4) -> list[Level]:
    """The default tree: sources belong to a domain by their number; domains
    weigh 4, 3, 2, 1, English twice another language, sources the same."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    number = F.coalesce(F.expr("try_cast(regexp_extract(coalesce(cast(source as string), ''), '([0-9]{1,9})$', 1) as int)"), F.lit(0))
    domain = F.concat(F.lit("d"), (number % domains).cast("string"))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    return [Level("domain", domain, F.lit(domains) - number % domains),
            Level("lang", lang, F.when(lang == "en", 4).otherwise(2)),
            Level("source", source, F.lit(1))]


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def _items(docs: DataFrame, tree: list[Level]) -> DataFrame:
    """One row per (doc_id, text, leaf): tokens, rows, and the weights."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = [level.name for level in tree]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("_id"), F.md5(text.cast("binary")).alias("_key"), n_words(F.col("text")).alias("_tokens"),
        *[level.key.alias(f"_{level.name}") for level in tree],
        *[level.weight.cast("long").alias(f"_w_{level.name}") for level in tree])
    return rows.groupBy("_id", "_key", *[f"_{n}" for n in names]).agg(
        F.sum("_tokens").alias("_tokens"), F.count("*").alias("_rows"),
        *[F.max(f"_w_{n}").alias(f"_w_{n}") for n in names])


def _share(children: DataFrame, parent: list[str], name: str, budget: Column) -> DataFrame:
    """``children`` (with ``cap`` and ``weight``) with their part of the parent's
    budget, in whole tokens."""
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), f"_{name}")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    placed = children.withColumns({"left": budget - before, "rest": rest, "nth": F.row_number().over(order)})
    full = F.col("cap") * F.col("rest") <= F.col("left") * F.col("weight")
    # the first child that isn't used up sets the rate for all that follow it
    rate = F.min(F.when(~full, F.struct("nth", "left", "rest"))).over(Window.partitionBy(*parent))
    placed = placed.withColumn("rate", rate)
    return placed.withColumn("budget", F.when(
        F.col("rate").isNull() | (F.col("nth") < F.col("rate.nth")), F.col("cap")).otherwise(
        F.expr("cast(rate.left as decimal(38, 0)) * weight div rate.rest").cast("long"))).drop("left", "rest", "nth", "rate")


def allocate(items: DataFrame, tree: list[Level], budget: int | None, max_epochs: int) -> DataFrame:
    """One row per leaf: its tokens and its ``budget``; None: as many as there are."""
    names = [level.name for level in tree]
    leaves = items.groupBy(*[f"_{n}" for n in names]).agg(
        F.sum("_tokens").alias("tokens"), *[F.max(f"_w_{n}").alias(f"_w_{n}") for n in names])
    leaves = materialize(leaves, "leaves")
    for depth, name in enumerate(names):
        path = [f"_{n}" for n in names[:depth + 1]]
        children = (leaves.groupBy(*path).agg((F.sum("tokens") * max_epochs).alias("cap"), F.max(f"_w_{name}").alias("weight"))
                    .where("weight > 0"))
        if depth == 0:
            total = budget if budget is not None else leaves.agg(F.sum("tokens")).first()[0] or 0
            shared = _share(children.withColumn("_root", F.lit(0)), ["_root"], name, F.lit(total).cast("long")).drop("_root")
        else:
            parent = path[:-1]
            given = shared.select(*parent, F.col("budget").alias("given"))
            shared = _share(children.join(given, parent), [*parent, "given"], name, F.col("given")).drop("given")
        shared = shared.select(*path, "budget")
    return leaves.join(shared, [f"_{n}" for n in names]).select(*[f"_{n}" for n in names], "tokens", "budget")


def select(items: DataFrame, leaves: DataFrame, tree: list[Level], seed: int, max_epochs: int) -> DataFrame:
    """``items`` with ``copies`` (at least 1): how many epochs take the text."""
    leaf = [f"_{level.name}" for level in tree]
    quota = leaves.withColumns({
        "epochs": F.when(F.col("tokens") > 0, F.least(F.lit(max_epochs), F.expr("budget div greatest(tokens, 1)"))).otherwise(F.lit(0)),
    }).withColumn("rest", F.when(F.col("epochs") < max_epochs, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(-1))
    # the order of the epoch that is cut, differs from leaf to leaf
    placed = items.join(quota.select(*leaf, "epochs", "rest"), leaf)
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs"), F.coalesce(F.col("_id").cast("string"), F.lit("")), F.col("_key")).cast("binary"))
    placed = materialize(placed.withColumn("order", order).withColumn("range", F.substring("order", 1, HEX_DIGITS)), "placed")
    sums = placed.groupBy(*leaf, "range").agg(F.sum("_tokens").alias("sum"))
    upto = F.sum("sum").over(Window.partitionBy(*leaf).orderBy("range"))        # at most RANGES rows a leaf
    sums = sums.withColumn("before", upto - F.col("sum")).select(*leaf, "range", "before", "sum")
    ranged = placed.join(sums, [*leaf, "range"])
    inside = ranged.where("before + sum <= rest").withColumn("extra", F.lit(1))
    edge = ranged.where("before <= rest and before + sum > rest")
    run = F.sum("_tokens").over(Window.partitionBy(*leaf, "range").orderBy("order", "_id"))
    edge = edge.withColumn("extra", F.when(F.col("before") + run <= F.col("rest"), 1).otherwise(0))
    beyond = ranged.where("before > rest").withColumn("extra", F.lit(0))
    chosen = inside.unionByName(edge).unionByName(beyond)
    return chosen.withColumn("copies", (F.col("epochs") + F.col("extra")).cast("int")).where("copies > 0").select(
        "_id", "_key", *leaf, "_tokens", "_rows", "copies")


def selection(docs: DataFrame, tree: list[Level] | None = None, budget: int | None = None,
              max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The chosen (doc_id, text) keys with their leaf, tokens, rows and copies."""
    tree = tree or source_tree()
    items = materialize(_items(docs, tree), "items")
    return select(items, allocate(items, tree, budget, max_epochs), tree, seed, max_epochs)


def mix_report(docs: DataFrame, tree: list[Level] | None = None, budget: int | None = None,
               max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per chosen copy: doc_id, leaf, epoch (from 0), n_tokens."""
    tree = tree or source_tree()
    names = [level.name for level in tree]
    chosen = selection(docs, tree, budget, max_epochs, seed)
    rows = chosen.select("*", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))).alias("_row"))
    return rows.select(F.col("_id").alias("doc_id"), *[F.col(f"_{n}").alias(n) for n in names],
                       F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("epoch"),
                       F.expr("_tokens div _rows").alias("n_tokens"))


def mix(docs: DataFrame, tree: list[Level] | None = None, budget: int | None = None,
        max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` in the target proportions; all columns, a row for each copy."""
    tree = tree or source_tree()
    names, leaf = docs.columns, [f"_lf_{level.name}" for level in tree]
    chosen = selection(docs, tree, budget, max_epochs, seed).select(
        F.col("_id").alias("_lf_i"), F.col("_key").alias("_lf_k"),
        *[F.col(f"_{level.name}").alias(f"_lf_c_{level.name}") for level in tree], F.col("copies").alias("_lf_copies"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    mine = docs.withColumns({"_lf_id": F.col("doc_id").cast("long"), "_lf_key": F.md5(text.cast("binary")),
                             **{f"_lf_{level.name}": level.key for level in tree}})
    on = F.col("_lf_id").eqNullSafe(F.col("_lf_i")) & (F.col("_lf_key") == F.col("_lf_k"))
    for level in tree:
        on = on & (F.col(f"_lf_{level.name}") == F.col(f"_lf_c_{level.name}"))
    return (mine.join(chosen, on)
            .withColumn("_lf_copy", F.explode(F.sequence(F.lit(1), F.col("_lf_copies")))).select(*names))
