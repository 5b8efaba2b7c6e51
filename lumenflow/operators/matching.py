"""Address matching: exact 4-name match, then the best fuzzy candidate.

Exact part: region rows and master rows are matched on the four names
(null-safe, as a dataframe merge matches missing to missing).  Rows with
no partner on either side go on to the fuzzy part.

Fuzzy part (exact result, pruned work).  Names are searched, not rows: rows of a province
with the same joined names are one search, and of master rows of a block with the same
joined names the first by the tie columns is the only member; the answers are joined back
to the rows.  For every unmatched region row the master row with the highest Jaro-Winkler score over the four joined
names is wanted, among the unmatched master rows of its *block* (master
provinces reached through the block rules).  The search is a branch and
bound over the members in the order of their names, block -> span -> chunk, and on
down the trie of a chunk's names:

* members are put in order of their joined names (a range shuffle) and cut into
  chunks of about ``group_rows`` neighbours; ``SPAN`` chunks are a span;
* spans and chunks are summarised by their length range, their common
  four-character prefix and the per-bucket maximum of their members' character
  histograms; for a row and a node these give a score no member can exceed;
* a floor per row comes from beams (the few best ways down a trie) in the chunks of the
  highest bounds: a bound alone says little about which chunk holds the best member;
* then only nodes whose bound reaches the floor are opened, level by level, and
  the rows that reach a chunk search its trie together in a cogrouped ``applyInPandas``
  (``functions.jaro_trie``: the matching is built along the trie for all rows at once, and
  its bounds see the match window and the transpositions); a chunk reached by many rows is
  split by a salt;
* the winner is an aggregate ``min(struct(-score, tie columns))`` (partial
  per task, final per row), so no group is ever collected.

Between levels only ids and bounds travel on; a row's histogram (128 bytes)
is joined where a bound is computed.  Written are the features, the chunk
summaries and the floors, which several branches read.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.functions import jaro_winkler as JW
from lumenflow.functions.jaro_trie import Batch, Trie
from lumenflow.functions.strings import join_names, strip_parenthesised, text_upper
from lumenflow.session import materialize

# Output and master column names.
MASTER_NAME_COLUMNS = ("PROVINCE_NAME", "DISTRICT_NAME", "SUBDISTRICT_NAME", "URBAN_NAME")
MASTER_ID = "URBAN_ID"
MASTER_CARRIED = ("ISLAND_NAME", "TYPE_LABEL", "POSTAL_CODE", "CODE_SICEPAT", "IS_COD_SICEPAT",
                  "CODE_JNE_DESTINATION", "CODE_JNE", "CODE_JNE_ORIGIN", "CODE_TIKI")
OUTPUT_COLUMNS = (
    "province_code", "province_name", "ISLAND_NAME", "city_code", "city_name", "TYPE_LABEL",
    "district_code", "district_name", "subdistrict_code", "URBAN_ID", "subdistrict_name",
    "POSTAL_CODE", "CODE_SICEPAT", "IS_COD_SICEPAT", "CODE_JNE_DESTINATION", "CODE_JNE",
    "CODE_JNE_ORIGIN", "CODE_TIKI", "similarity_score",
)
# The master's name columns are one level shifted against the region table:
# DISTRICT_NAME is the city, SUBDISTRICT_NAME the district, URBAN_NAME the
# subdistrict.  They are renamed on load (Spark names are case-insensitive,
# so PROVINCE_NAME and province_name could not both exist).
M_NAMES = ("m_province", "m_city", "m_district", "m_subdistrict")
LEFT_NAMES = ("province_name", "city_name", "district_name", "subdistrict_name")
# A missing master name is compared as the text a CSV reader gives it.
MISSING_NAME_TEXT = "NAN"


@dataclass(frozen=True)
class BlockRule:
    """Region provinces ``provinces`` are compared with master provinces
    equal to ``target`` or, with ``prefix``, starting with it."""
    provinces: tuple[str, ...]
    target: str
    prefix: bool = False


# The default block rules (new provinces split from an old
# one, and two renamed provinces).
DEFAULT_RULES = (
    BlockRule(("PAPUA SELATAN", "PAPUA TENGAH", "PAPUA PEGUNUNGAN", "PAPUA BARAT DAYA"), "PAPUA",
              prefix=True),
    BlockRule(("DAERAH ISTIMEWA YOGYAKARTA",), "DI YOGYAKARTA"),
    BlockRule(("KEPULAUAN BANGKA BELITUNG",), "BANGKA BELITUNG"),
)


# --- preparation and exact match --------------------------------------------

def master_names(master: DataFrame) -> DataFrame:
    """Master id and its four names as upper-cased text (renamed)."""
    return master.select(MASTER_ID, *[text_upper(c, MISSING_NAME_TEXT).alias(m)
                                      for c, m in zip(MASTER_NAME_COLUMNS, M_NAMES)])


def _same_names(left: DataFrame, master: DataFrame) -> Column:
    cond = None
    for l, m in zip(LEFT_NAMES, M_NAMES):
        c = left[l].eqNullSafe(master[m])
        cond = c if cond is None else cond & c
    return cond


def exact_split(region: DataFrame, master: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mapped pairs, region rows without partner, master rows without
    partner).  The three joins hash both sides on the same four keys, so
    Spark reuses the shuffles."""
    left = region.select("subdistrict_code", *LEFT_NAMES)
    # a master row without an id can't be anyone's match
    names = master_names(master.where(F.col(MASTER_ID).isNotNull()))
    cond = _same_names(left, names)
    mapped = left.join(names, cond, "inner").select("subdistrict_code", MASTER_ID)
    left_only = left.join(names, cond, "left_anti")
    master_only = names.join(left, _same_names(left, names), "left_anti")
    return mapped, left_only, master_only


# --- blocks -----------------------------------------------------------------

def block_map(left_provinces: DataFrame, master_provinces: DataFrame,
              rules: tuple[BlockRule, ...] = DEFAULT_RULES) -> DataFrame:
    """(province_name, block): the master provinces each region province
    is compared with.  Inputs are the distinct province names of each side;
    prefix rules become equi-joins on the master name's first characters."""
    p = F.col("province_name")
    width = F.lit(0)
    key = p
    for rule in reversed(rules):
        hit = p.isin(*rule.provinces)
        width = F.when(hit, F.lit(len(rule.target) if rule.prefix else 0)).otherwise(width)
        key = F.when(hit, F.lit(rule.target)).otherwise(key)
    lp = left_provinces.select("province_name", width.alias("_w"), key.alias("_k"))
    widths = sorted({0} | {len(r.target) for r in rules if r.prefix})
    mp = None
    for w in widths:
        k = F.col("m_province") if w == 0 else F.substring("m_province", 1, w)
        part = master_provinces.select(F.lit(w).alias("_w"), k.alias("_k"),
                                       F.col("m_province").alias("block"))
        mp = part if mp is None else mp.unionByName(part)
    return lp.join(mp, ["_w", "_k"]).select("province_name", "block")


# --- fuzzy best match ----------------------------------------------------------

# The row key of a region row: a repeated code with other names is another row.
ROW = ("a_id", "a")
# The key of a search: all rows of a province with these names.
NAME = ("province_name", "a")
TIE_COLUMNS = ("m_province", "m_city", "m_district", "m_sub_clean", MASTER_ID)
LEVELS = (("block", "span"), ("block", "span", "gid"))
SPAN = 32                   # chunks of a span
SEED_SPANS, SEEDS = 4, 8    # spans, and chunks in them, that give a row its floor
BLOCK_LEFT_ROWS = 8192      # region rows per search call (hot groups are salted)
GROUP_ROWS = 30_000         # members of a chunk, whose names are a trie


def joined_left(left_only: DataFrame) -> DataFrame:
    return left_only.select(F.col("subdistrict_code").alias("a_id"), join_names(*LEFT_NAMES).alias("a"), "province_name")


def candidate_features(left_only: DataFrame, master_only: DataFrame, rules: tuple[BlockRule, ...],
                       group_rows: int) -> tuple[DataFrame, DataFrame]:
    """The names of each side with their block, joined string, length, histogram and prefix;
    those of the master also carry their chunk id.  ``left_only`` are rows of ``joined_left``."""
    # the block map, the features and a range sample read both sides: written once
    left = materialize(left_only.select(*NAME).distinct(), "fuzzy_names")
    sub_clean = strip_parenthesised(F.col("m_subdistrict"))
    master = master_only.select(
        MASTER_ID, "m_province", "m_city", "m_district", sub_clean.alias("m_sub_clean"),
        join_names("m_province", "m_city", "m_district", sub_clean).alias("b"))
    # of members with the same string the first by the tie columns can win
    master = master.groupBy("m_province", "b").agg(F.min(F.struct(*TIE_COLUMNS)).alias("w"))
    master = materialize(master.select("w.*", "b"), "fuzzy_members")
    blocks = block_map(left.select("province_name").distinct(),
                       master.select("m_province").distinct(), rules)
    left = (left.join(blocks, "province_name").distinct()
            .select(*NAME, "block", F.length("a").alias("la"),
                    JW.pack_histogram_udf(JW.char_histogram_udf("a")).alias("ha"),
                    F.substring("a", 1, JW.PREFIX_MAX).alias("pa")))
    # a range holds about one chunk, or several once there are as many as shuffle partitions
    n = int(master.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, min(n, -(-master.count() // group_rows)))
    order = ["m_province", "b", MASTER_ID]
    # the id counts the rows of a range-sorted task: neighbours share a chunk
    master = master.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        MASTER_ID, F.col("m_province").alias("block"), "m_province", "m_city", "m_district", "m_sub_clean", "b",
        F.expr(f"monotonically_increasing_id() div {group_rows + group_rows // 2}").alias("_run"),
        F.length("b").alias("lb"), JW.char_histogram_udf("b").alias("hb"),
        F.substring("b", 1, JW.PREFIX_MAX).alias("pb"))
    span = F.xxhash64("block", F.expr(f"_run div {SPAN}"))
    return left, master.withColumns({"gid": F.xxhash64("block", "_run"), "span": span}).drop("_run")


def summaries(master: DataFrame) -> DataFrame:
    """Per chunk: length range, per-bucket character maxima and the common
    4-character prefix (null when members differ)."""
    hmax = F.array(*[F.max(F.col("hb")[i]) for i in range(JW.HIST_BUCKETS)])
    return (master.groupBy(*LEVELS[-1]).agg(
        F.min("lb").alias("g_min"), F.max("lb").alias("g_max"), hmax.alias("g_hist"),
        F.min("pb").alias("_p0"), F.max("pb").alias("_p1"))
        .select(*LEVELS[-1], "g_min", "g_max", "g_hist",
                F.when(F.col("_p0") == F.col("_p1"), F.col("_p0")).alias("g_pre")))


def summaries_above(chunks: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The summaries of an upper level, from those of the chunks."""
    hmax = F.array(*[F.max(F.col("g_hist")[i]) for i in range(JW.HIST_BUCKETS)])
    return chunks.groupBy(*keys).agg(
        F.min("g_min").alias("g_min"), F.max("g_max").alias("g_max"), hmax.alias("g_hist"),
        F.when((F.min("g_pre") == F.max("g_pre")) & (F.count("g_pre") == F.count(F.lit(1))), F.min("g_pre")).alias("g_pre"))


def bounds_below(nodes: DataFrame, left: DataFrame, level: DataFrame, parent: tuple[str, ...],
                 keys: tuple[str, ...]) -> DataFrame:
    """Children of each row's nodes, with their bound: (row, keys, ub)."""
    packed = level.withColumn("g_hist", JW.pack_histogram_udf("g_hist"))
    j = nodes.join(left.select(*NAME, "block", "la", "ha", "pa"), [*NAME, "block"]) if parent != ("block",) else left
    ub = JW.node_bound_udf("ha", "la", "pa", "g_hist", "g_min", "g_max", "g_pre")
    return j.join(packed, list(parent)).select(*NAME, *keys, ub.alias("ub"))


def search_groups(rows: DataFrame, members: DataFrame, floors: bool = False) -> DataFrame:
    """Best member per (row, group) for rows ``(province_name, a, floor, gid)``, and ``scored``,
    the members whose score was computed; no member (score 0) where none reaches the floor.
    With ``floors`` only a score that some member of the group has, a high one.

    Rows and members are cogrouped on the group id; a call builds the group's trie and
    searches it for its rows.  A group reached by more than ``BLOCK_LEFT_ROWS``
    rows is split: rows get a salt, members are replicated per salt, so no
    call holds more than that many rows and one group of members."""
    counts = rows.groupBy("gid").agg(F.count(F.lit(1)).alias("_n"))
    salts = counts.select("gid", F.ceil(F.col("_n") / BLOCK_LEFT_ROWS).cast("int").alias("_s"))
    r = (rows.join(salts, "gid")
         .withColumn("salt", F.pmod(F.xxhash64(*NAME), F.col("_s")).cast("int"))
         .select("gid", "salt", *NAME, "floor"))
    m = (members.join(salts, "gid")
         .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("_s") - 1)))
         .select(F.col("gid").alias("m_gid"), F.col("salt").alias("m_salt"), "b", *TIE_COLUMNS))
    # The work here is Python, invisible to AQE's byte-based coalescing, so
    # both sides are hash-partitioned explicitly (same count, same keys):
    # the cogroup keeps this partitioning and runs on every core.
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = r.repartition(n, "gid", "salt")
    m = m.repartition(n, "m_gid", "m_salt")
    ties = list(TIE_COLUMNS)
    schema = "province_name string, a string, score double"
    if not floors:
        schema += (", scored bigint, m_province string, m_city string, m_district string, "
                   f"m_sub_clean string, {MASTER_ID} bigint")

    def run(left_pdf, member_pdf):
        trie = Trie(member_pdf["b"])
        batch = Batch(left_pdf["a"].tolist(), trie, left_pdf["floor"].fillna(0.0))
        out = left_pdf[list(NAME)].reset_index(drop=True)
        if floors:
            return out.assign(score=batch.floors())
        found = pd.DataFrame(dict(zip(("row", "member", "score"), batch.run())))
        # of a row's members with its best score the first by the tie columns
        members = member_pdf.sort_values(ties).drop_duplicates("b", ignore_index=True)
        rank = pd.Series(members.index, index=members["b"]).reindex(trie.strings).to_numpy()
        found["rank"] = rank[found["member"].astype(int)]
        first = found.sort_values(["row", "rank"]).drop_duplicates("row").set_index("row").reindex(out.index)
        out = out.assign(score=first["score"].fillna(0.0), scored=batch.scored)
        best = members[ties].astype({MASTER_ID: "Int64"}).reindex(first["rank"].astype("Int64"))
        return pd.concat([out, best.reset_index(drop=True)], axis=1)

    # (the member side is renamed: both sides descend from the same tables,
    # and cogroup keys are matched by position)
    return (r.groupBy("gid", "salt").cogroup(m.groupBy("m_gid", "m_salt"))
            .applyInPandas(run, schema))


def fuzzy_best_match(left_only: DataFrame, master_only: DataFrame,
                     rules: tuple[BlockRule, ...] = DEFAULT_RULES,
                     group_rows: int = GROUP_ROWS, only_codes: tuple[str, ...] | None = None,
                     report: dict | None = None, names: bool = False) -> DataFrame:
    """(subdistrict_a, subdistrict_b, similarity_score): the best master row
    per unmatched region row.  Ties go to the smaller (province, city,
    district, cleaned subdistrict, id) of the master.  A row whose best score
    is 0 (nothing in common) gets no match.  ``only_codes`` restricts the
    search to some subdistrict codes.  ``report`` is filled with the number
    of pairs of names in the blocks and of pairs whose score was computed.  With ``names`` the
    row's joined names are in the result (``names_a``).
    """
    if only_codes is not None:
        left_only = searched_rows(left_only, only_codes)
    # a row with a missing name has no string to compare; ``unmatched`` reports it
    rows = materialize(joined_left(left_only).where(F.col("a").isNotNull()), "fuzzy_rows")
    left, master = candidate_features(rows, master_only, rules, group_rows)
    left = materialize(left, "fuzzy_left")
    master = materialize(master, "fuzzy_master")
    chunks = materialize(summaries(master), "fuzzy_chunks")
    spans = summaries_above(chunks, LEVELS[0])
    members = master.select("gid", "b", *TIE_COLUMNS)

    # 1) floor: the best spans, the best chunks in them (ties by key)
    def best(bounded: DataFrame, keys: tuple[str, ...], most: int) -> DataFrame:
        nth = F.row_number().over(Window.partitionBy(*NAME).orderBy(F.desc("ub"), *keys))
        return bounded.withColumn("_nth", nth).where(F.col("_nth") <= most).select(*NAME, *keys)

    top = best(bounds_below(left, left, spans, ("block",), LEVELS[0]), LEVELS[0], SEED_SPANS)
    seeds = best(bounds_below(top, left, chunks, LEVELS[0], LEVELS[1]), LEVELS[1], SEEDS)
    seeds = materialize(seeds.select(*NAME, "gid", F.lit(0.0).alias("floor")), "fuzzy_seeds")
    first = search_groups(seeds, members, floors=True)
    floor = materialize(first.groupBy(*NAME).agg(F.max("score").alias("floor")), "fuzzy_floors")

    # 2) open, level by level, only the nodes whose bound reaches the floor
    def reach(bounded: DataFrame) -> DataFrame:
        return (bounded.join(floor, list(NAME), "left")
                .where(F.col("ub") + 1e-9 >= F.coalesce(F.col("floor"), F.lit(0.0))))

    alive = reach(bounds_below(left, left, spans, ("block",), LEVELS[0])).select(*NAME, *LEVELS[0])
    alive = reach(bounds_below(alive, left, chunks, LEVELS[0], LEVELS[1]))
    alive = materialize(alive.select(*NAME, "gid", F.coalesce(F.col("floor"), F.lit(0.0)).alias("floor")), "fuzzy_alive")
    scored = search_groups(alive, members)
    if report is not None:
        scored = materialize(scored, "fuzzy_scored")
        blocks = master.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
        report["block_pairs"] = left.join(blocks, "block").agg(F.sum("n")).first()[0] or 0
        report["scored_pairs"] = scored.agg(F.sum("scored")).first()[0] or 0
    scored = scored.where("score > 0")
    winner = F.struct((-F.col("score")).alias("neg"), *TIE_COLUMNS)
    best_of = scored.groupBy(*NAME).agg(F.min(winner).alias("w"))
    # (a row without a code has no match)
    best_of = rows.where(F.col("a_id").isNotNull()).join(best_of, list(NAME)).groupBy(*ROW).agg(F.min("w").alias("w"))
    return (best_of.where(F.col("w.neg") < 0)
            .select(F.col("a_id").alias("subdistrict_a"), *([F.col("a").alias("names_a")] if names else []),
                    F.col(f"w.{MASTER_ID}").alias("subdistrict_b"), (-F.col("w.neg")).alias("similarity_score")))


def searched_rows(left_only: DataFrame, only_codes: tuple[str, ...] | None) -> DataFrame:
    return left_only if only_codes is None else left_only.where(F.col("subdistrict_code").isin(*only_codes))


def unmatched(left_only: DataFrame, fuzzy: DataFrame, only_codes: tuple[str, ...] | None = None) -> DataFrame:
    """Region rows that were searched and got no match, with the reason: a missing name,
    or no master row in their block with anything in common.  A row is its code and its
    names, so ``fuzzy`` is a match with ``names``; ``only_codes`` as for the search (rows that
    it left out were not searched)."""
    found = fuzzy.select(F.col("subdistrict_a").alias("a_id"), F.col("names_a").alias("a")).distinct()
    rows = joined_left(searched_rows(left_only, only_codes))
    # (a missing name is in no match, and a null never equals one)
    lost = rows.join(found, list(ROW), "left_anti")
    return lost.select(F.col("a_id").alias("subdistrict_code"),
                       F.when(F.col("a").isNull(), "missing name").otherwise("no candidate").alias("reason"))


# --- merge ----------------------------------------------------------------------

def merge_matches(mapped: DataFrame, fuzzy: DataFrame, region: DataFrame,
                  master: DataFrame) -> DataFrame:
    """Exact pairs (score 1) and fuzzy pairs, each joined back to the region
    row and the full master row, in the output column order."""
    carried = master.select(MASTER_ID, *MASTER_CARRIED)
    exact = (mapped.join(region, "subdistrict_code").join(carried, MASTER_ID)
             .withColumn("similarity_score", F.lit(1.0)))
    near = (fuzzy.withColumnRenamed("subdistrict_a", "subdistrict_code")
            .withColumnRenamed("subdistrict_b", MASTER_ID)
            .join(region, "subdistrict_code").join(carried, MASTER_ID))
    return exact.select(*OUTPUT_COLUMNS).unionByName(near.select(*OUTPUT_COLUMNS))
