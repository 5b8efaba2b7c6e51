"""Quality rules in DataFrame functions: counts of a text, and a hashed n-gram
log-likelihood ratio between trusted text and the whole corpus.

The word unigrams and bigrams of a text fall into ``BUCKETS`` hash buckets.
Two multinomials over the buckets are estimated, one from the documents
labelled good (the trusted target), one from every word of every
document (the raw corpus); both are smoothed by ``PRIOR`` target counts a
bucket, spread as in the raw corpus.  A text's score is the mean over its
n-grams of log(target / raw), so its length does not matter.  A text is kept if
its score reaches the cut.  The cut comes from the labelled documents that the
target did not see (half of them, by a hash of the id): the one that best parts good
from bad, but no higher than the ``LOW`` quantile of the good ones.  Every labelled
document is in one of the two halves.  The labels are joined by a shuffle to which only
the texts go whose id may be a target's, by a bitmap of ``MARKS`` bits over the hashed
ids; the others can't be in the target.  The cut is found by prefix sums over ranges of
the scores.  Neither is bounded by a task or the driver.

All of it is column expressions: the words are an array in the row, nothing is
exploded but for the corpus's bucket counts, which are summed before they are
shuffled (at most ``BUCKETS`` rows a task).

Defined results: null and empty texts have no words and fail the base rules;
rows repeat as they come; without labelled good documents the cut is minus
infinity (the base rules alone decide); an empty table gives none; other
columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.session import materialize

BUCKETS = 1 << 15
PRIOR = 2.0                 # pseudo-count of a bucket
MARKS = 1 << 24             # bits that tell texts outside the target apart before the join
LOW = 0.005                 # share of good documents that the cut may cost at most
MIN_WORDS = 50
MAX_REPEATED = 50           # per cent

_SPACES = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), _SPACES), "")


def with_words(docs: DataFrame) -> DataFrame:
    """(doc_id, text, words, hashes): ``hashes`` are those of the words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("words", words(F.col("text")))
    return rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def base_counts(rows: DataFrame) -> DataFrame:
    """``with_words`` rows with the counts of each text.

    Repeated words: sorting (hash, position) of the three-word windows puts
    equal ones side by side; the positions that have an equal neighbour, in
    order, cover min(3, gap to the next) words each, and the last one three."""
    hashes = F.col("hashes")
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long"),
        "_lines": lines,
        "_windows": F.when(F.size(hashes) >= 3, F.transform(
            F.sequence(F.lit(0), F.size(hashes) - 3),
            lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)))),
    })
    out = out.withColumns({
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        # only texts in which a window occurs again are sorted
        "_placed": F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(
            F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    })
    placed = F.col("_placed")
    out = out.withColumn("_twice", F.sort_array(F.transform(
        F.filter(placed, lambda x, k: F.coalesce(x["h"] == F.get(placed, k + 1)["h"], F.lit(False))
                 | F.coalesce(x["h"] == F.get(placed, k - 1)["h"], F.lit(False))),
        lambda x: x["i"])))
    twice = F.col("_twice")
    covered = F.aggregate(
        F.transform(twice, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(twice, k + 1) - p, F.lit(3)))),
        F.lit(0), lambda a, b: a + b)
    return (out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .drop("_lines", "_windows", "_placed", "_twice"))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEATED * n_words)


def _buckets(hashes: Column) -> Column:
    """Bucket of every unigram and bigram."""
    one = F.transform(hashes, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))
    two = F.when(F.size(hashes) >= 2, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - 2),
        lambda i: F.pmod(F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1)), F.lit(BUCKETS)).cast("int")))
    return F.concat(one, F.coalesce(two, F.array().cast("array<int>")))


@dataclass(frozen=True)
class Model:
    ratios: tuple[float, ...]       # log(target / raw) of each bucket
    cut: float

    def score(self, hashes: Column) -> Column:
        """Mean log ratio of a text's n-grams; null without words."""
        table = F.split(F.lit(",".join(map(repr, self.ratios))), ",").cast("array<double>")   # one folded literal
        n = F.size(hashes)
        total = F.aggregate(_buckets(hashes), F.lit(0.0), lambda a, b: a + F.get(table, b))
        return F.when(n > 0, total / (2 * n - 1))


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, good, held) of every labelled document; ``held`` marks the half that is
    not counted but sets the cut."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("good"))
              .where("doc_id is not null and good is not null")
              .groupBy("doc_id").agg(F.min("good").alias("good")).where("good in (0, 1)"))
    return marked.withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0)


def parted(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``doc_id`` may be among ``ids`` (all that are, and few others while
    there are far fewer ids than ``MARKS``), and those whose isn't."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(MARKS))
    part, at = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    # at most MARKS / 32,768 rows of 4 KB
    bits = ids.groupBy(part.alias("_part")).agg(F.bitmap_construct_agg(at).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    asked = rows.withColumn("_part", part).join(F.broadcast(bits), "_part", "left")
    return asked.where(maybe).select(*rows.columns), asked.where(~maybe).select(*rows.columns)


def learn(docs: DataFrame, marked: DataFrame) -> Model | None:
    """The ratios, without a cut; None without good documents to learn from."""
    target = marked.where((F.col("good") == 1) & ~F.col("held")).select("doc_id", F.lit(1).alias("target"))
    asked, others = parted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), target)
    # the texts are joined, as the words' hashes are larger; by a merge at any size, as
    # the ids grow with the corpus and outgrow a broadcast
    texts = (asked.join(target.hint("merge"), "doc_id", "left").select("target", "text")
             .union(others.select(F.lit(None).cast("int").alias("target"), "text")))
    rows = texts.select("target", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("hashes"))
    counts = (rows.select(F.explode(_buckets(F.col("hashes"))).alias("bucket"), "target")
              .groupBy("bucket").agg(F.count("*").alias("raw"), F.count("target").alias("target"))
              .collect())                               # at most BUCKETS rows
    n_raw, n_target = sum(r["raw"] for r in counts), sum(r["target"] for r in counts)
    if not n_target:
        return None
    ratios = [0.0] * BUCKETS
    for r in counts:
        ratios[r["bucket"]] = round(math.log((r["target"] + PRIOR) / (r["raw"] * n_target / n_raw + PRIOR)), 9)
    return Model(tuple(ratios), -math.inf)


def held_cut(scored: DataFrame, marked: DataFrame) -> float:
    """The cut from the held documents among ``scored`` rows (``doc_id, base_failed, score``)."""
    tried = scored.where("not base_failed and score is not null").select("doc_id", "score")
    return cut_of(tried.join(marked.where("held"), "doc_id").select("score", "good"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    marked = labelled(labels)
    model = learn(docs, marked)
    if model is None:
        return Model((0.0,) * BUCKETS, -math.inf)
    scored = materialize(judge(docs, model).select("doc_id", "base_failed", "score"), "quality_scores")
    return Model(model.ratios, held_cut(scored, marked))


def fit_and_judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``judge`` with the model that ``fit`` gives; the texts are scored once, for the cut
    and the verdicts."""
    marked = labelled(labels)
    model = learn(docs, marked)
    if model is None:
        return judge(docs, Model((0.0,) * BUCKETS, -math.inf))
    scored = materialize(judge(docs, model), "quality_scores")
    return scored.withColumn("kept", _kept(F.col("base_failed"), F.col("score"), held_cut(scored, marked)))


def cut_of(scored: DataFrame) -> float:
    """``best_cut`` of ``(score, good)`` rows: prefix sums over ranges of the scores."""
    good, bad = F.sum("good").cast("long"), F.sum(1 - F.col("good")).cast("long")
    by_score = scored.groupBy("score").agg(good.alias("g"), bad.alias("b"))
    ranges = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_score = materialize(by_score.repartitionByRange(ranges, "score").withColumn("part", F.spark_partition_id()), "scores")
    # a row per range
    sums = by_score.groupBy("part").agg(F.sum("g").alias("g"), F.sum("b").alias("b"), F.max("score").alias("top")).orderBy("part").collect()
    n_good, n_bad = sum(r["g"] for r in sums), sum(r["b"] for r in sums)
    if not n_good or not n_bad:
        return -math.inf
    before, g, b, top = [], 0, 0, None
    for r in sums:
        before.append((r["part"], g, b, top))
        g, b, top = g + r["g"], b + r["b"], r["top"]
    starts = scored.sparkSession.createDataFrame(before, "part int, g0 long, b0 long, top double")
    line = Window.partitionBy("part").orderBy("score")
    here = by_score.join(starts, "part").select(
        "score", (F.col("g0") + F.sum("g").over(line)).alias("upto"),
        (F.col("g0") + F.sum("g").over(line) - F.col("g")).alias("lost"),
        (F.col("b0") + F.sum("b").over(line) - F.col("b")).alias("dropped"),
        F.coalesce(F.lag("score").over(line), "top").alias("last"))
    gain = (n_good - F.col("lost")) / F.lit(float(n_good)) + F.col("dropped") / F.lit(float(n_bad))
    found = here.agg(
        F.max(F.when(F.col("last").isNotNull() & (gain > 1.0), F.struct(
            gain.alias("gain"), (-F.col("score")).alias("first"), F.col("last")))).alias("best"),
        F.min(F.when(F.col("upto") > int(LOW * n_good), F.col("score"))).alias("low")).first()
    best = found["best"]
    return min((best["last"] - best["first"]) / 2 if best else -math.inf, found["low"])


def best_cut(scored: list[tuple[float, int]]) -> float:
    """Midway between the two neighbouring scores that part good from bad best
    (share of good kept plus share of bad dropped), not above the good ones'
    ``LOW`` quantile; minus infinity without both classes."""
    good = sorted(s for s, label in scored if label == 1)
    bad = sum(1 for _, label in scored if label == 0)
    if not good or not bad:
        return -math.inf
    best, cut, kept, dropped, last = 1.0, -math.inf, len(good), 0, None
    for score, label in sorted(scored):
        if last is not None and score > last:
            gain = kept / len(good) + dropped / bad
            if gain > best:
                best, cut = gain, (last + score) / 2
        kept, dropped, last = kept - (label == 1), dropped + (label == 0), score
    return min(cut, good[int(LOW * len(good))])


def _kept(failed: Column, score: Column, cut: float) -> Column:
    return ~failed & F.coalesce(score >= F.lit(cut), F.lit(False))


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: the counts, base_failed, score, kept."""
    rows = base_counts(with_words(docs)).withColumn("score", model.score(F.col("hashes")))
    # never false; as it isn't deterministic, a later filter stays above this
    # projection instead of being rewritten in terms of the arrays below it
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words")) & (F.monotonically_increasing_id() >= 0)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), _kept(failed, F.col("score"), model.cut).alias("kept"), "score")
