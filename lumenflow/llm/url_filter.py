"""URL filters by Bloom filter cascades, in DataFrame functions only.

A rule names a host and a path prefix; it fits the host and its subdomains.
A url's keys are all its host suffixes joined to its path's prefixes of the
lengths that occur among the rules; a rule fits if it is one of the keys.  So
the rule list is a set of listed keys, and the question is exact membership.

Cascade: level 1 is a Bloom filter of the listed keys; level 2 of the keys of
the corpus that level 1 takes wrongly; level 3 of the listed keys that level 2
takes; and so on until a level takes nothing wrongly.  As the levels are built
against every key that occurs in the corpus, membership of such a key is exact.
Level 1 has a false positive rate of about (listed / 1.4) / universe and the
rest halve what is left, so a cascade has about listed x (1.44 log2(universe /
listed) + 5) bits: it is bounded by the list, which is a parameter, and grows
with the logarithm of the corpus.  Membership is a constant array and
arithmetic inside the scan's projection: no join, no shuffle.

Defined results: host and path of a null url, or one without ``://``, are
empty, and no rule fits; only A-Z are lower-cased; the longest rule wins (equal
length: the longer host, then the later in text order); a rule listed with both
verdicts blocks; a url that no rule fits gets ``default``; rows repeat as they
come; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenflow.session import materialize

Rule = tuple[str, str, str]      # host, path prefix, "block" or "allow"


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    link = F.col(url).cast("string")
    after = F.when(F.instr(link, "://") > 0, F.substring(link, F.instr(link, "://") + F.lit(3), F.length(link)))
    rest = F.coalesce(after, F.lit(""))
    named = F.regexp_extract(rest, "^([^/?#]*)", 1)
    tail = F.substring(rest, F.length(named) + F.lit(1), F.length(rest))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return pages.withColumns({"host": F.translate(named, upper, lower),
                              "path": F.regexp_extract(tail, "^([^?#]*)", 1)})


def url_keys(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """Every (host suffix + path prefix) that a rule could be."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    heads = F.array_compact(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]))
    return F.array_distinct(F.flatten(F.transform(suffixes, lambda s: F.transform(heads, lambda h: F.concat(s, h)))))


@dataclass(frozen=True)
class Level:
    """``words``: 64 bits each; ``hashes``: positions that a key sets."""
    number: int
    bits: int
    hashes: int
    words: tuple[int, ...] = ()

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(i)), F.lit(self.bits))
                for i in range(self.hashes)]

    def takes(self, key: Column) -> Column:
        # one folded literal, however many words there are
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        found = F.lit(True)
        for at in self.positions(key):
            word = F.element_at(words, (F.floor(at / 64) + 1).cast("int"))
            found = found & (F.bit_get(word, F.pmod(at, F.lit(64)).cast("int")) == 1)
        return found

    def filled(self, keys: DataFrame) -> "Level":
        """This level with the bits of ``keys(key)`` set."""
        at = keys.select(F.explode(F.array(*self.positions(F.col("key")))).alias("at"))
        rows = (at.groupBy(F.floor(F.col("at") / 64).alias("word"))
                .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(at, 64) as int))")).alias("bits")).collect())
        words = [0] * (-(-self.bits // 64))
        for r in rows:
            words[r["word"]] = r["bits"]
        return Level(self.number, self.bits, self.hashes, tuple(words))


def _level(number: int, keys: int, rate: float) -> Level:
    """An empty level for so many keys at a false positive rate."""
    return Level(number, max(64, math.ceil(keys * math.log2(1 / rate) / math.log(2))),
                 max(1, round(math.log2(1 / rate))))


def build_cascade(universe: DataFrame, listed: Sequence[str]) -> list[Level]:
    """Levels for ``listed`` over every key of ``universe(key)``.

    The universe is read twice (its size, the keys that level 1 takes wrongly).
    What a level takes wrongly is written, and later levels see only that.
    """
    listed = sorted(set(listed))
    if not listed:
        return []
    spark = universe.sparkSession
    size = universe.agg(F.approx_count_distinct("key")).first()[0]       # for the size of level 1 only
    inside = spark.createDataFrame([(k,) for k in listed], "key string")
    levels: list[Level] = []
    mine, other, count = inside, universe.join(inside, "key", "left_anti"), len(listed)
    rate = min(0.5, len(listed) * math.sqrt(0.5) / max(size, 1))
    while count:
        level = _level(len(levels), count, rate).filled(mine)
        levels.append(level)
        wrong = materialize(other.where(level.takes(F.col("key"))).distinct(), "wrongly_taken")
        count, rate = wrong.count(), 0.5
        mine, other = wrong, mine
    return levels


def member(levels: Sequence[Level], key: Column) -> Column:
    """Whether ``key`` is listed: in 1 and not (in 2 and not (in 3 ...))."""
    found = F.lit(False)
    for level in reversed(levels):
        found = level.takes(key) & ~found
    return found


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (null: none) and verdict; columns of these
    names in ``pages`` are replaced."""
    lengths = sorted({len(path) for _, path, _ in rules})
    parsed = with_host_and_path(pages, url)
    keys = url_keys(F.col("host"), F.col("path"), lengths) if rules else F.array().cast("array<string>")
    universe = parsed.select(F.explode(keys).alias("key"))
    blocked = build_cascade(universe, [h + p for h, p, v in rules if v == "block"])
    allowed = build_cascade(universe, [h + p for h, p, v in rules if v == "allow"])
    hits = F.filter(keys, lambda k: member(blocked, k) | member(allowed, k))
    longest = F.array_max(F.transform(hits, lambda k: F.struct(
        F.length(k).alias("n"), F.length(F.substring_index(k, "/", 1)).alias("host"), k.alias("rule"))))
    ruled = parsed.withColumn("rule", longest["rule"])
    verdict = (F.when(F.col("rule").isNull(), F.lit(default))
               .when(member(blocked, F.col("rule")), F.lit("block")).otherwise(F.lit("allow")))
    return ruled.withColumn("verdict", verdict)
