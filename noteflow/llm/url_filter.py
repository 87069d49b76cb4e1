"""URL rules by a cascade of Bloom filters, in DataFrame operations only.

A rule is a host and the beginning of a path. Its key is both, written one after the other. The keys that a
URL could be listed under are known beforehand: the last n labels of its host with the first m characters
of its path, for every pair (n, m) that some rule has. All keys of all URLs are the universe.

Level 0 of the cascade encodes the listed keys. Level 1 encodes the keys of the universe that level 0 takes
for listed ones and that are not. Level 2 encodes the listed keys that level 1 takes for unlisted ones, and
so on, until a level has no false positives. A key is then listed if the first level that does not hold it
has an odd number, or, if all hold it, if the last level has an even one. That answer is exact for every key of the
universe, so the URLs are judged where they lie, without a join: the longest listed key of a URL is its rule. A second cascade, whose
universe is the list itself, tells which rules block.

The filters are literals in the plan. Their size depends on the list: about 1.44 bits for each listed key and
each halving of the false positives, which level 0 lowers to about the number of listed keys. ``MOST_BITS`` bounds the
size of a level; a longer list is dealt by hash into lists that keep the bound, each with its own cascade.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noteflow.llm.store import Scratch

ALLOW, BLOCK = "allow", "block"
#: The rules of the registered query.
RULES = [("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK), ("com", "/fr/", ALLOW), ("com", "/de/", BLOCK)]
#: Bits of one level: 16 MB.
MOST_BITS = 1 << 27
#: A level without an end would mean that two keys share all their hashes at every level.
MOST_LEVELS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; empty without ``://`` and for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


class Level:
    """A Bloom filter as words of 63 bits in a literal of the plan."""

    def __init__(self, number: int, salt: int, bits: int, hashes: int):
        self.number, self.salt, self.bits, self.hashes, self.words = number, salt, bits, hashes, None

    def _spots(self, key: Column) -> list[Column]:
        a, b = (F.pmod(F.xxhash64(F.lit(self.salt), F.lit(side), F.lit(self.number), key), F.lit(self.bits)) for side in (0, 1))
        return [F.pmod(a + F.lit(i) * b + F.lit(i * i), F.lit(self.bits)) for i in range(self.hashes)]

    def fill(self, keys: DataFrame) -> Level:
        """Encodes column ``key``. One task's part of the bits is summed up before it travels."""
        spots = keys.select(F.explode(F.array(*self._spots(F.col("key")))).alias("spot")).distinct()
        words = spots.groupBy((F.col("spot") / 63).cast("long").alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("spot", F.lit(63)).cast("int"))).alias("word"))
        # At most MOST_BITS / 63 rows, made from the list alone.
        there = {r["at"]: r["word"] for r in words.collect()}
        text = ",".join(str(there.get(i, 0)) for i in range(-(-self.bits // 63)))
        self.words = F.split(F.lit(text), ",").cast("array<bigint>")
        return self

    def holds(self, key: Column) -> Column:
        # The words are named once, so that the plan holds them once.
        word = lambda spot: F.get(self.words, (spot / 63).cast("int"))
        return F.forall(F.array(*self._spots(key)), lambda spot: F.bit_get(word(spot), F.pmod(spot, F.lit(63)).cast("int")) == 1)


class Cascade:
    """Exact membership in the listed keys, for all keys of a universe."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def holds(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(level.holds(key), answer).otherwise(F.lit(level.number % 2 == 1))
        return answer


def cascade(listed: DataFrame, universe: Column, rows: DataFrame, size: int, scratch: Scratch, tag: str, salt: int = 0, rate: float | None = None) -> Cascade:
    """``listed`` has the distinct ``key``s. ``universe`` is an array of keys over ``rows``, ``size`` of them with repeats.

    The rows are read once, for the false positives of level 0. ``rate`` overrides the chance of one.
    """
    n = listed.count()
    if n == 0:
        return Cascade([])
    rate = min(0.5, n / (math.sqrt(2) * max(1, size))) if rate is None else rate
    level = Level(0, salt, *_shape(n, rate)).fill(listed)
    levels, inside = [level], listed
    # Repeats of a key go before the shuffle; what is left is the list and about as many others.
    taken = rows.select(F.explode(F.filter(universe, level.holds)).alias("key")).distinct()
    outside = scratch.keep(taken.join(listed, "key", "left_anti"), f"{tag}1")
    while (n := outside.count()) > 0:
        if len(levels) == MOST_LEVELS:
            raise RuntimeError(f"keys could not be told apart in {MOST_LEVELS} levels")
        level = Level(len(levels), salt, *_shape(n, 0.5)).fill(outside)
        levels.append(level)
        inside, outside = outside, scratch.keep(inside.filter(level.holds(F.col("key"))), f"{tag}{len(levels)}")
    return Cascade(levels)


def _shape(n: int, rate: float) -> tuple[int, int]:
    """Bits and hash functions for n keys at this chance of a false positive."""
    return max(64, math.ceil(n * math.log2(1 / rate) / math.log(2))), max(1, round(math.log2(1 / rate)))


def usable(rules: DataFrame) -> DataFrame:
    """(key, host, path, blocks) of all rules that can fit a URL; of two on one key, the blocking one counts.

    Hosts are lower-cased. Rules with a null, with another action than allow or block, or with a path that does
    not begin with a slash are left out.
    """
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.col("path").alias("path"), F.col("action").alias("action"))
    rules = rules.filter(F.col("host").isNotNull() & F.col("path").rlike(r"\A(?:/|\z)") & F.col("action").isin(ALLOW, BLOCK))
    return rules.groupBy(F.concat("host", "path").alias("key"), "host", "path").agg(F.max(F.col("action") == BLOCK).alias("blocks"))


def _candidates(at_host: Column, at_path: Column, shapes: list[tuple[int, int]]) -> Column:
    """All keys of the shapes (labels of the host, characters of the path) that this URL has."""
    made = [
        F.when((F.char_length(at_path) >= chars) & (F.size(F.split(at_host, r"\.", -1)) >= labels), F.concat(F.substring_index(at_host, ".", -labels), F.substring(at_path, 1, chars)))
        for labels, chars in shapes
    ]
    return F.array_compact(F.array(*made)) if made else F.array().cast("array<string>")


def judge(
    pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", default: str = ALLOW,
    most_bits: int = MOST_BITS, rate: float | None = None,
) -> DataFrame:
    """One row for each page: page_id, host, path, rule, verdict.

    ``rules`` has host, path and action. A rule fits its host and all subdomains, if the page's path begins with the
    rule's; the longest (host and path together, then the host) wins. A page without a rule is not listed and gets
    ``default``. A null URL, an empty one and one without ``://`` have an empty host and path. Repeated rows are each
    judged, null ids are kept; other columns are ignored; an empty table gives an empty result, an empty list of rules
    leaves every page unlisted.
    """
    scratch = Scratch(pages.sparkSession, "urlfilter")
    listed = scratch.keep(usable(rules), "rules")
    shape = listed.select(F.size(F.split("host", r"\.", -1)).alias("labels"), F.char_length("path").alias("chars"))
    # Pairs of small numbers: at most the labels of a host times the characters of a path.
    shapes = sorted((r["labels"], r["chars"]) for r in shape.distinct().collect())
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("_url"))
    rows = rows.select("page_id", host(F.col("_url")).alias("host"), path(F.col("_url")).alias("path"))
    rows = rows.withColumn("_keys", _candidates(F.col("host"), F.col("path"), shapes))
    size = rows.agg(F.sum(F.size("_keys"))).first()[0] or 0
    n = listed.count()
    bits = _shape(max(1, n), min(0.5, n / (math.sqrt(2) * max(1, size))) if n and rate is None else rate or 0.5)[0]
    parts = -(-bits // most_bits)
    part = lambda key: F.pmod(F.xxhash64(F.lit("part"), key), F.lit(parts))
    known, blocks = [], []
    for k in range(parts):
        mine = listed.filter(part(F.col("key")) == k)
        here = F.filter("_keys", lambda key: part(key) == k)  # noqa: B023 - called at once
        known.append(cascade(mine.select("key"), here, rows, size, scratch, f"listed{k}-", 2 * k, rate))
        blocks.append(cascade(mine.filter("blocks").select("key"), F.array("key"), mine, n, scratch, f"blocks{k}-", 2 * k + 1, 0.5))

    def told(cascades: list[Cascade], key: Column) -> Column:
        answer = cascades[-1].holds(key)
        for k, one in enumerate(cascades[:-1]):
            answer = F.when(part(key) == k, one.holds(key)).otherwise(answer)
        return answer

    found = F.filter("_keys", lambda key: told(known, key))
    best = F.array_max(F.transform(found, lambda key: F.struct(F.char_length(key), F.char_length(F.substring_index(key, "/", 1)), key.alias("key"))))
    rows = rows.withColumn("rule", best["key"])
    verdict = F.when(F.col("rule").isNull(), F.lit(default)).when(told(blocks, F.col("rule")), BLOCK).otherwise(ALLOW)
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def filter_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


ORACLE = r"""
WITH r(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), p AS (
  SELECT row_number() OVER () AS rid, page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), fit AS (
  SELECT p.rid, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.rid
)
SELECT p.page_id, p.host, p.path, fit.rule, coalesce(fit.verdict, 'allow') AS verdict FROM p LEFT JOIN fit ON p.rid = fit.rid
"""
