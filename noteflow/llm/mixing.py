"""Mixing sources to target weights by Pareto order sampling.

A source with target T and size S (both in words) wants every document T/S times. The whole copies,
floor(T/S), are certain. The remaining fraction f is drawn: each document gets a fixed random number u in
(0, 1) and the rank value (u / (1 - u)) / (f / (1 - f)), its random odds over its inclusion odds;
documents are taken in the order of that value until the words of the source reach its target. So the
size of the sample is fixed in words, inclusion differs between sources, and reruns agree, since u comes
from a digest of id and text.

No task sorts a source: u is cut into ``BLOCKS`` equal blocks, sums per (source, block) show the one block
where a source reaches its target, and only that block is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noteflow.llm.store import Scratch, documents, named_rows, row_name
from noteflow.operators.scan import global_rank, join_dimension

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: No source is taken more than so many times.
MOST = 3
SEED = 20
BLOCKS = 4096


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _chance(doc_id: Column, text: Column, seed: int) -> Column:
    """Uniform in (0, 1) with 52 bits, from a digest."""
    name = F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))
    bits = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``target`` to (source, source_size), one row per source.

    Sources share the sum of all sizes by weight; a target above ``most`` times its source's size stops
    there and the excess is shared again by weight, until none is above.
    """
    ranked = global_rank(sizes.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "_rank").drop("_null")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    table = scratch.keep(ranked.select("source", "source_size", weight.cast("long").alias("_w")), "weights")
    cap, level = F.col("source_size") * most, 0.0
    while True:
        # What a source can hold at this level grows with the level, so capped sources stay capped.
        held = F.lit(level) * F.col("_w") > cap
        r = table.agg(F.sum("source_size").alias("all"), F.sum(F.when(held, cap).otherwise(0)).alias("capped"), F.sum(F.when(held, 0).otherwise(F.col("_w"))).alias("free")).first()
        raised = (r["all"] - r["capped"]) / r["free"] if r["free"] else level
        if raised <= level:
            break
        level = raised
    return table.select("source", "source_size", F.least(cap.cast("double"), F.lit(level) * F.col("_w")).alias("target"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED, blocks: int = BLOCKS,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, taken, copies, _d, _k (see ``row_name``).

    Size is the number of words, 0 for null text; such documents are never taken. A null source is one
    source, the last. Of rows that agree in id and text each counts; which of them is drawn at the edge
    does not show. The document at the edge is taken if that brings the source closer to its target, so
    a source is off by half of that document at most. An empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    key, body = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    rows = scratch.keep(docs.select(
        key.cast("long").alias("doc_id"), F.col(f"`{source}`").alias("source"), words(body).alias("size"),
        _chance(key, body, seed).alias("u"), *[c.alias(n) for n, c in row_name(key, body).items()],
    ).withColumn("block", F.floor(F.col("u") * blocks).cast("int")), "rows")

    # All sizes of a source in BLOCKS + 1 rows at most, summed in the map tasks first.
    sums = scratch.keep(rows.groupBy("source", "block").agg(F.sum("size").alias("words")), "sums")
    sizes = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = targets(sizes, scratch, weights, most)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("whole", F.floor(ratio).cast("long")).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = scratch.keep(plan.withColumn("sid", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))), "plan")
    sid = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    before = F.sum("words").over(Window.partitionBy("sid").orderBy("block")) - F.col("words")
    cuts = sums.withColumn("sid", sid).join(plan.select("sid", "rest"), "sid").withColumn("before", before)
    cuts = cuts.filter((F.col("before") < F.col("rest"))).groupBy("sid").agg(F.max_by(F.struct("block", "before"), "block").alias("cut"))
    plan = scratch.keep(plan.drop("source").join(cuts, "sid", "left").select("sid", "source_size", "target", "whole", "rest", F.coalesce("cut.block", F.lit(-1)).alias("cut"), F.coalesce("cut.before", F.lit(0)).alias("before")), "cuts")

    told = join_dimension(rows.withColumn("sid", sid), plan, ["sid"])
    clear = told.filter("block <> cut").withColumn("drawn", F.col("block") < F.col("cut"))
    odds = F.col("rest") / F.col("source_size")
    value = (F.col("u") / (1 - F.col("u"))) / F.when(odds < 1, odds / (1 - odds)).otherwise(F.lit(1.0))
    order = Window.partitionBy("sid").orderBy("value", F.col("doc_id").asc_nulls_last(), "_k")
    edge = told.filter("block = cut").withColumn("value", value)
    edge = edge.withColumn("upto", F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    short, over = F.col("rest") - (F.col("upto") - F.col("size")), F.col("upto") - F.col("rest")
    edge = edge.withColumn("drawn", (over <= 0) | ((short > 0) & (over < short)))
    out = clear.unionByName(edge.drop("value", "upto"))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("drawn").cast("long")).otherwise(F.lit(0).cast("long"))
    return out.withColumn("copies", copies).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "_d", "_k"
    )


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix, each as often as it is taken; columns as in ``docs``.

    Rows that agree in id and text share their copies evenly.
    """
    rows, t = named_rows(docs, doc_id, text)
    key = [f"{t}d", f"{t}k"]
    copies = mix(docs, doc_id=doc_id, text=text, source=source).groupBy(F.col("_d").alias(key[0]), F.col("_k").alias(key[1]))
    copies = copies.agg(F.sum("copies").alias(f"{t}copies"), F.count(F.lit(1)).alias(f"{t}rows"))
    rows = rows.join(copies.filter(F.col(f"{t}copies") > 0), key)
    total, equal = F.col(f"{t}copies"), F.col(f"{t}rows")
    place = F.row_number().over(Window.partitionBy(*key).orderBy(equal))
    share = F.floor(total / equal) + (place <= total % equal).cast("long")
    rows = rows.withColumn(f"{t}share", share).filter(F.col(f"{t}share") > 0)
    rows = rows.withColumn(f"{t}copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{t}share"))))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_rows(docs)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         (('0x' || substr(md5(concat('20|', coalesce(doc_id::VARCHAR, ''), '|', coalesce(text, ''))), 1, 13))::BIGINT + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS w FROM s
), c AS (
  SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS k,
         coalesce(sum(3 * source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
         sum(source_size) OVER () AS total
  FROM w
), l AS (
  SELECT (total - capped)::DOUBLE / free::DOUBLE AS level FROM c WHERE (total - capped)::DOUBLE / free * w <= 3 * source_size ORDER BY k LIMIT 1
), t AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, level * w) AS target FROM w, l
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t
), o AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u, d.doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE (whole + CASE WHEN upto <= rest OR (upto - size < rest AND upto - rest < rest - (upto - size)) THEN 1 ELSE 0 END) * size END::BIGINT AS taken
FROM o
"""
