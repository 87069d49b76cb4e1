"""Token counts from an exact length histogram.

Documents are encoded whole and aggregated by encoded length. Suffix sums over the lengths then answer, for
every context limit, how many documents and tokens there are, how many tokens remain when documents are
truncated to it, and which share of the documents fits.

The sums are made in two steps: inside blocks of lengths, and over one row per block. The number of rows
depends on the longest document, not on the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noteflow.llm.store import Scratch, documents
from noteflow.llm.tokens import encoded

LENGTHS_PER_BLOCK = 1024


def lengths(docs: DataFrame, by: list[str], text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``by`` columns and n_tokens of each document; null text has none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids in encoded(batches, vocabulary):
            sizes = pa.array(np.fromiter((len(x) for x in ids), np.int64, batch.num_rows), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sizes], names=[*batch.schema.names[:-1], "n_tokens"])

    rows = docs.select(*[F.col(f"`{c}`").alias(f"_by{k}") for k, c in enumerate(by)], F.col(f"`{text}`").alias("text"))
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["n_tokens long"])
    return rows.mapInArrow(count, schema)


def histogram(docs: DataFrame, by: tuple[str, ...] = (), text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row for each length that occurs (in each group of ``by``).

    n_tokens; docs of that length; docs_from and tokens_from in documents of at least that length;
    tokens_total; truncated_total, if documents are cut to n_tokens; share_within, the part of the
    documents of at most that length. Null text counts as length 0, nulls in ``by`` are a group, repeated
    rows count each, and an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "tokencounts")
    keys = [f"_by{k}" for k in range(len(by))]
    counts = lengths(docs, list(by), text, vocabulary).groupBy(*keys, "n_tokens").agg(F.count(F.lit(1)).alias("docs"))
    block = F.floor(F.col("n_tokens") / LENGTHS_PER_BLOCK).cast("long").alias("block")
    counts = scratch.keep(counts.select("*", block), "counts")
    group = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys] + [F.concat_ws(",", *[F.col(k).isNull().cast("string") for k in keys])]
    counts = counts.withColumn("_group", F.array(*group))
    blocks = counts.groupBy("_group", "block").agg(F.sum("docs").alias("d"), F.sum(F.col("docs") * F.col("n_tokens")).alias("t"))
    after = Window.partitionBy("_group").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    full = Window.partitionBy("_group")
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        "_group", "block", F.coalesce(F.sum("d").over(after), zero).alias("d_after"), F.coalesce(F.sum("t").over(after), zero).alias("t_after"),
        F.sum("d").over(full).alias("docs_total"), F.sum("t").over(full).alias("tokens_total"),
    )
    here = Window.partitionBy("_group", "block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    out = counts.withColumns({"d": F.sum("docs").over(here), "t": F.sum(F.col("docs") * F.col("n_tokens")).over(here)}).join(blocks, ["_group", "block"])
    docs_from, tokens_from = F.col("d") + F.col("d_after"), F.col("t") + F.col("t_after")
    return out.select(
        *[F.col(k).alias(c) for k, c in zip(keys, by)], "n_tokens", "docs", docs_from.alias("docs_from"), tokens_from.alias("tokens_from"), "tokens_total",
        (F.col("tokens_total") - tokens_from + F.col("n_tokens") * docs_from).alias("truncated_total"),
        ((F.col("docs_total") - docs_from + F.col("docs")) / F.col("docs_total")).alias("share_within"),
    )


def at_limits(hist: DataFrame, limits: list[int], by: tuple[str, ...] = ()) -> DataFrame:
    """(by, limit, docs_over, truncated_total) for any context limits, read off a histogram."""
    limit = F.explode(F.array(*[F.lit(x).cast("long") for x in limits])).alias("limit")
    rows = hist.select(*by, "n_tokens", "docs", limit)
    over = F.col("n_tokens") > F.col("limit")
    return rows.groupBy(*by, "limit").agg(
        F.sum(F.when(over, F.col("docs")).otherwise(0)).alias("docs_over"),
        F.sum(F.col("docs") * F.least("n_tokens", "limit")).alias("truncated_total"),
    )


def quantiles(hist: DataFrame, shares: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """(by, share, n_tokens): the smallest length that at least this share of the documents stays within."""
    share = F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")
    rows = hist.select(*by, "n_tokens", "share_within", share).filter("share_within >= share")
    return rows.groupBy(*by, "share").agg(F.min("n_tokens").alias("n_tokens"))


def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(documents(spark, sf_dir), ("source",))
