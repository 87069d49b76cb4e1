"""Quality classifier: a byte-level convolutional network with one probability per document.

Learned filters run over overlapping chunks that cover the whole text; each keeps its maximum per chunk. The
mean and the maximum over the chunks then go through one hidden layer to a probability.

The network is fitted on the driver, on a bounded sample of labelled rows (``SAMPLE`` per class; texts above
``LONGEST`` bytes aren't sampled, but are scored whole). Both classes weigh alike in
the fit; the share of label 1 among all labelled rows is counted and put back into the score. Scoring is one
pass over the table in Arrow batches, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noteflow.llm.bytenet import Adam, Filters, slices, utf8
from noteflow.llm.store import documents, fold

SAMPLE = 1000
LONGEST = 1 << 17
CHUNK, UNIT, DEPTH, BANKS = 512, 4, 8, ((2, 12), (5, 16))
HIDDEN = 16
#: Chunks of one document that one training step sees; which ones changes from step to step.
CHUNKS_PER_STEP = 4
STEPS, STEP_DOCUMENTS = 600, 32
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7


class QualityNet:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.filters = Filters(CHUNK, UNIT, DEPTH, BANKS, seed)
        n = self.filters.n
        self.inner = rng.normal(0, (2 * n) ** -0.5, (2 * n, HIDDEN)).astype(np.float32)
        self.inner_bias = np.zeros(HIDDEN, np.float32)
        self.outer = rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32)
        self.outer_bias = np.zeros(1, np.float32)
        self.shift = 0.0

    def fit(self, texts: list[bytes], labels: np.ndarray, share: float, seed: int = 11) -> QualityNet:
        """``share``: of label 1 among all labelled rows."""
        rng, f = np.random.default_rng(seed), self.filters
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        data = np.frombuffer(b"".join(texts) + bytes(f.window), np.uint8)
        rows, starts = f.cut(np.diff(offsets))
        begin = np.searchsorted(rows, np.arange(len(texts) + 1))
        adam = Adam([*f.parameters(), self.inner, self.inner_bias, self.outer, self.outer_bias])
        # Both classes weigh alike, however many rows of each there are.
        weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32)
        done = 0
        while done < STEPS:
            order = rng.permutation(len(texts))
            for at in range(0, len(order), STEP_DOCUMENTS):
                chosen = order[at : at + STEP_DOCUMENTS]
                picks = [rng.permutation(np.arange(begin[k], begin[k + 1]))[:CHUNKS_PER_STEP] for k in chosen]
                owner = np.repeat(np.arange(len(chosen)), [len(p) for p in picks])
                picks = np.concatenate(picks)
                h, kept = f.learn(f.fill(data, offsets, rows[picks], starts[picks]))
                edge = np.searchsorted(owner, np.arange(len(chosen)))
                count = np.bincount(owner)[:, None]
                mean, top = np.add.reduceat(h, edge) / count, np.maximum.reduceat(h, edge)
                both = np.concatenate([mean, top], 1)
                pre = both @ self.inner + self.inner_bias
                mid = np.maximum(pre, 0)
                p = 1 / (1 + np.exp(-(mid @ self.outer + self.outer_bias)))
                d = (weight[chosen] * (p - labels[chosen]) / len(chosen)).astype(np.float32)
                d_pre = d[:, None] * self.outer * (pre > 0)
                d_both = d_pre @ self.inner.T
                d_mean, d_top = d_both[:, : f.n] / count, d_both[:, f.n :]
                ties = h == top[owner]
                d_h = d_mean[owner] + d_top[owner] * ties / np.add.reduceat(ties, edge)[owner]
                grads = [*f.gradients(kept, d_h), both.T @ d_pre + 1e-4 * self.inner, d_pre.sum(0), mid.T @ d + 1e-4 * self.outer, np.array([d.sum()])]
                adam.step(grads, 1 - 0.9 * min(1.0, done / STEPS))
                done += 1
        self.shift = float(np.log(share / (1 - share)))
        return self

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n, f = len(offsets) - 1, self.filters
        mean, top, count = np.zeros((n, f.n)), np.zeros((n, f.n), np.float32), np.zeros(n)
        for rows, _, h in f.slabs(data, offsets):
            edge = np.flatnonzero(np.diff(rows, prepend=-1))
            at = rows[edge]
            mean[at] += np.add.reduceat(h, edge)
            top[at] = np.maximum(top[at], np.maximum.reduceat(h, edge))
            count[at] += np.diff(np.append(edge, len(rows)))
        both = np.concatenate([mean / count[:, None], top], 1)
        mid = np.maximum(both @ self.inner + self.inner_bias, 0)
        return 1 / (1 + np.exp(-(mid @ self.outer + self.outer_bias + self.shift)))


def train(docs: DataFrame, labels: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> QualityNet | float:
    """The fitted network, or a constant score where there are no two classes to learn from.

    ``held_out`` is a column over the labels' doc_id. Labels other than 0 and 1, null ids and ids with both
    labels are left out.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).alias("_label")).filter("_id IS NOT NULL AND _label IN (0, 1)")
    known = known.filter(~held_out).groupBy("_id").agg(F.min("_label").alias("_label"), F.max("_label").alias("_other")).filter("_label = _other")
    known = known.join(docs.select(F.col(f"`{doc_id}`").cast("long").alias("_id")).distinct(), "_id", "left_semi")
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    zeros, ones = counts.get(0, 0), counts.get(1, 0)
    if not zeros or not ones:
        return (ones + 1) / (zeros + ones + 2)
    # About SAMPLE rows per class by a digest of the id, and at most that many.
    place = F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rate = F.when(F.col("_label") == 0, min(1.0, 1.3 * SAMPLE / zeros)).otherwise(min(1.0, 1.3 * SAMPLE / ones))
    near = known.filter(place < rate).withColumn("_place", place)
    chosen = near.filter("_label = 0").orderBy("_place", "_id").limit(SAMPLE).union(near.filter("_label = 1").orderBy("_place", "_id").limit(SAMPLE))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # At most 2 * SAMPLE narrow rows are broadcast, and as many texts of bounded length come to the driver.
    found = docs.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), body.alias("_text")).filter(F.octet_length("_text") <= LONGEST).join(F.broadcast(chosen), "_id")
    sample = sorted({(r["_id"], r["_text"]): r["_label"] for r in found.limit(4 * SAMPLE).collect()}.items())
    y = np.array([label for _, label in sample], np.float32)
    if not 0 < y.mean() < 1:
        return (ones + 1) / (zeros + ones + 2)
    return QualityNet().fit([t.encode() for (_, t), _ in sample], y, ones / (zeros + ones))


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, held_out, score, predicted.

    Learns from labelled rows outside the held-out fold only; label, language, source and id are never
    inputs. Null text is scored as empty text; a null id is in no held-out fold; every repeated row is
    scored. Without two classes to learn from all scores are one constant. An empty table gives an empty
    result.
    """
    net = train(docs, labels, fold("_id", FOLDS) == HELD_OUT, doc_id, text)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    judged = _scored(rows, net)
    return judged.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _scored(rows: DataFrame, net: QualityNet | float) -> DataFrame:
    """(doc_id, score) of rows of (doc_id, text)."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p = np.full(batch.num_rows, net) if isinstance(net, float) else net.score(*utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p, pa.float64())], names=["doc_id", "score"])

    return rows.mapInArrow(judge, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; columns unchanged. All rows stay if there are not two classes to learn from."""
    net = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold("_id", FOLDS) == HELD_OUT)
    return accepted(docs, net)


def accepted(docs: DataFrame, net: QualityNet | float, text: str = "text") -> DataFrame:
    if isinstance(net, float):
        # No network could be fitted, and a constant says nothing about a row.
        return docs
    at = docs.columns.index(text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p = net.score(*utf8(batch.column(at)))
            yield batch.filter(pa.array(p >= THRESHOLD))

    return docs.mapInArrow(judge, docs.schema)
