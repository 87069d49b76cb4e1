"""Language of a text by a byte convolutional network with a softmax.

Filters of several widths run over windows of a fixed number of bytes; each keeps its maximum, and a softmax
over the learned languages follows. Windows cover the whole text; a document's probabilities are the mean
over its windows, weighted by the bytes in them.

The network is fitted on the driver, on a bounded sample of rows with a known language (about ``SAMPLE`` per
language, texts of at most ``LONGEST`` bytes). Prediction is one pass over the table in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noteflow.llm.bytenet import Adam, Filters, slices, utf8
from noteflow.llm.store import documents, fold

SAMPLE = 400
LONGEST = 1 << 16
#: Languages that one network can tell apart; more of them is an error, not a cut.
MOST_LANGUAGES = 256
WINDOW, UNIT, DEPTH, BANKS = 256, 2, 8, ((1, 8), (2, 16), (3, 16))
WINDOWS_PER_DOCUMENT, EPOCHS, STEP_WINDOWS = 6, 4, 64
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"


class LanguageNet:
    def __init__(self, languages: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.filters = Filters(WINDOW, UNIT, DEPTH, BANKS, seed)
        n = self.filters.n
        self.outer = rng.normal(0, n**-0.5, (n, len(languages))).astype(np.float32)
        self.outer_bias = np.zeros(len(languages), np.float32)

    def _softmax(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.outer + self.outer_bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def fit(self, texts: list[bytes], labels: np.ndarray, seed: int = 13) -> LanguageNet:
        rng, f = np.random.default_rng(seed), self.filters
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        data = np.frombuffer(b"".join(texts) + bytes(f.window), np.uint8)
        rows, starts = f.cut(np.diff(offsets))
        begin = np.searchsorted(rows, np.arange(len(texts) + 1))
        adam = Adam([*f.parameters(), self.outer, self.outer_bias])
        for epoch in range(EPOCHS):
            picks = np.concatenate([rng.permutation(np.arange(begin[k], begin[k + 1]))[:WINDOWS_PER_DOCUMENT] for k in range(len(texts))])
            picks = rng.permutation(picks)
            for at in range(0, len(picks), STEP_WINDOWS):
                w = picks[at : at + STEP_WINDOWS]
                h, kept = f.learn(f.fill(data, offsets, rows[w], starts[w]))
                d = self._softmax(h)
                d[np.arange(len(w)), labels[rows[w]]] -= 1
                d /= len(w)
                adam.step([*f.gradients(kept, d @ self.outer.T), h.T @ d + 1e-4 * self.outer, d.sum(0)], 1 - 0.8 * (epoch + at / len(picks)) / EPOCHS)
        return self

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        total = np.zeros(len(out))
        for rows, sizes, h in self.filters.slabs(data, offsets):
            weight = np.maximum(sizes, 1)
            edge = np.flatnonzero(np.diff(rows, prepend=-1))
            out[rows[edge]] += np.add.reduceat(self._softmax(h) * weight[:, None], edge)
            total[rows[edge]] += np.add.reduceat(weight, edge)
        return out / total[:, None]


def train(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageNet | None:
    """The fitted network, or None if no row outside the held-out fold has a language and a letter."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text"), F.col(f"`{lang}`").alias("_lang"))
    rows = rows.filter(F.col("_lang").isNotNull() & F.col("_text").isNotNull() & ~held_out)
    counts = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return None
    names = sorted(counts)
    rate = F.create_map(*[x for k in names for x in (F.lit(k), F.lit(min(1.0, SAMPLE / counts[k])))])
    place = F.pmod(F.xxhash64("_id", F.substring("_text", 1, 64), F.lit("sample")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    near = rows.filter((place < F.element_at(rate, F.col("_lang"))) & (F.octet_length("_text") <= LONGEST) & F.col("_text").rlike(r"\p{L}"))
    # About SAMPLE texts of bounded length for each language come to the driver, never more than twice as many.
    sample = sorted((r["_lang"], r["_text"]) for r in near.select("_lang", "_text").limit(2 * SAMPLE * len(names)).collect())
    if not sample:
        return None
    return LanguageNet(names).fit([t.encode() for _, t in sample], np.array([names.index(k) for k, _ in sample]))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row for each document: doc_id, held_out, lang_pred, score.

    Learns from text and language outside the held-out fold only; language, source and id are never inputs.
    A text that is null or has no letter is ``und`` with score 0; so is every text if there is nothing to
    learn from. A null id is in no held-out fold; repeated rows are each predicted. An empty table gives
    an empty result.
    """
    net = train(docs, fold("_id", FOLDS) == HELD_OUT, doc_id, text, lang)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p = net.probabilities(*utf8(batch.column("text")))
            best = pa.array(np.array(net.languages, object)[p.argmax(1)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("known"), best, pa.array(p.max(1))], names=["doc_id", "known", "lang_pred", "score"])

    body = F.col(f"`{text}`")
    known = F.coalesce(body.rlike(r"\p{L}"), F.lit(False)).alias("known")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), known, body.alias("text"))
    if net is None:
        rows = rows.select("doc_id", F.lit(False).alias("known"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        rows = rows.mapInArrow(predict, "doc_id long, known boolean, lang_pred string, score double")
    return rows.select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), F.when(F.col("known"), F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("known"), F.col("score")).otherwise(0.0).alias("score"),
    )


def document_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))
