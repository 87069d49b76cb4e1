"""Cost-balanced packing of token ids into sequences of a fixed size.

Attention costs ``linear * n + quadratic * n * n`` for a piece of n tokens, since pieces in one sequence do
not see each other. Documents are handled in blocks of bounded size. In a block, a document longer than
a sequence first fills whole sequences; what is left of all documents is dealt out in descending length,
each to the sequence of lowest cost with enough room. The number of sequences is the smallest that can
hold the block's tokens; a document that fits nowhere is cut and goes on in the next cheapest sequence,
so only the last tokens of a block's room are padding.

Blocks are cut from the partitions of the input as they are read: encoding and packing are one pass
without a shuffle, a task holds one block, and a lost task makes the same blocks again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteflow.llm.store import documents
from noteflow.llm.tokens import encoded

SEQUENCE_TOKENS = 1024
#: The id after every document.
END_ID = 0
#: A block is closed at so many tokens.
BLOCK_TOKENS = 1 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(lengths: list[int], room: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) for documents of these lengths, in one block."""
    lengths = np.asarray(lengths, np.int64)
    out, sequence = [], 0
    for k in np.flatnonzero(lengths >= room).tolist():
        for start in range(0, int(lengths[k]) - room + 1, room):
            out.append((k, start, room, sequence, 0))
            sequence += 1
    rest = lengths % room
    n = -(-int(rest.sum()) // room)
    used, cost = np.zeros(n, np.int64), np.zeros(n)
    for k in np.argsort(-rest, kind="stable").tolist():
        left, at = int(rest[k]), int(lengths[k] - rest[k])
        while left:
            fits = np.where(room - used >= left, cost, np.inf)
            s = int(fits.argmin())
            if np.isinf(fits[s]):
                s = int(np.where(used < room, cost, np.inf).argmin())
            size = min(left, room - int(used[s]))
            out.append((k, at, size, sequence + s, int(used[s])))
            used[s] += size
            cost[s] += linear * size + quadratic * size * size
            left, at = left - size, at + size
    return out


def _pieces(ids: list[np.ndarray], names: list, first: int, room: int, linear: float, quadratic: float) -> tuple[pa.RecordBatch, int]:
    made = pack([len(x) for x in ids], room, linear, quadratic)
    columns = zip(*((names[k], at, size, zlib.crc32(ids[k][at : at + size].tobytes()), len(ids[k]), first + s, offset) for k, at, size, s, offset in made))
    fields = [f.split()[0] for f in PIECE.split(", ")]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=fields)
    return batch, first + 1 + max(s for *_, s, _ in made)


def pack_documents(
    docs: DataFrame, room: int = SEQUENCE_TOKENS, block_tokens: int = BLOCK_TOKENS, linear: float = LINEAR, quadratic: float = QUADRATIC,
    vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null text counts as empty: it is the end id alone. Null or repeated doc_ids are kept as they are, each
    row is a document of its own. Other columns are ignored; an empty table gives an empty result.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 40
        ids: list[np.ndarray] = []
        names: list = []
        size = 0
        end = np.array([END_ID], "<u4")
        for batch, coded in encoded(batches, vocabulary):
            for name, x in zip(batch.column("doc_id").to_pylist(), coded):
                ids.append(np.concatenate([x, end]))
                names.append(name)
                size += len(ids[-1])
                if size >= block_tokens:
                    out, first = _pieces(ids, names, first, room, linear, quadratic)
                    yield out
                    ids, names, size = [], [], 0
        if ids:
            yield _pieces(ids, names, first, room, linear, quadratic)[0]

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(blocks, PIECE)


def pack_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)
