"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The law is ``rows``: shard sizes differ by at most one row. Every row has a place on the ring, from its
key; every shard owns the arcs that end at its virtual nodes. A shard takes the rows of its own arcs, in
ring order, up to its capacity; the rows beyond that continue clockwise to the next virtual node whose
shard has room. The capacities add up to the number of rows, so the balance is exact, and only rows that
overflow leave the shard that plain consistent hashing gives them.

Which rows overflow depends on counts alone. The ring is cut into ``2 ** cell_bits`` equal cells; the
counts per cell (a table of fixed size) come to the driver, which returns at most a few segments for each
cell: positions lo..hi of this cell go to this shard, from this slot on. Rows find their position by a
window over one cell. Equal rows are aggregated before any shuffle, so a hot key is one row of the window.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noteflow.llm.store import Scratch, documents

SHARDS = 8
VIRTUAL_NODES = 64
#: 16384 cells: with 10^10 rows a cell has 600 000 narrow rows.
CELL_BITS = 14
SEGMENT = "cell long, lo long, hi long, shard int, first_slot long"


def ring(shards: int, virtual_nodes: int, cell_bits: int) -> list[tuple[int, int]]:
    """(cell, shard) of all virtual nodes, clockwise."""
    nodes = []
    for shard in range(shards):
        for node in range(virtual_nodes):
            digest = hashlib.blake2b(f"shard {shard} node {node}".encode(), digest_size=8).digest()
            nodes.append((int.from_bytes(digest, "big"), shard))
    return [(place >> (64 - cell_bits), shard) for place, shard in sorted(nodes)]


def segments(counts: dict[int, int], shards: int, virtual_nodes: int, cell_bits: int) -> list[tuple[int, int, int, int, int]]:
    """Which positions of each cell go to which shard, and the slot where they begin there."""
    nodes, total = ring(shards, virtual_nodes, cell_bits), sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    out: list[tuple[int, int, int, int, int]] = []

    def put(cell: int, lo: int, hi: int, shard: int) -> int:
        upto = min(hi, lo + room[shard])
        if upto > lo:
            out.append((cell, lo, upto, shard, filled[shard]))
            room[shard] -= upto - lo
            filled[shard] += upto - lo
        return upto

    def first_node(cell: int, near: int) -> int:
        while near < len(nodes) and nodes[near][0] < cell:
            near += 1
        return near

    late, near = [], 0
    for cell in sorted(counts):
        near = first_node(cell, near)
        lo = put(cell, 0, counts[cell], nodes[near % len(nodes)][1])
        if lo < counts[cell]:
            late.append((cell, lo, near))
    for cell, lo, near in late:
        while lo < counts[cell]:
            near += 1
            lo = put(cell, lo, counts[cell], nodes[near % len(nodes)][1])
    return out


def assign(
    docs: DataFrame, shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES, cell_bits: int = CELL_BITS,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row for each document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The key of a row is its doc_id, text checksum and size, so rows with a null or repeated doc_id spread
    too; fully equal rows are interchangeable and each gets a slot of its own. Null text has size 1 and
    checksum 0. Slots run from 0 without gaps in every shard. ``grown_shard`` is null under this law.
    Other columns are ignored; an empty table gives an empty result.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "sharding")
    body = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    key = ["doc_id", "text_crc32", "size"]
    place = F.xxhash64("doc_id", F.col("doc_id").isNull(), "text_crc32", "size")
    entries = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).withColumn("place", place)
    entries = scratch.keep(entries.withColumn("cell", F.shiftrightunsigned("place", 64 - cell_bits)), "entries")
    # At most 2 ** cell_bits rows.
    counts = {r["cell"]: r["n"] for r in entries.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    flow = spark.createDataFrame(segments(counts, shards, virtual_nodes, cell_bits), SEGMENT)
    upto = F.sum("n").over(Window.partitionBy("cell").orderBy("place", *key))
    spots = entries.withColumn("start", upto - F.col("n")).select(
        *key, "cell", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("spot")
    )
    # At most one segment for each cell and one more for each time a shard fills up or an overflow moves on.
    placed = spots.join(F.broadcast(flow), (spots["cell"] == flow["cell"]) & (F.col("spot") >= F.col("lo")) & (F.col("spot") < F.col("hi")))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("first_slot") + F.col("spot") - F.col("lo")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(documents(spark, sf_dir))
