"""Near-duplicate embeddings: exact threshold pairs by a cover-tree dual traversal.

On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c), so distance bounds hold. The
tree has two storeys. The upper one is shared by the cluster: a few pivots, in the order of a
farthest-first traversal of a bounded sample, so every prefix of them is a coarser level. Each vector belongs
to its nearest pivot among as many as its label needs. Pivots of one label are compared first; a pair is
dropped when the pivots are further apart than the threshold plus both covering radii. What is left is
cut into blocks of bounded size, and one task compares two blocks. A vector length that the sample doesn't
hold has no pivots; its vectors stay one node, of which all block pairs are compared.

The lower storey is a cover tree of each block inside a task: nested levels of centres with halving radii,
and exact covering radii. Two trees are descended together, level by level, and node pairs whose bound
exceeds the threshold are dropped; the members of the last surviving nodes are compared in double
precision. A task returns a link count and one local root for each linked vector, never pairs.

Every pair of blocks meets in one task, so no link is lost or counted twice. The bounds prune clusters that
lie apart; vectors without any structure leave all block pairs of a label to be compared, which no exact
method in so many dimensions avoids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteflow.llm.graph import components, local_roots
from noteflow.llm.store import Scratch

COSINE = 0.93
#: Vectors of a block.
BLOCK = 2048
#: Vectors that pivots are chosen from, and pivots, for the whole table.
SAMPLE, PIVOTS = 2000, 64
#: Room for rounding in distance bounds; the cosine itself is compared without it.
SLACK = 1e-6
#: A level of the block tree stops growing at this part of the block.
LAST = 0.25


def farthest_first(x: np.ndarray, most: int, stop: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` in farthest-first order and the covering radius when each is about to be added."""
    near, order, radii = np.full(len(x), np.inf), [0], [np.inf]
    while True:
        near = np.minimum(near, distances(x, x[order[-1]][None])[:, 0])
        k = int(near.argmax())
        if len(order) >= most or near[k] <= stop:
            return np.array(order), np.array(radii)
        radii.append(float(near[k]))
        order.append(k)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class BlockTree:
    """Nested levels of centres with halving radii over the unit vectors of one block."""

    def __init__(self, x: np.ndarray, threshold: float):
        self.x = x
        order, radii = farthest_first(x, max(1, int(len(x) * LAST)), threshold / 2)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # centres, covering radius of each
        self.parents: list[np.ndarray] = []  # centre of the level above, for each centre
        owner, size, radius = np.zeros(len(x), int), 1, 2.0
        gaps = distances(x, x[order])
        while True:
            owner = gaps[:, :size].argmin(1)
            cover = np.zeros(size)
            np.maximum.at(cover, owner, gaps[np.arange(len(x)), owner])
            self.levels.append((order[:size], cover))
            if size == len(order):
                break
            radius /= 2
            grown = max(size + 1, int((radii > radius).sum()))
            size = min(grown, len(order)) if radius > 0.05 else len(order)
        # A node is the part of its finest cell's points below it; bounds use the deepest owners, so radii follow the nesting.
        self._nest(gaps, owner)

    def _nest(self, gaps: np.ndarray, owner: np.ndarray) -> None:
        last = len(self.levels) - 1
        for k in range(last, 0, -1):
            above = len(self.levels[k - 1][0])
            centres = self.levels[k][0]
            up = gaps[centres, :above].argmin(1)
            self.parents.insert(0, up)
            cover = np.zeros(above)
            np.maximum.at(cover, up, gaps[centres, up] + self.levels[k][1])
            self.levels[k - 1] = (self.levels[k - 1][0], cover)
        self.members = [np.flatnonzero(owner == c) for c in range(len(self.levels[last][0]))]


def linked(a: BlockTree, b: BlockTree, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (row of a, row of b) with at least this cosine, by descending both trees together."""
    reach = np.sqrt(2 - 2 * cosine) + SLACK
    depth = max(len(a.levels), len(b.levels))
    alive = None
    for k in range(depth):
        ka, kb = min(k, len(a.levels) - 1), min(k, len(b.levels) - 1)
        (ca, ra), (cb, rb) = a.levels[ka], b.levels[kb]
        if alive is not None:
            alive = alive[a.parents[ka - 1]] if k == ka else alive
            alive = alive[:, b.parents[kb - 1]] if k == kb else alive
        near = distances(a.x[ca], b.x[cb]) <= reach + ra[:, None] + rb[None]
        alive = near if alive is None else alive & near
        if not alive.any():
            return np.empty(0, int), np.empty(0, int)
    rows, columns = [], []
    dense = alive.mean() > 0.3
    for node in [None] if dense else np.flatnonzero(alive.any(1)):
        mine = np.arange(len(a.x)) if dense else a.members[node]
        others = np.arange(len(b.x)) if dense else np.concatenate([b.members[c] for c in np.flatnonzero(alive[node])])
        i, j = np.nonzero(a.x[mine] @ b.x[others].T >= cosine)
        rows.append(mine[i])
        columns.append(others[j])
    return np.concatenate(rows), np.concatenate(columns)


def _unit(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.asarray(flat.flatten(), np.float64).reshape(len(flat), -1)
    # Scaled first, so that squares of very large or small components stay finite.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _compare(key: tuple, table: pa.Table, cosine: float) -> pa.Table:
    """Links between the two blocks of a group, or inside its only block."""
    rid, side = table.column("rid").to_numpy(), table.column("side").to_numpy()
    x = _unit(table.column("vector"))
    order = np.lexsort((rid, side))
    rid, side, x = rid[order], side[order], x[order]
    cut, (_, _, p, q, i, j) = int((side == 0).sum()), key
    alone = p == q and i == j
    first = BlockTree(x[:cut], np.sqrt(2 - 2 * cosine)) if cut else None
    i = j = np.empty(0, int)
    if first is not None and alone:
        i, j = linked(first, first, cosine)
        i, j = i[i < j], j[i < j]
    elif first is not None and cut < len(x):
        i, j = linked(first, BlockTree(x[cut:], np.sqrt(2 - 2 * cosine)), cosine)
        j = j + cut
    links = np.bincount(i, minlength=len(rid)) + np.bincount(j, minlength=len(rid))
    # The root is the smallest row number of the local component.
    rank = np.argsort(np.argsort(rid))
    root = np.sort(rid)[local_roots(len(rid), rank[i], rank[j])[rank]]
    hit = links > 0
    return pa.table({"rid": rid[hit], "links": links[hit].astype(np.int64), "root": root[hit]})


def pivots(vectors: DataFrame, sample: int, most: int) -> dict[int, np.ndarray]:
    """For each vector length of the sample the pivots, as unit vectors in farthest-first order.

    At most ``sample`` vectors come to the driver, those with the smallest digests of about twice as many. Digests
    are of row numbers, so repeated vectors are drawn as often as others. Rare lengths may have no pivots.
    """
    rate = min(1.0, 2 * sample / max(1, vectors.count()))
    near = vectors.select("rid", "dim", "vector").withColumn("_h", F.xxhash64("rid")).drop("rid").filter(F.pmod("_h", F.lit(1 << 20)) < int(rate * (1 << 20)) + 1)
    rows = near.orderBy("_h").limit(sample).drop("_h").toArrow()
    out = {}
    for dim in set(rows.column("dim").to_pylist()):
        x = _unit(rows.filter(pa.compute.equal(rows.column("dim"), dim)).column("vector"))
        out[dim] = x[farthest_first(x, most, 0.0)[0]]
    return out


def near_vectors(
    table: DataFrame, cosine: float = COSINE, block: int = BLOCK, sample: int = SAMPLE, most_pivots: int = PIVOTS,
    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and their cosine in double precision is at least ``cosine``.
    Vectors that are null, empty or zero or hold null, NaN or infinite components, and vectors with a null
    label, link with nothing; vectors of different lengths never link. Repeated rows are vectors of their
    own. A component is named by its smallest vec_id (null if all are null). An empty table gives an empty
    result; other columns are ignored.
    """
    spark, scratch = table.sparkSession, Scratch(table.sparkSession, "embeddings")
    vector = F.col(f"`{embedding}`").cast("array<double>")
    sound = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists(vector, lambda v: v != 0)
    rows = scratch.keep(table.select(
        F.monotonically_increasing_id().alias("rid"), F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"),
        F.when(F.coalesce(sound, F.lit(False)) & F.col(f"`{label}`").isNotNull(), F.col(f"`{embedding}`")).alias("vector"),
    ), "rows")
    good = rows.filter("vector IS NOT NULL").withColumn("dim", F.size("vector"))
    top = pivots(good, sample, most_pivots)
    # As many pivots as the label has blocks.
    needs = good.groupBy("label", "dim").agg(F.least(F.ceil(F.count(F.lit(1)) / block), F.lit(most_pivots)).cast("int").alias("need"))
    needs = scratch.keep(needs, "needs")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            dims, need = batch.column("dim").to_numpy(), batch.column("need").to_numpy()
            node, gap = np.zeros(n, np.int32), np.zeros(n)
            for dim in np.unique(dims):
                if dim not in top:
                    # A length without pivots is one node, and no unit vectors are further apart than 2.
                    gap[dims == dim] = 2.0
                    continue
                for k in np.unique(need[dims == dim]):
                    at = np.flatnonzero((dims == dim) & (need == k))
                    d = distances(_unit(batch.column("vector").take(pa.array(at))), top[dim][:k])
                    node[at], gap[at] = d.argmin(1), d.min(1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rid", "label", "dim", "vector")), pa.array(node), pa.array(gap)], names=["rid", "label", "dim", "vector", "node", "gap"])

    kind = rows.schema["vector"].dataType.simpleString()
    told = good.join(needs, ["label", "dim"]).mapInArrow(place, f"rid long, label {rows.schema['label'].dataType.simpleString()}, dim int, vector {kind}, node int, gap double")
    told = scratch.keep(told, "placed")
    nodes = scratch.keep(told.groupBy("label", "dim", "node").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("chunks"), F.max("gap").alias("radius")), "nodes")
    # At most PIVOTS ** 2 rows for each vector length of the sample.
    gaps = [(int(dim), p, q, float(g)) for dim, x in top.items() for p, line in enumerate(distances(x, x)) for q, g in enumerate(line) if p <= q]
    gaps = spark.createDataFrame(gaps, "dim int, p int, q int, apart double")
    a = nodes.select("label", "dim", F.col("node").alias("p"), F.col("chunks").alias("ca"), F.col("radius").alias("ra"))
    b = nodes.select("label", "dim", F.col("node").alias("q"), F.col("chunks").alias("cb"), F.col("radius").alias("rb"))
    pairs = a.join(b, ["label", "dim"]).filter("p <= q").join(F.broadcast(gaps), ["dim", "p", "q"], "left")
    reach = float(np.sqrt(2 - 2 * cosine) + SLACK)
    # Only the one node of a length without pivots has no distance.
    pairs = pairs.filter(F.coalesce("apart", F.lit(0.0)) <= F.col("ra") + F.col("rb") + reach).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ca") - 1)))
    pairs = pairs.withColumn("j", F.explode(F.sequence(F.when(F.col("p") == F.col("q"), F.col("i")).otherwise(0), F.col("cb") - 1)))
    pairs = scratch.keep(pairs.select("label", "dim", "p", "q", "i", "j"), "pairs")
    mine = pairs.select("*", F.lit(0).alias("side"), F.col("p").alias("node"), F.col("i").alias("chunk"))
    other = pairs.filter("p <> q OR i <> j").select("*", F.lit(1).alias("side"), F.col("q").alias("node"), F.col("j").alias("chunk"))
    chunked = told.join(nodes.select("label", "dim", "node", "chunks"), ["label", "dim", "node"])
    chunked = chunked.withColumn("chunk", F.pmod(F.xxhash64("rid"), F.col("chunks")).cast("int")).drop("gap", "chunks")
    sent = chunked.join(mine.unionByName(other), ["label", "dim", "node", "chunk"]).select("label", "dim", "p", "q", "i", "j", "side", "rid", "vector")
    found = sent.groupBy("label", "dim", "p", "q", "i", "j").applyInArrow(lambda key, t: _compare(key, t, cosine), "rid long, links long, root long")
    found = scratch.keep(found, "found")
    scratch.drop("placed")
    links = found.groupBy("rid").agg(F.sum("links").alias("n_links"))
    groups = components(found.select(F.col("rid").alias("u"), F.col("root").alias("v")), scratch).withColumnRenamed("node", "rid")
    groups = scratch.keep(rows.select("rid", "vec_id").join(groups, "rid"), "groups")
    names = scratch.keep(groups.groupBy("component").agg(F.min("vec_id").alias("component_id")), "names")
    told = groups.join(names, "component").select("rid", "component_id", F.lit(True).alias("_in"))
    out = rows.select("rid", "vec_id").join(links, "rid", "left").join(told, "rid", "left")
    component = F.when(F.col("_in"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


def near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), r AS (
  SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (SELECT a, min(least(a, b)) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
       e.vec_id = coalesce(c.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN c ON c.a = e.vec_id
"""
