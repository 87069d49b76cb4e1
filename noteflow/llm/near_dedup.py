"""Near-duplicate join on word shingles: Bayesian pruning of MinHash candidates, then exact Jaccard.

1. One pass over the texts makes shingle sets, and from them a digest of the set and the band keys of a MinHash
   signature: 32 bands of 4 values, so a pair at similarity 0.8 shares no band with a chance of 5e-8. Only these
   travel. Documents with one shingle set are a class; its representative stands for all of them.
2. Representatives that share a band key are candidates. The sets and signatures of these alone are made
   again from their texts.
3. Keys with few representatives list their pairs; each distinct pair is one row. Its signatures are compared
   16 values at a time and it is dropped as soon as the posterior chance of reaching the threshold falls below
   ``TOLERANCE``; the rest are verified on their shingle sets.
4. A key with many representatives never lists pairs. They are cut into blocks, a task compares two
   blocks by the same rule, and returns a link count and one local root for each linked representative. A pair
   that shares several such keys counts at the smallest of them, and is left out of step 3.

Links between copies of one class are counted, not listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noteflow.llm import shingles as S
from noteflow.llm.bytenet import slices, utf8
from noteflow.llm.graph import components, local_roots
from noteflow.llm.store import Scratch, documents, pick_rows, row_name
from noteflow.operators.scan import join_dimension

THRESHOLD = 0.8
WORDS = 5
#: A pair is dropped when its chance of reaching the threshold is below this.
TOLERANCE = 1e-9
#: Representatives of one key that list their pairs; above, they are compared in blocks.
LISTED = 48
#: Representatives of a block.
BLOCK = 512
#: Representatives that are found in the texts by a broadcast join, after being counted; above, by a shuffle.
BROADCAST_ROWS = 200_000


def _sketches(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """(rid, doc_id, _d, _k, n, set_a, set_b, bands) of each document."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, a, b, bands = [], [], [], []
            for s in S.shingle_sets(*utf8(batch.column("text")), width):
                n.append(len(s))
                with np.errstate(over="ignore"):
                    a.append(int(S.mix(s).sum(dtype=np.uint64).view(np.int64)))
                    b.append(int(S.mix(s ^ S._MIX2).sum(dtype=np.uint64).view(np.int64)))
                bands.append(S.band_keys(S.signature(s)) if len(s) else np.empty(0, np.int64))
            edges = np.concatenate([[0], np.cumsum([len(x) for x in bands])]).astype(np.int32)
            keys = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(bands) if bands else np.empty(0, np.int64)))
            columns = [batch.column(c) for c in ("rid", "doc_id", "_d", "_k")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), keys], names=["rid", "doc_id", "_d", "_k", "n", "set_a", "set_b", "bands"])

    key, body = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    names = [c.alias(k) for k, c in row_name(key, body).items()]
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), key.cast("long").alias("doc_id"), *names, body.alias("text"))
    return rows.mapInArrow(sketch, "rid long, doc_id long, _d long, _k long, n long, set_a long, set_b long, bands array<long>")


def _sets(rows: DataFrame, width: int) -> DataFrame:
    """(rep, members, big, shingles, values) of rows (rep, members, big, text)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = list(S.shingle_sets(*utf8(batch.column("text")), width))
            values = [S.signature(s).tobytes() for s in sets]
            columns = [batch.column(c) for c in ("rep", "members", "big")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(values, pa.binary())], names=["rep", "members", "big", "shingles", "values"])

    return rows.select("rep", "members", "big", "text").mapInArrow(make, "rep long, members long, big array<long>, shingles binary, values binary")


def _table(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Signatures of a column as one row each."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint32).reshape(len(values), S.VALUES)


def _compare(key: tuple, table: pa.Table, threshold: float, rule: dict[int, int]) -> pa.Table:
    """Links between two blocks of a key, or inside one block."""
    bucket, alone = key[0].as_py(), key[1] == key[2]
    rep, side, members = (table.column(c).to_numpy() for c in ("rep", "side", "members"))
    order = np.lexsort((rep, side))
    values = _table(table.column("values"))
    sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
    big = [np.array(b) for b in table.column("big").to_pylist()]
    size = np.array([len(s) for s in sets])
    # Shingles of the task numbered, so that a set is a row of a table of bits.
    names, number = np.unique(np.concatenate(sets), return_inverse=True)
    begins = np.concatenate([[0], np.cumsum(size)])
    left = [k for k in order if side[k] == 0]
    right = [k for k in order if side[k] == 1]
    links, weight = np.zeros(len(rep), np.int64), np.zeros(len(rep), np.int64)
    ends_a, ends_b = [], []
    right = np.array(left if alone else right, int)
    for place, k in enumerate(left):
        others = right[place + 1 :] if alone else right
        fits = (np.minimum(size[others], size[k]) >= threshold * np.maximum(size[others], size[k]) - 1e-9)
        others = others[fits]
        if not len(others):
            continue
        others = others[S.survivors(np.broadcast_to(values[k], (len(others), S.VALUES)), values[others], rule)]
        others = others[[np.intersect1d(big[k], big[o]).min() == bucket for o in others]] if len(others) else others
        if not len(others):
            continue
        mine = np.zeros(len(names), bool)
        mine[number[begins[k] : begins[k + 1]]] = True
        spans = np.concatenate([number[begins[o] : begins[o + 1]] for o in others])
        common = np.add.reduceat(mine[spans].astype(np.int64), np.concatenate([[0], np.cumsum(size[others])[:-1]]))
        others = others[S.reaches(common, size[others], size[k], threshold)]
        links[k] += members[others].sum()
        links[others] += members[k]
        ends_a.append(np.full(len(others), k))
        ends_b.append(others)
    a = np.concatenate(ends_a) if ends_a else np.empty(0, int)
    b = np.concatenate(ends_b) if ends_b else np.empty(0, int)
    rank = np.argsort(np.argsort(rep))
    root = np.sort(rep)[local_roots(len(rep), rank[a], rank[b])[rank]]
    hit = links > 0
    return pa.table({"rep": rep[hit], "links": links[hit], "root": root[hit]})


def near_duplicates(
    docs: DataFrame, threshold: float = THRESHOLD, width: int = WORDS, tolerance: float = TOLERANCE, listed: int = LISTED, block: int = BLOCK,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row for each document: doc_id, rep_id, class_id, n_links, kept, _d, _k (see ``row_name``).

    Words are runs of characters outside [\\x20\\x09-\\x0D]; shingles are ``width`` words in a row, a shorter text
    is one shingle. Two documents link if the Jaccard similarity of their shingle sets is at least
    ``threshold``. rep_id: the smallest doc_id with the same shingle set; class_id: the smallest doc_id reachable
    by links; n_links: other documents linked directly, copies included; kept: one document of each class,
    that with the smallest doc_id.

    Null and empty texts and texts of blanks have no shingles: they link with nothing and stay. Null ids sort
    last. Repeated rows are documents of their own and copies of each other. Other columns are ignored; an
    empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "neardup")
    rule = S.least_matches(threshold, tolerance)
    rows = scratch.keep(_sketches(docs, doc_id, text, width), "rows")
    full = rows.filter("n > 0")
    classes = scratch.keep(full.groupBy("n", "set_a", "set_b").agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("members")), "classes")
    reps = full.join(classes.select(F.col("rep").alias("rid"), "members"), "rid").select("rid", "members", "_d", "_k", "bands")

    keys = scratch.keep(reps.select(F.col("rid").alias("rep"), F.explode("bands").alias("key")), "keys")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    told = scratch.keep(keys.join(shared, "key"), "shared")
    scratch.drop("keys")
    wanted = told.groupBy("rep").agg(F.sort_array(F.collect_list(F.when(F.col("m") > listed, F.col("key")))).alias("big"))
    wanted = reps.select(F.col("rid").alias("rep"), "members", "_d", "_k").join(wanted, "rep")
    wanted = scratch.keep(wanted, "wanted")
    names = row_name(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    body = docs.select(*[c.alias(k) for k, c in names.items()], F.col(f"`{text}`").alias("text"))
    # Rows that agree in id and text have one representative among them, so a row name may occur more than once here.
    found = join_dimension(body, wanted, ["_d", "_k"], max_rows=BROADCAST_ROWS)
    sets = scratch.keep(_sets(found, width), "allsets")
    once = F.row_number().over(Window.partitionBy("rep").orderBy("members"))
    sets = sets.withColumn("_once", once).filter("_once = 1").drop("_once")
    sets = scratch.keep(sets, "sets")
    scratch.drop("allsets")

    # Pairs of keys with few representatives; at most ``listed`` of them meet in one list.
    lists = told.filter(F.col("m") <= listed).groupBy("key").agg(F.sort_array(F.collect_list("rep")).alias("reps"))
    pairs = lists.select("reps", F.posexplode("reps").alias("at", "a")).select("a", F.explode(F.expr("slice(reps, at + 2, size(reps))")).alias("b"))
    pairs = scratch.keep(pairs.distinct(), "pairs")
    side = lambda c, *more: sets.select(F.col("rep").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in more])

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alive = S.survivors(_table(batch.column("values_a")), _table(batch.column("values_b")), rule)
            yield batch.select(["a", "b"]).take(pa.array(alive))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("shingles_a").to_pylist(), batch.column("shingles_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(bool(S.reaches(np.intersect1d(x, y, assume_unique=True).size, len(x), len(y), threshold)))
            yield batch.select(["a", "b", "members_a", "members_b"]).filter(pa.array(keep, pa.bool_()))

    likely = pairs.join(side("a", "values", "big"), "a").join(side("b", "values", "big"), "b")
    likely = likely.filter(~F.arrays_overlap("big_a", "big_b")).select("a", "b", "values_a", "values_b").mapInArrow(prune, "a long, b long")
    likely = scratch.keep(likely, "likely")
    sure = likely.join(side("a", "shingles", "members"), "a").join(side("b", "shingles", "members"), "b")
    sure = sure.select("a", "b", "members_a", "members_b", "shingles_a", "shingles_b").mapInArrow(verify, "a long, b long, members_a long, members_b long")
    sure = scratch.keep(sure, "sure")

    # Keys with many representatives: every block meets every other once.
    blocks = told.filter(F.col("m") > listed).withColumn("blocks", F.ceil(F.col("m") / block).cast("int"))
    blocks = blocks.withColumn("at", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    sent = blocks.select("key", "rep", "at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("to"))
    sent = sent.select("key", "rep", F.least("at", "to").alias("i"), F.greatest("at", "to").alias("j"), (F.col("at") > F.col("to")).cast("int").alias("side"))
    grouped = sent.join(sets, "rep").groupBy("key", "i", "j")
    dense = grouped.applyInArrow(lambda key, t: _compare(key, t, threshold, rule), "rep long, links long, root long")
    dense = scratch.keep(dense, "dense")

    counts = sure.select(F.col("a").alias("rep"), F.col("members_b").alias("links")).union(sure.select("b", "members_a")).union(dense.select("rep", "links"))
    counts = counts.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(sure.select(F.col("a").alias("u"), F.col("b").alias("v")).union(dense.select("rep", "root")), scratch)
    told = classes.join(counts, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    told = told.select("n", "set_a", "set_b", "rep", "members", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("component"))
    told = scratch.keep(told, "told")
    keys = ["n", "set_a", "set_b"]
    flat = scratch.keep(full.join(told, keys).select("rid", "doc_id", "_d", "_k", "rep", "component", (F.col("members") - 1 + F.col("links")).alias("n_links")), "flat")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "rid")
    by_rep = scratch.keep(flat.groupBy("rep").agg(F.min("doc_id").alias("rep_id")), "byrep")
    by_class = scratch.keep(flat.groupBy("component").agg(F.min_by(F.struct("doc_id", "rid"), first).alias("first")), "byclass")
    joined = flat.join(by_rep, "rep").join(by_class, "component")
    joined = joined.select("doc_id", "rep_id", F.col("first.doc_id").alias("class_id"), "n_links", (F.col("rid") == F.col("first.rid")).alias("kept"), "_d", "_k")
    alone = rows.filter("n = 0").select("doc_id", F.col("doc_id").alias("rep_id"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept"), "_d", "_k")
    return joined.unionByName(alone)


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate class; columns unchanged."""
    return pick_rows(docs, near_duplicates(docs, doc_id=doc_id, text=text).filter("kept"), doc_id, text)


def near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).drop("_d", "_k")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
         ELSE array_to_string(w[i:i + 4], ' ') END AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT c.a, c.b, c.c = x.n AND c.c = y.n AS same FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b
  WHERE c.c / (x.n + y.n - c.c)::DOUBLE >= 0.8
), r AS (
  SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), k AS (SELECT a, min(least(a, b)) AS class_id FROM r GROUP BY a),
m AS (SELECT a, count(*) AS n_links, min(CASE WHEN same THEN b END) AS twin FROM l GROUP BY a)
SELECT d.doc_id, least(d.doc_id, coalesce(m.twin, d.doc_id)) AS rep_id, coalesce(k.class_id, d.doc_id) AS class_id,
       coalesce(m.n_links, 0) AS n_links, d.doc_id = coalesce(k.class_id, d.doc_id) AS kept
FROM documents d LEFT JOIN k ON k.a = d.doc_id LEFT JOIN m ON m.a = d.doc_id
"""
