"""Prefix trie of conversations by whole-sequence collapse.

Every conversation is rebuilt from the first turns of another and its own later ones. Equal rebuilt conversations
become one weighted sequence with the list of its conversations (``ends``); a sequence that is a proper prefix of another one
is dropped by an anti-join from the leaves. Only distinct sequences are then unrolled into their prefixes, and
the nodes of the trie are sums over them: members and leaves are sums of weights.

What a prefix saves below it is a sum over nodes, not over members, so every node has one owner: the
sequence of its smallest conversation. A sequence owns the nodes of its path from some depth on. The bytes of all members below
a node are a sum over weighted prefixes, and the bytes of all nodes below it are a sum over the sequences of what they own there;
the saved tokens are the difference. Nothing walks up or down the trie, whatever its depth.

A prefix is known by its length and a running exclusive-or of 120 bits of a SHA-256 of each turn with its position,
so a long conversation is cut like any ordered scan (``operators.scan``). Texts are hashed where they lie and never shuffled.
A first turn that all conversations share is summed inside tasks; the joins are on conversations and sequences, not on nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noteflow.llm.store import Scratch
from noteflow.operators.scan import ordered_scan

#: A conversation begins with turns of the one whose id is the next lower multiple of this.
SHARED = 5
#: At most one turn less than this is taken from it.
HEAD = 9
LANES = ("a", "b")
NODE = ["d", *LANES]


def _lanes(*parts: Column) -> dict[str, Column]:
    """Twice 60 bits of a digest."""
    digest = F.sha2(F.concat_ws(":", *parts), 256)
    return {name: F.conv(F.substring(digest, 1 + 15 * k, 15), 16, 10).cast("long") for k, name in enumerate(LANES)}


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, what, bytes) of every turn; ``what`` is a digest of role and text."""
    body, who = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (text, role))
    return conversations.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, body), 256).alias("what"),
        F.octet_length(body).cast("long").alias("bytes"),
    ).filter("conv_id IS NOT NULL")


def rebuilt(rows: DataFrame, scratch: Scratch, shared: int = SHARED, head: int = HEAD, max_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(conv_id, d, a, b, pa, pb, bytes, sum) of every turn of every rebuilt conversation, and (conv_id, d, a, b, sum) of its last.

    The lanes stand for the first d turns, pa and pb for those before the last of them; ``sum`` is their bytes.
    """
    own = ordered_scan(scratch.keep(rows, "turns"), "conv_id", ["turn", "what"], row_number="pos", max_rows=max_rows)
    own = scratch.keep(own.select("conv_id", F.col("pos").cast("long").alias("pos"), "what", "bytes"), "numbered")
    size = own.groupBy("conv_id").agg(F.max("pos").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % shared
    convs = size.select("conv_id", base.alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % head).alias("h"))
    convs = convs.join(size.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
    convs = scratch.keep(convs.withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0).cast("long")))), "convs")
    # At most ``head`` - 1 turns of a conversation meet at most 2 * ``shared`` others.
    first = own.filter(F.col("pos") < head).select(F.col("conv_id").alias("base"), "pos", "what", "bytes")
    begin = convs.join(first, "base").filter(F.col("pos") <= F.col("h")).select("conv_id", F.col("pos").alias("d"), "what", "bytes")
    rest = own.join(convs, "conv_id").filter(F.col("pos") > F.col("h"))
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("d"), "what", "bytes")
    joined = begin.unionByName(rest)
    joined = joined.select("conv_id", "d", "bytes", *[c.alias(f"_{n}") for n, c in _lanes(F.col("d").cast("string"), F.col("what")).items()])
    scan = ordered_scan(scratch.keep(joined, "joined"), "conv_id", ["d"], xor_before={f"_x{n}": f"_{n}" for n in LANES}, sum_before={"_sum": "bytes"}, max_rows=max_rows)
    lanes = [F.col(f"_x{n}").bitwiseXOR(F.col(f"_{n}")).alias(n) for n in LANES]
    above = [F.col(f"_x{n}").alias(f"p{n}") for n in LANES]
    path = scratch.keep(scan.select("conv_id", "d", *lanes, *above, "bytes", (F.col("_sum") + F.col("bytes")).alias("sum")), "path")
    last = path.groupBy("conv_id").agg(F.max(F.struct("d", *LANES, "sum")).alias("last"))
    zero = F.lit(0).cast("long")
    whole = convs.select("conv_id").join(last, "conv_id", "left")
    whole = whole.select("conv_id", *[F.coalesce(F.col(f"last.{c}"), zero).alias(c) for c in ("d", *LANES, "sum")])
    scratch.drop("turns", "joined")
    return path, scratch.keep(whole, "whole")


def _runs(rows: pa.RecordBatch, n: int) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of rows that agree in the first n columns."""
    if rows.num_rows:
        change = np.zeros(rows.num_rows, bool)
        change[0] = True
        for i in range(n):
            col = rows.column(i).to_numpy()
            change[1:] |= col[1:] != col[:-1]
        at = np.flatnonzero(change)
        yield from zip(at.tolist(), np.append(at[1:], rows.num_rows).tolist())


def _id_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by sequence and conversation: pieces of the lists of ids, as text."""
    for rows in batches:
        runs = list(_runs(rows, 4))
        lo = np.array([r[0] for r in runs], np.int64)
        ids = rows.column(4).to_numpy()
        text = [",".join(map(str, ids[a:b].tolist())) for a, b in runs]
        yield pa.RecordBatch.from_arrays(
            [*(rows.column(i).take(pa.array(lo)) for i in range(5)), pa.array([b - a for a, b in runs], pa.int64()), pa.array(text, pa.string())],
            [*NODE, "sum", "least", "weight", "ids"],
        )


def _end_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by sequence and first id: a digest of each whole list; only the digest's state is held."""
    names, key, out = [*NODE, "sum", "least", "weight", "ends_sha256"], None, []

    def made() -> pa.RecordBatch:
        cols = list(zip(*out))
        out.clear()
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:-1]), pa.array(cols[-1], pa.string())], names)

    for rows in batches:
        cols = [rows.column(i).to_pylist() for i in range(6)]
        for i in range(rows.num_rows):
            now, ids = tuple(c[i] for c in cols[:4]), rows.column(6)[i].as_py().encode()
            if now == key:
                state.update(b"," + ids)
                count += cols[5][i]
                continue
            if key is not None:
                out.append((*key, least, count, state.hexdigest()))
            key, least, count, state = now, cols[4][i], cols[5][i], hashlib.sha256(ids)
        if len(out) >= 10_000:
            yield made()
    if key is not None:
        out.append((*key, least, count, state.hexdigest()))
    if out:
        yield made()


def sequences(whole: DataFrame) -> DataFrame:
    """(d, a, b, sum, least, weight, ends_sha256) of every distinct rebuilt conversation.

    Ids are sorted and written out by ranges, so that many equal conversations are dealt to many tasks. The digest of one
    list is made in one task, since it is defined over the whole list; it reads a row for every batch of ids.
    """
    rows = whole.select(*NODE, "sum", "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    fields = ", ".join(f"{c} long" for c in (*NODE, "sum", "least", "weight"))
    lists = rows.mapInArrow(_id_lists, f"{fields}, ids string")
    return lists.repartition(*NODE).sortWithinPartitions(*NODE, "least").mapInArrow(_end_lists, f"{fields}, ends_sha256 string")


def trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    shared: int = SHARED, head: int = HEAD, max_rows: int | None = None,
) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns go by their number, null first; turns with the same number go by a digest of role and text, and
    repeated rows are turns of their own. Null roles and texts are empty. Rows without conv_id belong to no conversation and are left
    out. A conversation without turns is a member of the root, which exists if there is any conversation at all;
    an empty table gives an empty result. Other columns are ignored. Groups above ``max_rows`` turns are cut.
    """
    scratch = Scratch(conversations.sparkSession, "trie")
    path, whole = rebuilt(turns(conversations, conv_id, turn, role, text), scratch, shared, head, max_rows)
    seqs = scratch.keep(sequences(whole), "sequences")
    # The path of one conversation stands for all that are equal to it; the root is added to each.
    own = seqs.select(F.col("least").alias("conv_id"), "least", "weight", F.col("d").alias("length"), F.col("sum").alias("total"))
    unrolled = path.join(own, "conv_id").drop("conv_id")
    zero = F.lit(0).cast("long")
    above = (F.col("sum") - F.col("bytes")).alias("above")
    steps = ["least", "weight", "length", "total", *NODE, *[f"p{n}" for n in LANES], "bytes", "above"]
    unrolled = path.join(own, "conv_id").select("*", above).select(*steps)
    roots = own.select("least", "weight", "length", "total", *[zero.alias(c) for c in steps[4:]])
    rows = scratch.keep(unrolled.unionByName(roots), "prefixes")
    inner = rows.filter(F.col("d") < F.col("length")).select(*NODE).distinct()
    leaves = seqs.join(inner, NODE, "left_anti").select("least", F.lit(1).cast("long").alias("leaf"))
    # The first node of its path that a sequence owns, and the bytes before it; it owns all after that.
    owners = rows.groupBy(*NODE).agg(F.min("least").alias("least"), F.max("above").alias("above"))
    since = owners.groupBy("least").agg(F.min(F.struct("d", "above"))["above"].alias("owned_from"))
    marks = scratch.keep(own.select("least").join(since, "least", "left").join(leaves, "least", "left"), "marks")
    owned = F.when(F.col("owned_from").isNotNull(), F.col("total") - F.greatest("above", "owned_from"))
    nodes = rows.join(marks, "least").groupBy(*NODE).agg(
        *[F.max(f"p{n}").alias(f"p{n}") for n in LANES], F.min("least").alias("conv_id"), F.sum("weight").alias("n_convs"),
        F.coalesce(F.sum("leaf"), zero).alias("n_leaves"),
        (F.sum(F.col("weight") * (F.col("total") - F.col("above"))) - F.coalesce(F.sum(owned), zero)).alias("saved_tokens"),
    )
    nodes = scratch.keep(nodes.withColumn("pd", F.col("d") - 1), "nodes")
    scratch.drop("path", "prefixes", "marks")
    up = [f"p{n}" for n in NODE]
    children = nodes.filter("d > 0").groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(*[F.col(n).alias(f"p{n}") for n in NODE], F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(parents, up, "left")
    out = out.join(children.select(*[F.col(f"p{n}").alias(n) for n in NODE], "n_children"), NODE, "left").join(seqs.select(*NODE, "ends_sha256"), NODE, "left")
    return out.select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, conv_id::VARCHAR AS s FROM t GROUP BY conv_id
), h AS (
  SELECT conv_id, base, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(s) + 1), lambda i: [ascii(s[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
         lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) WHEN acc % 2 = 1 THEN xor(acc // 2, 3988292384::BIGINT) ELSE acc // 2 END), 4294967295::BIGINT) % 9 AS h
  FROM c
), r AS (
  SELECT h.conv_id, 0 AS side, t.pos, t.role, t.text FROM h JOIN t ON t.conv_id = h.base AND t.pos <= h.h
  UNION ALL SELECT h.conv_id, 1, t.pos, t.role, t.text FROM h JOIN t ON t.conv_id = h.conv_id AND t.pos > h.h
), l AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY side, pos) AS l FROM r GROUP BY conv_id
), q AS (
  SELECT h.conv_id, coalesce(l.l, []) AS l FROM h LEFT JOIN l ON h.conv_id = l.conv_id
), pre AS (
  SELECT conv_id, d, l[1:d] AS p, len(l) AS n FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM q)
), node AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends,
         coalesce(strlen(p[d].text), 0) AS bytes
  FROM pre GROUP BY p, d
), kid AS (
  SELECT p[1:d - 1] AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1
), full_node AS (
  SELECT node.*, coalesce(kid.n_children, 0) AS n_children FROM node LEFT JOIN kid ON node.p = kid.p
), under AS (
  SELECT p[1:k] AS p, sum((n_convs - 1) * bytes) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM full_node) GROUP BY 1
)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, under.leaves AS n_leaves,
       under.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_node n JOIN under ON n.p = under.p LEFT JOIN node up ON n.d > 0 AND up.p = n.p[1:n.d - 1]
"""
