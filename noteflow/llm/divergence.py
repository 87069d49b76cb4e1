"""Source divergence audit: how the words of each source differ from those of its language.

A group is a (lang, source). Each language keeps the terms that occur in at least ``LEAST_DOCUMENTS`` of its documents;
every group and the language itself give every kept term an integer share p out of ``UNIT``, smoothed by one
occurrence. The divergence of a group's share p from another share q is floor((p - q)^2 / q).

* Part ``pair`` sums the divergence of a group from each other source of its language over all kept terms. Groups are
  dealt into tiles of ``TILE`` by ``TILE`` sources and into parts of about ``PART_ROWS`` entries by term; a task holds one part
  of one tile and returns one sum for each pair of sources. Terms that neither source has add one constant each.
* Part ``term`` lists the terms that a group uses more than its language does, by divergence. The divergence grows with the
  group's count and falls with the language's, and ties go to the earlier term; so a term that k others dominate in all three
  is not among the first k. Every partition keeps its dominance skyband, the terms dominated by fewer than k others;
  skybands of ``FAN_IN`` partitions are merged into the skyband of their union until one is left for each group, and its terms are ranked
  exactly. A task walks through its terms in an order in which dominating terms come first, and compares them
  with the terms kept so far only; that is enough, because of the terms that dominate one, the first k are always kept.

Terms are counted inside tasks before they are shuffled, so a hot source or a frequent term is a few rows from each task.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noteflow.llm.store import Scratch, documents
from noteflow.operators.scan import join_dimension

LEAST_DOCUMENTS = 3
UNIT = 1_000_000_000
TOP = 200
TILE = 256
PART_ROWS = 4096
FAN_IN = 16
#: Distinct (group, term) that a task counts before it hands them on.
MOST_COUNTED = 200_000
#: Terms of one group that are sorted and compared at once.
SLICE, BLOCK = 50_000, 512

_TERM_BYTES = frozenset(string.ascii_letters.encode()) | frozenset(range(0x80, 0x100))
#: Bytes of terms, A-Z lower-cased; all others become a space.
_FOLDED = bytes(ord(chr(b).lower()) if b < 0x80 and b in _TERM_BYTES else b if b in _TERM_BYTES else 0x20 for b in range(256))
COUNTED = "lang string, source string, term binary, n long, docs long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term and group. The empty term stands for the group itself."""
    seen: dict[tuple[str, str], dict[bytes, list[int]]] = {}
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in seen.items():
            n, docs = (np.fromiter((v[i] for v in terms.values()), np.int64, len(terms)) for i in (0, 1))
            k = len(terms)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()).take(pa.array(np.zeros(k, np.int32))), pa.array([source], pa.string()).take(pa.array(np.zeros(k, np.int32))),
                 pa.array(list(terms), pa.binary()), pa.array(n), pa.array(docs)],
                ["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            terms = seen.get((lang, source))
            if terms is None:
                terms = seen[lang, source] = {b"": [0, 1]}
                held += 1
            own: dict[bytes, int] = {}
            for word in text.as_py().translate(_FOLDED).split():
                own[word] = own.get(word, 0) + 1
            for word, n in own.items():
                got = terms.get(word)
                if got is None:
                    terms[word] = [n, 1]
                    held += 1
                else:
                    got[0] += n
                    got[1] += 1
            if held > MOST_COUNTED:
                yield from out()
                seen, held = {}, 0
    yield from out()


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents. Every group has a row with the empty term."""
    own = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    rows = own.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(_count, COUNTED)
    return rows.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + terms)) in decimals, which hold the product exactly."""
    wide = lambda c: c.cast("decimal(18,0)")
    above = F.lit(UNIT).cast("decimal(10,0)") * wide(count + 1)
    return F.when(total + terms > 0, 1 + F.call_function("div", above, wide(total + terms))).otherwise(F.lit(1).cast("long"))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class Tables:
    """The kept terms of every group with their shares (``entries``), and the groups."""

    def __init__(self, docs: DataFrame, scratch: Scratch, least: int, tile: int, part_rows: int, text: str, lang: str, source: str):
        counts = scratch.keep(term_counts(docs, text, lang, source), "counts")
        kept = counts.filter("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs"))
        kept = scratch.keep(kept.filter(F.col("docs") >= least).drop("docs"), "kept")
        found = counts.filter("term <> ''").select("lang", "source", "term", "n").join(kept, ["lang", "term"])
        found = scratch.keep(found, "found")
        langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("all_n").alias("all_total"))
        sums = found.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows"))
        zero = F.lit(0).cast("long")
        groups = counts.filter("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        groups = groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "rows", "terms", "all_total")])
        # As many rows as there are sources of one language.
        by_lang = Window.partitionBy("lang")
        place = F.row_number().over(by_lang.orderBy("source")) - 1
        groups = groups.withColumns({"at": place, "sources": F.count(F.lit(1)).over(by_lang), "lang_rows": F.sum("rows").over(by_lang)})
        tiles = F.ceil(F.col("sources") / tile).cast("int")
        parts = F.ceil(F.col("lang_rows") * F.least(F.lit(2), tiles) / tiles / part_rows)
        groups = groups.withColumns({"p0": share(zero, F.col("total"), F.col("terms")), "tiles": tiles, "parts": F.greatest(parts.cast("int"), F.lit(1))})
        self.groups = scratch.keep(groups.drop("rows", "lang_rows", "sources"), "groups")
        entries = join_dimension(found, self.groups, ["lang", "source"])
        entries = entries.withColumns({"p": share(F.col("n"), F.col("total"), F.col("terms")), "q": share(F.col("all_n"), F.col("all_total"), F.col("terms"))})
        self.entries = scratch.keep(entries.select("lang", "source", "term", "n", "all_n", "p", "q", "p0", "at", "tiles", "parts"), "entries")
        scratch.drop("found")


def _pair_sums(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Sums of the divergence of each source of one block from each of the other, over the terms of this part."""
    lang, low, high, tile = (k.as_py() for k in key[:4])
    at, p = table["at"].to_numpy(), table["p"].to_numpy()
    code = table["term"].combine_chunks().dictionary_encode()
    term = code.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    names = term < 0
    who, first = np.unique(at[names], return_index=True)
    p0 = p[names][first]
    col, n_terms = np.searchsorted(who, at), len(code.dictionary)
    sums = np.zeros((len(who), len(who)), np.int64)
    order = np.argsort(term, kind="stable")
    order = order[np.count_nonzero(names) :]
    # A slab of terms holds as many shares as SLICE, or one term's.
    step = max(1, SLICE // max(1, len(who)))
    edge = np.searchsorted(term[order], np.arange(0, n_terms + step, step))
    for k in range(len(edge) - 1):
        rows = order[edge[k] : edge[k + 1]]
        held = min(step, n_terms - k * step)
        if held <= 0:
            break
        shares = np.repeat(p0[:, None], held, 1)
        shares[col[rows], term[rows] - k * step] = p[rows]
        for a in range(len(who)):
            gap = shares[a] - shares
            sums[a] += (gap * gap // shares).sum(1)
    block = who // tile
    own = ((block[:, None] == low) & (block[None, :] == high)) | ((block[:, None] == high) & (block[None, :] == low))
    np.fill_diagonal(own, False)
    a, b = np.nonzero(own)
    m = len(a)
    return pa.table({"lang": pa.array([lang] * m, pa.string()), "a": pa.array(who[a], pa.int32()), "b": pa.array(who[b], pa.int32()), "value": sums[a, b], "held": np.full(m, n_terms, np.int64)})


def pairs(tables: Tables, tile: int = TILE) -> DataFrame:
    """(lang, source, item, value) of every group and every other source of its language."""
    keys = ["lang", "low", "high", "tile", "part"]

    def dealt(rows: DataFrame) -> DataFrame:
        block = F.floor(F.col("at") / tile).cast("int")
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        return rows.withColumns({"low": F.least(block, "other"), "high": F.greatest(block, "other"), "tile": F.lit(tile)})

    entries = dealt(tables.entries.select("lang", "term", "at", "p", "tiles", "parts"))
    entries = entries.withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int"))
    names = dealt(tables.groups.select("lang", F.lit(None).cast("string").alias("term"), "at", F.col("p0").alias("p"), "tiles", "parts"))
    names = names.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cols = [*keys, "term", "at", "p"]
    parts = entries.select(*cols).unionByName(names.select(*cols)).groupBy(*keys)
    sums = parts.applyInArrow(_pair_sums, "lang string, a int, b int, value long, held long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("held").alias("held"))
    one = tables.groups.select("lang", F.col("at").alias("a"), "source", F.col("p0").alias("pa"), "terms")
    two = tables.groups.select("lang", F.col("at").alias("b"), F.col("source").alias("item"), F.col("p0").alias("qb"))
    both = join_dimension(join_dimension(sums, one, ["lang", "a"]), two, ["lang", "b"])
    rest = (F.col("terms") - F.col("held")) * divergence(F.col("pa"), F.col("qb"))
    return both.select("lang", "source", "item", (F.col("value") + rest).alias("value"))


BAND = "lang string, source string, term string, n long, all_n long, p long, q long"


def _skyband(k: int):
    """Map over rows sorted by group, count (descending), language count and term: the skyband of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, kept = None, None
        for table in _by_group(batches):
            now = (table["lang"][0].as_py(), table["source"][0].as_py())
            if now != group:
                if kept is not None:
                    yield from kept.to_batches()
                group, kept = now, None
            kept = _grown(kept, table, k)
        if kept is not None:
            yield from kept.to_batches()

    return run


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows of one group, at most ``SLICE`` rows at once."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        n = table.num_rows
        if not n:
            continue
        change = np.zeros(n, bool)
        for name in ("lang", "source"):
            code = table[name].combine_chunks().dictionary_encode().indices.to_numpy()
            change[1:] |= code[1:] != code[:-1]
        edge = np.append(np.flatnonzero(np.append(True, change[1:])), n)
        for lo, hi in zip(edge[:-1], edge[1:]):
            for at in range(lo, hi, SLICE):
                yield table.slice(at, min(SLICE, hi - at))


def _grown(kept: pa.Table | None, more: pa.Table, k: int) -> pa.Table:
    """``kept`` with those rows of ``more`` that fewer than k earlier rows dominate. All of ``kept`` come before ``more``."""
    table = more if kept is None else pa.concat_tables([kept, more])
    table = table.combine_chunks()
    n, old = table.num_rows, 0 if kept is None else kept.num_rows
    rank = np.empty(n, np.int64)
    rank[pc.array_sort_indices(table["term"].combine_chunks().cast(pa.binary())).to_numpy()] = np.arange(n)
    cost = table["all_n"].to_numpy()
    held_cost, held_rank = np.empty(n, np.int64), np.empty(n, np.int64)
    held_cost[:old], held_rank[:old] = cost[:old], rank[:old]
    took, size = [np.arange(old)], old
    for at in range(old, n, BLOCK):
        rows = np.arange(at, min(n, at + BLOCK))
        c, r = cost[rows], rank[rows]
        # Earlier rows of the block count whether they stay or not: what dominates them dominates the later ones too.
        within = (c[None, :] <= c[:, None]) & (r[None, :] < r[:, None])
        count = np.tril(within, -1).sum(1)
        open_ = np.flatnonzero(count < k)
        for lo in range(0, size, 4096):
            if not len(open_):
                break
            hc, hr = held_cost[lo : min(size, lo + 4096)], held_rank[lo : min(size, lo + 4096)]
            count[open_] += ((hc[None, :] <= c[open_, None]) & (hr[None, :] < r[open_, None])).sum(1)
            open_ = open_[count[open_] < k]
        m = len(open_)
        held_cost[size : size + m], held_rank[size : size + m] = c[open_], r[open_]
        size += m
        took.append(rows[open_])
    return table.take(pa.array(np.concatenate(took)))


def skyband(entries: DataFrame, k: int, scratch: Scratch, fan_in: int = FAN_IN) -> DataFrame:
    """The terms of every group that fewer than k others of it dominate. ``entries`` is a written table."""
    order = ["lang", "source", F.desc("n"), "all_n", "term"]
    local = entries.sortWithinPartitions(*order).mapInArrow(_skyband(k), BAND)
    band = scratch.keep(local.withColumn("bucket", F.spark_partition_id()), "band0")
    buckets, level = (band.agg(F.max("bucket")).first()[0] or 0) + 1, 0
    while buckets > 1:
        band = band.withColumn("bucket", F.floor(F.col("bucket") / fan_in).cast("int")).repartition("lang", "source", "bucket")
        merged = band.sortWithinPartitions("bucket", *order).mapInArrow(_merged(k), f"{BAND}, bucket int")
        level += 1
        band = scratch.keep(merged, f"band{level}")
        scratch.drop(f"band{level - 1}")
        buckets = -(-buckets // fan_in)
    return band.drop("bucket")


def _merged(k: int):
    one = _skyband(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one bucket after the other; each bucket is a run of its own."""
        waiting: list[pa.RecordBatch] = []
        source = (b for b in batches if b.num_rows)

        def until_change() -> Iterator[pa.RecordBatch]:
            nonlocal bucket
            while True:
                batch = waiting.pop() if waiting else next(source, None)
                if batch is None:
                    return
                ids = batch.column("bucket").to_numpy()
                if ids[0] != bucket:
                    waiting.append(batch)
                    return
                end = np.searchsorted(ids, bucket, "right")
                if end < len(ids):
                    waiting.append(batch.slice(end))
                yield batch.slice(0, end).drop_columns(["bucket"])

        while True:
            head = waiting[-1] if waiting else next(source, None)
            if head is None:
                return
            if not waiting:
                waiting.append(head)
            bucket = head.column("bucket")[0].as_py()
            for out in one(until_change()):
                yield out.append_column("bucket", pa.array(np.full(out.num_rows, bucket), pa.int32()))

    return run


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", top: int = TOP, least: int = LEAST_DOCUMENTS,
    tile: int = TILE, part_rows: int = PART_ROWS, fan_in: int = FAN_IN,
) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` for every other source, part ``term`` for the first ``top`` terms.

    Null text, language and source are read as empty. Terms are runs of ASCII letters and of characters beyond ASCII; only
    A-Z are lower-cased. Every row is a document, repeated ones too. A group without terms still has its pairs; a language without kept
    terms has the value 0 in all of them; a language with one source has no pairs. Ties in value go by the item's UTF-8 bytes.
    Other columns are ignored; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    tables = Tables(docs, scratch, least, tile, part_rows, text, lang, source)
    more = tables.entries.filter("p > q").select("lang", "source", "term", "n", "all_n", "p", "q")
    band = skyband(more, top, scratch, fan_in)
    terms = band.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    by = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(by)
    # The limit is applied in every partition before the rows are shuffled.
    terms = terms.withColumn("rank", rank).filter(F.col("rank") <= top)
    others = scratch.keep(pairs(tables, tile), "pairs").withColumn("part", F.lit("pair")).withColumn("rank", rank)
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return others.select(*cols).unionByName(terms.select(*cols))


def audit_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), tok AS (SELECT rid, lang, source, unnest(ts) AS term FROM d),
cnt AS (SELECT lang, source, term, count(*) AS n FROM tok GROUP BY ALL),
kept AS (SELECT lang, term, count(*) AS c, count(DISTINCT rid) AS docs FROM tok GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(c) AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
gt AS (
  SELECT g.lang, g.source, kept.term, coalesce(cnt.n, 0) AS n, kept.c FROM g JOIN kept USING (lang)
  LEFT JOIN cnt ON cnt.lang = g.lang AND cnt.source = g.source AND cnt.term = kept.term
), s AS (SELECT lang, source, sum(n) AS total FROM gt GROUP BY ALL),
p AS (
  SELECT gt.lang, gt.source, gt.term, gt.n,
         1 + (1000000000::HUGEINT * (gt.n + 1)) // (s.total + langs.v) AS p,
         1 + (1000000000::HUGEINT * (gt.c + 1)) // (langs.total + langs.v) AS q
  FROM gt JOIN s USING (lang, source) JOIN langs USING (lang)
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pairs UNION ALL FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
