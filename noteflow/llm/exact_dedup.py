"""Exact duplicates by deterministic block naming, in DataFrame operations only.

Every text is cut into blocks of a fixed number of characters. Equal blocks get one integer name;
then adjacent names are paired and the pairs are named, level by level, until each document has a
single name. Texts are equal exactly when their last level and last name agree, because no step ever
gives one name to two contents:

* Blocks are sorted and grouped under a 128-bit address made from their bytes. The same pass counts the
  different contents of every address; if an address ever held two, all addresses are made anew under
  another seed. Only addresses travel after that, so the text is shuffled once, and only its distinct blocks.
* Pairs are named by their two integers themselves.

A block or pair that a third of all rows share is one row of its name table: it is pre-aggregated in
each map task before the shuffle, and the join back to its users is an ordinary equi-join of narrow
rows on both sides, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noteflow.llm.store import Scratch, pick_rows, row_name

#: Characters that do not count when texts are compared.
BLANKS = r"[\x20\x09-\x0D]+"
#: Characters of a block.
BLOCK_CHARS = 2048
#: Name tables are sorted in so many parts; with 10^11 blocks a part has 24 million narrow rows.
NAME_PARTS = 4096
SEEDS = 8


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def _address(block: Column, seed: int, bits: int) -> Column:
    """Two independent hashes of the block; ``bits`` < 64 makes them clash, for tests."""
    a, b = F.xxhash64(F.lit(seed), block), F.xxhash64(F.lit(-1 - seed), block)
    if bits < 64:
        a, b = F.shiftrightunsigned(a, 64 - bits), F.lit(0).cast("long")
    return F.struct(a.alias("a"), b.alias("b"))


def _blocks(text: Column, chars: int) -> Column:
    return F.regexp_extract_all(normalised(text), F.lit("(?s).{1,%d}" % chars), F.lit(0))


def named(distinct: DataFrame, keys: list[str], parts: int = NAME_PARTS) -> DataFrame:
    """Adds ``name``: the rank inside one of ``parts`` fixed parts and the part, as one integer.

    It depends on the set of rows alone, not on partitions or their order.
    """
    part = F.pmod(F.xxhash64(*keys), F.lit(parts))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return distinct.withColumn("_part", part).withColumn("name", (rank.cast("long") - 1) * parts + F.col("_part")).drop("_part")


def _block_names(docs: DataFrame, text: Column, chars: int, bits: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """(a, b, name) of every distinct block, and the seed under which no address holds two contents."""
    for seed in range(SEEDS):
        block = docs.select(F.explode(_blocks(text, chars)).alias("block"))
        distinct = block.select(_address(F.col("block"), seed, bits).alias("at"), "block").select("at.a", "at.b", "block").distinct()
        names = scratch.keep(named(distinct.groupBy("a", "b").agg(F.count(F.lit(1)).alias("contents")), ["a", "b"]), f"blocks{seed}")
        if bits < 64:
            bits += 8
        if names.filter("contents > 1").isEmpty():
            return names.drop("contents"), seed
        scratch.drop(f"blocks{seed}")
    raise RuntimeError(f"different blocks shared a 128-bit address under {SEEDS} seeds")


def identities(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS, address_bits: int = 64,
    scratch: Scratch | None = None,
) -> DataFrame:
    """One row for each document: rid (a row number), _d and _k (see ``row_name``), doc_id, chars, text_sha256, level, name.

    (level, name) is the collision-free identity of the normalised text. Null counts as empty; all
    empty texts have level -1, name 0.
    """
    scratch = scratch or Scratch(docs.sparkSession, "blocknames")
    body, key = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    names, seed = _block_names(docs, body, block_chars, address_bits, scratch)
    bits = address_bits if address_bits >= 64 else address_bits + 8 * seed
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        key.cast("long").alias("doc_id"),
        *[c.alias(n) for n, c in row_name(key, body).items()],
        F.coalesce(F.char_length(body), F.lit(0)).cast("long").alias("chars"),
        F.sha2(normalised(body).cast("binary"), 256).alias("text_sha256"),
        F.transform(_blocks(body, block_chars), lambda b: _address(b, seed, bits)).alias("at"),
    )
    rows = scratch.keep(rows, "rows")
    small = rows.drop("at")
    cells = rows.select("rid", F.size("at").alias("left"), F.posexplode("at").alias("i", "at")).select("rid", "left", "i", "at.a", "at.b")
    level = scratch.keep(cells.join(names, ["a", "b"]).select("rid", "left", "i", "name"), "level0")
    most = rows.agg(F.max(F.size("at"))).first()[0] or 0
    done = [small.join(rows.filter(F.size("at") == 0).select("rid"), "rid", "left_semi").select("rid", F.lit(-1).alias("level"), F.lit(0).cast("long").alias("name"))]
    for n in range(64):
        done.append(level.filter("left = 1").select("rid", F.lit(n).alias("level"), "name"))
        if most <= 1:
            break
        side = F.col("i") % 2
        pairs = level.filter("left > 1").groupBy("rid", F.floor(F.col("i") / 2).cast("int").alias("i")).agg(
            F.max(F.when(side == 0, F.col("name"))).alias("l"),
            F.coalesce(F.max(F.when(side == 1, F.col("name"))), F.lit(-1)).alias("r"),
            F.max(F.ceil(F.col("left") / 2).cast("int")).alias("left"),
        )
        level = pairs.join(named(pairs.select("l", "r").distinct(), ["l", "r"]), ["l", "r"])
        level = scratch.keep(level.select("rid", "left", "i", "name"), f"level{n + 1}")
        most = (most + 1) // 2
    last = done[0]
    for d in done[1:]:
        last = last.unionByName(d)
    return small.join(last, "rid")


def exact_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS, address_bits: int = 64
) -> DataFrame:
    """One row for each document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256, chars, level, name.

    Of equal texts the row with the most code points in the original text stays, then the smallest
    doc_id (null last); of rows that agree in both, one. Null text counts as empty, and all texts without
    a character that counts are equal. Other columns are ignored; an empty table gives an empty result.
    """
    return _judged(docs, doc_id, text, block_chars, address_bits).drop("rid", "_d", "_k")


def _judged(docs: DataFrame, doc_id: str, text: str, block_chars: int, address_bits: int) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "exactdedup")
    members = scratch.keep(identities(docs, doc_id, text, block_chars, address_bits, scratch), "members")
    order = F.struct("chars", F.col("doc_id").isNotNull(), F.bitwise_not("doc_id"), F.bitwise_not("rid"))
    best = F.max_by(F.struct("doc_id", "rid"), order).alias("best")
    # Written, so that both sides of the join come straight from a shuffle and a hot group can be split.
    groups = scratch.keep(members.groupBy("level", "name").agg(F.count(F.lit(1)).alias("group_size"), best), "groups")
    return members.join(groups, ["level", "name"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("best.rid")).alias("kept"),
        "text_sha256", "chars", "level", "name", "rid", "_d", "_k",
    )


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without all rows that ``exact_dedup`` drops; columns unchanged."""
    return pick_rows(docs, _judged(docs, doc_id, text, BLOCK_CHARS, 64).filter("kept"), doc_id, text)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body
  FROM documents
), k AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS place,
         first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM k
"""
