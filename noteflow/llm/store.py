"""Tables that an operator writes between its steps, and small helpers that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noteflow.session import ensure_checkpoint_dir


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the session's own in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


class Scratch:
    """A folder of one operator call. It is deleted when the driver ends; ``drop`` deletes a table earlier.

    A written table cuts the lineage: it can be read again after executors are lost, and row numbers
    made before the write hold afterwards.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        path, fs = self._at(self.root)
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def _at(self, where: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(where)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def keep(self, df: DataFrame, tag: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{tag}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{tag}")

    def drop(self, *tags: str) -> None:
        for tag in tags:
            path, fs = self._at(f"{self.root}/{tag}")
            fs.delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def pick_rows(docs: DataFrame, chosen: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` named by ``chosen(_d, _k)``, one for each name; columns as in ``docs``.

    A name is made by ``row_name``. Rows that agree in id and text share it; of those the row with the
    smallest digest over all columns stays.
    """
    rows, t = named_rows(docs, doc_id, text)
    rows = rows.join(chosen.select(F.col("_d").alias(f"{t}d"), F.col("_k").alias(f"{t}k")), [f"{t}d", f"{t}k"], "left_semi")
    digest = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])))
    first = F.row_number().over(Window.partitionBy(f"{t}d", f"{t}k").orderBy(digest))
    return rows.withColumn(f"{t}first", first).filter(f"{t}first = 1").select(*[F.col(f"`{c}`") for c in docs.columns])


def named_rows(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, str]:
    """``docs`` with the parts of the row name in two more columns, and the prefix of such columns, free in ``docs``."""
    tag = "_"
    while any(c.startswith(tag) for c in docs.columns):
        tag += "_"
    names = row_name(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    return docs.withColumns({f"{tag}{k[1:]}": c for k, c in names.items()}), tag


def row_name(doc_id: Column, text: Column) -> dict[str, Column]:
    return {"_d": F.coalesce(doc_id.cast("long"), F.lit(0)), "_k": F.xxhash64(text, doc_id.isNull())}
