"""A training corpus from raw documents: filter, exact dedup, near dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last
return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from noteflow.llm import exact_dedup, mixing, near_dedup, packing, quality
from noteflow.llm.store import Scratch, documents

STAGES = [
    ("quality", quality.stage),
    ("exact_dedup", exact_dedup.stage),
    ("near_dedup", near_dedup.stage),
    ("mixing", mixing.stage),
    ("packing", packing.stage),
]
#: The first stage is a trained network, so SQL cannot state the rows; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = Scratch(spark, "pipeline"), documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
