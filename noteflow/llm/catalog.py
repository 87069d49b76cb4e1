"""The queries of this folder and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from noteflow.llm import divergence, embedding_dedup, exact_dedup, language, licenses, mixing, near_dedup, packing, prefix_trie, quality, sharding, token_counts, url_filter
from noteflow.llm.store import documents

CONTRACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir)).select(*CONTRACT)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_near_dedup": near_dedup.near_documents,
    "op3_quality": quality.quality_scores,
    "op4_language": language.document_languages,
    "op5_sharding": sharding.shard_documents,
    "op6_licenses": licenses.scan_documents,
    "op7_packing": packing.pack_table,
    "op8_token_counts": token_counts.count_tokens,
    "op9_embedding_dedup": embedding_dedup.near_embeddings,
    "op10_mixing": mixing.mix_documents,
    "op11_divergence": divergence.audit_documents,
    "op12_url_filters": url_filter.filter_pages,
    "op13_prefix_trie": prefix_trie.conversation_trie,
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op2_near_dedup": near_dedup.ORACLE,
    "op9_embedding_dedup": embedding_dedup.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op11_divergence": divergence.ORACLE,
    "op12_url_filters": url_filter.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
