"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from popweave.llm import (
    centroid_clusters,
    chat_format,
    decontaminate,
    embedding_dedup,
    fill_in_middle,
    language_id,
    license_scan,
    line_dedup,
    sentencepiece_codec,
    sharding,
    simhash_dedup,
    substring_dedup,
    topk_search,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": sentencepiece_codec.query,
    "op2_decontamination": decontaminate.query,
    "op3_license_scan": license_scan.query,
    "op4_line_dedup": line_dedup.query,
    "op5_substring_dedup": substring_dedup.query,
    "op6_sharding": sharding.query,
    "op7_language_id": language_id.query,
    "op8_simhash": simhash_dedup.query,
    "op9_chat_format": chat_format.query,
    "op10_embedding_dedup": embedding_dedup.query,
    "op11_fill_in_middle": fill_in_middle.query,
    "op12_centroid_clusters": centroid_clusters.query,
    "op13_topk_search": topk_search.query,
}
ORACLE: dict[str, str] = {
    "op10_embedding_dedup": embedding_dedup.SQL,
    "op11_fill_in_middle": fill_in_middle.SQL,
    "op12_centroid_clusters": centroid_clusters.SQL,
    "op13_topk_search": topk_search.SQL,
}
