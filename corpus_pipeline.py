"""The corpus pipeline: five of the training-data operators, each stage on all that the one
before kept. Stages are written as Parquet under the session's checkpoint folder and read
again, so a lost executor costs at most the stage at work.

1. language ID: documents whose text is rejected (no letters, or far from every language) go;
2. line dedup: lines of recurring templates are dropped, the documents stay;
3. SimHash near-dedup: of each group of linked documents the smallest id stays;
4. benchmark decontamination: documents that hold a benchmark item go;
5. SentencePiece: the ids of each document with their byte spans, and the digests of the
   round trip.

``doc_id`` may be null or repeated, texts may be null or empty; each operator's docstring says
what becomes of them. Columns beyond those named are carried through the filtering stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.llm import decontaminate, language_id, line_dedup, sentencepiece_codec, simhash_dedup
from popweave.llm.common import prepare, read
from popweave.session import drop_path, materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language_id.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = line_dedup.dedup(docs)
    if "n_chars" in docs.columns:  # it counts the text's characters
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash_dedup.dedup(docs, width=4, radius=4)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return sentencepiece_codec.round_trip(docs, sentencepiece_codec.public_model()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("sentencepiece", tokens),
]

#: Language models, fingerprints and piece merges have no SQL form; tests/llm compares the
#: pipeline with its stages, and operators with brute force. The whole has no brute-force test yet.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if last is not None:
            drop_path(spark, last)
        last = docs.inputFiles()[0].rsplit("/", 1)[0] if docs.inputFiles() else None
    return docs
