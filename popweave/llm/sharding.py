"""Contiguous shards of near-equal bytes (operator 6).

Method: every row has a byte size; the global prefix sum of the sizes, built from
per-partition totals, is cut at equal targets. Rows keep the order of ``order``, so a shard is
a contiguous stretch of it. Only the narrow columns are shuffled, never the texts.

Defined cases: null or empty text has size 1 (its separator) and CRC 0; ties on ``order`` and repeated
rows each get a slot of their own; an empty table gives no rows; other columns of the input
are carried along, columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.llm.common import positions, prepare, read
from popweave.session import materialize

OUT = ("shard", "slot", "pos", "before")


def byte_size(text: str = "text"):
    """UTF-8 bytes of the text (null: none) plus one for its separator."""
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + F.lit(1)).cast("long")


def assign(df: DataFrame, n_shards: int, size: str = "size", order: list[str] | None = None) -> DataFrame:
    """Add ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (gapless from 0 within the shard).

    A row goes to the shard in which the middle of its byte range falls, so a shard's bytes
    differ from the target by at most one row's size at either end.
    """
    df = df.drop(*OUT)
    placed = positions(df, order or [df.columns[0]], size)
    total = placed.agg(F.max(F.col("before") + F.col(size)).alias("t")).select("t").scalar()
    # decimal(38): twice the byte total of any corpus times the shard count
    middle = (F.col("before").cast("decimal(38,0)") * 2 + F.col(size)) * n_shards
    shard = F.least(F.lit(n_shards - 1), F.floor(middle / (total.cast("decimal(38,0)") * 2)).cast("int"))
    placed = materialize(placed.withColumn("shard", shard), "shards")
    first = placed.groupBy("shard").agg(F.min("pos").alias("_first"))  # n_shards rows
    return (placed.join(F.broadcast(first), "shard")
            .withColumn("slot", F.col("pos") - F.col("_first"))
            .drop("_first", "pos", "before"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = read(spark, sf_dir, "documents").select(
        "doc_id", byte_size().alias("size"), F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"))
    return assign(rows, 8, "size", ["doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
