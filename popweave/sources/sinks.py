"""Sinks (SNK1-SNK10): CSV files with the original headers, Parquet, catalog tables."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite",
              sort_by: Sequence[str] = ()) -> None:
    """CSV output (SNK1, SNK2, SNK5, SNK7, SNK8 with ``header=False``). Sorting, when the
    file order matters, happens here at the sink and nowhere earlier (SO1, SO2)."""
    if sort_by:
        df = df.orderBy(*sort_by)
    df.write.mode(mode).option("header", header).csv(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "csv",
                      mode: str = "overwrite") -> None:
    """One folder per key combination in a single job (SNK6: the 8 zonal files)."""
    df.write.mode(mode).partitionBy(*by).option("header", True).format(fmt).save(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite",
               bucket_by: Sequence[str] = (), buckets: int = 0) -> None:
    """Catalog table (SNK3, SNK4); ``bucket_by`` co-locates later joins on that key so
    the person-household join reads without a shuffle."""
    w = df.write.mode(mode)
    if bucket_by and buckets:
        w = w.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    w.saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Copy rows into an existing like-typed table, columns found by name (SNK10)."""
    df.select(*df.sparkSession.table(name).columns).write.mode("append").insertInto(name)


def write_report(df: DataFrame, path: str, ordinal: str = "ordinal") -> None:
    """A labelled report as one CSV file whose rows are in report order (SNK7). Reports have as many
    rows as their label list."""
    df.repartition(1).sortWithinPartitions(ordinal).drop(ordinal).write.mode("overwrite").option("header", True).csv(path)


class AuditError(ValueError):
    """A staged table broke its keys; the published one is as it was."""


def publish_table(df: DataFrame, name: str, keys: Sequence[str], quarantine: str | None = None) -> int:
    """Write, audit, publish (PL5, SNK3): rows are staged as a table of their own, their keys
    checked there, and only a table whose keys are unique and not null takes the place of ``name``.

    Rows that break the keys refuse the whole write (``AuditError``) or, with ``quarantine``, are
    written to that table while the others are published. Returns the number of rows set aside."""
    spark = df.sparkSession
    staged, former = f"{name}__staged", f"{name}__former"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    df.write.mode("overwrite").saveAsTable(staged)
    table = spark.table(staged)
    hit = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    bad = (table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
           .filter((F.col("_n") > 1) | F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)))
           .select(*[F.col(k).alias(f"_{k}") for k in keys], "_n"))
    aside = int(bad.agg(F.sum("_n")).first()[0] or 0)
    if aside and quarantine is None:
        spark.sql(f"DROP TABLE {staged}")
        raise AuditError(f"{aside} rows of {name} break its keys {tuple(keys)}")
    if aside:
        on = reduce(lambda a, b: a & b, hit)
        table.join(bad.drop("_n"), on, "left_semi").write.mode("overwrite").saveAsTable(quarantine)
        clean = f"{name}__clean"
        spark.sql(f"DROP TABLE IF EXISTS {clean}")
        table.join(bad.drop("_n"), on, "left_anti").write.saveAsTable(clean)
        spark.sql(f"DROP TABLE {staged}")
        spark.sql(f"ALTER TABLE {clean} RENAME TO {staged}")
    # the swap: two renames of whole tables; readers see the old or the new one
    spark.sql(f"DROP TABLE IF EXISTS {former}")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {former}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {former}")
    return aside
