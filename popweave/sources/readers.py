"""Typed readers for the original file formats (SRC1-SRC12). Nothing is inferred."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from popweave.config import CONTROL_KEYS_MAZ
from popweave.sources import schemas as S

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def typed(df: DataFrame, schema: T.StructType, empty_as_zero: bool = False) -> DataFrame:
    """Text columns to ``schema``, found by name (files may order theirs as they like and have
    more). A missing column or text that isn't of its column's type stops the run: as a null it
    would vanish in the next join."""
    if missing := [f.name for f in schema.fields if f.name not in df.columns]:
        raise ValueError(f"columns {missing} are missing among {df.columns}")
    out = []
    for f in schema.fields:
        text = F.trim(F.col(f"`{f.name}`"))
        if isinstance(f.dataType, T.StringType):
            out.append(F.col(f"`{f.name}`").alias(f.name))
            continue
        value = text.try_cast(f.dataType)
        bad = F.raise_error(F.concat(F.lit(f"{f.name} is not {f.dataType.simpleString()}: "), text)).cast(f.dataType)
        value = F.when(text.isNotNull() & (text != "") & value.isNull(), bad).otherwise(value)
        if empty_as_zero and isinstance(f.dataType, _INTEGRAL):
            value = F.coalesce(value, F.lit(0).cast(f.dataType))
        out.append(value.alias(f.name))
    return df.select(*out)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             empty_as_zero: bool = False) -> DataFrame:
    """CSV with an explicit schema, columns by name (by position only without a header); with
    ``empty_as_zero`` empty integer fields read as 0 (the bulk loader's lenient mode, SRC11)."""
    if header:
        df = spark.read.option("header", True).csv(path)
    else:
        df = spark.read.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])).csv(path)
    return typed(df, schema, empty_as_zero)


def _renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def read_person_seed(spark: SparkSession, path: str) -> DataFrame:
    """SRC1: person seed CSV -> snake_case columns."""
    return _renamed(read_csv(spark, path, S.PERSON_SEED), S.SEED_PERSON_RENAMES)


def read_household_seed(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: household seed CSV -> snake_case columns."""
    return _renamed(read_csv(spark, path, S.HOUSEHOLD_SEED), S.SEED_HOUSEHOLD_RENAMES)


def read_zone_map(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: ``Zone, PD`` columns of a zones file (other columns ignored)."""
    return _renamed(read_csv(spark, path, S.ZONE_MAP), {"Zone": "zone", "PD": "pd"})


def read_controls(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: a control table CSV; keys are int, every other column a 64-bit total."""
    df = spark.read.option("header", True).csv(path)
    return typed(df, T.StructType([T.StructField(c, T.IntegerType() if c in CONTROL_KEYS_MAZ else T.LongType())
                                   for c in df.columns]))


def read_population_vector(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: first column = zone, last column = new population; renamed on read so a
    vector column named like a control (e.g. ``totpop``) cannot clash."""
    df = spark.read.option("header", True).csv(path)
    pair = df.select(F.col(f"`{df.columns[0]}`").alias("zone"), F.col(f"`{df.columns[-1]}`").alias("population"))
    return typed(pair, S.POPULATION_VECTOR)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """SRC6/SRC7: a catalog table, or a Parquet path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)
