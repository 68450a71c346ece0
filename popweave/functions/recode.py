"""Category re-coding by dictionary, as map-literal lookups (PRJ9, PRJ10)."""

from __future__ import annotations

from itertools import chain
from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_literal(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def recode(df: DataFrame, maps: Mapping[str, Mapping]) -> DataFrame:
    """Replace each mapped column by its code; values not in the map become null."""
    for column, mapping in maps.items():
        if column in df.columns:
            df = df.withColumn(column, map_literal(mapping)[F.col(column)])
    return df


def invert(mapping: Mapping) -> dict:
    """code -> label; when two labels share a code the later one wins."""
    out: dict = {}
    for label, code in mapping.items():
        out[code] = label
    return out


def recode_inverse(df: DataFrame, maps: Mapping[str, Mapping]) -> DataFrame:
    """Map codes back to labels (inverse of :func:`recode`); unknown codes become null."""
    return recode(df, {c: invert(m) for c, m in maps.items()})
