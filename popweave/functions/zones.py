"""Zone-set predicates and group assignment, all as built-in Column expressions."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.config import ZoneRanges


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_ranges(c: str | Column, zones: ZoneRanges) -> Column:
    """``c`` lies in any inclusive ``[lo, hi]`` pair (PRJ13/PRJ14).

    An OR of ``between`` terms: pushable to Parquet, never a materialised id list.
    """
    col = _col(c)
    terms = [col.between(lo, hi) for lo, hi in zones.ranges]
    if not terms:
        return F.lit(False)
    return reduce(lambda a, b: a | b, terms)


def assign_group(c: str | Column, groups: Sequence[Sequence[int]],
                 otherwise: int | Column = 0) -> Column:
    """Group number (1-based) of the inclusive range holding ``c`` (PRJ12).

    Ranges may share end points; the *last* matching group wins, so the CASE is built
    from the last group backwards. No match gives ``otherwise``.
    """
    col = _col(c)
    expr = None
    for idx in range(len(groups) - 1, -1, -1):
        lo, hi = groups[idx]
        cond = col.between(lo, hi)
        expr = F.when(cond, F.lit(idx + 1)) if expr is None else expr.when(cond, F.lit(idx + 1))
    other = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return other if expr is None else expr.otherwise(other)


def employment_zone_type(c: str | Column, internal: ZoneRanges, roaming_zone: int) -> Column:
    """Roaming / Internal / External label of an employment zone (PRJ17)."""
    col = _col(c)
    return (F.when(col == roaming_zone, F.lit("Roaming"))
            .when(in_ranges(col, internal), F.lit("Internal"))
            .otherwise(F.lit("External")))


def expand_ranges(spark: SparkSession, zones: ZoneRanges, name: str = "zone") -> DataFrame:
    """One row per zone id of a range set (PRJ13), built by ``explode(sequence)``.

    Only for when rows are really needed (e.g. a spine to anti-join); predicates
    should use :func:`in_ranges`.
    """
    pairs = spark.createDataFrame([(lo, hi) for lo, hi in zones.ranges], "lo int, hi int")
    return pairs.select(F.explode(F.sequence("lo", "hi")).alias(name))
