"""Data-quality checks (PL5) and household-size repair (AG27)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``n`` (PL5: what a primary key
    would have rejected). An aggregate with map-side partial counts."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def repair_household_size(persons_hh: DataFrame, order: Sequence[str] = ("person_number",),
                          size_col: str = "number_of_persons",
                          number_col: str = "person_number") -> DataFrame:
    """Where a household's stated size differs from its person rows, set the size to the
    row count and renumber its persons 1..n (AG27). Other households are unchanged.

    The count is an aggregate joined back on the household key; the renumbering is a
    distributed dense position over (household, order, all columns) minus the
    household's first position, so even a huge household is split across tasks.
    """
    from popweave.operators.ids import dense_position

    key = "household_id"
    rest = [c for c in persons_hh.columns if c != key and c not in order]
    pos = dense_position(persons_hh, [key, *order, *rest], "_pos")
    # row count and first position in one aggregate (partial map-side), joined back once
    stats = pos.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    j = pos.join(stats, key, "inner")
    bad = F.col(size_col) != F.col("_n")
    return (j.withColumn(f"original_{number_col}", F.col(number_col))
            .withColumn(number_col, F.when(bad, (F.col("_pos") - F.col("_first") + 1).cast("int"))
                        .otherwise(F.col(number_col)))
            .withColumn(size_col, F.when(bad, F.col("_n").cast("int")).otherwise(F.col(size_col)))
            .drop("_n", "_pos", "_first"))
