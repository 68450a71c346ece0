"""Household sampling and population slicing (SM1, SM3, JN10).

The surveyed behaviour samples person *rows* per puma and keeps every household with at
least one sampled member (size-biased, weights unchanged, D4). Draws are keyed hashes,
so the sample is repeatable and survives task retries.

* ``method="threshold"`` (default, scales): a row is sampled when its keyed uniform is
  below ``frac``. No shuffle beyond the household grouping the input already has.
* ``method="exact"``: per puma exactly ``round_half_even(frac * rows)`` rows, the ones with the
  smallest keyed uniform. A histogram of the uniforms per puma finds the bucket that the last
  of them falls into; buckets before it are kept whole and only that bucket's rows (one in
  ``BUCKETS``) are ranked, so records are neither sorted nor ranged for the choice.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from popweave.functions.draws import keyed_uniform
from popweave.functions.sizing import broadcast_if_bounded
from popweave.session import materialize

BUCKETS = 1 << 16  # of the uniforms' histogram


def sampled_household_ids(persons_hh: DataFrame, frac: float, key_cols: Sequence[str],
                          group: str = "puma", method: str = "threshold",
                          salt: str = "sample") -> DataFrame:
    """Distinct ``household_id`` of households with at least one sampled member."""
    u = keyed_uniform(salt, *key_cols)
    if method == "threshold":
        rows = persons_hh.select("household_id", u.alias("_u")).filter(F.col("_u") < frac)
        return rows.select("household_id").distinct()
    if method != "exact":
        raise ValueError(f"unknown sampling method {method!r}")
    rows = persons_hh.select(group, "household_id", *[c for c in key_cols if c != "household_id"], u.alias("_u"),
                             F.floor(u * BUCKETS).cast("int").alias("_b"))
    counts = rows.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))  # at most BUCKETS rows a puma
    run = Window.partitionBy(group).orderBy("_b")
    cum = counts.select(group, "_b", (F.sum("_n").over(run) - F.col("_n")).alias("_before"), F.sum("_n").over(run).alias("_upto"),
                        F.bround(F.sum("_n").over(Window.partitionBy(group)) * F.lit(frac), 0).cast("long").alias("_k"))
    # the bucket that the last row to keep falls into: one row a puma, broadcast behind a count
    edge = cum.filter("_before < _k AND _k <= _upto").select(
        F.col(group), F.col("_b").alias("_edge"), (F.col("_k") - F.col("_before")).alias("_rest"))
    placed = rows.join(broadcast_if_bounded(materialize(edge, "sample-edges")), group)
    whole = placed.filter("_b < _edge").select("household_id")
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_u", *key_cols))
    part = placed.filter("_b = _edge").withColumn("_rank", rank).filter("_rank <= _rest").select("household_id")
    return whole.unionByName(part).distinct()


def sample_households(persons_hh: DataFrame, frac: float, key_cols: Sequence[str],
                      group: str = "puma", method: str = "threshold") -> DataFrame:
    """All person rows of households that have a sampled member (SM1 + JN10 semi-join)."""
    if frac >= 1.0:
        return persons_hh
    ids = sampled_household_ids(persons_hh, frac, key_cols, group, method)
    return persons_hh.join(ids, "household_id", "left_semi")


def slice_population(households: DataFrame, persons: DataFrame, frac: float,
                     weight_cols_h: Sequence[str] = ("expansion_factor",),
                     weight_cols_p: Sequence[str] = ("expansion_factor",),
                     salt: str = "slice") -> tuple[DataFrame, DataFrame]:
    """Keep a keyed-hash ``frac`` of households (and their persons), weights x 1/frac (SM3)."""
    keep = keyed_uniform(salt, "household_id") < frac
    h = households.filter(keep)
    p = persons.filter(keep)
    for c in weight_cols_h:
        h = h.withColumn(c, F.col(c) * F.lit(1.0 / frac))
    for c in weight_cols_p:
        p = p.withColumn(c, F.col(c) * F.lit(1.0 / frac))
    return h, p
