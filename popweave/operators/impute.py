"""Weighted category shares and invalid-code imputation (AG17, SM2).

An invalid code is replaced by a draw from the weighted shares of the valid codes in
the record's own group (puma). The draw is an inverse-CDF lookup with a keyed uniform
``u``: the category is the first whose cumulative bound exceeds ``u``.

Plan shape: one aggregate over the records on the joint codes (partial sums map-side),
split into ``(group, column, value) -> weight`` for every imputed column at once; a tiny window cumulates it; the bounds are folded
into one row per group holding sorted arrays, and that table (one row per group id,
so bounded by the number of groups) is broadcast-joined back. No shuffle of records
beyond the aggregate's partial sums, no range join, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from popweave.functions.draws import keyed_uniform
from popweave.functions.sizing import broadcast_if_bounded
from popweave.session import materialize


UNROLLED = 16  # bounds of a group that a draw is compared with one by one; more are sorted


@dataclass(frozen=True)
class ImputeSpec:
    column: str
    invalid: object
    salt: str | None = None  # key prefix for the draw; defaults to the column name


def category_shares(df: DataFrame, columns: Sequence[ImputeSpec], weight: str,
                    group: str = "puma") -> DataFrame:
    """``(group, column, value, weight, share, lower, upper)`` over valid values (AG17).

    Shares are weighted by ``weight``; values sort ascending inside a group. Sums stay
    in the weight's own type (exact for decimals) and are divided once as doubles.
    """
    types = dict(df.dtypes)

    def num_key(c: str):
        numeric = types[c] in ("tinyint", "smallint", "int", "bigint", "float", "double") \
            or types[c].startswith("decimal")
        return F.col(c).cast("double") if numeric else F.lit(None).cast("double")

    items = F.array(*[
        F.struct(F.lit(s.column).alias("column"), num_key(s.column).alias("num"),
                 F.col(s.column).cast("string").alias("value"),
                 (F.col(s.column).isNotNull() & (F.col(s.column) != F.lit(s.invalid))).alias("ok"))
        for s in columns
    ])
    # Pre-aggregate on the joint codes first (partial sums map-side; the output is bounded
    # by groups x the product of the code domains), then split it per column. That small
    # result is hash-partitioned by group once: the per-code sums, the cumulative window
    # and the per-group fold downstream all cluster on the group, so they add no exchange.
    cols = list(dict.fromkeys(s.column for s in columns))
    pre = df.groupBy(group, *cols).agg(F.sum(weight).alias("_w")).repartition(group)
    long = (pre.select(group, "_w", F.explode(items).alias("it"))
            .filter("it.ok")
            .select(group, "it.column", "it.num", "it.value", "_w"))
    sums = long.groupBy(group, "column", "num", "value").agg(F.sum("_w").alias("w"))
    order = Window.partitionBy(group, "column").orderBy("num", "value")
    whole = Window.partitionBy(group, "column")
    cum = F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("w").over(whole)
    return sums.select(
        group, "column", "num", "value", F.col("w").alias("weight"),
        (F.col("w").cast("double") / total.cast("double")).alias("share"),
        ((cum - F.col("w")).cast("double") / total.cast("double")).alias("lower"),
        (cum.cast("double") / total.cast("double")).alias("upper"),
    )


def _bounds_by_group(shares: DataFrame, columns: Sequence[ImputeSpec], group: str) -> DataFrame:
    aggs = []
    for s in columns:
        pairs = F.array_sort(F.collect_list(
            F.when(F.col("column") == s.column, F.struct(F.col("num"), F.col("value"), F.coalesce("upper", F.lit(2.0)).alias("upper")))))
        aggs.append(pairs.alias(f"_b_{s.column}"))
    return shares.groupBy(group).agg(*aggs)


def resample_invalid(df: DataFrame, columns: Sequence[ImputeSpec], weight: str,
                     key_cols: Sequence[str], group: str = "puma",
                     pool: str | None = None) -> DataFrame:
    """Replace each spec's invalid code by a keyed draw from its group's valid shares.

    ``pool=None`` draws from the record's own group (the documented intent, D3);
    ``pool="global:<g>"`` draws every record from group ``g``'s shares (the surveyed
    literal behaviour with ``g = 1``). A group with no valid value keeps the invalid code
    (nothing to draw from). Types are kept: integer columns get integer draws.
    """
    shares = category_shares(df, columns, weight, group)
    bounds = _bounds_by_group(shares, columns, group).withColumnRenamed(group, "_pool")
    # one row per group id, written once; broadcast behind a count, as ``group`` is the caller's
    bounds = materialize(bounds, "draw-bounds")
    most = bounds.select(F.max(F.greatest(F.lit(0), *[F.size(f"_b_{s.column}") for s in columns]))).first()[0] or 0
    bounds = broadcast_if_bounded(bounds)
    if pool is None:
        key = F.col(group)
    elif pool.startswith("global:"):
        key = F.lit(int(pool.split(":", 1)[1]))
    else:
        raise ValueError(f"unknown pool {pool!r}")
    types = dict(df.dtypes)
    out = df.withColumn("_pool", key.cast(types[group])).join(bounds, "_pool", "left") \
            .drop("_pool")
    # a column of its own: what is read several times in one expression is hashed anew each time
    out = out.withColumns({f"_u_{s.column}": F.when((F.col(s.column) == F.lit(s.invalid)) & (F.size(f"_b_{s.column}") > 0),
                                                    keyed_uniform(s.salt or s.column, *key_cols)) for s in columns})
    for s in columns:
        arr, u = F.col(f"_b_{s.column}"), F.col(f"_u_{s.column}")
        if most <= UNROLLED:
            upto = sum((F.when(F.get(arr, F.lit(i))["upper"] <= u, 1).otherwise(0) for i in range(most)), F.lit(0))
        else:
            # u stands first of its equals in falling order
            upto = F.size(arr) - F.array_position(F.sort_array(F.concat(arr["upper"], F.array(u)), asc=False), u) + 1
        drawn = F.element_at(arr, (upto + 1).cast("int"))["value"]  # 1 + the number of bounds up to u
        out = out.withColumn(s.column, F.when(u.isNotNull(), drawn.cast(types[s.column])).otherwise(F.col(s.column)))
    return out.drop(*[f"{x}{s.column}" for s in columns for x in ("_b_", "_u_")])
