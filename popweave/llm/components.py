"""Connected components of a links table by alternating large and small stars.

Every round links each node's larger neighbours to its smallest one, then the reverse, until
the links form stars around the smallest node of each component. A round is two aggregates
(partial minima, so a node with very many links is summed before the shuffle) and two joins,
written to the checkpoint folder; nothing is gathered on the driver but one row of counts. The
joins merge at any size: a links table that Parquet makes small would be broadcast through the
driver, where its rows take many times that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popweave.session import drop_path, materialize


def _large(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u > v").distinct())


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    met = e.join(least.hint("merge"), "u")
    return (met.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .filter("u > v").distinct())


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum("v")).first())


def _path(df: DataFrame) -> str:
    return df.inputFiles()[0].rsplit("/", 1)[0] if df.inputFiles() else ""


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; component: the smallest node reachable.

    Self links, repeated links and nulls are ignored; no links give no rows.
    """
    e = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .filter(F.col(a).isNotNull() & F.col(b).isNotNull()).filter("u > v").distinct(), "links")
    state = _state(e)
    while state[0]:
        new = materialize(_small(_large(e)), "links")
        old, e = e, new
        if path := _path(old):
            drop_path(e.sparkSession, path)
        before, state = state, _state(e)
        if before == state:
            break
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
