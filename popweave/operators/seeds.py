"""Seed preparation: geography joins, puma assignment, internal-zone filter (JN1, JN2,
PRJ12, PRJ14, PRJ16, SRC3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popweave.config import RunConfig
from popweave.functions.zones import assign_group, in_ranges


def zone_map(zones: DataFrame, cfg: RunConfig) -> DataFrame:
    """Zone dimension ``(zone, pd, puma)``: puma from inclusive PD groups, last match
    wins, 0 when no group holds the PD (SRC3 + PRJ12). Sorting by (pd, zone) is a sink
    concern and is not done here."""
    return zones.select("zone", "pd", assign_group("pd", cfg.pd_groups, 0).alias("puma"))


def households_with_zone(households: DataFrame, zmap: DataFrame) -> DataFrame:
    """Households inner-joined to the zone map on their zone (JN1): unknown zones drop.

    ``zmap`` is a zone dimension; callers pass it through ``broadcast_if_bounded``.
    """
    z = zmap.withColumnRenamed("zone", "household_zone")
    return households.join(z, "household_zone", "inner")


def persons_households(persons: DataFrame, households_z: DataFrame,
                       household_cols: tuple[str, ...] | None = None) -> DataFrame:
    """Persons inner-joined to households on ``household_id`` (JN2).

    Both sides are fact tables: a sort-merge join on the id, shuffled by household.
    The household weight is renamed ``household_weight`` so the person weight keeps
    the name ``expansion_factor``.
    """
    h = households_z.withColumnRenamed("expansion_factor", "household_weight")
    if household_cols is not None:
        h = h.select("household_id", *household_cols)
    return persons.join(h, "household_id", "inner")


def filter_internal(df: DataFrame, zone_col: str, cfg: RunConfig) -> DataFrame:
    """Keep rows whose ``zone_col`` is an internal zone (PRJ14)."""
    return df.filter(in_ranges(zone_col, cfg.internal))


def filter_positive_pd(df: DataFrame, pd_col: str = "pd") -> DataFrame:
    """Keep rows with a valid planning district, ``pd > 0`` (PRJ16)."""
    return df.filter(F.col(pd_col) > 0)
