"""Re-scaling control tables to a forecast population vector (FC1-FC5, AG25, AG26, JN3,
JN4, PRJ6).

All frames here live on the zone dimension (one row per zone), so every step is a
small join or aggregate. The per-puma ratio row chosen for zero-base zones is attached
as a scalar subquery (one struct value), not through a join without keys.

Zone classes (FC1): ``t1`` base > 0 and new > 0, ``t2`` base = 0 and new > 0,
``t3`` new = 0.
* t1: every control column x (new / base)                                   (FC2)
* t2: totpop = new; other controls = puma ratio (control / totpop over t1 zones)
  x new totpop; ``fallback="last_group"`` uses the highest non-zero puma's ratio for
  every zone (D6, the surveyed behaviour), ``"own_group"`` the zone's own puma  (FC3)
* t3: 0                                                                      (FC4)
Then every column is ceiled to int (PRJ6). Meta gets the summed new totpop/totalhh on
every region, summed before the ceiling (D8).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popweave.config import CONTROL_KEYS_MAZ, NEW_ZONE_PUMA, NEW_ZONE_REGION, RunConfig
from popweave.functions.sizing import broadcast_if_bounded
from popweave.functions.zones import assign_group
from popweave.session import materialize

KEYS = ("region", "puma", "taz", "maz")
BASE = "totpop"
NEW = "_new"
CLASS = "_class"
ORIG_PUMA = "_puma0"
EXACT = "decimal(38,18)"


def map_control_puma(controls: DataFrame, zone_key: str, zones: DataFrame,
                     cfg: RunConfig) -> DataFrame:
    """Controls inner-joined to the zone map (JN3); puma re-derived from the PD groups,
    last match wins, unchanged when no group holds the PD (PRJ12 on controls)."""
    z = zones.select(F.col("zone").alias(zone_key), "pd")
    j = controls.join(broadcast_if_bounded(z), zone_key, "inner")
    return j.withColumn("puma", assign_group("pd", cfg.pd_groups, F.col("puma"))).drop("pd")


def outer_with_vector(controls: DataFrame, zone_key: str, vector: DataFrame,
                      measures: Sequence[str], new_zone_region: int = NEW_ZONE_REGION,
                      new_zone_puma: int = NEW_ZONE_PUMA) -> DataFrame:
    """Full outer join of controls and the population vector (JN4), nulls -> 0; zones
    new to the controls get region 1 and puma 3 by default (D9), as does any puma 0."""
    v = vector.select(F.col("zone").alias("_vz"), F.col("population").alias(NEW))
    j = controls.join(v, controls[zone_key] == v["_vz"], "full_outer")
    key = F.coalesce(controls[zone_key], F.col("_vz"))
    region = F.coalesce(F.col("region"), F.lit(0))
    puma = F.coalesce(F.col("puma"), F.lit(0))
    return j.select(
        F.when(region == 0, F.lit(new_zone_region)).otherwise(region).alias("region"),
        F.when(puma == 0, F.lit(new_zone_puma)).otherwise(puma).alias("puma"),
        F.col("puma").alias(ORIG_PUMA),
        key.alias("taz"), key.alias("maz"),
        *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures],
        F.coalesce(F.col(NEW), F.lit(0.0)).alias(NEW),
    )


def zone_class(base: Column, new: Column) -> Column:
    """FC1."""
    return (F.when((base > 0) & (new > 0), F.lit("t1"))
            .when((base == 0) & (new > 0), F.lit("t2"))
            .when(new == 0, F.lit("t3")))


def forecast_ratios(classified: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per original puma, control / totpop summed over t1 zones (AG25)."""
    t1 = classified.filter(F.col(CLASS) == "t1")
    tot = F.sum(BASE).cast("double")
    return t1.groupBy(ORIG_PUMA).agg(*[(F.sum(c).cast("double") / tot).alias(c) for c in columns])


def _control_columns(measures: Sequence[str], cfg: RunConfig) -> tuple[list[str], list[str]]:
    person = [c for c in cfg.person_control_columns if c in measures]
    household = [c for c in cfg.household_control_columns if c in measures and c not in person]
    return person, household


def forecast_zone_values(maz: DataFrame, vector: DataFrame, zones: DataFrame, cfg: RunConfig,
                         fallback: str = "last_group") -> tuple[DataFrame, list[str]]:
    """Unceiled forecast MAZ values and the list of control columns."""
    measures = [c for c in maz.columns if c not in KEYS]
    person, household = _control_columns(measures, cfg)
    controls = person + household
    m = outer_with_vector(map_control_puma(maz, "maz", zones, cfg), "maz", vector, measures)
    m = m.withColumn(CLASS, zone_class(F.col(BASE), F.col(NEW)))
    ratios = forecast_ratios(m, controls)
    packed = F.struct(*[F.col(c) for c in controls])
    if fallback == "last_group":
        last = ratios.filter(F.col(ORIG_PUMA) != 0).orderBy(F.col(ORIG_PUMA).desc()).limit(1)
        m = m.withColumn("_r", last.select(packed.alias("_r")).scalar())
    elif fallback == "own_group":
        own = ratios.select(F.col(ORIG_PUMA).alias("_rp"), packed.alias("_r"))
        m = m.join(broadcast_if_bounded(own), m["puma"] == own["_rp"], "left").drop("_rp")
    else:
        raise ValueError(f"unknown fallback {fallback!r}")

    # totpop of a zero-base zone becomes the new population as soon as any non-zero puma
    # has t1 zones (the surveyed loop sets it inside the puma loop); other controls need
    # the ratio row chosen above
    any_ratio = ratios.select((F.count(F.when(F.col(ORIG_PUMA) != 0, 1)) > 0).alias("_a")).scalar()
    m = m.withColumn("_any", any_ratio)
    has = F.col("_r").isNotNull()
    cls = F.col(CLASS)
    new_totpop = (F.when(F.col("_any"), F.col(NEW)).otherwise(F.col(BASE)) if BASE in person
                  else F.col(BASE))

    def value(c: str) -> Column:
        t1 = F.col(c) * (F.col(NEW) / F.col(BASE))
        t2 = new_totpop if c == BASE else F.when(has, F.col("_r")[c] * new_totpop).otherwise(F.col(c))
        return (F.when(cls == "t1", t1).when(cls == "t2", t2).when(cls == "t3", F.lit(0.0))
                .otherwise(F.col(c).cast("double")))

    keep = set(controls)
    out = m.select(*KEYS, *[value(c).alias(c) if c in keep else F.col(c) for c in measures])
    return out.select(*KEYS, *[c for c in measures if c in keep]), controls


def ceil_int(c: str) -> Column:
    """PRJ6: keys to int, totals to 64 bits."""
    return F.ceil(F.col(c)).cast("int" if c in CONTROL_KEYS_MAZ else "bigint").alias(c)


def forecast_maz(maz: DataFrame, vector: DataFrame, zones: DataFrame, cfg: RunConfig,
                 fallback: str = "last_group") -> DataFrame:
    vals, _ = forecast_zone_values(maz, vector, zones, cfg, fallback)
    return vals.select(*[ceil_int(c) for c in vals.columns])


def forecast_taz(taz: DataFrame, maz_values: DataFrame, controls: Sequence[str],
                 vector: DataFrame, zones: DataFrame, cfg: RunConfig) -> DataFrame:
    """TAZ rows take the MAZ forecast value of the same zone id where one exists."""
    measures = [c for c in taz.columns if c not in ("region", "puma", "taz")]
    t = outer_with_vector(map_control_puma(taz, "taz", zones, cfg), "taz", vector, measures)
    mv = maz_values.select(F.col("maz").alias("taz"), *[F.col(c).alias(f"_m_{c}") for c in controls])
    j = t.join(mv, "taz", "left")
    keep = [c for c in measures if c in set(controls)]
    return j.select(ceil_int("region"), ceil_int("puma"), ceil_int("taz"),
                    *[F.ceil(F.coalesce(F.col(f"_m_{c}"), F.col(c).cast("double"))).cast("bigint").alias(c)
                      for c in keep])


def forecast_meta(meta: DataFrame, maz_values: DataFrame, rescale_meta: bool = False) -> DataFrame:
    """Meta with totpop/totalhh replaced by the summed forecast (same value on every
    region, AG26), summed exactly as decimals, then every column ceiled. With
    ``rescale_meta`` every meta measure present in the MAZ forecast is replaced the same
    way (the surveyed run leaves the others at their base values, D8)."""
    names = [c for c in meta.columns if c != "region" and c in maz_values.columns] if rescale_meta \
        else [c for c in ("totpop", "totalhh") if c in maz_values.columns]
    out = meta
    if names:
        sums = [F.sum(F.col(c).cast(EXACT)).alias(c) for c in names]
        scal = maz_values.select(F.struct(*sums).alias("_t")).scalar()
        out = meta.withColumn("_t", scal)
        for c in names:
            out = out.withColumn(c, F.col("_t")[c])
        out = out.drop("_t")
    return out.select(*[ceil_int(c) for c in meta.columns])


def apply_population_vector(maz: DataFrame, taz: DataFrame, meta: DataFrame,
                            vector: DataFrame, zones: DataFrame, cfg: RunConfig,
                            fallback: str = "last_group", rescale_meta: bool = False
                            ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """FC5: (maz, taz, meta) re-scaled to the vector.

    The unceiled MAZ values feed all three outputs and two scalar subqueries; they are
    zone-sized, so they are written once (under the checkpoint folder) instead of being
    recomputed per use."""
    vals, controls = forecast_zone_values(maz, vector, zones, cfg, fallback)
    vals = materialize(vals, "forecast-values")
    return (vals.select(*[ceil_int(c) for c in vals.columns]),
            forecast_taz(taz, vals, controls, vector, zones, cfg),
            forecast_meta(meta, vals, rescale_meta))
