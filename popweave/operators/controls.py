"""Control totals at MAZ, TAZ and meta level (AG1-AG16, JN5, PRJ5, PRJ15, PRJ18, PRJ19).

Every measure is a conditional weighted sum. All household measures are one
``groupBy(zone).agg(...)`` and all person measures another: two scans, each with
map-side partial aggregation, so the shuffle carries one row per (task, zone) instead
of one per record. The per-zone results (bounded by the zone dimension) are
left-joined onto the internal-zone spine; AQE turns those joins into broadcasts from
runtime sizes.

Raw (untruncated) sums are kept in one frame; MAZ and TAZ truncate per zone and meta
sums the raw values before truncating, so meta >= sum of truncated zones (D5).
"""

from __future__ import annotations

import re
from decimal import Decimal
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popweave.config import (AGE_BINS, AGE_COLUMNS, CONTROL_KEYS_MAZ, CONTROL_KEYS_TAZ,
                             CONTROL_MEASURES, META_MEASURES, RunConfig)
from popweave.functions.zones import in_ranges


HALF = 30  # bits of the lower part of a weight's whole units


# --- AG1-AG3: conditional weighted sums --------------------------------------------

def sum_where(cond: Column, weight: str) -> Column:
    """``sum(weight) where cond`` (null when nothing matches; filled with 0 later)."""
    return F.sum(F.when(cond, F.col(weight)))


def sum_eq(column: str, value, weight: str) -> Column:          # AG1
    return sum_where(F.col(column) == F.lit(value), weight)


def sum_gte(column: str, value, weight: str) -> Column:         # AG2
    return sum_where(F.col(column) >= F.lit(value), weight)


def sum_between(column: str, lo, hi, weight: str) -> Column:    # AG3
    return sum_where(F.col(column).between(lo, hi), weight)


# --- measure groups ----------------------------------------------------------------

def household_measures(weight: str = "expansion_factor") -> list[Column]:
    """totalhh (AG4), income classes 1-6 (AG8), household sizes 1,2,3,4+ (AG9)."""
    out = [F.sum(weight).alias("totalhh")]
    out += [sum_eq("income_class", k, weight).alias(f"income_class_{k}") for k in range(1, 7)]
    out += [sum_eq("number_of_persons", k, weight).alias(f"hhsize{k}") for k in (1, 2, 3)]
    out.append(sum_gte("number_of_persons", 4, weight).alias("hhsize4p"))
    return out


def employment_zone_measures(cfg: RunConfig, weight: str) -> list[Column]:
    """Internal / external (roaming id excluded) / roaming / zone 0 (AG7, PRJ15, D11)."""
    ez = F.col("employment_zone")
    return [
        sum_where(in_ranges(ez, cfg.internal), weight).alias("employment_zone_internal"),
        sum_where(ez == cfg.roaming_zone, weight).alias("employment_zone_roaming"),
        sum_where(in_ranges(ez, cfg.external) & (ez != cfg.roaming_zone), weight)
        .alias("employment_zone_external"),
        sum_where(ez == 0, weight).alias("employment_zone_0"),
    ]


def person_measures(cfg: RunConfig, weight: str = "expansion_factor") -> list[Column]:
    """totpop (AG4), sex (AG6), employment zone (AG7), age (AG10), employment status
    (AG11), occupation (AG12), license and student status (AG13)."""
    out = [F.sum(weight).alias("totpop"),
           sum_eq("sex", "M", weight).alias("male"),
           sum_eq("sex", "F", weight).alias("female")]
    out += employment_zone_measures(cfg, weight)
    out += [sum_between("age", lo, hi, weight).alias(name)
            for (lo, hi), name in zip(AGE_BINS, AGE_COLUMNS)]
    out += [sum_eq("employment_status", v, weight).alias(f"E_{v}") for v in "JPFOH"]
    out += [sum_eq("occupation", v, weight).alias(v) for v in "PGSMO"]
    out += [sum_eq("license", v, weight).alias(f"license_{v}") for v in "YN"]
    out += [sum_eq("student_status", v, weight).alias(f"S_{v}") for v in "OSP"]
    return out


def zone_sums(df: DataFrame, zone: str, measures: Callable[[str], Sequence[Column]], weight: str = "expansion_factor") -> DataFrame:
    """``measures(weight)`` per zone, by the name ``zone``.

    A decimal of up to 18 digits is summed as two whole numbers of 30 bits and more, put together once a zone: exact
    as the decimal sums and of their type, without a wide decimal a row and measure. Either half fits 64 bits over
    2^33 rows a zone."""
    digits = re.fullmatch(r"decimal\((\d+),(\d+)\)", dict(df.dtypes)[weight])
    if not digits or int(digits[1]) > 18:
        return df.groupBy(F.col(zone).alias("zone")).agg(*measures(weight))
    whole = (F.col(weight) * F.lit(10 ** int(digits[2])).cast("decimal(19,0)")).cast("bigint")
    halves = (df.withColumn("_units", whole).withColumn("_high", F.shiftright("_units", HALF))
              .withColumn("_low", F.col("_units").bitwiseAND((1 << HALF) - 1)))
    sums = halves.groupBy(F.col(zone).alias("zone")).agg(F.struct(*measures("_high")).alias("_h"), F.struct(*measures("_low")).alias("_l"))
    to = f"decimal({int(digits[1]) + 10},{digits[2]})"
    unit = F.lit(Decimal(1).scaleb(-int(digits[2])))
    return sums.select("zone", *[((F.col(f"_h.{m}").cast("decimal(20,0)") * F.lit(1 << HALF).cast("decimal(10,0)") + F.col(f"_l.{m}")) * unit)
                                 .cast(to).alias(m) for m in sums.schema["_h"].dataType.names])


# --- AG14: the raw per-zone control frame ------------------------------------------

def raw_zone_controls(households_z: DataFrame, persons_hh: DataFrame, zmap: DataFrame,
                      cfg: RunConfig) -> DataFrame:
    """Untruncated per-zone measures on the internal-zone spine (JN5), nulls -> 0.

    ``households_z``: households with ``household_zone`` and ``expansion_factor``;
    ``persons_hh``: persons joined to households (person weight ``expansion_factor``);
    ``zmap``: zone dimension ``(zone, pd, puma)``.
    """
    hh = households_z.filter(in_ranges("household_zone", cfg.internal))
    ph = persons_hh.filter(in_ranges("household_zone", cfg.internal))
    hh_agg = zone_sums(hh, "household_zone", household_measures)
    p_agg = zone_sums(ph, "household_zone", lambda weight: person_measures(cfg, weight))
    spine = (zmap.filter(in_ranges("zone", cfg.internal))
             .select(F.lit(1).alias("region"), F.col("puma").cast("int").alias("puma"),
                     F.col("zone").alias("taz"), F.col("zone").alias("maz"), "zone"))
    joined = spine.join(hh_agg, "zone", "left").join(p_agg, "zone", "left")
    return joined.select(*CONTROL_KEYS_MAZ,
                         *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in CONTROL_MEASURES])


def _drop(columns: Iterable[str], drop: Sequence[str]) -> list[str]:
    """Configured columns to drop; names that are not present are ignored (D17)."""
    dropset = set(drop)
    return [c for c in columns if c not in dropset]


def truncate_int(c: str) -> Column:
    """Truncate toward zero (PRJ5): keys to int, totals to 64 bits (a region of more than
    2^31 persons fits)."""
    return F.col(c).cast("int" if c in CONTROL_KEYS_MAZ else "bigint").alias(c)


def controls_maz(raw: DataFrame, cfg: RunConfig) -> DataFrame:
    """MAZ control table: keys + 43 measures, each truncated per zone (AG14, PRJ19)."""
    cols = _drop(CONTROL_KEYS_MAZ + CONTROL_MEASURES, cfg.drop_control_columns)
    return raw.select(*[truncate_int(c) for c in cols])


def raw_taz(raw: DataFrame) -> DataFrame:
    """Untruncated TAZ measures: sum of MAZ rows per (region, puma, taz) (AG15)."""
    return raw.groupBy(*CONTROL_KEYS_TAZ).agg(*[F.sum(m).alias(m) for m in CONTROL_MEASURES])


def controls_taz(raw: DataFrame, cfg: RunConfig) -> DataFrame:
    cols = _drop(CONTROL_KEYS_TAZ + CONTROL_MEASURES, cfg.drop_control_columns)
    return raw_taz(raw).select(*[truncate_int(c) for c in cols])


def controls_meta(raw: DataFrame, cfg: RunConfig) -> DataFrame:
    """Meta table: per region, sum of the *untruncated* TAZ values, then truncated; no
    license or household-size measures (AG16, D5)."""
    cols = _drop(META_MEASURES, cfg.drop_control_columns)
    agg = raw_taz(raw).groupBy("region").agg(*[F.sum(m).alias(m) for m in cols])
    return agg.select(truncate_int("region"), *[truncate_int(c) for c in cols])


def override_totpop(raw: DataFrame, vector: DataFrame) -> DataFrame:
    """Population total taken from a supplied vector where it has the zone (AG5)."""
    v = vector.select(F.col("zone").alias("maz"), F.col("population").alias("_pop"))
    return (raw.join(v, "maz", "left")
            .withColumn("totpop", F.coalesce(F.col("_pop"), F.col("totpop").cast("double")))
            .drop("_pop"))
