"""Synthetic-population outputs (SNK4, PRJ10, PRJ11, PRJ20, PRJ21, JN7, JN11, JN12, AG18,
AG19, SO4, PL3).

Record-level steps are projections (narrow, no shuffle); the per-zone totals are
aggregates with map-side partial sums; the person-household join is one equi-join on
the household id.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popweave.config import RunConfig
from popweave.functions.recode import recode_inverse
from popweave.functions.zones import in_ranges
from popweave.operators.ids import first_per_key

PERSON_OUTPUT = ("household_id", "person_number", "age", "sex", "license", "transit_pass",
                 "employment_status", "occupation", "free_parking", "student_status",
                 "employment_zone", "school_zone", "expansion_factor")
HOUSEHOLD_OUTPUT = ("household_id", "household_zone", "expansion_factor", "number_of_persons",
                    "dwelling_type", "vehicles", "income_class")


def _narrow(df: DataFrame, name: str, typ: str, default=None) -> Column:
    """Narrow-typed column; a value that does not fit stops the run instead of wrapping or
    turning into null. An absent column takes ``default`` (PRJ20, PRJ21). Zones and weights
    are int: zone ids and weights beyond 16 bits are ordinary."""
    if name not in df.columns:
        return F.lit(default).cast(typ)
    fits = F.expr(f"try_cast(`{name}` AS {typ})")
    says = F.concat(F.lit(f"{name} does not fit {typ}: "), F.col(name).cast("string"))
    return F.when(F.col(name).isNotNull() & fits.isNull(), F.raise_error(says).cast(typ)).otherwise(fits)


def transform_persons(synpop_person: DataFrame) -> DataFrame:
    """Synthesizer person rows -> final person table (SNK4)."""
    d = synpop_person

    def txt(name: str, default: str | None = None) -> Column:
        return F.col(name) if name in d.columns else F.lit(default).cast("string")

    return d.select(
        F.col("temp_id").cast("bigint").alias("household_id"),
        F.col("person_number").cast("int").alias("person_number"),
        _narrow(d, "age", "smallint").alias("age"),
        txt("sex").alias("sex"),
        txt("license").alias("license"),
        txt("transit_pass", "O").alias("transit_pass"),
        _narrow(d, "employment_status", "smallint").alias("employment_status"),
        _narrow(d, "occupation", "smallint").alias("occupation"),
        txt("free_parking", "O").alias("free_parking"),
        txt("student_status").alias("student_status"),
        _narrow(d, "employment_zone", "int", 0).alias("employment_zone"),
        F.lit(0).cast("int").alias("school_zone"),
        _narrow(d, "finalweight", "int").alias("expansion_factor"),
    )


def transform_households(synpop_hh: DataFrame) -> DataFrame:
    """Synthesizer household rows -> final household table (SNK4)."""
    d = synpop_hh
    return d.select(
        F.col("temp_id").cast("bigint").alias("household_id"),
        _narrow(d, "maz", "int").alias("household_zone"),
        _narrow(d, "finalweight", "int").alias("expansion_factor"),
        _narrow(d, "number_of_persons", "tinyint").alias("number_of_persons"),
        _narrow(d, "dwelling_type", "tinyint").alias("dwelling_type"),
        _narrow(d, "vehicles", "tinyint").alias("vehicles"),
        _narrow(d, "income_class", "tinyint").alias("income_class"),
    )


def scale_expansion(df: DataFrame, percent: float, col: str = "expansion_factor") -> DataFrame:
    """Weight x 1/percent (PRJ11)."""
    return df.withColumn(col, F.col(col).cast("double") * F.lit(1.0 / percent))


def person_category_maps(cfg: RunConfig) -> dict:
    names = {"Occupation": "occupation", "EmploymentStatus": "employment_status",
             "StudentStatus": "student_status"}
    return {names.get(k, k): v for k, v in cfg.person_category_map.items()}


def output_persons(synpop_person: DataFrame, cfg: RunConfig) -> DataFrame:
    """PL3 person side: transform, scale by 1/percent, map codes back to letters."""
    p = scale_expansion(transform_persons(synpop_person), cfg.percent_population)
    return recode_inverse(p, person_category_maps(cfg))


def output_households(synpop_hh: DataFrame, cfg: RunConfig) -> DataFrame:
    return scale_expansion(transform_households(synpop_hh), cfg.percent_population)


def synthetic_join(persons: DataFrame, households: DataFrame) -> DataFrame:
    """Persons joined to households (JN7): the person weight becomes ``persons`` and the
    household weight ``household_expansion`` (the clashing names are split before the
    join instead of suffixed after it)."""
    p = persons.withColumnRenamed("expansion_factor", "persons")
    h = households.withColumnRenamed("expansion_factor", "household_expansion")
    return p.join(h, "household_id", "inner")


def household_totals(households: DataFrame) -> DataFrame:
    """Expanded households per zone (AG18)."""
    return households.groupBy(F.col("household_zone").alias("zone")).agg(
        F.sum("expansion_factor").alias("expanded_households"))


ZONAL_OCCUPATIONS = ("G", "M", "P", "S")
ZONAL_STATUSES = ("F", "P")


def zonal_residence(joined: DataFrame, cfg: RunConfig) -> DataFrame:
    """Persons by home zone x occupation x employment status, for persons working in an
    internal zone, sliced to the 8 (G,M,P,S) x (F,P) files (AG19). A pair with no persons
    yields no rows (D12). The sink writes it partitioned by the two codes (SNK6)."""
    internal = joined.filter(in_ranges("employment_zone", cfg.internal)
                             & F.col("occupation").isin(*ZONAL_OCCUPATIONS)
                             & F.col("employment_status").isin(*ZONAL_STATUSES))
    return internal.groupBy(F.col("household_zone").alias("zone"), "occupation",
                            "employment_status").agg(F.sum("persons").alias("persons"))


def merge_populations(primary: DataFrame, other: DataFrame, keys: Sequence[str],
                      columns: Sequence[str]) -> DataFrame:
    """Append ``other`` to ``primary`` column-aligned, nulls -> 0 (in text columns ``"0"``, PRJ18),
    projected to ``columns``, first row per key with ``primary`` rows first (SO4). Idempotent."""
    a = primary.withColumn("_src", F.lit(0))
    b = other.withColumn("_src", F.lit(1))
    u = a.unionByName(b, allowMissingColumns=True).na.fill(0).na.fill("0")
    u = u.select(*columns, "_src")
    return first_per_key(u, keys, ["_src"]).drop("_src")


def missing_zones(zone_list: DataFrame, zone_col: str = "zone") -> DataFrame:
    """Ids between the smallest and largest zone of a list that the list lacks (JN11).

    Each listed zone opens the gap up to the next one (one row per gap, not one array for the
    whole span); the window runs over the zone dimension, not records."""
    following = F.lead(zone_col).over(Window.orderBy(zone_col))
    ids = zone_list.select(zone_col).filter(F.col(zone_col).isNotNull()).distinct().withColumn("_next", following)
    return (ids.filter(F.col("_next") > F.col(zone_col) + 1)
            .select(F.explode(F.sequence(F.col(zone_col) + 1, F.col("_next") - 1)).alias(zone_col)))


def fill_missing_zones(vector: DataFrame, value_col: str = "population") -> DataFrame:
    """A population vector with the missing intermediate zones added at 0 (JN11 intent)."""
    gaps = missing_zones(vector.select("zone")).withColumn(value_col, F.lit(0.0))
    return vector.select("zone", value_col).unionByName(gaps)


def replace_population(a: DataFrame, b: DataFrame, zones: Sequence[int],
                       zone_col: str = "household_zone") -> DataFrame:
    """Drop ``a``'s records in ``zones`` and insert ``b``'s records of those zones (JN12)."""
    inside = F.col(zone_col).isin(*zones)
    return a.filter(~inside).unionByName(b.filter(inside).select(*a.columns))


def replace_population_persons(a_persons: DataFrame, b_persons: DataFrame,
                               a_households: DataFrame, b_households: DataFrame,
                               zones: Sequence[int]) -> DataFrame:
    """Person side of :func:`replace_population`: membership by the household's zone."""
    def in_zones(h: DataFrame) -> DataFrame:
        return h.filter(F.col("household_zone").isin(*zones)).select("household_id")
    keep_a = a_persons.join(a_households.select("household_id", "household_zone")
                            .filter(~F.col("household_zone").isin(*zones)).select("household_id"),
                            "household_id", "left_semi")
    add_b = b_persons.join(in_zones(b_households), "household_id", "left_semi")
    return keep_a.unionByName(add_b.select(*a_persons.columns))


def rename_for_sink(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns to the original file headers right before a sink."""
    for a, b in names.items():
        if a in df.columns:
            df = df.withColumnRenamed(a, b)
    return df
