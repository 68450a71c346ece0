"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the
survey views of the test tables; ``ORACLE`` holds the DuckDB twin of each one."""

from __future__ import annotations

import uuid
from dataclasses import replace
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.config import (AGE_BINS, AGE_COLUMNS, CONTROL_KEYS_MAZ, CONTROL_KEYS_TAZ, CONTROL_MEASURES,
                             HOUSEHOLD_MEASURES, META_MEASURES, PERSON_MEASURES)
from popweave.functions.draws import keyed_uniform_sql
from popweave.functions.recode import recode, recode_inverse
from popweave.functions.sizing import broadcast_if_bounded
from popweave.functions.zones import expand_ranges
from popweave.operators import controls as ctl
from popweave.operators import forecast as fc
from popweave.operators import outputs as out
from popweave.operators import pool
from popweave.operators import quality as qual
from popweave.operators import synthesis as syn
from popweave.operators import validation as val
from popweave.operators import zonegroups as zg
from popweave.operators import seeds as seeds_ops
from popweave.operators.ids import assign_hhnum, dense_position, first_per_key
from popweave.operators.impute import category_shares, resample_invalid
from popweave.operators.quality import duplicate_keys
from popweave.operators.sampling import slice_population
from popweave.plans import seeds as seedplan
from popweave.session import materialize, scratch_dir
from popweave.sources import schemas as S
from popweave.sources import survey_sql as sq
from popweave.sources.readers import read_csv
from popweave.sources.sinks import write_csv
from popweave.sources import survey_views as sv

CFG = sv.TEST_CONFIG

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def prepared(spark: SparkSession, sf_dir: str, unread: Sequence[str] = ()) -> seedplan.PreparedSeeds:
    return seedplan.prepare(sv.zones(spark, sf_dir), sv.households(spark, sf_dir),
                            sv.persons(spark, sf_dir), CFG, unread)


def raw_controls(spark: SparkSession, sf_dir: str,
                 seeds: seedplan.PreparedSeeds | None = None) -> DataFrame:
    return seedplan.raw_controls(seeds or prepared(spark, sf_dir), CFG)


def _trunc_cols(cols) -> str:
    return ", ".join(f"CAST(trunc({c}) AS BIGINT) AS {c}" for c in cols)


# --- control totals ------------------------------------------------------------------

@register("controls_maz", sq.with_seeds(sq.raw_controls_cte(CONTROL_MEASURES)[1:] + f"""
SELECT {", ".join(CONTROL_KEYS_MAZ)}, {_trunc_cols(CONTROL_MEASURES)} FROM raw"""))
def q_controls_maz(spark, sf_dir):
    return ctl.controls_maz(raw_controls(spark, sf_dir), CFG)


@register("controls_taz", sq.with_seeds(sq.raw_controls_cte(CONTROL_MEASURES)[1:] + f""",
t AS (SELECT region, puma, taz, {", ".join(f"SUM({m}) AS {m}" for m in CONTROL_MEASURES)}
      FROM raw GROUP BY region, puma, taz)
SELECT {", ".join(CONTROL_KEYS_TAZ)}, {_trunc_cols(CONTROL_MEASURES)} FROM t"""))
def q_controls_taz(spark, sf_dir):
    return ctl.controls_taz(raw_controls(spark, sf_dir), CFG)


@register("controls_meta", sq.with_seeds(sq.raw_controls_cte(CONTROL_MEASURES)[1:] + f""",
m AS (SELECT region, {", ".join(f"SUM({c}) AS {c}" for c in META_MEASURES)} FROM raw GROUP BY region)
SELECT CAST(region AS INTEGER) AS region, {_trunc_cols(META_MEASURES)} FROM m"""))
def q_controls_meta(spark, sf_dir):
    return ctl.controls_meta(raw_controls(spark, sf_dir), CFG)


def _controls_subset(name: str, cols: tuple[str, ...]):
    sql = sq.with_seeds(sq.raw_controls_cte(CONTROL_MEASURES)[1:] + f"""
SELECT maz, {_trunc_cols(cols)} FROM raw""")

    def q(spark, sf_dir):
        return ctl.controls_maz(raw_controls(spark, sf_dir), CFG).select("maz", *cols)
    register(name, sql)(q)


_controls_subset("controls_totals", ("totalhh", "totpop"))
_controls_subset("controls_income", tuple(f"income_class_{k}" for k in range(1, 7)))
_controls_subset("controls_hhsize", ("hhsize1", "hhsize2", "hhsize3", "hhsize4p"))
_controls_subset("controls_age", AGE_COLUMNS)
_controls_subset("controls_employment", ("E_O", "E_F", "E_P", "E_J", "E_H"))
_controls_subset("controls_occupation", ("P", "G", "S", "M", "O"))
_controls_subset("controls_license_student", ("license_Y", "license_N", "S_O", "S_S", "S_P"))
_controls_subset("employment_zone_controls", ("employment_zone_internal", "employment_zone_external",
                                              "employment_zone_roaming", "employment_zone_0"))

DROP_CFG = replace(CFG, drop_control_columns=("hhsize1", "license_Y", "E_J", "not_a_column"))
_META_KEPT = tuple(c for c in META_MEASURES if c not in DROP_CFG.drop_control_columns)


@register("controls_drop_columns", sq.with_seeds(sq.raw_controls_cte(CONTROL_MEASURES)[1:] + f""",
m AS (SELECT region, {", ".join(f"SUM({c}) AS {c}" for c in _META_KEPT)} FROM raw GROUP BY region)
SELECT CAST(region AS INTEGER) AS region, {_trunc_cols(_META_KEPT)} FROM m"""))
def q_controls_drop_columns(spark, sf_dir):
    """Meta controls with configured columns dropped; absent names are ignored (D17)."""
    return ctl.controls_meta(raw_controls(spark, sf_dir), DROP_CFG)


@register("controls_totpop_override", sq.with_seeds(sq.raw_controls_cte(CONTROL_MEASURES)[1:] + """,
vec AS (SELECT zone, CASE WHEN zone % 6 = 0 THEN 0.0 ELSE CAST(zone AS DOUBLE) * 1000.0 END AS population
        FROM zones)
SELECT maz, CAST(trunc(COALESCE(v.population, CAST(r.totpop AS DOUBLE))) AS BIGINT) AS totpop
FROM raw r LEFT JOIN vec v ON r.maz = v.zone"""))
def q_controls_totpop_override(spark, sf_dir):
    raw = raw_controls(spark, sf_dir)
    vec = sv.population_vector(spark, sf_dir)
    return ctl.override_totpop(raw, vec).select("maz", ctl.truncate_int("totpop"))


# --- seeds: geography, imputation, sampling, re-coding ---------------------------------

@register("zone_map", "WITH " + sq.VIEWS + " SELECT zone, pd, puma FROM zmap")
def q_zone_map(spark, sf_dir):
    return seeds_ops.zone_map(sv.zones(spark, sf_dir), CFG)


@register("assign_puma", "WITH " + sq.VIEWS + """
SELECT h.household_id, z.pd, z.puma FROM hh h JOIN zmap z ON h.household_zone = z.zone""")
def q_assign_puma(spark, sf_dir):
    zm = seeds_ops.zone_map(sv.zones(spark, sf_dir), CFG)
    return seeds_ops.households_with_zone(sv.households(spark, sf_dir), broadcast_if_bounded(zm)) \
        .select("household_id", "pd", "puma")


@register("zone_ranges", "WITH " + sq.VIEWS + """,
r AS (SELECT 'internal' AS zone_set, generate_series AS zone FROM generate_series(1, 20)
      UNION ALL SELECT 'external', generate_series FROM generate_series(21, 25))
SELECT r.zone_set, z.zone, z.pd FROM r JOIN zones z ON r.zone = z.zone""")
def q_zone_ranges(spark, sf_dir):
    """Range sets expanded to rows (PRJ13) and matched to the zone dimension."""
    z = sv.zones(spark, sf_dir)
    sets = [expand_ranges(spark, CFG.internal).withColumn("zone_set", F.lit("internal")),
            expand_ranges(spark, CFG.external).withColumn("zone_set", F.lit("external"))]
    r = sets[0].unionByName(sets[1])
    return r.join(z, "zone", "inner").select("zone_set", "zone", "pd")


@register("filter_internal", "WITH " + sq.VIEWS + """
SELECT household_id, household_zone FROM hh WHERE household_zone BETWEEN 1 AND 20""")
def q_filter_internal(spark, sf_dir):
    return seeds_ops.filter_internal(sv.households(spark, sf_dir), "household_zone", CFG) \
        .select("household_id", "household_zone")


@register("households_with_zone", sq.with_seeds("SELECT * FROM hz0"))
def q_households_with_zone(spark, sf_dir):
    zm = broadcast_if_bounded(seeds_ops.zone_map(sv.zones(spark, sf_dir), CFG))
    return seeds_ops.households_with_zone(sv.households(spark, sf_dir), zm)


@register("persons_households", sq.with_seeds("""
SELECT p.*, h.household_zone, h.dwelling_type, h.number_of_persons, h.vehicles, h.income_class,
       h.expansion_factor AS household_weight, h.pd, h.puma
FROM ps p JOIN hz0 h ON p.household_id = h.household_id"""))
def q_persons_households(spark, sf_dir):
    zm = broadcast_if_bounded(seeds_ops.zone_map(sv.zones(spark, sf_dir), CFG))
    hz = seeds_ops.households_with_zone(sv.households(spark, sf_dir), zm)
    return seeds_ops.persons_households(sv.persons(spark, sf_dir), hz)


@register("category_shares", sq.with_seeds(sq.SHARES_SQL))
def q_category_shares(spark, sf_dir):
    zm = broadcast_if_bounded(seeds_ops.zone_map(sv.zones(spark, sf_dir), CFG))
    hz = seeds_ops.households_with_zone(sv.households(spark, sf_dir), zm)
    ph = seeds_ops.persons_households(sv.persons(spark, sf_dir), hz)
    sh = category_shares(ph, seedplan.PERSON_IMPUTE, "expansion_factor", "puma")
    return sh.select("puma", "column", "value", F.col("weight").cast("double").alias("weight"),
                     "share", "lower", "upper")


@register("resample_income", sq.with_seeds("SELECT household_id, puma, income_class FROM hz"))
def q_resample_income(spark, sf_dir):
    s = prepared(spark, sf_dir)
    zm = s.zone_map
    hz = seeds_ops.households_with_zone(sv.households(spark, sf_dir), zm)
    hz = resample_invalid(hz, seedplan.HOUSEHOLD_IMPUTE, "expansion_factor", ["household_id"])
    return hz.select("household_id", "puma", "income_class")


@register("resample_occupation", sq.with_seeds("""
SELECT household_id, person_number, puma, occupation, employment_status, student_status FROM ph_all"""))
def q_resample_occupation(spark, sf_dir):
    zm = broadcast_if_bounded(seeds_ops.zone_map(sv.zones(spark, sf_dir), CFG))
    hz = seeds_ops.households_with_zone(sv.households(spark, sf_dir), zm)
    hz = resample_invalid(hz, seedplan.HOUSEHOLD_IMPUTE, "expansion_factor", ["household_id"])
    ph = seeds_ops.persons_households(sv.persons(spark, sf_dir), hz)
    ph = resample_invalid(ph, seedplan.PERSON_IMPUTE, "expansion_factor", list(seedplan.PERSON_KEY))
    return ph.select("household_id", "person_number", "puma", "occupation", "employment_status",
                     "student_status")


@register("seed_households", sq.with_seeds(sq.SEED_HOUSEHOLDS_FROM.format(src="phi")))
def q_seed_households(spark, sf_dir):
    s = prepared(spark, sf_dir)
    return seedplan.processed_households(seedplan.sampled(s, CFG))


@register("seed_persons", sq.with_seeds(sq.SEED_PERSONS_SQL))
def q_seed_persons(spark, sf_dir):
    s = prepared(spark, sf_dir)
    return seedplan.processed_persons(seedplan.sampled(s, CFG), CFG)


SAMPLE_CFG = replace(CFG, input_sample=0.5)


@register("sample_households", sq.with_seeds(sq.sample_threshold_sql(0.5)))
def q_sample_households(spark, sf_dir):
    s = prepared(spark, sf_dir)
    return seedplan.processed_households(seedplan.sampled(s, SAMPLE_CFG, "threshold"))


@register("sample_households_exact", sq.with_seeds(sq.sample_exact_sql(0.5)))
def q_sample_households_exact(spark, sf_dir):
    s = prepared(spark, sf_dir)
    return seedplan.processed_households(seedplan.sampled(s, SAMPLE_CFG, "exact"))


@register("slice_population", "WITH " + sq.VIEWS + f"""
SELECT household_id, household_zone, CAST(expansion_factor * 2.0 AS DOUBLE) AS expansion_factor
FROM hh WHERE {keyed_uniform_sql('slice', 'household_id')} < 0.5""")
def q_slice_population(spark, sf_dir):
    h, _ = slice_population(sv.households(spark, sf_dir), sv.persons(spark, sf_dir), 0.5)
    return h.select("household_id", "household_zone",
                    F.col("expansion_factor").cast("double").alias("expansion_factor"))


@register("slice_population_persons", "WITH " + sq.VIEWS + f"""
SELECT household_id, person_number, age, CAST(expansion_factor * 2.0 AS DOUBLE) AS expansion_factor
FROM ps WHERE {keyed_uniform_sql('slice', 'household_id')} < 0.5""")
def q_slice_population_persons(spark, sf_dir):
    """The persons of the sliced households, their weights scaled alike."""
    _, p = slice_population(sv.households(spark, sf_dir), sv.persons(spark, sf_dir), 0.5)
    return p.select("household_id", "person_number", "age", F.col("expansion_factor").cast("double").alias("expansion_factor"))


@register("recode_categories", "WITH " + sq.VIEWS + f"""
SELECT household_id, person_number, {sq.OCC_CODE} AS occupation, {sq.EMP_CODE} AS employment_status
FROM ps""")
def q_recode_categories(spark, sf_dir):
    p = recode(sv.persons(spark, sf_dir), {"occupation": CFG.person_category_map["Occupation"],
                                           "employment_status": CFG.person_category_map["EmploymentStatus"]})
    return p.select("household_id", "person_number", "occupation", "employment_status")


# --- ids, dedup, data quality ----------------------------------------------------------

@register("dedup_first", "WITH " + sq.VIEWS + f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY household_id, person_number
                               ORDER BY {", ".join(sq.PERSON_REST)}) AS rn FROM ps) t
WHERE rn = 1""")
def q_dedup_first(spark, sf_dir):
    return first_per_key(sv.persons(spark, sf_dir), ["household_id", "person_number"])


@register("duplicate_keys", "WITH " + sq.VIEWS + """
SELECT household_id, person_number, COUNT(*) AS n FROM ps
GROUP BY household_id, person_number HAVING COUNT(*) > 1""")
def q_duplicate_keys(spark, sf_dir):
    return duplicate_keys(sv.persons(spark, sf_dir), ["household_id", "person_number"])


@register("assign_hhnum", sq.with_seeds(f"""
sh AS ({sq.SEED_HOUSEHOLDS_FROM.format(src="phi")})
SELECT *, row_number() OVER (ORDER BY household_id) AS hhnum FROM sh"""))
def q_assign_hhnum(spark, sf_dir):
    s = prepared(spark, sf_dir)
    hh = seedplan.processed_households(seedplan.sampled(s, CFG))
    return dense_position(hh, ["household_id"], "hhnum")


@register("assign_hhnum_persons", sq.with_seeds(f"""
sh AS ({sq.SEED_HOUSEHOLDS_FROM.format(src="phi")}),
hn AS (SELECT household_id, row_number() OVER (ORDER BY household_id) AS hhnum FROM sh),
sp AS ({sq.SEED_PERSONS_SQL})
SELECT sp.*, hn.hhnum FROM sp LEFT JOIN hn USING (household_id)"""))
def q_assign_hhnum_persons(spark, sf_dir):
    s = prepared(spark, sf_dir)
    ph = seedplan.sampled(s, CFG)
    _, pers = assign_hhnum(seedplan.processed_households(ph), seedplan.processed_persons(ph, CFG))
    return pers


# --- forecast --------------------------------------------------------------------------

FORECAST_CFG = replace(CFG, person_control_columns=PERSON_MEASURES,
                       household_control_columns=HOUSEHOLD_MEASURES)
_FC_CONTROLS = sq.forecast_controls(CONTROL_MEASURES, PERSON_MEASURES, HOUSEHOLD_MEASURES)
_FC_SQL = sq.raw_controls_cte(CONTROL_MEASURES)[1:] + "," + sq.forecast_ctes(
    CONTROL_MEASURES, PERSON_MEASURES, HOUSEHOLD_MEASURES)


def zero_zone(controls: DataFrame, key: str, zone: int) -> DataFrame:
    """Set every measure of one zone to 0 (gives the test a base-zero zone with a row)."""
    keys = {"region", "puma", "taz", "maz"}
    return controls.select(*[F.when(F.col(key) == zone, F.lit(0)).otherwise(F.col(c)).alias(c)
                             if c not in keys else F.col(c) for c in controls.columns])


def forecast_inputs(spark, sf_dir, seeds: seedplan.PreparedSeeds | None = None):
    raw = materialize(raw_controls(spark, sf_dir, seeds), "raw-controls")  # zone-sized, used 3x
    maz = zero_zone(ctl.controls_maz(raw, CFG), "maz", 5)
    return (maz, ctl.controls_taz(raw, CFG), ctl.controls_meta(raw, CFG),
            sv.population_vector(spark, sf_dir), sv.zones(spark, sf_dir))


@register("forecast_maz", sq.with_seeds(_FC_SQL + f"""
SELECT region, puma, k AS taz, k AS maz, {", ".join(f"CAST(ceil({c}) AS BIGINT) AS {c}" for c in _FC_CONTROLS)}
FROM fc"""))
def q_forecast_maz(spark, sf_dir):
    maz, _, _, vec, zones = forecast_inputs(spark, sf_dir)
    return fc.forecast_maz(maz, vec, zones, FORECAST_CFG)


@register("forecast_taz", sq.with_seeds(_FC_SQL + f"""
SELECT region, puma, k AS taz, {", ".join(f"CAST(ceil({c}) AS BIGINT) AS {c}" for c in _FC_CONTROLS)}
FROM fc"""))
def q_forecast_taz(spark, sf_dir):
    maz, taz, meta, vec, zones = forecast_inputs(spark, sf_dir)
    return fc.apply_population_vector(maz, taz, meta, vec, zones, FORECAST_CFG)[1]


@register("forecast_meta", sq.with_seeds(_FC_SQL + f""",
m0 AS (SELECT region, {", ".join(f"SUM({c}) AS {c}" for c in META_MEASURES)} FROM raw GROUP BY region),
m AS (SELECT CAST(region AS INTEGER) AS region, {_trunc_cols(META_MEASURES)} FROM m0),
tot AS (SELECT SUM(CAST(totpop AS DECIMAL(38,18))) AS tp, SUM(CAST(totalhh AS DECIMAL(38,18))) AS th FROM fc)
SELECT region, {", ".join("CAST(ceil(tot.tp) AS BIGINT) AS totpop" if c == "totpop" else
                          "CAST(ceil(tot.th) AS BIGINT) AS totalhh" if c == "totalhh" else c
                          for c in META_MEASURES)}
FROM m, tot"""))
def q_forecast_meta(spark, sf_dir):
    maz, taz, meta, vec, zones = forecast_inputs(spark, sf_dir)
    return fc.apply_population_vector(maz, taz, meta, vec, zones, FORECAST_CFG)[2]


@register("forecast_outer", sq.with_seeds(_FC_SQL + """
SELECT k AS maz, region, puma, totpop, totalhh, new AS population FROM fo"""))
def q_forecast_outer(spark, sf_dir):
    maz, _, _, vec, zones = forecast_inputs(spark, sf_dir)
    measures = [c for c in maz.columns if c not in fc.KEYS]
    m = fc.outer_with_vector(fc.map_control_puma(maz, "maz", zones, FORECAST_CFG), "maz", vec, measures)
    return m.select("maz", "region", "puma", "totpop", "totalhh", F.col(fc.NEW).alias("population"))


@register("forecast_classes", sq.with_seeds(_FC_SQL + """
SELECT k AS maz, cls AS zone_class FROM cls"""))
def q_forecast_classes(spark, sf_dir):
    maz, _, _, vec, zones = forecast_inputs(spark, sf_dir)
    measures = [c for c in maz.columns if c not in fc.KEYS]
    m = fc.outer_with_vector(fc.map_control_puma(maz, "maz", zones, FORECAST_CFG), "maz", vec, measures)
    return m.select("maz", fc.zone_class(F.col("totpop"), F.col(fc.NEW)).alias("zone_class"))


@register("forecast_ratios", sq.with_seeds(_FC_SQL + f"""
SELECT p0 AS puma, {", ".join(_FC_CONTROLS)} FROM rat"""))
def q_forecast_ratios(spark, sf_dir):
    maz, _, _, vec, zones = forecast_inputs(spark, sf_dir)
    measures = [c for c in maz.columns if c not in fc.KEYS]
    m = fc.outer_with_vector(fc.map_control_puma(maz, "maz", zones, FORECAST_CFG), "maz", vec, measures)
    m = m.withColumn(fc.CLASS, fc.zone_class(F.col("totpop"), F.col(fc.NEW)))
    return fc.forecast_ratios(m, _FC_CONTROLS).withColumnRenamed(fc.ORIG_PUMA, "puma")


# --- outputs ---------------------------------------------------------------------------

OUTPUT_CFG = replace(CFG, percent_population=0.5)


def synthetic(spark, sf_dir):
    return sv.synthetic_persons(spark, sf_dir, CFG), sv.synthetic_households(spark, sf_dir)


def outputs(spark, sf_dir):
    sp, sh = synthetic(spark, sf_dir)
    return out.output_persons(sp, OUTPUT_CFG), out.output_households(sh, OUTPUT_CFG)


@register("transform_persons", sq.with_outputs("SELECT * FROM tr_p"))
def q_transform_persons(spark, sf_dir):
    return out.transform_persons(synthetic(spark, sf_dir)[0])


@register("transform_households", sq.with_outputs("SELECT * FROM tr_h"))
def q_transform_households(spark, sf_dir):
    return out.transform_households(synthetic(spark, sf_dir)[1])


@register("recode_inverse", sq.with_outputs(f"""
SELECT temp_id AS household_id, person_number,
       {sq._inverse_case("occupation", CFG.person_category_map["Occupation"])} AS occupation,
       {sq._inverse_case("employment_status", CFG.person_category_map["EmploymentStatus"])}
         AS employment_status
FROM syn_p"""))
def q_recode_inverse(spark, sf_dir):
    p = recode_inverse(synthetic(spark, sf_dir)[0], out.person_category_maps(CFG))
    return p.select(F.col("temp_id").alias("household_id"), "person_number", "occupation",
                    "employment_status")


@register("scale_expansion", sq.with_outputs("SELECT household_id, expansion_factor FROM out_h"))
def q_scale_expansion(spark, sf_dir):
    h = out.scale_expansion(out.transform_households(synthetic(spark, sf_dir)[1]), 0.5)
    return h.select("household_id", "expansion_factor")


@register("output_persons", sq.with_outputs("SELECT * FROM out_p"))
def q_output_persons(spark, sf_dir):
    return outputs(spark, sf_dir)[0]


@register("output_households", sq.with_outputs("SELECT * FROM out_h"))
def q_output_households(spark, sf_dir):
    return outputs(spark, sf_dir)[1]


@register("synthetic_join", sq.with_outputs("SELECT * FROM sj"))
def q_synthetic_join(spark, sf_dir):
    p, h = outputs(spark, sf_dir)
    return out.synthetic_join(p, h)


@register("household_totals", sq.with_outputs("""
SELECT household_zone AS zone, SUM(expansion_factor) AS expanded_households FROM out_h GROUP BY 1"""))
def q_household_totals(spark, sf_dir):
    return out.household_totals(outputs(spark, sf_dir)[1])


@register("zonal_residence", sq.with_outputs(f"""
SELECT household_zone AS zone, occupation, employment_status, SUM(persons) AS persons FROM sj
WHERE employment_zone {sq.INTERNAL} AND occupation IN ('G','M','P','S') AND employment_status IN ('F','P')
GROUP BY 1, 2, 3"""))
def q_zonal_residence(spark, sf_dir):
    p, h = outputs(spark, sf_dir)
    return out.zonal_residence(out.synthetic_join(p, h), OUTPUT_CFG)


_MERGE_COLS = ("household_id", "household_zone", "expansion_factor", "number_of_persons",
               "dwelling_type", "vehicles", "income_class")


@register("merge_populations", sq.with_outputs(f"""
a AS (SELECT * EXCLUDE (vehicles), 0 AS src FROM out_h),
b AS (SELECT household_id + 1000 AS household_id, household_zone, CAST(expansion_factor AS DOUBLE) AS expansion_factor,
             number_of_persons, dwelling_type, vehicles, income_class, 1 AS src
      FROM hh),
u AS (SELECT household_id, household_zone, expansion_factor, number_of_persons, dwelling_type,
             0 AS vehicles, income_class, src FROM a
      UNION ALL SELECT * FROM b)
SELECT {", ".join(_MERGE_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY src, {", ".join(_MERGE_COLS[1:])}) AS rn
  FROM u) t WHERE rn = 1"""))
def q_merge_populations(spark, sf_dir):
    """Synthetic households (lacking ``vehicles``) merged with all seed households under shifted
    ids: most ids are in both populations, some in one."""
    h = outputs(spark, sf_dir)[1].drop("vehicles")
    other = sv.households(spark, sf_dir) \
        .withColumn("household_id", F.col("household_id") + 1000) \
        .withColumn("expansion_factor", F.col("expansion_factor").cast("double")) \
        .select(*_MERGE_COLS)
    return out.merge_populations(h, other, ["household_id"], _MERGE_COLS)


_PERSON_COLS = ("household_id", "person_number", "age", "sex", "license", "transit_pass", "employment_status", "occupation",
                "free_parking", "student_status", "employment_zone", "school_zone", "expansion_factor")
_PERSON_TYPES = {"age": "smallint", "employment_zone": "int", "school_zone": "int", "expansion_factor": "double"}


def _seed_persons_like_outputs(spark, sf_dir):
    return sv.persons(spark, sf_dir).select(*[F.col(c).cast(_PERSON_TYPES[c]).alias(c) if c in _PERSON_TYPES else F.col(c)
                                              for c in _PERSON_COLS])


def _seed_persons_sql(shift: int = 0) -> str:
    cast = {**_PERSON_TYPES, "household_id": "bigint"}
    cols = ", ".join(f"CAST({c}{f' + {shift}' if shift and c == 'household_id' else ''} AS {cast[c]}) AS {c}" if c in cast else c
                     for c in _PERSON_COLS)
    return f"SELECT {cols} FROM ps"


@register("merge_populations_persons", sq.with_outputs(f"""
u AS (SELECT * REPLACE ('0' AS student_status), 0 AS src FROM out_p
      UNION ALL SELECT *, 1 AS src FROM ({_seed_persons_sql(1000)})),
f AS (SELECT * REPLACE ({", ".join(f"COALESCE({c}, '0') AS {c}" for c in
                                   ("sex", "license", "transit_pass", "employment_status", "occupation", "free_parking", "student_status"))})
      FROM u)
SELECT {", ".join(_PERSON_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY household_id, person_number ORDER BY src, {", ".join(_PERSON_COLS[2:])}) AS rn
  FROM f) t WHERE rn = 1"""))
def q_merge_populations_persons(spark, sf_dir):
    """Synthetic persons (lacking ``student_status``, filled with 0) merged with all seed persons of
    shifted households."""
    p = outputs(spark, sf_dir)[0].drop("student_status")
    other = _seed_persons_like_outputs(spark, sf_dir).withColumn("household_id", F.col("household_id") + 1000)
    return out.merge_populations(p, other, ["household_id", "person_number"], _PERSON_COLS)


@register("replace_population_persons", sq.with_outputs(f"""
keep AS (SELECT household_id FROM out_h WHERE household_zone NOT IN (3, 7)),
new AS (SELECT household_id FROM hh WHERE household_zone IN (3, 7))
SELECT {", ".join(_PERSON_COLS)} FROM out_p WHERE household_id IN (SELECT household_id FROM keep)
UNION ALL
SELECT * FROM ({_seed_persons_sql()}) WHERE household_id IN (SELECT household_id FROM new)"""))
def q_replace_population_persons(spark, sf_dir):
    """Persons of the replaced population: those of the zones' households come from the seed."""
    p, h = outputs(spark, sf_dir)
    return out.replace_population_persons(p.select(*_PERSON_COLS), _seed_persons_like_outputs(spark, sf_dir), h,
                                          sv.households(spark, sf_dir), [3, 7])


@register("missing_zones", "WITH " + sq.VIEWS + ", " + sq.VECTOR + """,
present AS (SELECT zone FROM vec WHERE population > 0),
span AS (SELECT generate_series AS zone FROM generate_series((SELECT min(zone) FROM present),
                                                             (SELECT max(zone) FROM present)))
SELECT zone, 0.0 AS population FROM span WHERE zone NOT IN (SELECT zone FROM present)
UNION ALL SELECT zone, population FROM vec WHERE population > 0""")
def q_missing_zones(spark, sf_dir):
    """Vector zones with a population; the gaps between them are added at 0 (JN11)."""
    vec = sv.population_vector(spark, sf_dir).filter(F.col("population") > 0)
    return out.fill_missing_zones(vec)


@register("replace_population", sq.with_outputs("""
SELECT * FROM out_h WHERE household_zone NOT IN (3, 7)
UNION ALL
SELECT household_id, CAST(household_zone AS INTEGER), CAST(expansion_factor AS DOUBLE),
       CAST(number_of_persons AS TINYINT), CAST(dwelling_type AS TINYINT), CAST(vehicles AS TINYINT),
       CAST(income_class AS TINYINT)
FROM hh WHERE household_zone IN (3, 7)"""))
def q_replace_population(spark, sf_dir):
    a = outputs(spark, sf_dir)[1]
    b = sv.households(spark, sf_dir).select(
        "household_id", F.col("household_zone").cast("int").alias("household_zone"),
        F.col("expansion_factor").cast("double").alias("expansion_factor"),
        *[F.col(c).cast("tinyint").alias(c) for c in ("number_of_persons", "dwelling_type",
                                                      "vehicles", "income_class")])
    return out.replace_population(a, b, [3, 7])


# --- validation ------------------------------------------------------------------------

def validation_sides(spark, sf_dir):
    p, h = outputs(spark, sf_dir)
    zones = sv.zones(spark, sf_dir)
    obs = val.validation_join(sv.persons(spark, sf_dir), sv.households(spark, sf_dir), zones, CFG)
    syn = val.validation_join(p, h, zones, CFG)
    return obs, syn


@register("validation_join", sq.with_outputs(sq.VALIDATION_JOINS[1:] + """
SELECT household_id, person_number, household_zone, pd, expansion_factor FROM obs"""))
def q_validation_join(spark, sf_dir):
    obs, _ = validation_sides(spark, sf_dir)
    return obs.select("household_id", "person_number", "household_zone", "pd", "expansion_factor")


@register("validation_persons", sq.with_outputs(sq.VALIDATION_JOINS[1:] + ",\n"
                                                + sq.compare_sql(sq.PERSON_LABELS, "obs", "syn")))
def q_validation_persons(spark, sf_dir):
    obs, syn = validation_sides(spark, sf_dir)
    return val.validation_persons(obs, syn, CFG)


@register("validation_households", sq.with_outputs(f"""
oh AS (SELECT * FROM hh WHERE household_zone {sq.INTERNAL}),
sh AS (SELECT * FROM out_h WHERE household_zone {sq.INTERNAL}),
""" + sq.compare_sql(sq.HOUSEHOLD_LABELS, "oh", "sh")))
def q_validation_households(spark, sf_dir):
    return val.validation_households(sv.households(spark, sf_dir), outputs(spark, sf_dir)[1], CFG)


@register("occupation_zone_crosstab", sq.with_outputs(sq.VALIDATION_JOINS[1:] + f""",
ot AS (SELECT pd, occupation, employment_status,
              CASE WHEN employment_zone = {sq.ROAMING} THEN 'Roaming'
                   WHEN employment_zone {sq.INTERNAL} THEN 'Internal' ELSE 'External' END AS employment_zone_type,
              CAST(SUM(expansion_factor) AS DOUBLE) AS total_input FROM obs GROUP BY 1, 2, 3, 4),
st AS (SELECT pd, occupation, employment_status,
              CASE WHEN employment_zone = {sq.ROAMING} THEN 'Roaming'
                   WHEN employment_zone {sq.INTERNAL} THEN 'Internal' ELSE 'External' END AS employment_zone_type,
              CAST(SUM(expansion_factor) AS DOUBLE) AS total_synthesized FROM syn GROUP BY 1, 2, 3, 4),
j AS (SELECT COALESCE(ot.pd, st.pd) AS pd, COALESCE(ot.occupation, st.occupation) AS occupation,
             COALESCE(ot.employment_status, st.employment_status) AS employment_status,
             COALESCE(ot.employment_zone_type, st.employment_zone_type) AS employment_zone_type,
             COALESCE(total_input, 0.0) AS total_input, COALESCE(total_synthesized, 0.0) AS total_synthesized
      FROM ot FULL OUTER JOIN st ON ot.pd = st.pd AND ot.occupation = st.occupation
        AND ot.employment_status = st.employment_status AND ot.employment_zone_type = st.employment_zone_type)
SELECT *, total_synthesized - total_input AS delta FROM j
WHERE pd BETWEEN 1 AND 59 AND occupation IN ('P','G','S','M','O') AND employment_status IN ('F','P','O','J','H')"""))
def q_occupation_zone_crosstab(spark, sf_dir):
    obs, syn = validation_sides(spark, sf_dir)
    return val.occupation_zone_crosstab(obs, syn, CFG)


@register("pd_compare", sq.with_seeds(sq.raw_controls_cte(CONTROL_MEASURES)[1:] + "," + sq.SYNTHETIC + f""",
c AS (SELECT z.pd, CAST(SUM(CAST(trunc(r.hhsize1) AS BIGINT)) AS DOUBLE) AS control
      FROM raw r JOIN zones z ON r.taz = z.zone GROUP BY 1),
s AS (SELECT z.pd, CAST(SUM(h.expansion_factor) AS DOUBLE) AS synthesized
      FROM out_h h JOIN zones z ON h.household_zone = z.zone WHERE h.number_of_persons = 1 GROUP BY 1)
SELECT COALESCE(c.pd, s.pd) AS pd, c.control, s.synthesized FROM c FULL OUTER JOIN s ON c.pd = s.pd"""))
def q_pd_compare(spark, sf_dir):
    """One-person-household control vs synthesized one-person households, per PD."""
    cm = ctl.controls_maz(raw_controls(spark, sf_dir), CFG)
    h = outputs(spark, sf_dir)[1]
    return val.pd_compare(cm, "hhsize1", h, F.col("number_of_persons") == 1, sv.zones(spark, sf_dir))


# --- zone groups, repair, lenient load -------------------------------------------------

@register("zone_running_population", sq.with_seeds(sq.raw_controls_cte(CONTROL_MEASURES)[1:] + """
SELECT maz AS zone, CAST(trunc(totpop) AS BIGINT) AS population,
       SUM(CAST(trunc(totpop) AS BIGINT)) OVER (ORDER BY maz ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS running
FROM raw"""))
def q_zone_running_population(spark, sf_dir):
    zp = ctl.controls_maz(raw_controls(spark, sf_dir), CFG) \
        .select(F.col("maz").alias("zone"), F.col("totpop").alias("population"))
    return zg.running_population(zp)


@register("balanced_pumas", "WITH RECURSIVE " + sq.SEEDS + "," + sq.raw_controls_cte(CONTROL_MEASURES)[1:] + """,
c AS (SELECT maz AS zone, row_number() OVER (ORDER BY maz) AS pos,
             SUM(CAST(trunc(totpop) AS BIGINT)) OVER (ORDER BY maz ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               AS cum FROM raw),
lim AS (SELECT CAST(MAX(cum) AS DOUBLE) / CAST(3 AS DOUBLE) AS l FROM c),
r(pos, zone, cum, grp, start) AS (
  SELECT pos, zone, cum, 1, cum FROM c WHERE pos = 1
  UNION ALL
  SELECT c.pos, c.zone, c.cum,
         CASE WHEN CAST(r.cum - r.start AS DOUBLE) > lim.l THEN r.grp + 1 ELSE r.grp END,
         CASE WHEN CAST(r.cum - r.start AS DOUBLE) > lim.l THEN r.cum ELSE r.start END
  FROM r JOIN c ON c.pos = r.pos + 1 CROSS JOIN lim)
SELECT zone, CAST(grp AS INTEGER) AS "group" FROM r""")
def q_balanced_pumas(spark, sf_dir):
    """Internal zones split into 3 contiguous groups of near-equal control population."""
    zp = ctl.controls_maz(raw_controls(spark, sf_dir), CFG) \
        .select(F.col("maz").alias("zone"), F.col("totpop").alias("population"))
    return zg.balanced_groups(zp, 3)


@register("repair_household_size", "WITH " + sq.VIEWS + f""",
j AS (SELECT p.*, h.number_of_persons FROM ps p JOIN hh h ON p.household_id = h.household_id),
n AS (SELECT *, COUNT(*) OVER (PARTITION BY household_id) AS cnt,
             row_number() OVER (PARTITION BY household_id
                                ORDER BY person_number, {", ".join(sq.PERSON_REST)}, number_of_persons) AS rn
      FROM j)
SELECT household_id,
       CASE WHEN number_of_persons <> cnt THEN CAST(rn AS INTEGER) ELSE person_number END AS person_number,
       person_number AS original_person_number,
       CASE WHEN number_of_persons <> cnt THEN CAST(cnt AS INTEGER) ELSE number_of_persons END AS number_of_persons
FROM n""")
def q_repair_household_size(spark, sf_dir):
    h = sv.households(spark, sf_dir).select("household_id", "number_of_persons")
    j = sv.persons(spark, sf_dir).join(h, "household_id", "inner")
    r = qual.repair_household_size(j)
    return r.select("household_id", "person_number", "original_person_number", "number_of_persons")


@register("load_empty_as_zero", "WITH " + sq.VIEWS + """
SELECT household_id, household_zone, dwelling_type, number_of_persons, vehicles,
       CASE WHEN income_class = 7 THEN 0 ELSE income_class END AS income_class,
       CAST(expansion_factor AS DOUBLE) AS expansion_factor
FROM hh""")
def q_load_empty_as_zero(spark, sf_dir):
    """Households written as a seed CSV with invalid income left empty, read back with
    the lenient loader (empty integer field -> 0)."""
    h = sv.households(spark, sf_dir).select(
        F.col("household_id").alias("HouseholdId"), F.col("household_zone").alias("HouseholdZone"),
        F.col("dwelling_type").alias("DwellingType"), F.col("number_of_persons").alias("NumberOfPersons"),
        F.col("vehicles").alias("Vehicles"),
        F.when(F.col("income_class") != 7, F.col("income_class")).alias("IncomeClass"),
        F.col("expansion_factor").cast("double").alias("ExpansionFactor"))
    path = f"{scratch_dir(spark)}/household-seed-{uuid.uuid4().hex}"
    write_csv(h, path)
    df = read_csv(spark, path, S.HOUSEHOLD_SEED, empty_as_zero=True)
    return df.select(*[F.col(a).alias(b) for a, b in S.SEED_HOUSEHOLD_RENAMES.items()])


# --- synthesis -------------------------------------------------------------------------

CONSTRAINTS = syn.default_constraints(CFG)
UNREAD = ("transit_pass", "free_parking", "school_zone", "pd")  # by constraints, controls and synthesis queries


def synthesis_seed(spark, sf_dir, seeds: seedplan.PreparedSeeds | None = None):
    """(households with maz/taz/region and household weight, coded persons) of the
    sampled internal seed."""
    s = seeds or prepared(spark, sf_dir)
    ph = seedplan.sampled(s, CFG)
    # the smallest whole row of an id, so that rows under one id never mix
    row = F.min(F.struct(F.col("household_zone").alias("maz"), F.col("household_weight").alias("weight"), "income_class",
                         "puma", "number_of_persons", "dwelling_type", "vehicles")).alias("r")
    hh = ph.groupBy("household_id").agg(row).select("household_id", "r.*")
    hh = hh.withColumn("taz", F.col("maz")).withColumn("region", F.lit(1))
    return hh, seedplan.processed_persons(ph, CFG)


def _inc_sql() -> str:
    """Incidence twin: the seed keeps letters, so code comparisons become letter ones."""
    person = ([(v, f"occupation = '{v}'") for v in "GSMPO"]
              + [(f"E_{v}", f"employment_status = '{v}'") for v in "OFP"]
              + [("employment_zone_0", "employment_zone = 0"),
                 ("employment_zone_internal", f"employment_zone {sq.INTERNAL}"),
                 ("employment_zone_external", f"employment_zone {sq.EXTERNAL} AND employment_zone <> {sq.ROAMING}"),
                 ("employment_zone_roaming", f"employment_zone = {sq.ROAMING}")]
              + [(n, f"age BETWEEN {lo} AND {hi}") for (lo, hi), n in zip(AGE_BINS, AGE_COLUMNS)]
              + [(f"S_{v}", f"student_status = '{v}'") for v in "SPO"]
              + [("totpop", "expansion_factor >= 0 AND expansion_factor < 99999999")])
    counts = ", ".join(f"CAST(SUM(CASE WHEN {p} THEN 1 ELSE 0 END) AS INTEGER) AS inc_{n}" for n, p in person)
    hhc = {"totalhh": "household_weight > -100", **{f"income_class_{k}": f"income_class = {k}" for k in range(1, 7)}}
    cols = []
    for c in CONSTRAINTS:
        if c.table == "household":
            cols.append(f"CASE WHEN {hhc[c.control]} THEN 1 ELSE 0 END AS inc_{c.control}")
        else:
            cols.append(f"inc_{c.control}")
    return f"""pc AS (SELECT household_id, {counts} FROM phi GROUP BY household_id),
h AS (SELECT DISTINCT household_id, household_zone, household_weight, income_class FROM phi)
SELECT h.household_id, h.household_zone AS maz, {", ".join(cols)}
FROM h JOIN pc ON h.household_id = pc.household_id"""


@register("incidence", sq.with_seeds(_inc_sql()))
def q_incidence(spark, sf_dir):
    hh, persons = synthesis_seed(spark, sf_dir)
    inc = syn.incidence(hh, persons, CONSTRAINTS)
    return inc.select("household_id", "maz", *[f"inc_{c.control}" for c in CONSTRAINTS])


def _targets_sql() -> str:
    parts = []
    for c in CONSTRAINTS:
        src = {"maz": "raw r", "taz": "tz r", "meta": "mt r"}[c.level]
        join = {"maz": "", "taz": " ON r.taz = k.maz", "meta": " ON r.region = k.region"}[c.level]
        if c.level == "maz":
            parts.append(f"SELECT r.maz, '{c.control}' AS control, 'maz' AS level, "
                         f"CAST(trunc(r.{c.control}) AS DOUBLE) AS target FROM raw r")
        else:
            parts.append(f"SELECT k.maz, '{c.control}' AS control, '{c.level}' AS level, "
                         f"CAST(trunc(r.{c.control}) AS DOUBLE) AS target FROM raw k JOIN {src}{join}")
    return f"""tz AS (SELECT taz, {", ".join(f"SUM({m}) AS {m}" for m in CONTROL_MEASURES)} FROM raw GROUP BY taz),
mt AS (SELECT region, {", ".join(f"SUM({m}) AS {m}" for m in META_MEASURES)} FROM raw GROUP BY region)
""" + "\nUNION ALL ".join(parts)


@register("constraint_targets", sq.with_seeds(sq.raw_controls_cte(CONTROL_MEASURES)[1:] + ",\n" + _targets_sql()))
def q_constraint_targets(spark, sf_dir):
    """Each constraint's target for every MAZ, read at the constraint's level (SY1)."""
    raw = raw_controls(spark, sf_dir)
    cm, ct, cmeta = ctl.controls_maz(raw, CFG), ctl.controls_taz(raw, CFG), ctl.controls_meta(raw, CFG)
    t = syn.targets(cm.select("maz", "taz", "region"), cm, ct, cmeta, CONSTRAINTS)
    rows = F.array(*[F.struct(F.lit(c.control).alias("control"), F.lit(c.level).alias("level"),
                              F.col(f"t_{i}").alias("target")) for i, c in enumerate(CONSTRAINTS)])
    return t.select("maz", F.inline(rows))


@register("integerize", sq.with_seeds("""
g AS (SELECT household_zone, SUM(expansion_factor) AS tot FROM hzi GROUP BY 1),
s AS (SELECT h.household_id, h.household_zone, CAST(floor(g.tot) AS BIGINT) AS t,
             CAST(h.expansion_factor AS DOUBLE) * CAST(CAST(floor(g.tot) AS BIGINT) AS DOUBLE)
               / CAST(g.tot AS DOUBLE) AS sc
      FROM hzi h JOIN g USING (household_zone)),
f AS (SELECT *, floor(sc) AS fl, sc - floor(sc) AS fr FROM s),
r AS (SELECT *, SUM(fl) OVER (PARTITION BY household_zone) AS sfl,
             row_number() OVER (PARTITION BY household_zone ORDER BY fr DESC, household_id) AS rn FROM f)
SELECT household_id, household_zone,
       CAST(fl + CASE WHEN rn - 1 < t - sfl THEN 1 ELSE 0 END AS INTEGER) AS finalweight
FROM r"""))
def q_integerize(spark, sf_dir):
    """Seed household weights integerised per zone to the zone's truncated total (SY4)."""
    h = prepared(spark, sf_dir).households.select("household_id", "household_zone", "expansion_factor")
    r = syn.integerize(h, "household_zone", "expansion_factor", target=F.floor(F.col("_tot")))
    return r.select("household_id", "household_zone", "finalweight")


def balance_inputs(spark, sf_dir):
    """(households with incidence, coded persons, targets, forecast zones) of the synthesis run."""
    seeds = prepared(spark, sf_dir, UNREAD)  # one seed preparation feeds targets and households
    maz, taz, meta, vec, zones = forecast_inputs(spark, sf_dir, seeds)
    fmaz, ftaz, fmeta = fc.apply_population_vector(maz, taz, meta, vec, zones, FORECAST_CFG)
    fmaz = materialize(fmaz, "forecast")  # zone-sized; cut the lineage once
    tgt = materialize(syn.targets(fmaz.select("maz", "taz", "region"), fmaz, ftaz, fmeta, CONSTRAINTS), "targets")
    hh, persons = synthesis_seed(spark, sf_dir, seeds)
    hh_inc = materialize(syn.incidence(hh, persons, CONSTRAINTS), "incidence")
    return hh_inc, persons, tgt, fmaz


def balanced(spark, sf_dir, iterations: int | None = None):
    """The synthesis run: (balanced population, household attributes, coded persons, targets)."""
    hh_inc, persons, tgt, fmaz = balance_inputs(spark, sf_dir)
    return pool.balance(hh_inc, tgt, fmaz.select("maz", "puma"), CONSTRAINTS, CFG, iterations), hh_inc, persons, tgt


@register("balance_weights")
def q_balance_weights(spark, sf_dir):
    """Weights above zero of every (zone, household): each zone draws on all households of its puma."""
    pop, hh, _, _ = balanced(spark, sf_dir)
    hw = syn.households_of(pop.units, pop.members)
    return (hw.join(hh.select("household_id", F.col("weight").cast("double").alias("seed_weight")), "household_id")
            .select("household_id", "maz", "seed_weight", F.col("finalweight").alias("balanced_weight")))


@register("balance_multipliers")
def q_balance_multipliers(spark, sf_dir):
    """The multiplier of every constraint in every zone: with the signature dictionary, all fractional weights."""
    pop = balanced(spark, sf_dir)[0]
    return pool.multipliers(spark, pop.zones, CONSTRAINTS)


def _settled_sql() -> str:
    """Every target of the zones that get households holds up to its relaxation."""
    table = {"maz": ("fm", "maz"), "taz": ("ft", "taz"), "meta": ("fr", "region")}
    rows = [f"SELECT '{c.level}' AS level, CAST({key} AS INTEGER) AS geo, '{c.control}' AS control, "
            f"CAST({c.control} AS DOUBLE) AS target, TRUE AS settled FROM {src} "
            f"WHERE {key} IN (SELECT {key} FROM fm WHERE totalhh > 0)"
            for c in CONSTRAINTS for src, key in [table[c.level]]]
    return f"""WITH fm AS ({ORACLE["forecast_maz"]}), ft AS ({ORACLE["forecast_taz"]}), fr AS ({ORACLE["forecast_meta"]})
""" + "\nUNION ALL ".join(rows)


@register("balance_optimality", _settled_sql())
def q_balance_optimality(spark, sf_dir):
    """The optimality condition of the balanced weights, target by target (a certificate: the dual is
    strictly convex, so weights that meet it are the only ones)."""
    pop = balanced(spark, sf_dir)[0]
    return pool.optimality(spark, pop.zones, pop.sums, CONSTRAINTS)


def _start_sql() -> str:
    sums = ", ".join(f"SUM(CAST(household_weight AS DOUBLE) * inc_{c.control}) AS s_{c.control}" for c in CONSTRAINTS)
    rows = "\nUNION ALL ".join(f"SELECT f.maz, '{c.control}' AS control, round(p.s_{c.control} / p.w * f.totalhh, 2) AS achieved "
                               f"FROM f JOIN p ON f.puma = p.puma" for c in CONSTRAINTS)
    return f"""i AS ({_inc_sql().replace("pc AS", "WITH pc AS", 1)}),
hp AS (SELECT DISTINCT household_id, puma, household_weight FROM phi),
p AS (SELECT hp.puma, SUM(CAST(household_weight AS DOUBLE)) AS w, {sums} FROM hp JOIN i ON hp.household_id = i.household_id GROUP BY hp.puma),
f AS (SELECT * FROM ({ORACLE["forecast_maz"]}) WHERE totalhh > 0)
{rows}"""


@register("balance_step", sq.with_seeds(_start_sql()))
def q_balance_step(spark, sf_dir):
    """One pass over the signature dictionary at the start: what each zone's share of its puma achieves."""
    hh_inc, _, tgt, fmaz = balance_inputs(spark, sf_dir)
    table, _, zone_pool = pool.dictionary(hh_inc, syn.inc_columns(CONSTRAINTS), fmaz.select("maz", "puma"))
    z = pool.zones_of(tgt, zone_pool, table, CONSTRAINTS, 0, float("inf"))  # the plain share: nothing is capped
    sums = pool.look(table, z)[:, 3:3 + len(CONSTRAINTS)]
    rows = F.array(*[F.struct(F.lit(c.control).alias("control"), F.round(f"a_{i}", 2).alias("achieved"))
                     for i, c in enumerate(CONSTRAINTS)])
    return pool.achieved(spark, z, sums).select("maz", F.inline(rows))


@register("balance_residual")
def q_balance_residual(spark, sf_dir):
    pop, _, _, tgt = balanced(spark, sf_dir)
    return syn.residual_report(pop.achieved, tgt, CONSTRAINTS)


def synthesized(spark, sf_dir):
    """(households, persons) of the synthetic population."""
    pop, hh, persons, _ = balanced(spark, sf_dir)
    kept = syn.households_of(pop.units, pop.members)
    rest = hh.drop("maz", "taz", "region", *syn.inc_columns(CONSTRAINTS))
    return syn.synthesize(kept.join(rest, "household_id"), persons)


@register("synthesize")
def q_synthesize(spark, sf_dir):
    return synthesized(spark, sf_dir)[0].select("temp_id", "maz", "household_id", "finalweight", "dwelling_type",
                                                "number_of_persons", "vehicles", "income_class")


@register("synthesize_persons")
def q_synthesize_persons(spark, sf_dir):
    return synthesized(spark, sf_dir)[1].select("temp_id", "household_id", "person_number", "age", "sex",
                                                "employment_status", "occupation", "finalweight")


@register("synthesize_totals", f"""
SELECT maz, totalhh AS target, totalhh AS households FROM ({ORACLE["forecast_maz"]}) f""")
def q_synthesize_totals(spark, sf_dir):
    """Households of the synthetic population per MAZ against the MAZ's target: equal."""
    pop, _, _, tgt = balanced(spark, sf_dir)
    got = syn.households_of(pop.units, pop.members).groupBy("maz").agg(F.sum("finalweight").alias("households"))
    return (tgt.select("maz", F.col("t_0").cast("long").alias("target")).join(got, "maz", "left")
            .select("maz", "target", F.coalesce("households", F.lit(0)).cast("long").alias("households")))
