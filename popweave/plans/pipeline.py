"""End-to-end runs over the original file formats (PL1-PL4, SRC1-SRC12, SNK1-SNK10).

The stages mirror the surveyed command: inputs (seeds + controls) -> record tables ->
[forecast] -> synthesis -> outputs -> validation. Each stage reads what the previous
one wrote, so any stage can be re-run alone; every intermediate table is written to the
output folder (a shared path on a cluster).
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from popweave.config import RunConfig
from popweave.session import materialize, run_scratch
from popweave.functions.sizing import broadcast_if_bounded
from popweave.operators import controls as ctl
from popweave.operators import forecast as fc
from popweave.operators import outputs as out
from popweave.operators import pool
from popweave.operators import synthesis as syn
from popweave.operators import validation as val
from popweave.operators.ids import assign_hhnum
from popweave.plans import seeds as seedplan
from popweave.sources import readers as rd
from popweave.sources import schemas as S
from popweave.sources import sinks as sk

CONTROL_FILES = ("controls_maz", "controls_taz", "controls_meta")

OUTPUT_PERSON_HEADERS = {
    "household_id": "HouseholdId", "person_number": "PersonNumber", "age": "Age", "sex": "Sex",
    "license": "License", "transit_pass": "TransitPass", "employment_status": "EmploymentStatus",
    "occupation": "Occupation", "free_parking": "FreeParking", "student_status": "StudentStatus",
    "employment_zone": "EmploymentZone", "school_zone": "SchoolZone",
    "expansion_factor": "ExpansionFactor", "weight": "weight", "weightp": "weightp", "puma": "puma",
}
OUTPUT_HOUSEHOLD_HEADERS = {
    "household_id": "HouseholdId", "household_zone": "HouseholdZone",
    "expansion_factor": "ExpansionFactor", "number_of_persons": "NumberOfPersons",
    "dwelling_type": "DwellingType", "vehicles": "Vehicles", "income_class": "IncomeClass",
}
PROCESSED_HOUSEHOLD_HEADERS = {
    "household_id": "HouseholdId", "dwelling_type": "DwellingType", "number_of_persons": "NumberOfPersons",
    "vehicles": "Vehicles", "income_class": "IncomeClass",
}
PROCESSED_HOUSEHOLD = T.StructType([
    T.StructField("HouseholdId", T.LongType()), T.StructField("puma", T.IntegerType()),
    T.StructField("DwellingType", T.IntegerType()), T.StructField("NumberOfPersons", T.IntegerType()),
    T.StructField("Vehicles", T.IntegerType()), T.StructField("IncomeClass", T.IntegerType()),
    T.StructField("weight", T.DoubleType()),
])
VALIDATION_HEADERS = {"observed_total": "Observed Total",
                      "synthesized_total": "Synthesized Total", "abs_difference": "Abs. Difference"}


@dataclass(frozen=True)
class SeedFiles:
    persons: str
    households: str
    zones: str


def _inputs_dir(out_dir: str) -> str:
    return f"{out_dir}/Inputs"


def generate_inputs(spark: SparkSession, cfg: RunConfig, files: SeedFiles, out_dir: str,
                    build_controls: bool = True) -> None:
    """PL1: seeds -> geography -> imputation -> controls (CSV) -> sample -> processed
    seeds (CSV)."""
    seeds = seedplan.prepare(rd.read_zone_map(spark, files.zones),
                             rd.read_household_seed(spark, files.households),
                             rd.read_person_seed(spark, files.persons), cfg)
    if build_controls:
        raw = materialize(seedplan.raw_controls(seeds, cfg), "raw-controls")  # zone-sized
        sk.write_csv(ctl.controls_maz(raw, cfg), f"{_inputs_dir(out_dir)}/controls_maz",
                     sort_by=("puma", "taz", "maz"))
        sk.write_csv(ctl.controls_taz(raw, cfg), f"{_inputs_dir(out_dir)}/controls_taz",
                     sort_by=("puma", "taz"))
        sk.write_csv(ctl.controls_meta(raw, cfg), f"{_inputs_dir(out_dir)}/controls_meta")
    ph = seedplan.sampled(seeds, cfg)
    sk.write_csv(out.rename_for_sink(seedplan.processed_households(ph), PROCESSED_HOUSEHOLD_HEADERS),
                 f"{_inputs_dir(out_dir)}/processed_households")
    sk.write_csv(out.rename_for_sink(seedplan.processed_persons(ph, cfg), OUTPUT_PERSON_HEADERS),
                 f"{_inputs_dir(out_dir)}/processed_persons")


def initialize_records(spark: SparkSession, out_dir: str) -> tuple[DataFrame, DataFrame]:
    """PL2: record tables with dense ``hhnum``; doubles narrowed to float for the load
    (PRJ4). Written as Parquet next to the inputs."""
    hh = rd.read_csv(spark, f"{_inputs_dir(out_dir)}/processed_households", PROCESSED_HOUSEHOLD)
    snake = {v: k for k, v in OUTPUT_PERSON_HEADERS.items()}
    wide = {"household_id": T.LongType(), "weight": T.DoubleType(), "weightp": T.DoubleType()}
    ints = ("person_number", "puma", "age", "employment_status", "occupation", "employment_zone", "school_zone")
    path = f"{_inputs_dir(out_dir)}/processed_persons"
    # the student map decides whether that column holds codes or letters, so the file's own names are kept
    names = spark.read.option("header", True).csv(path).columns
    kind = lambda c: wide.get(snake.get(c, c), T.IntegerType() if snake.get(c, c) in ints else T.StringType())
    pp = rd.read_csv(spark, path, T.StructType([T.StructField(c, kind(c)) for c in names]))
    snake_h = {v: k for k, v in PROCESSED_HOUSEHOLD_HEADERS.items()}
    hh = hh.select(*[F.col(c).alias(snake_h.get(c, c)) for c in hh.columns]).withColumn("weight", F.col("weight").cast("float"))
    pp = pp.select(*[F.col(c).alias(snake.get(c, c)) for c in pp.columns])
    hht, pst = assign_hhnum(hh, pp)
    hht.write.mode("overwrite").parquet(f"{out_dir}/tables/hhtable")
    pst.write.mode("overwrite").parquet(f"{out_dir}/tables/perstable")
    return hht, pst


def read_control_tables(spark: SparkSession, out_dir: str) -> tuple[DataFrame, ...]:
    """SRC4/SRC8: the three control tables of a run."""
    return tuple(rd.read_controls(spark, f"{_inputs_dir(out_dir)}/{n}") for n in CONTROL_FILES)


def apply_forecast(spark: SparkSession, cfg: RunConfig, out_dir: str, vector_path: str,
                   zones_path: str, fallback: str = "last_group",
                   controls_dir: str | None = None) -> None:
    """FC5 over the run's control files, or those of another folder (``controls_dir``); the
    re-scaled tables become the run's."""
    src = controls_dir or _inputs_dir(out_dir)
    maz, taz, meta = (rd.read_controls(spark, f"{src}/{n}") for n in CONTROL_FILES)
    vec = rd.read_population_vector(spark, vector_path)
    zones = rd.read_zone_map(spark, zones_path)
    fmaz, ftaz, fmeta = fc.apply_population_vector(maz, taz, meta, vec, zones, cfg, fallback)
    for df, name in zip((fmaz, ftaz, fmeta), CONTROL_FILES):
        sk.write_csv(materialize(df, name), f"{_inputs_dir(out_dir)}/{name}")


def synthesize(spark: SparkSession, cfg: RunConfig, out_dir: str, iterations: int | None = None) -> None:
    """SY1-SY5: balance the processed seed to the control tables, every zone drawing on all
    households of its puma, and write the synthesizer-shaped tables ``synpop_hh`` / ``synpop_person``,
    the residuals of the fractional and of the whole weights and the multipliers."""
    maz, taz, meta = read_control_tables(spark, out_dir)
    hh = spark.read.parquet(f"{out_dir}/tables/hhtable")
    pst = spark.read.parquet(f"{out_dir}/tables/perstable")
    constraints = syn.default_constraints(cfg)
    tgt = materialize(syn.targets(maz.select("maz", "taz", "region"), maz, taz, meta, constraints),
                      "targets")
    persons = pst.withColumn("weight", F.col("weight").cast("double"))
    for c in ("age", "employment_status", "occupation", "employment_zone"):
        persons = persons.withColumn(c, F.col(c).cast("int"))
    hh_inc = materialize(syn.incidence(hh, persons, constraints), "incidence")
    pop = pool.balance(hh_inc, tgt, maz.select("maz", "puma"), constraints, cfg, iterations)
    whole = syn.achieved_units(pop.units, pop.signatures, tgt, len(constraints))
    report = syn.residual_report(pop.achieved, tgt, constraints).join(
        syn.residual_report(whole, tgt, constraints).select("level", "geo", "control", F.col("achieved").alias("achieved_whole")),
        ["level", "geo", "control"])
    report.write.mode("overwrite").parquet(f"{out_dir}/tables/balance_residual")
    pool.multipliers(spark, pop.zones, constraints).write.mode("overwrite").parquet(f"{out_dir}/tables/balance_multipliers")
    kept = syn.households_of(pop.units, pop.members)
    sh, sp = syn.synthesize(kept.join(hh, "household_id"), persons)
    sh.select("temp_id", "maz", "finalweight", "household_id", "dwelling_type", "number_of_persons",
              "vehicles", "income_class").write.mode("overwrite").parquet(f"{out_dir}/tables/synpop_hh")
    sp.select("temp_id", "person_number", "age", "sex", "license", "transit_pass", "employment_status",
              "occupation", "free_parking", "student_status", "employment_zone", "finalweight") \
        .write.mode("overwrite").parquet(f"{out_dir}/tables/synpop_person")


def generate_outputs(spark: SparkSession, cfg: RunConfig, out_dir: str,
                     merge_with: tuple[str, str] | None = None, saved: str | None = None,
                     tables: tuple[str, str] | None = None) -> None:
    """PL3: transform, scale, inverse re-code, optional merge, household totals and the
    8 zonal-residence files (one partitioned write). ``saved`` is the folder of an earlier run
    whose output files are read instead of the synthesizer's tables (SRC9); ``tables`` are the
    catalog names of household and person tables to read instead (SRC7); ``merge_with`` are
    household and person files of another population, their columns found by name."""
    if saved is not None:
        persons, households = read_outputs(spark, saved)
    else:
        hh, pp = tables or (f"{out_dir}/tables/synpop_hh", f"{out_dir}/tables/synpop_person")
        persons = out.output_persons(rd.read_table(spark, pp), cfg)
        households = out.output_households(rd.read_table(spark, hh), cfg)
    if merge_with is not None:
        households = out.merge_populations(households, rd.read_household_seed(spark, merge_with[0]),
                                           ["household_id"], list(households.columns))
        persons = out.merge_populations(persons, rd.read_person_seed(spark, merge_with[1]),
                                        ["household_id", "person_number"], list(persons.columns))
    households = materialize(households, "out-households")
    persons = materialize(persons, "out-persons")
    joined = out.synthetic_join(persons, households)
    residence = out.rename_for_sink(out.zonal_residence(joined, cfg), {"zone": "Zone", "persons": "Persons"})
    sk.write_partitioned(residence, f"{out_dir}/ZonalResidence",
                         ["occupation", "employment_status"])
    sk.write_csv(out.rename_for_sink(out.household_totals(households),
                                     {"zone": "Zone", "expanded_households": "ExpandedHouseholds"}),
                 f"{out_dir}/HouseholdData/HouseholdTotals")
    sk.write_csv(out.rename_for_sink(persons, OUTPUT_PERSON_HEADERS), f"{out_dir}/HouseholdData/Persons",
                 sort_by=("household_id",))
    sk.write_csv(out.rename_for_sink(households, OUTPUT_HOUSEHOLD_HEADERS),
                 f"{out_dir}/HouseholdData/Households", sort_by=("household_id",))


def read_outputs(spark: SparkSession, out_dir: str) -> tuple[DataFrame, DataFrame]:
    """SRC9: saved output CSVs with integer zones."""
    return (rd.read_person_seed(spark, f"{out_dir}/HouseholdData/Persons"),
            rd.read_household_seed(spark, f"{out_dir}/HouseholdData/Households"))


def validate(spark: SparkSession, cfg: RunConfig, files: SeedFiles, out_dir: str) -> None:
    """PL4: observed (seed) vs synthesized (outputs) totals, written with the report
    headers (SRC10, SNK7)."""
    zones = rd.read_zone_map(spark, files.zones)
    seed_p = rd.read_person_seed(spark, files.persons)
    seed_h = rd.read_household_seed(spark, files.households)
    syn_p, syn_h = read_outputs(spark, out_dir)
    obs = val.validation_join(seed_p, seed_h, zones, cfg)
    synj = val.validation_join(syn_p, syn_h, zones, cfg)
    sk.write_report(out.rename_for_sink(val.validation_persons(obs, synj, cfg, ordinal=True), VALIDATION_HEADERS),
                    f"{out_dir}/Validation/persons_totals")
    sk.write_report(out.rename_for_sink(val.validation_households(seed_h, syn_h, cfg, ordinal=True), VALIDATION_HEADERS),
                    f"{out_dir}/Validation/households_totals")


def compare(spark: SparkSession, files: SeedFiles, out_dir: str, control: str = "hhsize1", column: str = "NumberOfPersons",
            value: int = 1, controls: str | None = None) -> None:
    """Saved households against a control column, per planning district (SRC12, SNK9, AG23).

    Reads only the columns it needs of the run's household file and control table (or of the file
    ``controls``, e.g. one with a count of one-vehicle households: ``control="numv1", column="Vehicles"``),
    and writes the comparison per district, in district order, and the households with theirs."""
    zones = rd.read_zone_map(spark, files.zones)
    kept = [f for f in S.HOUSEHOLD_SEED.fields if f.name in ("HouseholdId", "HouseholdZone", "ExpansionFactor", column)]
    households = rd.read_csv(spark, f"{out_dir}/HouseholdData/Households", T.StructType(kept))
    households = households.select(*[F.col(f.name).alias(S.SEED_HOUSEHOLD_RENAMES[f.name]) for f in kept])
    totals = rd.read_csv(spark, controls or f"{_inputs_dir(out_dir)}/controls_maz",
                         T.StructType([T.StructField("taz", T.IntegerType()), T.StructField(control, T.DoubleType())]))
    chosen = F.col(S.SEED_HOUSEHOLD_RENAMES[column]) == value
    by_pd = val.pd_compare(totals, control, households, chosen, zones)
    sk.write_report(by_pd.select(F.col("pd").alias("_pd"), F.col("pd").alias("PD"), F.col("control").alias(control),
                                 F.col("synthesized").alias("ExpansionFactor")), f"{out_dir}/Compare/pd_compare", "_pd")
    pd = broadcast_if_bounded(zones.select(F.col("zone").alias("household_zone"), "pd"))
    sk.write_csv(out.rename_for_sink(households.join(pd, "household_zone"), OUTPUT_HOUSEHOLD_HEADERS | {"pd": "PD"}),
                 f"{out_dir}/Compare/households_with_pd")


CONTROL_KEYS = {"controls_maz": ("maz",), "controls_taz": ("taz",), "controls_meta": ("region",)}


def publish_controls(spark: SparkSession, out_dir: str, prefix: str = "control_totals_") -> list[str]:
    """The run's control tables as catalog tables, refused where a key is missing or twice there (SNK3, PL5)."""
    names = []
    for df, name in zip(read_control_tables(spark, out_dir), CONTROL_FILES):
        names.append(prefix + name.removeprefix("controls_"))
        sk.publish_table(df, names[-1], CONTROL_KEYS[name])
    return names


def export_controls(spark: SparkSession, names: Sequence[str], out_dir: str) -> None:
    """Control tables of the catalog (MAZ, TAZ, meta) as the control files of a run that did not
    build them itself (SRC8)."""
    for table, name in zip(names, CONTROL_FILES):
        df = rd.read_table(spark, table)
        sk.write_csv(df, f"{_inputs_dir(out_dir)}/{name}", sort_by=[k for k in ("puma", "taz", "maz", "region") if k in df.columns])


def export_population(spark: SparkSession, out_dir: str) -> None:
    """The synthesizer's tables as header-less CSV, in id order (SNK8)."""
    for name in ("synpop_hh", "synpop_person"):
        sk.write_csv(spark.read.parquet(f"{out_dir}/tables/{name}"), f"{out_dir}/Export/{name}", header=False, sort_by=("temp_id",))


def full_run(spark: SparkSession, cfg: RunConfig, files: SeedFiles, out_dir: str,
             vector_path: str | None = None, iterations: int | None = None) -> None:
    """The whole chain: inputs -> records -> [forecast] -> synthesis -> outputs -> validation.
    Every stage writes its results to ``out_dir``; the intermediate tables of the run live
    in one scratch folder under the checkpoint dir that is deleted when the run ends."""
    with run_scratch(spark, "full-run"):
        generate_inputs(spark, cfg, files, out_dir)
        initialize_records(spark, out_dir)
        if vector_path:
            apply_forecast(spark, cfg, out_dir, vector_path, files.zones)
        synthesize(spark, cfg, out_dir, iterations)
        generate_outputs(spark, replace(cfg, percent_population=1.0), out_dir)
        validate(spark, cfg, files, out_dir)
