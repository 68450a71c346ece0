"""End-to-end run over seed CSV files derived from the test tables (sf0.001)."""

import tempfile

from pyspark.sql import functions as F

from popweave.plans import pipeline as pl
from popweave.sources import survey_views as sv

SF = "/root/testdata/sf0.001"


def _write_seeds(spark, d):
    p = sv.persons(spark, SF).withColumn("expansion_factor", F.col("expansion_factor").cast("double"))
    h = sv.households(spark, SF).withColumn("expansion_factor", F.col("expansion_factor").cast("double"))
    from popweave.sources.schemas import SEED_HOUSEHOLD_RENAMES, SEED_PERSON_RENAMES
    p.select(*[F.col(b).alias(a) for a, b in SEED_PERSON_RENAMES.items()]) \
        .write.option("header", True).csv(f"{d}/persons")
    h.select(*[F.col(b).alias(a) for a, b in SEED_HOUSEHOLD_RENAMES.items()]) \
        .write.option("header", True).csv(f"{d}/households")
    sv.zones(spark, SF).select(F.col("zone").alias("Zone"), F.col("pd").alias("PD"),
                               F.lit("x").alias("Name")).write.option("header", True).csv(f"{d}/zones")
    sv.population_vector(spark, SF).select(F.col("zone").alias("Zone#"), F.col("population").alias("totpop")) \
        .write.option("header", True).csv(f"{d}/vector")
    return pl.SeedFiles(f"{d}/persons", f"{d}/households", f"{d}/zones")


def test_full_run_writes_every_output(spark):
    d = tempfile.mkdtemp(prefix="popweave-e2e-")
    files = _write_seeds(spark, d)
    pl.full_run(spark, sv.TEST_CONFIG, files, f"{d}/out", vector_path=f"{d}/vector", iterations=5)
    # the run's intermediate tables are gone, and later work goes back to the shared folder
    import os
    from popweave.session import SCRATCH_CONF, scratch_dir
    assert spark.conf.get(SCRATCH_CONF, None) is None
    root = scratch_dir(spark).removeprefix("file:")
    assert not [x for x in (os.listdir(root) if os.path.isdir(root) else []) if x.startswith("full-run-")]
    r = spark.read.option("header", True).csv(f"{d}/out/Validation/persons_totals")
    assert r.count() == 28 and "Observed Total" in r.columns
    assert spark.read.option("header", True).csv(f"{d}/out/Validation/households_totals").count() == 12
    maz = spark.read.option("header", True).csv(f"{d}/out/Inputs/controls_maz")
    assert maz.count() == 25  # 20 internal zones + 5 zones new in the vector
    hh = spark.read.option("header", True).csv(f"{d}/out/HouseholdData/Households")
    tot = hh.agg(F.sum(F.col("ExpansionFactor").cast("double"))).first()[0]
    want = maz.filter("totalhh > 0").agg(F.sum(F.col("totalhh").cast("double"))).first()[0]
    assert tot == want
    z = spark.read.option("header", True).csv(f"{d}/out/ZonalResidence")
    assert set(r[0] for r in z.select("occupation").distinct().collect()) <= {"G", "M", "P", "S"}
    _check_reports_in_order(d)
    _check_compare(spark, files, d)
    _check_tables(spark, d)


def _lines(folder):
    import glob
    (part,) = glob.glob(f"{folder}/part-*.csv")
    return open(part).read().splitlines()


def _check_reports_in_order(d):
    from popweave.operators import validation as val
    for name, labels in (("persons_totals", val.person_labels(sv.TEST_CONFIG)), ("households_totals", val.household_labels())):
        got = [x.split(",")[0] for x in _lines(f"{d}/out/Validation/{name}")[1:]]
        assert got == [name for name, _ in labels]


def _check_compare(spark, files, d):
    pl.compare(spark, files, f"{d}/out", "totalhh", "NumberOfPersons", 1)  # a forecast keeps the totals only
    rows = _lines(f"{d}/out/Compare/pd_compare")
    assert rows[0] == "PD,totalhh,ExpansionFactor" and [int(x.split(",")[0]) for x in rows[1:]] == sorted(int(x.split(",")[0]) for x in rows[1:])
    hh = spark.read.option("header", True).csv(f"{d}/out/HouseholdData/Households")
    zones = spark.read.option("header", True).csv(files.zones)
    pd = spark.read.option("header", True).csv(f"{d}/out/Compare/households_with_pd")
    assert pd.count() == hh.count() and "PD" in pd.columns
    want = {r.PD: r.s for r in hh.filter("NumberOfPersons = 1").join(zones, F.col("HouseholdZone") == F.col("Zone"))
            .groupBy("PD").agg(F.sum(F.col("ExpansionFactor").cast("double")).alias("s")).collect()}
    assert {x.split(",")[0]: float(x.split(",")[2]) for x in rows[1:] if x.split(",")[2]} == want
    # a control file with a column of the caller's own, against another household column
    spark.createDataFrame([(1, 10.0), (2, 5.0)], "taz int, numv1 double").write.option("header", True).csv(f"{d}/own_controls")
    pl.compare(spark, files, f"{d}/out", "numv1", "Vehicles", 1, f"{d}/own_controls")
    assert _lines(f"{d}/out/Compare/pd_compare")[0] == "PD,numv1,ExpansionFactor"


def _check_tables(spark, d):
    import pytest
    from popweave.sources import sinks as sk
    names = pl.publish_controls(spark, f"{d}/out", "t_controls_")
    pl.export_controls(spark, names, f"{d}/again")
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    for a, b in zip(pl.read_control_tables(spark, f"{d}/out"), pl.read_control_tables(spark, f"{d}/again")):
        assert a.columns == b.columns and key(a) == key(b)
    # duplicate keys: the published table stays as it is, or the rows are set aside
    held = spark.table(names[0])
    before = key(held)
    twice = spark.createDataFrame(held.collect(), held.schema)
    twice = twice.unionByName(twice.limit(2)).unionByName(twice.limit(1).withColumn("maz", F.lit(None).cast("int")))
    with pytest.raises(sk.AuditError):
        sk.publish_table(twice, names[0], ("maz",))
    assert key(spark.table(names[0])) == before
    assert sk.publish_table(twice, names[0], ("maz",), quarantine="t_controls_bad") == 5
    assert spark.table(names[0]).count() == len(before) - 2 and spark.table("t_controls_bad").count() == 5
    # synthesizer's tables in the catalog, columns found by name
    for t in ("synpop_hh", "synpop_person"):
        df = spark.read.parquet(f"{d}/out/tables/{t}")
        sk.save_table(df.limit(0), f"t_{t}")
        sk.append_table(df.select(*reversed(df.columns)), f"t_{t}")
    pl.generate_outputs(spark, sv.TEST_CONFIG, f"{d}/from_tables", tables=("t_synpop_hh", "t_synpop_person"))
    pl.generate_outputs(spark, sv.TEST_CONFIG, f"{d}/from_files", tables=(f"{d}/out/tables/synpop_hh", f"{d}/out/tables/synpop_person"))
    read = lambda x: key(spark.read.option("header", True).csv(f"{d}/{x}/HouseholdData/Persons"))
    assert read("from_tables") == read("from_files")
    pl.export_population(spark, f"{d}/out")
    raw = spark.read.csv(f"{d}/out/Export/synpop_hh")
    assert raw.count() == spark.read.parquet(f"{d}/out/tables/synpop_hh").count() and raw.columns[0] == "_c0"
    for t in (*names, "t_controls_bad", "t_synpop_hh", "t_synpop_person"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_run_scratch_holds_and_then_drops_intermediate_tables(spark):
    import os
    from popweave.session import materialize, run_scratch, scratch_dir
    with run_scratch(spark, "t") as path:
        t = materialize(spark.range(10), "x")
        local = path.removeprefix("file:")
        assert scratch_dir(spark) == path and len(os.listdir(local)) == 1
        assert t.count() == 10
    assert not os.path.exists(local) and scratch_dir(spark) != path
