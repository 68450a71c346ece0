"""Files read by name, text that doesn't fit, wide values, zones without seed households."""

import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from popweave.config import RunConfig
from popweave.operators import controls as ctl
from popweave.operators import outputs as out
from popweave.operators import synthesis as syn
from popweave.sources import readers as rd
from popweave.sources import sinks as sk


def _csv(header, *rows):
    path = tempfile.mkdtemp(prefix="popweave-csv-") + "/f.csv"
    with open(path, "w") as f:
        f.write("\n".join([header, *rows]) + "\n")
    return path


def test_households_in_another_column_order_with_an_extra_column(spark):
    path = _csv("HouseholdId,HouseholdZone,ExpansionFactor,Note,NumberOfPersons,DwellingType,Vehicles,IncomeClass",
                "7,40000,12.5,x,4,2,1,3")
    r = rd.read_household_seed(spark, path).first()
    assert (r.household_id, r.household_zone, r.expansion_factor) == (7, 40000, 12.5)
    assert (r.number_of_persons, r.dwelling_type, r.vehicles, r.income_class) == (4, 2, 1, 3)


@pytest.mark.parametrize("read, header, row", [
    (rd.read_household_seed, "HouseholdId,HouseholdZone,DwellingType,NumberOfPersons,Vehicles,IncomeClass,ExpansionFactor", "x7,1,1,1,1,1,1.0"),
    (rd.read_person_seed, "HouseholdId,PersonNumber,Age,Sex,License,TransitPass,EmploymentStatus,Occupation,FreeParking,StudentStatus,EmploymentZone,SchoolZone,ExpansionFactor",
     "1,1,old,M,Y,N,F,P,N,O,1,1,1.0"),
    (rd.read_zone_map, "Zone,PD", "one,1"),
    (rd.read_controls, "region,puma,taz,maz,totalhh", "1,1,1,1,many"),
    (rd.read_population_vector, "Zone,Pop", "1,lots"),
])
def test_bad_text_stops_the_run(spark, read, header, row):
    with pytest.raises(Exception, match="is not"):
        read(spark, _csv(header, row)).collect()


def test_a_missing_column_stops_the_run(spark):
    with pytest.raises(ValueError, match="ExpansionFactor"):
        rd.read_household_seed(spark, _csv("HouseholdId,HouseholdZone,DwellingType,NumberOfPersons,Vehicles,IncomeClass", "1,1,1,1,1,1"))


def test_totals_beyond_32_bits(spark):
    assert rd.read_controls(spark, _csv("region,puma,taz,maz,totpop", "1,1,1,1,3000000000")).first().totpop == 3_000_000_000
    raw = spark.createDataFrame([(1, 3e9)], "maz int, totpop double")
    assert raw.select(ctl.truncate_int("maz"), ctl.truncate_int("totpop")).first() == (1, 3_000_000_000)


def test_wide_zones_stay_and_misfits_stop_the_run(spark):
    row = (1, 40000, 70000, 2, 1, 0, 3)
    cols = "temp_id int, maz int, finalweight int, number_of_persons int, dwelling_type int, vehicles int, income_class int"
    r = out.transform_households(spark.createDataFrame([row], cols)).first()
    assert (r.household_zone, r.expansion_factor) == (40000, 70000)
    with pytest.raises(Exception, match="does not fit"):
        out.transform_households(spark.createDataFrame([(*row[:5], 300, 3)], cols)).collect()


def test_student_map_uses_its_codes(spark):
    maps = {**RunConfig().person_category_map, "StudentStatus": {"O": 1, "S": 2, "P": 3}}
    cons = {c.control: c for c in syn.default_constraints(replace(RunConfig(), person_category_map=maps))}
    df = spark.createDataFrame([(1,), (2,), (2,)], "student_status int")
    assert df.filter(cons["S_S"].cond()).count() == 2


def test_a_group_of_zero_weights_still_meets_its_target(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (2, 1, 0.0)], "household_id long, maz int, w double")
    r = syn.integerize(df, "maz", "w", target=F.lit(101))
    assert sorted(x.finalweight for x in r.collect()) == [50, 51]


def test_tables_written_appended_and_read(spark):
    import uuid

    name = f"t_{uuid.uuid4().hex}"
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    sk.save_table(df, name, bucket_by=["id"], buckets=2)
    sk.append_table(df, name)
    assert rd.read_table(spark, name).count() == 10
    spark.sql(f"DROP TABLE {name}")
    path = tempfile.mkdtemp(prefix="popweave-pq-")
    df.write.mode("overwrite").parquet(path)
    assert rd.read_table(spark, path).count() == 5


def test_replacing_persons_follows_their_households_zone(spark):
    ah = spark.createDataFrame([(1, 3), (2, 4)], "household_id long, household_zone int")
    bh = spark.createDataFrame([(1, 3), (9, 3), (2, 4)], "household_id long, household_zone int")
    ap = spark.createDataFrame([(1, "a"), (2, "a")], "household_id long, src string")
    bp = spark.createDataFrame([(1, "b"), (9, "b"), (2, "b")], "household_id long, src string")
    got = out.replace_population_persons(ap, bp, ah, bh, [3])
    assert sorted(map(tuple, got.collect())) == [(1, "b"), (2, "a"), (9, "b")]
