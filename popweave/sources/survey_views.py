"""Survey views over the driver's star-schema test tables.

The test data has no survey; these views give it one, deterministically, so every

* zones       <- nation:              zone = n_nationkey+1, pd = n_regionkey+1
* households  <- orders JOIN customer: one household per order, zone = customer's nation+1
* persons     <- lineitem:            one person per line item

Weights are ``decimal(18,6)``: sums are exact, independent of summation order, and widen to 28
digits, enough for a whole-table total at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.config import RunConfig, ZoneRanges

WEIGHT_TYPE = "decimal(18,6)"

# Fixed test configuration paired with the views: internal zones 1..20, external 21..25
# with roaming id 25 inside the external range, PD groups with shared end points.
TEST_CONFIG = RunConfig(
    internal=ZoneRanges(((1, 20),)),
    external=ZoneRanges(((21, 25),)),
    roaming_zone=25,
    pd_groups=((1, 2), (2, 4), (4, 5)),
)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, *values: str) -> Column:
    """values[index] (0-based) as a CASE, so it stays a simple codegen'd expression."""
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation")
    return n.select((F.col("n_nationkey") + 1).cast("int").alias("zone"),
                    (F.col("n_regionkey") + 1).cast("int").alias("pd"))


def households(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.select(
        F.col("o_orderkey").alias("household_id"),
        (F.col("c_nationkey") + 1).cast("int").alias("household_zone"),
        (F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2)
         .when(F.col("o_orderstatus") == "P", 3).otherwise(0)).cast("int").alias("dwelling_type"),
        (F.col("o_orderkey") % 5 + 1).cast("int").alias("number_of_persons"),
        (F.col("o_custkey") % 4).cast("int").alias("vehicles"),
        (F.col("o_orderkey") % 7 + 1).cast("int").alias("income_class"),
        (F.col("o_totalprice").cast("decimal(18,2)") / F.lit(10000))
        .cast(WEIGHT_TYPE).alias("expansion_factor"),
    )


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    student = _pick((F.col("l_orderkey") + F.col("l_linenumber")) % 4, "S", "P", "O", "9")
    return li.select(
        F.col("l_orderkey").alias("household_id"),
        F.col("l_linenumber").cast("int").alias("person_number"),
        (F.col("l_quantity") * 2).cast("int").alias("age"),
        F.when(F.col("l_linestatus") == "O", "M").otherwise("F").alias("sex"),
        F.when(F.col("l_returnflag") == "A", "Y").otherwise("N").alias("license"),
        F.when(F.col("l_tax") >= 0.04, "Y").otherwise("N").alias("transit_pass"),
        _pick(F.col("l_suppkey") % 6, "F", "P", "O", "J", "H", "9").alias("employment_status"),
        _pick(F.col("l_partkey") % 6, "P", "G", "S", "M", "O", "9").alias("occupation"),
        F.when(F.col("l_partkey") % 2 == 0, "Y").otherwise("N").alias("free_parking"),
        student.alias("student_status"),
        (F.col("l_suppkey") % 27).cast("int").alias("employment_zone"),
        (F.col("l_partkey") % 21).cast("int").alias("school_zone"),
        (F.lit(1) + F.col("l_discount").cast("decimal(18,2)") * 10)
        .cast(WEIGHT_TYPE).alias("expansion_factor"),
    )


def population_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast vector over the zone dimension: 0 when zone%6=0 else 1000*zone."""
    z = zones(spark, sf_dir)
    return z.select("zone", F.when(F.col("zone") % 6 == 0, F.lit(0.0))
                    .otherwise(F.col("zone").cast("double") * 1000.0).alias("population"))


def synthetic_households(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthesizer-shaped household output: every household, weight x2."""
    h = households(spark, sf_dir)
    return h.select(
        F.col("household_id").alias("temp_id"),
        F.col("household_zone").alias("maz"),
        (F.floor(F.col("expansion_factor")) * 2).cast("int").alias("finalweight"),
        "dwelling_type", "number_of_persons", "vehicles", "income_class",
    )


def synthetic_persons(spark: SparkSession, sf_dir: str, cfg: RunConfig = TEST_CONFIG) -> DataFrame:
    """Synthesizer-shaped person output: members of the synthetic households, coded."""
    from popweave.functions.recode import recode

    h = synthetic_households(spark, sf_dir).select("temp_id", "finalweight")
    p = persons(spark, sf_dir)
    j = p.join(h, p.household_id == h.temp_id, "inner")
    j = recode(j, {"occupation": cfg.person_category_map["Occupation"],
                   "employment_status": cfg.person_category_map["EmploymentStatus"]})
    return j.select("temp_id", "person_number", "age", "sex", "license", "transit_pass",
                    "employment_status", "occupation", "free_parking", "student_status",
                    "employment_zone", "finalweight")
