"""Small-area synthesis as DataFrame jobs (SY1-SY6).

Constraints and their targets, household incidence, largest-remainder integers, the
sharing out of whole signature weights over households, emission of the synthetic population and
the residual report. The weights themselves are balanced over puma pools in ``operators/pool``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from popweave.config import AGE_BINS, AGE_COLUMNS, RunConfig
from popweave.functions.zones import in_ranges
from popweave.operators.ids import dense_position
from popweave.session import materialize


@dataclass(frozen=True)
class Constraint:
    control: str       # control-table column holding the target
    level: str         # "maz" | "taz" | "meta"
    table: str         # "household" (0/1 per household) | "person" (member count)
    importance: float
    predicate: Callable[[], Column]  # builds the predicate over processed seed columns

    def cond(self) -> Column:
        return self.predicate()


def default_constraints(cfg: RunConfig) -> list[Constraint]:
    """The eight synthesizer targets (SY1). Occupation and employment status are
    matched on their codes (the seed is re-coded); student status on its codes where a
    student map is configured, else on its letters. Employment-zone bins follow the run's zone ranges, with
    the roaming id excluded from external, as in the controls."""
    occ = cfg.person_category_map["Occupation"]
    emp = cfg.person_category_map["EmploymentStatus"]
    student = cfg.person_category_map.get("StudentStatus", {v: v for v in "SPO"})

    def ez():
        return F.col("employment_zone")

    out = [Constraint("totalhh", "maz", "household", 1000, lambda: F.col("weight") > -100)]
    out += [Constraint(v, "maz", "person", 1000, lambda v=v: F.col("occupation") == occ[v])
            for v in "GSMPO"]
    out += [Constraint(f"E_{v}", "maz", "person", 1000,
                       lambda v=v: F.col("employment_status") == emp[v]) for v in "OFP"]
    out += [Constraint("employment_zone_0", "taz", "person", 4000, lambda: ez() == 0),
            Constraint("employment_zone_internal", "taz", "person", 4000,
                       lambda: in_ranges(ez(), cfg.internal)),
            Constraint("employment_zone_external", "taz", "person", 4000,
                       lambda: in_ranges(ez(), cfg.external) & (ez() != cfg.roaming_zone)),
            Constraint("employment_zone_roaming", "taz", "person", 4000,
                       lambda: ez() == cfg.roaming_zone)]
    out += [Constraint(f"income_class_{k}", "taz", "household", 1000 if k == 1 else 900,
                       lambda k=k: F.col("income_class") == k) for k in range(1, 7)]
    out += [Constraint(name, "meta", "person", 700, lambda lo=lo, hi=hi: F.col("age").between(lo, hi))
            for (lo, hi), name in zip(AGE_BINS, AGE_COLUMNS)]
    out += [Constraint(f"S_{v}", "meta", "person", 800, lambda v=v: F.col("student_status") == student[v])
            for v in "SPO" if v in student]
    out.append(Constraint("totpop", "meta", "person", 100000,
                          lambda: (F.col("weight") >= 0) & (F.col("weight") < 99999999)))
    return out


def constraint_table(spark: SparkSession, constraints: Sequence[Constraint]) -> DataFrame:
    """SY1 as a small DataFrame (one row per constraint)."""
    rows = [(i, c.control, c.level, c.table, float(c.importance)) for i, c in enumerate(constraints)]
    return spark.createDataFrame(rows, "id int, control string, level string, table string, importance double")


def incidence(households: DataFrame, persons: DataFrame,
              constraints: Sequence[Constraint]) -> DataFrame:
    """Households with ``inc_<control>`` columns: 0/1 for household constraints, member
    counts for person constraints (SY2). Persons are aggregated per household (partial
    counts map-side) and joined back on the household id."""
    pc = [c for c in constraints if c.table == "person"]
    counts = persons.groupBy("household_id").agg(
        *[F.sum(F.when(c.cond(), 1).otherwise(0)).alias(f"inc_{c.control}") for c in pc])
    j = households.join(counts, "household_id", "left")
    cols = []
    for c in constraints:
        if c.table == "household":
            cols.append(F.when(c.cond(), 1).otherwise(0).cast("int").alias(f"inc_{c.control}"))
        else:
            cols.append(F.coalesce(F.col(f"inc_{c.control}"), F.lit(0)).cast("int")
                        .alias(f"inc_{c.control}"))
    keep = [c for c in households.columns]
    return j.select(*keep, *cols)


def targets(zone_keys: DataFrame, controls_maz: DataFrame, controls_taz: DataFrame,
            controls_meta: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Per MAZ ``(maz, taz, region, t_0..t_{K-1})``: each constraint's target read at its
    own level (null when the control column is absent). All inputs are zone-sized."""
    def pick(df: DataFrame, key: str, level: str) -> DataFrame:
        cols = [F.col(c.control).cast("double").alias(f"t_{i}") for i, c in enumerate(constraints)
                if c.level == level and c.control in df.columns]
        return df.select(F.col(key).alias(key), *cols)

    t = (zone_keys.join(pick(controls_maz, "maz", "maz"), "maz", "left")
         .join(pick(controls_taz, "taz", "taz"), "taz", "left")
         .join(pick(controls_meta, "region", "meta"), "region", "left"))
    return t.select("maz", "taz", "region",
                    *[(F.col(f"t_{i}") if f"t_{i}" in t.columns else F.lit(None).cast("double"))
                      .alias(f"t_{i}") for i in range(len(constraints))])


def inc_columns(constraints: Sequence[Constraint]) -> list[str]:
    return [f"inc_{c.control}" for c in constraints]


def by_level(ach: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Zone sums ``a_i`` read at each constraint's own level: summed by TAZ or region where it is one."""
    key = {"taz": "taz", "meta": "region"}
    return ach.select("maz", "taz", "region", *[
        (F.sum(f"a_{i}").over(Window.partitionBy(key[c.level])) if c.level in key else F.col(f"a_{i}")).alias(f"a_{i}")
        for i, c in enumerate(constraints)])


def residual_report(ach: DataFrame, tgt: DataFrame, constraints: Sequence[Constraint]) -> DataFrame:
    """Achieved vs target per (level, geography, control) (SY6): every target of every zone,
    zones without households at 0. ``ach`` is zone-sized: (maz, taz, region, a_0..)."""
    zero = [F.coalesce(f"a_{i}", F.lit(0.0)).alias(f"a_{i}") for i in range(len(constraints))]
    whole = tgt.select("maz", "taz", "region").join(ach.drop("taz", "region"), "maz", "left").select("maz", "taz", "region", *zero)
    both = by_level(whole, constraints).join(tgt.drop("taz", "region"), "maz")
    rows = [F.struct(F.lit(c.level).alias("level"), F.col({"maz": "maz", "taz": "taz", "meta": "region"}[c.level]).cast("int").alias("geo"),
                     F.lit(c.control).alias("control"), F.col(f"t_{i}").alias("target"), F.col(f"a_{i}").alias("achieved"))
            for i, c in enumerate(constraints)]
    long = both.select(F.inline(F.array(*rows))).filter(F.col("target").isNotNull())
    # the zones of a TAZ or region repeat its rows
    return (long.groupBy("level", "geo", "control").agg(F.max("target").alias("target"), F.max("achieved").alias("achieved"))
            .withColumn("residual", F.col("achieved") - F.col("target")))


def achieved_units(units: DataFrame, signatures: DataFrame, tgt: DataFrame, k: int) -> DataFrame:
    """Zone sums (maz, taz, region, a_0..) of whole weights (maz, sig, units)."""
    a = (units.join(signatures.select("sig", "inc"), "sig").groupBy("maz")
         .agg(*[F.sum(F.col("units") * F.col("inc")[i]).cast("double").alias(f"a_{i}") for i in range(k)]))
    return a.join(tgt.select("maz", "taz", "region"), "maz")


def households_of(units: DataFrame, members: DataFrame) -> DataFrame:
    """(maz, household_id, finalweight): the units of each signature shared out over its
    households in proportion to their seed weights (SY5).

    A signature with one household passes its units on. Else its units are given to the households as
    whole numbers (``integerize``); both sides are numbered densely within the signature, in
    mixed order, and joined on (signature, number): linear in the units."""
    single = (units.join(members.filter("n = 1").select("sig", "household_id"), "sig")
              .select("maz", "household_id", F.col("units").alias("finalweight")))
    need = units.groupBy("sig").agg(F.sum("units").alias("_need"))
    wanted = materialize(members.filter("n > 1").join(need, "sig"), "shared-members")  # read twice
    shared = integerize(wanted, "sig", "weight", target=F.col("_need"), out_col="_u").filter("_u > 0")
    each = lambda c: F.explode(F.sequence(F.lit(1).cast("long"), F.col(c).cast("long")))

    def numbered(df: DataFrame, *order: str) -> DataFrame:
        d = dense_position(df, ["sig", *order], "_pos")
        first = d.groupBy("sig").agg(F.min("_pos").alias("_first"))
        return d.join(first, "sig").withColumn("_slot", F.col("_pos") - F.col("_first"))

    given = numbered(shared.select("sig", "household_id", each("_u").alias("_k"))
                     .withColumn("_mix", F.xxhash64("household_id", "_k")), "_mix", "household_id", "_k")
    asked = numbered(units.join(shared.select("sig").distinct(), "sig", "left_semi").select("sig", "maz", each("units").alias("_k")), "maz", "_k")
    many = (asked.select("sig", "_slot", "maz").join(given.select("sig", "_slot", "household_id"), ["sig", "_slot"])
            .groupBy("maz", "household_id").agg(F.count(F.lit(1)).alias("finalweight")))
    return single.unionByName(many).withColumn("finalweight", F.col("finalweight").cast("int"))


def integerize(df: DataFrame, group: str, weight: str, target: Column | None = None,
               tie: Sequence[str] = ("household_id",), out_col: str = "finalweight") -> DataFrame:
    """Integer weights whose per-group total is exact (SY4): scale to the group target
    (default: the rounded weight total), take floors, and give the group's remaining
    units to the largest fractional parts (ties by ``tie``). A group whose weights are all
    zero shares its target equally.

    The per-group rank comes from a distributed dense position over
    (group, -fraction, tie) minus the group's first position, so a large group is not
    one window partition."""
    tot = df.groupBy(group).agg(F.sum(weight).alias("_tot"), F.count(F.lit(1)).alias("_rows"))
    d = df.join(tot, group, "inner")
    tgt = F.round(F.col("_tot").cast("double"), 0) if target is None else target
    d = d.withColumn("_T", tgt.cast("long"))
    scaled = F.when(F.col("_tot") > 0, F.col(weight).cast("double") * F.col("_T").cast("double")
                    / F.col("_tot").cast("double")).otherwise(F.col("_T") / F.col("_rows"))
    d = d.withColumn("_s", scaled).withColumn("_fl", F.floor("_s")) \
         .withColumn("_fr", F.col("_s") - F.col("_fl")).withColumn("_nfr", -F.col("_fr"))
    pos = dense_position(d, [group, "_nfr", *tie], "_pos")
    # floor total and first position per group in one aggregate, joined back once
    stats = pos.groupBy(group).agg(F.sum("_fl").alias("_sfl"), F.min("_pos").alias("_first"))
    r = pos.join(stats, group)
    extra = F.when(F.col("_pos") - F.col("_first") < F.col("_T") - F.col("_sfl"), 1).otherwise(0)
    return r.withColumn(out_col, (F.col("_fl") + extra).cast("int")) \
            .drop("_tot", "_rows", "_T", "_s", "_fl", "_fr", "_nfr", "_sfl", "_pos", "_first")


def synthesize(hh_final: DataFrame, persons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Synthetic households (weight > 0) with a dense ``temp_id`` in (maz, household) order,
    and their persons carrying the household's ``temp_id`` and final weight (SY5)."""
    kept = hh_final.filter(F.col("finalweight") > 0)
    hh = dense_position(kept, ["maz", "household_id"], "temp_id")
    # a household drawn by several zones has a row, an id and its persons in each
    p = persons.join(hh.select("household_id", "temp_id", "finalweight"), "household_id", "inner")
    return hh, p
