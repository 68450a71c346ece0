
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from popweave.config import RunConfig, ZoneRanges
from popweave.functions.zones import assign_group, in_ranges
from popweave.operators import controls as ctl
from popweave.operators import forecast as fc
from popweave.operators import outputs as out
from popweave.operators import validation as val
from popweave.operators.ids import dense_position, first_per_key
from popweave.operators.impute import ImputeSpec, resample_invalid
from popweave.operators.sampling import sample_households
from popweave.operators.zonegroups import balanced_groups
from popweave.plans import seeds as seedplan

CFG = RunConfig(internal=ZoneRanges(((1, 4),)), external=ZoneRanges(((5, 6),)), roaming_zone=6,
                pd_groups=((1, 2), (2, 3)))


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# --- fixtures ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def zones(spark):
    # 6 zones, 3 PDs; PD 2 sits on the shared end of both groups; PD 9 is outside all
    return spark.createDataFrame([(1, 1), (2, 2), (3, 2), (4, 3), (5, 9), (6, 1)], "zone int, pd int")


@pytest.fixture(scope="module")
def survey(spark):
    hh = spark.createDataFrame([
        (1, 1, 1, 2, 0, 1, Decimal("1.6")),
        (2, 1, 1, 1, 1, 2, Decimal("2.6")),
        (3, 2, 2, 3, 1, 7, Decimal("1.0")),
        (4, 3, 1, 4, 2, 3, Decimal("1.5")),
        (5, 4, 3, 1, 0, 4, Decimal("2.0")),
        (6, 99, 1, 1, 0, 1, Decimal("5.0")),   # unknown zone: dropped by the join
        (7, 5, 1, 2, 1, 5, Decimal("3.0")),    # external zone
        (8, 2, 1, 1, 0, 6, Decimal("1.0")),    # no persons (D15)
    ], "household_id long, household_zone int, dwelling_type int, number_of_persons int, "
       "vehicles int, income_class int, expansion_factor decimal(18,6)")
    p = spark.createDataFrame([
        (1, 1, 30, "M", "Y", "N", "F", "G", "N", "O", 2, 0, Decimal("1.6")),
        (1, 2, 28, "F", "Y", "N", "P", "9", "N", "S", 6, 0, Decimal("1.6")),
        (2, 1, 70, "F", "N", "N", "H", "P", "N", "O", 0, 0, Decimal("2.6")),
        (3, 1, 5, "M", "N", "N", "O", "S", "N", "S", 0, 3, Decimal("1.0")),
        (3, 2, 40, "F", "Y", "Y", "F", "M", "Y", "O", 5, 0, Decimal("1.0")),
        (3, 3, 12, "M", "N", "N", "O", "9", "N", "P", 0, 2, Decimal("1.0")),
        (4, 1, 50, "M", "Y", "N", "F", "O", "N", "O", 3, 0, Decimal("1.5")),
        (5, 1, 18, "F", "N", "Y", "J", "G", "N", "S", 1, 4, Decimal("2.0")),
        (6, 1, 33, "M", "Y", "N", "F", "P", "N", "O", 1, 0, Decimal("5.0")),
        (7, 1, 44, "F", "Y", "N", "F", "S", "N", "O", 1, 0, Decimal("3.0")),
        (7, 2, 45, "M", "Y", "N", "P", "G", "N", "O", 8, 0, Decimal("3.0")),
    ], "household_id long, person_number int, age int, sex string, license string, "
       "transit_pass string, employment_status string, occupation string, free_parking string, "
       "student_status string, employment_zone int, school_zone int, expansion_factor decimal(18,6)")
    return hh, p


@pytest.fixture(scope="module")
def prepared(spark, zones, survey):
    hh, p = survey
    return seedplan.prepare(zones, hh, p, CFG)


# --- D1-D17 ------------------------------------------------------------------------------

def test_D1_default_ranges_are_explicit_intervals(spark):
    cfg = RunConfig()
    df = spark.createDataFrame([(1,), (2,), (5999,), (6000,), (8886,), (8887,)], "z int")
    got = rows(df.select("z", in_ranges("z", cfg.internal).alias("i"),
                         in_ranges("z", cfg.external).alias("e")), "z", "i", "e")
    assert got == [(1, True, False), (2, True, False), (5999, True, False),
                   (6000, False, True), (8886, False, True), (8887, False, False)]


def test_D2_last_matching_group_wins(spark, zones):
    z = zones.select("zone", assign_group("pd", CFG.pd_groups, 0).alias("puma"))
    assert dict(rows(z, "zone", "puma")) == {1: 1, 2: 2, 3: 2, 4: 2, 5: 0, 6: 1}
    controls = spark.createDataFrame([(1, 7, 1, 1), (5, 7, 5, 5)], "region int, puma int, taz int, maz int")
    m = fc.map_control_puma(controls, "maz", zones, CFG)
    assert dict(rows(m, "maz", "puma")) == {1: 1, 5: 7}  # unmatched keeps its puma on controls


def test_D3_draws_come_from_own_puma(spark):
    df = spark.createDataFrame(
        [(i, 1, "A" if i % 2 else "B", Decimal(1)) for i in range(20)]
        + [(100 + i, 2, "C", Decimal(1)) for i in range(5)]
        + [(200 + i, 1, "9", Decimal(1)) for i in range(30)]
        + [(300 + i, 2, "9", Decimal(1)) for i in range(30)],
        "id long, puma int, occupation string, w decimal(18,6)")
    r = resample_invalid(df, [ImputeSpec("occupation", "9")], "w", ["id"])
    got = {(p, o) for p, o in rows(r.filter("id >= 200"), "puma", "occupation")}
    assert {o for p, o in got if p == 1} <= {"A", "B"} and {o for p, o in got if p == 1} == {"A", "B"}
    assert {o for p, o in got if p == 2} == {"C"}
    again = resample_invalid(df, [ImputeSpec("occupation", "9")], "w", ["id"])
    assert rows(r, "id", "occupation") == rows(again, "id", "occupation")  # repeatable


def test_D4_sample_keeps_whole_households_and_weights(spark, prepared):
    ph = prepared.persons_households
    s = sample_households(ph, 0.5, ("household_id", "person_number"))
    ids = {r[0] for r in s.select("household_id").distinct().collect()}
    for hid in ids:
        assert s.filter(F.col("household_id") == hid).count() == ph.filter(F.col("household_id") == hid).count()
    assert rows(s, "household_id", "person_number", "expansion_factor") == \
        rows(ph.join(s.select("household_id").distinct(), "household_id"), "household_id", "person_number",
             "expansion_factor")


def test_D5_meta_sums_untruncated_values(spark, prepared):
    raw = seedplan.raw_controls(prepared, CFG)
    maz = ctl.controls_maz(raw, CFG)
    meta = ctl.controls_meta(raw, CFG).first()
    assert meta["totalhh"] >= sum(r["totalhh"] for r in maz.collect())
    # 1.6 + 2.6 in zone 1 truncates to 4; 1.0 + 1.0 in zone 2 to 2 ...; meta adds the .6s
    assert dict(rows(maz, "maz", "totalhh"))[1] == 4
    assert meta["totalhh"] == 9  # 4.2 + 2.0 + 1.5 + 2.0 = 9.7 -> 9


def _fc_inputs(spark):
    maz = spark.createDataFrame([
        (1, 1, 1, 1, 10, 100, 40), (1, 1, 2, 2, 20, 200, 100), (1, 2, 3, 3, 0, 0, 0),
        (1, 2, 4, 4, 30, 300, 150)],
        "region int, puma int, taz int, maz int, totalhh int, totpop int, male int")
    zones = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3), (7, 3)], "zone int, pd int")
    vec = spark.createDataFrame([(1, 150.0), (2, 0.0), (3, 50.0), (4, 300.0), (7, 80.0)],
                                "zone int, population double")
    cfg = RunConfig(pd_groups=((1, 2), (3, 4)), person_control_columns=("totpop", "male"),
                    household_control_columns=("totalhh",))
    return maz, zones, vec, cfg


def test_D6_zero_base_zones_use_last_puma_ratio(spark):
    maz, zones, vec, cfg = _fc_inputs(spark)
    last = dict((r["maz"], (r["totpop"], r["male"])) for r in fc.forecast_maz(maz, vec, zones, cfg).collect())
    own = dict((r["maz"], (r["totpop"], r["male"]))
               for r in fc.forecast_maz(maz, vec, zones, cfg, fallback="own_group").collect())
    # t2 zone 3 (puma 2): last non-zero puma is 2 -> male ratio 150/300
    assert last[3] == (50, 25)
    # new zone 7 gets puma 3 (D9); last_group still uses puma 2's ratio, own_group has none
    # (totpop is still the new population; other controls keep their value)
    assert last[7] == (80, 40) and own[7] == (80, 0)
    assert own[3] == (50, 25)


def test_D7_totpop_is_written_before_other_columns(spark):
    maz, zones, vec, cfg = _fc_inputs(spark)
    cfg2 = RunConfig(pd_groups=cfg.pd_groups, person_control_columns=("male", "totpop"),
                     household_control_columns=("totalhh",))
    a = dict((r["maz"], r["male"]) for r in fc.forecast_maz(maz, vec, zones, cfg).collect())
    b = dict((r["maz"], r["male"]) for r in fc.forecast_maz(maz, vec, zones, cfg2).collect())
    assert a[3] == b[3] == 25


def test_D8_meta_gets_only_new_totals(spark):
    maz, zones, vec, cfg = _fc_inputs(spark)
    taz = maz.drop("maz")
    meta = spark.createDataFrame([(1, 60, 600, 290)], "region int, totalhh int, totpop int, male int")
    _, _, m = fc.apply_population_vector(maz, taz, meta, vec, zones, cfg)
    r = m.first()
    assert r["totpop"] == 150 + 50 + 300 + 80 and r["male"] == 290


def test_D9_new_zones_get_region_1_puma_3(spark):
    maz, zones, vec, cfg = _fc_inputs(spark)
    r = {x["maz"]: (x["region"], x["puma"]) for x in fc.forecast_maz(maz, vec, zones, cfg).collect()}
    assert r[7] == (1, 3)
    assert r[2][0] == 1  # t3 zone keeps its row, measures zeroed
    z2 = [x for x in fc.forecast_maz(maz, vec, zones, cfg).collect() if x["maz"] == 2][0]
    assert (z2["totpop"], z2["male"], z2["totalhh"]) == (0, 0, 0)


def test_D10_difference_is_signed(spark):
    o = spark.createDataFrame([("M", 1.0), ("F", 5.0)], "sex string, expansion_factor double")
    s = spark.createDataFrame([("M", 3.0), ("F", 2.0)], "sex string, expansion_factor double")
    labels = [("Male", F.col("sex") == "M"), ("Female", F.col("sex") == "F")]
    r = dict(rows(val.compare_totals(o, s, labels), "label", "abs_difference"))
    assert r == {"Male": -2.0, "Female": 3.0}


def test_D11_roaming_excluded_from_external_only_in_controls(spark):
    p = spark.createDataFrame([(6, 1.0), (5, 2.0)], "employment_zone int, w double")
    c = p.agg(*ctl.employment_zone_measures(CFG, "w")).first()
    assert c["employment_zone_external"] == 2.0 and c["employment_zone_roaming"] == 1.0
    labels = dict(val.person_labels(CFG))
    v = p.agg(F.sum(F.when(labels["EmploymentZone External"], F.col("w")))).first()[0]
    assert v == 3.0


def test_D12_missing_zonal_pair_gives_no_rows(spark):
    j = spark.createDataFrame([(1, "G", "F", 1, 2.0)],
                              "household_zone int, occupation string, employment_status string, "
                              "employment_zone int, persons double")
    r = out.zonal_residence(j, CFG)
    assert rows(r, "zone", "occupation", "employment_status", "persons") == [(1, "G", "F", 2.0)]


def test_D13_balanced_groups_cumulate_population(spark):
    zp = spark.createDataFrame([(i + 1, p) for i, p in enumerate([10, 10, 10, 30, 5, 40, 10])],
                               "zone int, population int")
    assert [g for _, g in rows(balanced_groups(zp, 3), "zone", "group")] == [1, 1, 1, 1, 2, 2, 3]


def test_D14_percent_is_a_scalar(spark):
    h = spark.createDataFrame([(1, 3)], "household_id long, expansion_factor int")
    assert out.scale_expansion(h, 0.25).first()["expansion_factor"] == 12.0


def test_D15_households_without_persons(spark, prepared):
    raw = seedplan.raw_controls(prepared, CFG)
    maz = dict(rows(ctl.controls_maz(raw, CFG), "maz", "totalhh"))
    assert maz[2] == 2  # household 8 (no persons) counts
    ids = {r[0] for r in seedplan.processed_households(prepared.persons_households).collect()}
    assert 8 not in ids and 6 not in ids and 7 not in ids  # no persons / unknown / external


def test_D16_weight_and_rounded_weightp(spark):
    p = spark.createDataFrame([(1, 1, 1, Decimal("1.1234567"))],
                              "household_id long, person_number int, puma int, expansion_factor decimal(18,7)")
    for c, v in [("age", 1), ("sex", "M"), ("license", "Y"), ("transit_pass", "N"),
                 ("employment_status", "F"), ("occupation", "G"), ("free_parking", "N"),
                 ("student_status", "O"), ("employment_zone", 0), ("school_zone", 0)]:
        p = p.withColumn(c, F.lit(v))
    r = seedplan.processed_persons(p, RunConfig()).first()
    assert r["weight"] == 1.1234567 and r["weightp"] == 1.12346
    assert r["occupation"] == 1 and r["employment_status"] == 2


def test_D17_dropping_absent_columns_is_ignored(spark, prepared):
    raw = seedplan.raw_controls(prepared, CFG)
    cfg = RunConfig(internal=CFG.internal, external=CFG.external, roaming_zone=CFG.roaming_zone,
                    pd_groups=CFG.pd_groups, drop_control_columns=("hhsize1", "license_Y", "nope"))
    meta = ctl.controls_meta(raw, cfg)
    assert "hhsize1" not in meta.columns and "totpop" in meta.columns


# --- invariants ----------------------------------------------------------------------------

def test_controls_equal_filtered_weights(spark, prepared):
    raw = seedplan.raw_controls(prepared, CFG)
    tot = raw.agg(F.sum("totalhh"), F.sum("totpop")).first()
    hh = prepared.households.agg(F.sum("expansion_factor")).first()[0]
    pp = prepared.persons_households.agg(F.sum("expansion_factor")).first()[0]
    assert tot[0] == hh and tot[1] == pp


def test_taz_equals_maz_per_zone(spark, prepared):
    raw = seedplan.raw_controls(prepared, CFG)
    m = ctl.controls_maz(raw, CFG).drop("maz")
    t = ctl.controls_taz(raw, CFG)
    assert sorted(map(tuple, m.collect())) == sorted(map(tuple, t.select(*m.columns).collect()))


def test_dense_position_over_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k")).repartition(13)
    r = dense_position(df, ["k"], "pos", num_partitions=7)
    got = rows(r, "k", "pos")
    assert got == [(k, k + 1) for k in range(5000)]


def test_first_per_key_breaks_ties_on_all_columns(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (1, 1, "a"), (2, 5, "x")], "k int, o int, v string")
    assert rows(first_per_key(df, ["k"], ["o"]), "k", "o", "v") == [(1, 1, "a"), (2, 5, "x")]


def test_inverse_recode_is_identity(spark):
    from popweave.functions.recode import recode, recode_inverse
    cfg = RunConfig()
    df = spark.createDataFrame([("G",), ("O",), ("M",)], "occupation string")
    maps = {"occupation": cfg.person_category_map["Occupation"]}
    assert rows(recode_inverse(recode(df, maps), maps), "occupation") == [("G",), ("M",), ("O",)]


def test_merge_is_idempotent(spark):
    a = spark.createDataFrame([(1, 2.0), (2, 3.0)], "household_id long, expansion_factor double")
    b = spark.createDataFrame([(2, 9.0, 1), (3, 4.0, 2)], "household_id long, expansion_factor double, vehicles int")
    cols = ("household_id", "expansion_factor", "vehicles")
    m = out.merge_populations(a, b, ["household_id"], cols)
    assert rows(m, *cols) == [(1, 2.0, 0), (2, 3.0, 0), (3, 4.0, 2)]
    assert rows(out.merge_populations(m, b, ["household_id"], cols), *cols) == rows(m, *cols)


def test_D3_literal_global_pool(spark):
    df = spark.createDataFrame(
        [(i, 1, "A", Decimal(1)) for i in range(5)] + [(100 + i, 2, "C", Decimal(1)) for i in range(5)]
        + [(200 + i, 2, "9", Decimal(1)) for i in range(10)],
        "id long, puma int, occupation string, w decimal(18,6)")
    r = resample_invalid(df, [ImputeSpec("occupation", "9")], "w", ["id"], pool="global:1")
    assert {o for (o,) in rows(r.filter("id >= 200"), "occupation")} == {"A"}


def test_D8_option_rescales_all_meta_measures(spark):
    maz, zones, vec, cfg = _fc_inputs(spark)
    meta = spark.createDataFrame([(1, 60, 600, 290)], "region int, totalhh int, totpop int, male int")
    _, _, m = fc.apply_population_vector(maz, maz.drop("maz"), meta, vec, zones, cfg, rescale_meta=True)
    fm = fc.forecast_maz(maz, vec, zones, cfg)
    assert m.first()["male"] >= sum(r["male"] for r in fm.collect()) - len(fm.collect())


def test_D9_new_zone_defaults_are_arguments(spark):
    maz, zones, vec, cfg = _fc_inputs(spark)
    measures = [c for c in maz.columns if c not in fc.KEYS]
    m = fc.outer_with_vector(maz, "maz", vec, measures, new_zone_region=2, new_zone_puma=9)
    assert {r["maz"]: (r["region"], r["puma"]) for r in m.collect()}[7] == (2, 9)


def test_hot_group_is_split_and_exact(spark):
    """One group holds 60 % of the rows: the ranked operators (range-partitioned positions,
    no window per group) still give exact per-group results (checked by brute force)."""
    import math

    from popweave.operators import synthesis as syn
    from popweave.operators.sampling import sampled_household_ids

    rows_ = [(i, 0 if i < 3000 else 1 + i % 7, 0.37 * (i % 11) + 0.05) for i in range(5000)]
    df = spark.createDataFrame(rows_, "household_id long, g int, w double").repartition(8)
    # exact integer totals per group, hot group included
    r = syn.integerize(df, "g", "w", target=F.lit(1000))
    per = {x["g"]: x["s"] for x in r.groupBy("g").agg(F.sum("finalweight").alias("s")).collect()}
    assert per == {g: 1000 for g in range(8)}
    # largest remainders first: in the hot group, every row with a larger fraction than an
    # unrounded-up row is rounded up (brute force over the hot group)
    hot = [(x["household_id"], x["finalweight"]) for x in r.filter("g = 0").collect()]
    tot = sum(w for i, g, w in rows_ if g == 0)
    frac = {i: (w * 1000 / tot) - math.floor(w * 1000 / tot) for i, g, w in rows_ if g == 0}
    up = {i for i, fw in hot if fw > math.floor([w for j, g, w in rows_ if j == i][0] * 1000 / tot)}
    assert not up or min(frac[i] for i in up) >= max((frac[i] for i in frac if i not in up), default=0) - 1e-12
    # exact per-group sample size on the hot group: round_half_even(frac * rows)
    p = df.select("household_id", "g", F.col("household_id").alias("person_number"))
    ids = sampled_household_ids(p.withColumnRenamed("g", "puma"), 0.25,
                                ["household_id", "person_number"], method="exact")
    got = ids.join(df, "household_id").groupBy("g").count().collect()
    want = {0: 750, **{g: round(0.25 * sum(1 for _, gg, _ in rows_ if gg == g)) for g in range(1, 8)}}
    assert {x["g"]: x["count"] for x in got} == want


def test_zone_sums_of_whole_halves_are_the_decimal_sums(spark):
    """F4-F8: no wide decimal a row and measure, the same exact totals and types."""
    from decimal import Decimal

    from popweave.operators.controls import zone_sums

    rows = [(1, "-3.000001", 1), (1, "999999999999.999999", 2), (1, None, 1), (2, "-999999999999.999999", 1),
            (2, "-0.500000", 1), (2, "0.000001", 2), (3, None, 1), (None, "7.25", 2)]
    df = spark.createDataFrame([(z, None if w is None else Decimal(w), c) for z, w, c in rows], "z int, w decimal(18,6), c int")
    measures = lambda w: [F.sum(w).alias("a"), F.sum(F.when(F.col("c") == 1, F.col(w))).alias("b")]
    got = zone_sums(df, "z", measures, "w")
    want = df.groupBy(F.col("z").alias("zone")).agg(*measures("w"))
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "sum(_high" in plan and "sum(w#" not in plan
    plain = df.withColumn("w", F.col("w").cast("double"))
    assert dict(zone_sums(plain, "z", measures, "w").dtypes)["a"] == "double"
