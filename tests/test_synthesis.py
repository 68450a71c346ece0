"""Balancing over puma pools, controlled rounding, exact integers, emission."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from popweave.config import RunConfig
from popweave.operators import pool
from popweave.operators import synthesis as syn

TOTAL = syn.Constraint("totalhh", "maz", "household", 1000, lambda: F.col("weight") > -100)


def _people(spark, n=240):
    hh = spark.createDataFrame(
        [(h, 1 + h % 6, 1 + h % 2, 1.0 + h % 4, 1 + (h // 3) % 2, 1 + h % 5) for h in range(n)],
        "household_id long, home int, puma int, weight double, income_class int, size int")
    persons = spark.createDataFrame(
        [(h, k, 20 + (7 * h + 13 * k) % 50) for h in range(n) for k in range(1 + h % 5)],
        "household_id long, person_number int, age int")
    cons = [TOTAL, syn.Constraint("young", "maz", "person", 1000, lambda: F.col("age") < 40),
            syn.Constraint("inc1", "taz", "household", 900, lambda: F.col("income_class") == 1),
            syn.Constraint("old", "meta", "person", 700, lambda: F.col("age") >= 60),
            syn.Constraint("totpop", "meta", "person", 100000, lambda: F.col("age") >= 0)]
    return syn.incidence(hh, persons, cons), cons


def _zones(spark):
    """Zones 1 to 6 in TAZs of two, pumas by turns."""
    return spark.createDataFrame([(z, (z + 1) // 2, 1, 1 + z % 2) for z in range(1, 7)], "maz int, taz int, region int, puma int")


def _truth(spark, inc, cons, lift=1.0):
    """Targets that some weights of each puma's households meet, times ``lift`` for TAZs."""
    zones = _zones(spark)
    t = inc.join(zones.withColumnRenamed("puma", "zp"), F.col("puma") == F.col("zp"))
    w = (F.col("household_id") % 3 + 1) * F.col("maz")
    sums = {lv: t.groupBy(k).agg(*[F.round(F.sum(w * F.col(f"inc_{c.control}")) * (lift if lv == "taz" else 1.0)).alias(c.control)
                                   for c in cons if c.level == lv])
            for lv, k in (("maz", "maz"), ("taz", "taz"), ("meta", "region"))}
    return zones, syn.targets(zones.select("maz", "taz", "region"), sums["maz"], sums["taz"], sums["meta"], cons)


def _report(df):
    return {(r.level, r.geo, r.control): (r.target, r.achieved) for r in df.collect()}


def _check_whole(spark, got, tgt, cons, inc, slack):
    """Whole weights: exact totals, and every control near what the balanced weights achieve."""
    balanced = _report(syn.residual_report(got.achieved, tgt, cons))
    whole = _report(syn.residual_report(syn.achieved_units(got.units, got.signatures, tgt, len(cons)), tgt, cons))
    assert balanced.keys() == whole.keys()
    for k, (target, a) in whole.items():
        if k[2] == "totalhh":
            assert a == target, k
        assert abs(a - balanced[k][1]) <= slack, (k, a, balanced[k])
    kept = syn.households_of(got.units, got.members)
    assert kept.groupBy("household_id", "maz").count().filter("count > 1").count() == 0
    pumas = _zones(spark).select("maz", F.col("puma").alias("zp"))
    assert kept.join(inc, "household_id").join(pumas, "maz").filter("puma <> zp").count() == 0
    homes = kept.join(inc, "household_id").filter("home <> maz").count()
    assert homes > 0  # zones use households of the whole puma
    got_hh = {r.maz: r.s for r in kept.groupBy("maz").agg(F.sum("finalweight").alias("s")).collect()}
    assert got_hh == {k[1]: int(t) for k, (t, _) in whole.items() if k[2] == "totalhh"}


@pytest.mark.parametrize("block", [16384, 12])
def test_feasible_targets_are_met_and_rounded_weights_keep_them(spark, block, monkeypatch):
    monkeypatch.setattr(pool, "BLOCK", block)
    inc, cons = _people(spark)
    zones, tgt = _truth(spark, inc, cons)
    got = pool.balance(inc, tgt, zones.select("maz", "puma"), cons, RunConfig(), parts=1)
    assert got.history[-1] <= 1e-6
    for k, (target, a) in _report(syn.residual_report(got.achieved, tgt, cons)).items():
        assert abs(a - target) <= 0.02 * max(target, 1), k
    assert all(r.settled for r in pool.optimality(spark, got.zones, got.sums, cons).collect())
    _check_whole(spark, got, tgt, cons, inc, 1.01 if block > 1000 else 3.01)


def test_contradictory_levels_settle_and_totals_stay_exact(spark):
    inc, cons = _people(spark)
    zones, tgt = _truth(spark, inc, cons, lift=1.4)
    got = pool.balance(inc, tgt, zones.select("maz", "puma"), cons, RunConfig())
    assert got.history[-1] <= 1e-6
    assert all(r.settled for r in pool.optimality(spark, got.zones, got.sums, cons).collect())
    _check_whole(spark, got, tgt, cons, inc, 1.51)


@pytest.mark.parametrize("i1,i2", [(3000.0, 1000.0), (1000.0, 1000.0), (500.0, 40000.0)])
def test_contradictory_totals_give_the_compromise_of_their_importances(spark, i1, i2):
    """Two targets for one sum: (I1 + I2) / (I1 / T1 + I2 / T2)."""
    hh = spark.createDataFrame([(h, 1, 1.0, 1 + h % 4) for h in range(40)], "household_id long, puma int, weight double, size int")
    persons = spark.createDataFrame([(h, k) for h in range(40) for k in range(1 + h % 4)], "household_id long, person_number int")
    cons = [TOTAL, syn.Constraint("near", "maz", "person", i1, lambda: F.lit(True)), syn.Constraint("far", "meta", "person", i2, lambda: F.lit(True))]
    tgt = spark.createDataFrame([(1, 1, 1, 100.0, 180.0, 240.0)], "maz int, taz int, region int, t_0 double, t_1 double, t_2 double")
    got = pool.balance(syn.incidence(hh, persons, cons), tgt, spark.createDataFrame([(1, 1)], "maz int, puma int"), cons, RunConfig(), parts=1)
    want = (i1 + i2) / (i1 / 180 + i2 / 240)
    assert abs(got.sums[0, 1] - want) < 0.002 * want and abs(got.sums[0, 0] - 100) < 1e-3
    m = {r.control: r for r in pool.multipliers(spark, got.zones, cons).collect()}
    assert abs(m["near"].relaxation - want / 180) < 0.003 and abs(m["far"].relaxation - want / 240) < 0.003


def test_empty_zones_pumas_without_households_and_zones_without_controls(spark):
    hh = spark.createDataFrame([(h, 1 + h % 2, 1.0 + h % 3) for h in range(30)], "household_id long, puma int, weight double")
    inc = hh.withColumn("inc_totalhh", F.lit(1))
    tgt = spark.createDataFrame([(1, 1, 1, 70.0), (2, 2, 1, 0.0), (3, 3, 1, 33.0), (4, 4, 1, None)], "maz int, taz int, region int, t_0 double")
    pumas = spark.createDataFrame([(1, 1), (2, 2), (3, 9), (4, 1), (5, 2)], "maz int, puma int")
    got = pool.balance(inc, tgt, pumas, [TOTAL], RunConfig(), parts=0)
    kept = syn.households_of(got.units, got.members).join(hh.select("household_id", "puma"), "household_id")
    by = {r.maz: (r.s, sorted(r.p)) for r in kept.groupBy("maz").agg(F.sum("finalweight").alias("s"), F.collect_set("puma").alias("p")).collect()}
    assert by == {1: (70, [1]), 3: (33, [1, 2])}
    assert _report(syn.residual_report(got.achieved, tgt, [TOTAL])) == {
        ("maz", 1, "totalhh"): (70.0, pytest.approx(70.0)), ("maz", 2, "totalhh"): (0.0, 0.0), ("maz", 3, "totalhh"): (33.0, pytest.approx(33.0))}
    none = pool.balance(inc, tgt.limit(0), pumas, [TOTAL], RunConfig(), parts=0)
    assert none.units.count() == 0 and none.achieved.count() == 0


def test_weights_stay_below_the_cap(spark):
    hh = spark.createDataFrame([(h, 1, 100.0 if h == 0 else 1.0, 1 if h else 0) for h in range(20)], "household_id long, puma int, weight double, own int")
    cons = [TOTAL, syn.Constraint("own", "maz", "household", 1000, lambda: F.col("own") == 0)]
    inc = hh.withColumn("inc_totalhh", F.lit(1)).withColumn("inc_own", 1 - F.col("own"))
    tgt = spark.createDataFrame([(1, 1, 1, 60.0, 55.0)], "maz int, taz int, region int, t_0 double, t_1 double")
    got = pool.balance(inc, tgt, spark.createDataFrame([(1, 1)], "maz int, puma int"), cons, RunConfig(max_expansion_factor=10.0), parts=1)
    assert abs(got.sums[0, 0] - 60) < 1e-3 and got.sums[0, 1] <= 10 + 1e-9  # one household of its kind


@pytest.mark.parametrize("seed", range(5))
def test_repair_against_all_whole_weights_of_small_zones(seed):
    rng = np.random.default_rng(seed)
    best_found = 0
    for _ in range(12):
        n, k, count = 5, 4, 7
        s = np.column_stack([np.ones(n), rng.integers(0, 4, (n, k - 1))]).astype(float)
        w = rng.dirichlet(np.ones(n)) * count
        target, price = np.round(w @ s), rng.uniform(0.5, 4, k)
        price[0] = 0.0
        most = np.full(n, 5.0)
        cost = lambda u: float((price * (u @ s - target) ** 2).sum())
        start = np.minimum(pool.rounded(w, count), 5)
        if start.sum() != count:
            continue
        got = pool.repair(start, s, target, price, w, most)
        assert got.sum() == count and (got >= 0).all() and (got <= most).all() and cost(got) <= cost(start)
        near = 1e-3 * price[price > 0].min()
        full = lambda u: cost(u) + near * ((u - w) ** 2).sum()
        for i, j in itertools.permutations(range(n), 2):   # no exchange is left that helps
            if got[i] > 0 and got[j] < most[j]:
                u = got.copy()
                u[i] -= 1
                u[j] += 1
                assert full(u) >= full(got) - 1e-6
        every = [np.array(u) for u in itertools.product(range(6), repeat=n) if sum(u) == count]
        best_found += cost(got) <= min(map(cost, every)) + 1e-9
    assert best_found >= 6


def test_rounding_along_the_running_sum_is_exact():
    rng = np.random.default_rng(1)
    for count in (0, 1, 7, 1000):
        w = rng.exponential(size=50)
        u = pool.rounded(w, count)
        assert u.sum() == count and np.abs(u - w / w.sum() * count).max() < 1
    assert pool.rounded(np.zeros(4), 6).sum() == 6


def test_integerize_hits_group_totals_exactly(spark):
    df = spark.createDataFrame([(i, i % 3, 0.37 * (i % 7) + 0.2) for i in range(60)],
                               "household_id long, maz int, w double")
    r = syn.integerize(df, "maz", "w", target=F.lit(17))
    per = dict((x["maz"], x["s"]) for x in r.groupBy("maz").agg(F.sum("finalweight").alias("s")).collect())
    assert per == {0: 17, 1: 17, 2: 17}
    assert r.filter("finalweight < 0").count() == 0


def test_synthesize_emits_kept_households_with_dense_ids(spark):
    hh = spark.createDataFrame([(1, 2, 0), (2, 2, 3), (3, 1, 1)], "household_id long, maz int, finalweight int")
    persons = spark.createDataFrame([(2, 1), (2, 2), (3, 1), (1, 1)], "household_id long, person_number int")
    h, p = syn.synthesize(hh, persons)
    assert sorted((r["temp_id"], r["household_id"]) for r in h.collect()) == [(1, 3), (2, 2)]
    assert p.count() == 3


def test_passes_read_packed_signatures(spark):
    """F3-F9: what every pass reads holds no arrays; its sums and Hessians are those of the plain weights."""
    rows = [(p, s, 1 + s % 3, 0.5 + s, [1, (7 * s + p) % 5, 300 if s % 4 == 0 else s % 3]) for p in (1, 2) for s in range(60)]
    table = spark.createDataFrame(rows, "pool int, sig long, n long, w0 double, inc array<int>").repartition(3)
    z = pool.Zones(np.array([1, 2, 3]), np.array([1, 1, 2]), np.ones(3, int), np.array([1, 2, 1]), np.array([10, 20, 30]), np.full((3, 3), 5.0),
                   np.ones(3), ("maz", "taz", "meta"), np.array([-1.0, -2.0, -3.0]), np.array([[0.1, -0.2, 0.0], [0.0, 0.1, 1e-3], [0.2, 0.0, -1e-3]]), 2.0)
    packed = pool.packed(table)
    assert dict(packed.dtypes)["inc"] == "binary"
    a, b = np.triu_indices(3)
    for got in (pool.look(table, z), pool.look(packed, z)):
        for i in range(3):
            own = [r for r in rows if r[0] == z.pool[i]]
            s, w0, n = np.array([r[4] for r in own], float), np.array([r[3] for r in own]), np.array([r[2] for r in own], float)
            x = np.log(w0) + z.log_share[i] + s @ z.multiplier[i]
            over = np.maximum(x - np.log(2.0 * n), 0)
            w, capped = np.exp(x - over), over > 0
            assert 0 < capped.sum() < len(own)
            free = np.where(capped, 0, w)
            want = [(w * (1 + over)).sum(), free.sum(), w[capped].sum(), *(w @ s), *(free @ (s[:, a] * s[:, b]))]
            assert got[i] == pytest.approx(want, rel=1e-9)


def test_draws_hash_a_key_once_and_keep_the_category_of_its_place(spark):
    """F3-F9: no lambda over the bounds; the category is the first whose bound exceeds the draw."""
    from popweave.functions.draws import keyed_uniform
    from popweave.operators.impute import ImputeSpec, category_shares, resample_invalid

    rows = [(i, 1 + i % 3, None if i % 11 == 0 else "x" if i % 2 else "abcd"[i // 6 % 4], None if i % 3 == 2 else 1.0 + i % 5) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, puma int, code string, w double").filter("puma < 3 OR code = 'x'")
    got = resample_invalid(df, [ImputeSpec("code", "x")], "w", ["id"])
    assert "lambda" not in got._jdf.queryExecution().analyzed().toString()
    bounds = {}
    for r in category_shares(df, [ImputeSpec("code", "x")], "w").orderBy("value").collect():
        bounds.setdefault(r.puma, []).append((r.upper, r.value))
    assert sorted(bounds) == [1, 2]  # the third has nothing to draw from
    u = {r.id: r.u for r in df.select("id", keyed_uniform("code", "id").alias("u")).collect()}
    new = {r.id: r.code for r in got.collect()}
    for i, p, code, _ in rows:
        if i in new:
            want = next(v for upper, v in bounds[p] if upper > u[i]) if code == "x" and p in bounds else code
            assert new[i] == want, (i, p)


def test_stages_go_on_from_known_sums_and_blocks_are_single_rows(spark, monkeypatch):
    """F4-F8: a stage of new importances needs no pass of its own; the passes read a row a block."""
    inc, cons = _people(spark)
    zones, tgt = _truth(spark, inc, cons, lift=1.4)
    calls, settled = [], pool.settled

    def spied(signatures, z, *rest):
        got = settled(signatures, z, *rest)
        calls.append((z.multiplier, got[0].multiplier, signatures))
        return got

    monkeypatch.setattr(pool, "settled", spied)
    got = pool.balance(inc, tgt, zones.select("maz", "puma"), cons, RunConfig())
    assert got.history[-1] <= 1e-6
    for (_, found, _), (asked, _, _) in zip(calls, calls[1:]):
        assert not np.array_equal(found, asked)
    rows = calls[0][2]
    assert rows.count() == got.signatures.select("pool", "block").distinct().count() < got.signatures.count()


def test_households_of_their_own_signature_are_not_joined_again(spark):
    """F4-F8: their household comes with the signature; the others are found by its counts."""
    rows = [(h, 1 + h % 2, 1.0 + h, h % 4 if h < 8 else h) for h in range(20)]
    hh = spark.createDataFrame(rows, "household_id long, puma int, weight double, inc_a int")
    zones = spark.createDataFrame([(1, 1), (2, 2)], "maz int, puma int")
    table, members, _ = pool.dictionary(hh, ["inc_a"], zones)
    alone = members.filter("n = 1")
    assert "Join" not in alone._jdf.queryExecution().optimizedPlan().toString()
    sigs = {r.sig: (r.pool, r.inc[0], r.n, r.w0) for r in table.collect()}
    held = {}
    for r in members.collect():
        _, p, w, a = rows[r.household_id]
        assert sigs[r.sig][:3] == (p, a, r.n) and r.pool == p and r.weight == w
        held.setdefault(r.sig, []).append(r.weight)
    assert {s: (len(w), sum(w)) for s, w in held.items()} == {s: v[2:] for s, v in sigs.items()}
    assert {r.n for r in alone.collect()} == {1} and alone.count() == 12


@pytest.mark.parametrize("most", [0, 16])
def test_a_draw_is_hashed_once_a_row_with_few_and_many_bounds(spark, monkeypatch, most):
    """F5-F7: the plan reads one hash a column; bounds compared one by one and sorted ones give the same draws."""
    from popweave.functions.draws import keyed_uniform
    from popweave.operators import impute

    monkeypatch.setattr(impute, "UNROLLED", most)
    rows = [(i, 1 + i % 3, (9, None, 4, 2, 9, 7)[i % 6], "?xyz"[i // 3 % 4], 1.0 + i % 4) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, puma int, size int, code string, w double").filter("puma < 3 OR size = 9")
    specs = (impute.ImputeSpec("size", 9), impute.ImputeSpec("code", "?", salt="other"))
    got = impute.resample_invalid(df, specs, "w", ["id"])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("md5(") == len(specs)
    assert got.dtypes == df.dtypes
    shares = impute.category_shares(df, specs, "w").orderBy("num", "value").collect()
    u = {r.id: (r.a, r.b) for r in df.select("id", keyed_uniform("size", "id").alias("a"), keyed_uniform("other", "id").alias("b")).collect()}
    drawn = lambda p, c, x: next((r.value for r in shares if (r.puma, r.column) == (p, c) and r.upper > x), None)
    for r in got.collect():
        _, p, size, code, _ = rows[r.id]
        size = int(drawn(p, "size", u[r.id][0]) or 9) if size == 9 else size
        assert (r["size"], r.code) == (size, drawn(p, "code", u[r.id][1]) if code == "?" else code)


def test_columns_that_nobody_reads_are_not_written(spark):
    """F5-F7: the joined table leaves them out, and the coded persons have the others."""
    from popweave.plans import seeds
    from popweave.sources import survey_views as sv

    views = (spark.createDataFrame([(1, 1), (2, 3), (21, 4)], "zone int, pd int"),
             spark.createDataFrame([(h, (1, 2, 21)[h % 3], 1, 2, 0, 1 + h % 7, 1.5 + h) for h in range(30)],
                                   "household_id long, household_zone int, dwelling_type int, number_of_persons int, vehicles int, income_class int, w double")
             .withColumn("expansion_factor", F.col("w").cast(sv.WEIGHT_TYPE)).drop("w"),
             spark.createDataFrame([(h, k, 20 + h, "FM"[k % 2], "YN"[h % 2], "Y", "FPO9"[h % 4], "PGS9"[k % 4], "YN"[k % 2], "SPO9"[h % 4], h % 27, h % 5, 1.0)
                                    for h in range(30) for k in range(4)],
                                   "household_id long, person_number int, age int, sex string, license string, transit_pass string, employment_status string, "
                                   "occupation string, free_parking string, student_status string, employment_zone int, school_zone int, w double")
             .withColumn("expansion_factor", F.col("w").cast(sv.WEIGHT_TYPE)).drop("w"))
    whole = seeds.prepare(*views, sv.TEST_CONFIG)
    part = seeds.prepare(*views, sv.TEST_CONFIG, unread=("free_parking", "pd"))
    left = [c for c in whole.persons_households.columns if c not in ("free_parking", "pd")]
    assert part.persons_households.columns == left
    assert sorted(part.persons_households.collect()) == sorted(whole.persons_households.select(left).collect())
    full = seeds.processed_persons(whole.persons_households, sv.TEST_CONFIG)
    assert seeds.processed_persons(part.persons_households, sv.TEST_CONFIG).columns == [c for c in full.columns if c != "free_parking"]
