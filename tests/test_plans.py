"""Plans and steps that must not gather rows: the fact join, prefix scans, exact sampling."""

import random

import pytest
from pyspark.sql import functions as F

from popweave.operators import sampling, zonegroups
from popweave.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_fact_join_runs_once(spark):
    """Nothing that reads the prepared persons joins or shuffles them by household again."""
    s = catalog.prepared(spark, SF)
    text = plan(s.persons_households)
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text and "hashpartitioning(household_id" not in text
    controls = plan(catalog.raw_controls(spark, SF, s))
    assert "hashpartitioning(household_id" not in controls


def test_running_population_is_a_prefix_scan(spark):
    rows = [(z, random.Random(z).randrange(0, 50) if z % 7 else None) for z in range(1, 400, 3)]
    df = spark.createDataFrame(rows, "zone int, population long").repartition(5)
    got = zonegroups.running_population(df)
    assert "SinglePartition, ENSURE" not in plan(got).split("Window")[0]
    total, want = None, {}
    for z, p in rows:
        total = total if p is None else (total or 0) + p
        want[z] = total
    assert {r.zone: r.running for r in got.collect()} == want
    assert zonegroups.running_population(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 3, 10, 200])
def test_balanced_groups_follow_the_greedy_rule(spark, n):
    rng = random.Random(n)
    pops = [(z, rng.choice([0, 0, 5, 10, 30, 200])) for z in range(2, 160, 2)]
    limit, t, start, group, want = sum(p for _, p in pops) / n, 0, None, 1, {}
    for z, p in pops:
        t += p
        start = t if start is None else start
        want[z] = group
        if t - start > limit:
            group, start = group + 1, t
    got = zonegroups.balanced_groups(spark.createDataFrame(pops, "zone int, population long").repartition(4), n)
    assert {r.zone: r.group for r in got.collect()} == want
    assert zonegroups.balanced_groups(got.limit(0).withColumn("population", F.lit(1)), 3).count() == 0


def test_exact_sampling_takes_the_smallest_draws(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BUCKETS", 8)  # many rows in the border bucket
    rows = [(h, k, 1 + h % 3) for h in range(300) for k in range(1 + h % 4)]
    df = spark.createDataFrame(rows, "household_id long, person_number int, puma int")
    u = sampling.keyed_uniform("sample", "household_id", "person_number")
    drawn = [tuple(r) for r in df.select("puma", u.alias("u"), "household_id").collect()]
    for frac in (0.0, 0.1, 0.37, 0.999):
        want = set()
        for puma in (1, 2, 3):
            own = sorted(x[1:] for x in drawn if x[0] == puma)
            want |= {h for _, h in own[:round(len(own) * frac)]}
        got = sampling.sampled_household_ids(df, frac, ("household_id", "person_number"), method="exact")
        assert {r.household_id for r in got.collect()} == want
        assert "rangepartitioning" not in plan(got)
