"""SimHash and embedding near-dedup, components and buckets against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from popweave.llm import embedding_dedup, simhash_dedup
from popweave.llm.components import components


def roots(ids, near):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in near:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def simple_fingerprint(text, width=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_equals_brute_force(spark, sf, texts):
    fp = {d: simple_fingerprint(t) for d, t in texts}
    ids = sorted(fp)
    near = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (fp[a] ^ fp[b]).bit_count() <= 4]
    want = roots(ids, near)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_dedup.query(spark, sf).collect()}
    assert got == {i: (f"{fp[i]:016x}", want[i]) for i in ids}
    assert simhash_dedup.fingerprint("Ünder THE ß x".encode(), 4) == simple_fingerprint("Ünder THE ß x")


@pytest.mark.parametrize("chunk", [8, 2048])
def test_simhash_links_random_fingerprints_in_any_chunks(spark, chunk):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 6)
    fps = {int(b): None for b in base}
    for b in base:  # a dense group around each base, so that buckets exceed the chunk
        for _ in range(40):
            fps[int(b) ^ sum(1 << int(k) for k in rng.choice(62, rng.integers(1, 6), replace=False))] = None
    rows = [(i, f) for i, f in enumerate(fps)]
    near = [(i, j) for i, f in rows for j, g in rows if i < j and (f ^ g).bit_count() <= 4]
    want = roots([i for i, _ in rows], near)
    reps = spark.createDataFrame(rows, "rep long, fp long")
    got = {r.node: r.component for r in components(simhash_dedup.links(reps, chunk=chunk)).collect()}
    assert {i: got.get(i, i) for i in want} == want


def test_simhash_odd_rows(spark, odd):
    got = simhash_dedup.classify(odd).collect()
    assert len(got) == odd.count()
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1}  # fingerprint zero
    assert {r.component_id for r in got if r.doc_id == 6} == {5}
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    kept = simhash_dedup.dedup(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect()) == [1, 4, 5, 5, 5, 7]
    assert simhash_dedup.classify(odd.limit(0)).count() == 0


def test_components_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(0, j) for j in range(1, 50)] + [(7, 7), (3, 1)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 0 for i in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors():
    rng = np.random.default_rng(5)
    rows, n = [], 0
    for label in (0, 1):
        for _ in range(12):
            c = rng.standard_normal(24)
            for _ in range(rng.integers(1, 30)):
                v = c + rng.standard_normal(24) * rng.choice([0.02, 0.1, 0.2])
                rows.append((n, v.tolist(), label))
                n += 1
    rows += [(n + i, rows[3][1], 0) for i in range(5)]  # equal vectors
    rows += [(n + 5, [2 * x for x in rows[3][1]], 0), (n + 6, [1e200 * x for x in rows[3][1]], 0), (n + 7, rows[3][1], None),
             (n + 8, None, 0), (n + 9, [0.0] * 24, 0), (n + 10, [float("nan")] + [1.0] * 23, 0), (n + 11, [None] + [1.0] * 23, 0),
             (n + 12, [float("inf")] + [1.0] * 23, 0), (n + 13, [], 0), (n + 14, [1.0, 2.0], 0), (n + 15, rows[3][1], 1)]
    return rows


@pytest.mark.parametrize("chunk", [16, 1024])
def test_embeddings_equal_brute_force(spark, chunk):
    rows = vectors()
    unit = {}
    for i, v, label in rows:
        if v and label is not None and None not in v and np.isfinite(v).all() and any(v):
            x = np.array(v) / np.max(np.abs(v))
            unit[i] = (label, x / np.linalg.norm(x))
    near = [(a, b) for a in unit for b in unit if a < b and unit[a][0] == unit[b][0]
            and len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= 0.98]
    component = roots([r[0] for r in rows], near)
    links = {i: sum(i in p for p in near) for i in component}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("cls", F.lit(1))
    got = {r.vec_id: tuple(r)[1:] for r in embedding_dedup.near_duplicates(df, chunk=chunk).collect()}
    assert got == {i: (links[i], component[i], component[i] == i) for i in component}
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_of_the_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    got = embedding_dedup.query(spark, sf)
    assert got.count() == len(rows)


def test_nothing_that_grows_with_the_corpus_is_broadcast(spark):
    """buckets, labels and stars are merged at any size; as broadcasts they ended the driver."""
    from popweave.llm.buckets import units
    from popweave.llm.components import _large, _small

    docs = spark.createDataFrame([(i, f"some words of group {i % 5} that come again and again") for i in range(40)], "doc_id long, text string")
    edges = spark.createDataFrame([(i, i // 2) for i in range(1, 40)], "u long, v long")
    members = spark.createDataFrame([(i % 6, i) for i in range(40)], "key long, rep long")
    for df in (simhash_dedup.classify(docs), _large(edges), _small(edges), units(members, "rep", 8)):
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert rows and "SortMergeJoin" in plan and "Broadcast" not in plan
