"""Fill-in-middle against a plain slicing version, and awkward texts."""

import hashlib

import pytest
from pyspark.sql import functions as F

from popweave.llm import fill_in_middle as fim


def simple(key, text, seed=1, plain=10, spm=20):
    text = text or ""
    x = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(x[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in fim.SENTINELS) or h[2] % 100 >= 100 - plain:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def awkward():
    long = "".join(chr(0x1F600 + i % 60) if i % 3 else "ä\n" for i in range(400_000))
    texts = ["", None, " ", "\n\r \x85", "a", "😀", "é😀‍👩", "<P>", "x<M>y", "<", "<<S", "P><S", "$1\\2 \\E \\Q (?s) {3}+",
             "x" * fim.RUN, "y" * (fim.RUN * 2 + 1), "😀" * (fim.RUN + 7), long, "\x00 nul", "a < b > c"]
    return [(i, t) for i, t in enumerate(texts * 6)] + [(None, "no id here"), (3, "twice"), (3, "twice")]


def test_query_equals_slicing(spark, sf, texts):
    got = {r.doc_id: r for r in fim.query(spark, sf).collect()}
    assert len(got) == len(texts)
    for d, t in texts:
        n, form, a, m, out = simple(d, t)
        r = got[d]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, a, m)
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert {r.form for r in got.values()} == {"plain", "psm", "spm"}


def test_awkward_texts(spark):
    rows = awkward()
    df = (spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
          .withColumn("n", F.lit("clash")).withColumn("_extra", F.lit(1)))
    got = fim.restore(fim.transform(df)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or "")
    rows, got = sorted(rows, key=key), sorted(got, key=lambda r: key((r.doc_id, r.text)))
    assert [(r.doc_id, r.text) for r in got] == rows and {r._extra for r in got} == {1}
    for (d, t), r in zip(rows, got):
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == simple(d, t), (d, (t or "")[:20])
        assert r.restored == (t or "")
    assert fim.transform(df.limit(0)).count() == 0


def test_shares_seed_and_other_sentinels(spark):
    rows = [(i, f"text number {i} of some words") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    own = ("$pre{", "|suf", "\\E[")
    got = fim.restore(fim.transform(df, seed=7, plain_percent=25, spm_percent=50, sentinels=own), sentinels=own).collect()
    assert all(r.restored == r.text for r in got)
    assert [r.form for r in sorted(got)] == [simple(i, t, 7, 25, 50)[1] for i, t in rows]
    assert 0.2 < sum(r.form == "plain" for r in got) / 3000 < 0.3
    for bad in (("<P>", "<P>", "<M>"), ("<P>", "", "<M>"), ("ab", "ba", "c"), ("<", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fim.transform(df, sentinels=bad)
