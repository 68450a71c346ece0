"""Line dedup: short lines, scripts without blanks, several templates in a leaf."""

import re

from popweave.llm import line_dedup


def run(spark, texts):
    rows = list(enumerate(texts))
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    return [r.text for r in got.orderBy("doc_id").collect()]


def test_short_lines_that_recur_are_dropped(spark):
    own = "one two three four five six seven eight".split()
    got = run(spark, [f"Les.\nAnd ornd.\n\n 　\n{w} alone\nPage {i}" for i, w in enumerate(own)])
    assert got[0] == "Les.\nAnd ornd.\n\n 　\none alone\nPage 0"
    assert got[1:] == [f"\n 　\n{w} alone" for w in own[1:]]


def test_short_lines_of_the_test_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    short = {}
    for d, t in rows:
        for line in {x.strip(" ") for x in (t or "").split("\n")}:
            if line.strip() and len(line.split()) < 3 and not re.search(r"\d", line):
                short.setdefault(line, set()).add(t)
    recurring = {x for x, texts in short.items() if len(texts) >= 5}
    assert recurring
    got = [r.text for r in line_dedup.query(spark, sf).collect()]
    for x in recurring:
        assert sum(line.strip(" ") == x for t in got for line in (t or "").split("\n")) == 1


def test_lines_without_blanks_merge_only_where_equal_but_for_digits(spark):
    kana = "あいうえおかきく"
    got = run(spark, [f"この長い行は毎ページに立つ。{i}ページ\n{c * 9}は{i}番目の別の文です" for i, c in enumerate(kana)])
    assert got[0].count("\n") == 1
    assert got[1:] == [f"{c * 9}は{i}番目の別の文です" for i, c in enumerate(kana)][1:]


def test_a_hot_source_does_not_switch_a_template_off(spark):
    authors = [f"{a}{b}" for a in "kelmor" for b in ("an", "ben", "cor", "dil", "eth", "fin", "gan", "hol", "ias", "jun")]
    word = lambda i: "".join("abcdefghij"[int(c)] * 3 for c in str(i))
    texts = [f"Own text {word(4 * i + j)} of {a} goes here alone\nRead more posts by {a}" for i, a in enumerate(authors) for j in range(4)]
    hot = [f"Another {word(j)} one stands here of its own\nRead more posts by Hotname" for j in range(300)]
    for more in ([], hot):
        got = run(spark, texts + more)[:len(texts)]
        assert sum("Read more posts by" in t for t in got) == 1 and "Read more posts by" in got[0]
        assert all("goes here alone" in t for t in got)


def test_a_second_template_of_a_leaf_is_found(spark):
    first = [f"You are now at the end of this page about x{c}x so turn back" for c in "abcdefghij"]
    second = [f"You are now at a place where nobody reads the y{c}y long list today" for c in "klmnop"]
    assert {len(t.split()) for t in first + second} == {14}
    got = run(spark, first + second)
    assert [bool(t) for t in got] == [True] + [False] * 9 + [True] + [False] * 5
