"""Substring dedup: short sentences, passages of one or two sentences, short texts."""

from collections import defaultdict

from popweave.llm import substring_dedup
from tests.llm.test_text import plain_sentences


def run(spark, texts):
    rows = list(enumerate(texts))
    got = substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    return [r.text for r in got.orderBy("doc_id").collect()]


def test_passages_of_short_sentences_go_whole(spark):
    shout = " ".join(f"{w}!" for w in "THE QUICK BROWN FOX JUMPS OVER A LAZY DOG AND THEN RUNS BACK HOME".split())
    got = run(spark, [f"First text here. {shout} It ends now.", f"Second one there. {shout} It closes then."])
    assert got == [f"First text here. {shout} It ends now.", "Second one there. It closes then."]


def test_a_short_sentence_at_the_passage_end_goes_too(spark):
    passage = "Ten words stand in this one and it is whole. Oh. Yes."
    got = run(spark, [f"One a. {passage} No end here.", f"Two b. {passage} Some other end."])
    assert got[1] == "Two b. Some other end."


def test_passages_of_one_or_two_sentences_go(spark):
    long = " ".join(f"word{i}" for i in range(25)) + "."
    pair = "A first sentence of seven words stands. Then a second one comes."
    got = run(spark, [f"One a. {long} One b. {pair} One c.", f"Two a. {long} Two b. {pair} Two c.", "Three. One a. Two b."])
    assert got[1:] == ["Two a. Two b. Two c.", "Three. One a. Two b."]


def test_whole_short_texts_match_whole_texts_only(spark):
    text = "One sentence of a bit more than ten words is this whole text."
    got = run(spark, [text, text, f"{text} More.", "Too short.", "Too short."])
    assert got == [text, "", f"{text} More.", "Too short.", "Too short."]


def brute(rows, span=2, least=10, lone=25):
    plain = lambda s: s.replace("\n", " ").replace("\t", " ").replace("\r", " ").strip(" ").lower()
    places = defaultdict(set)
    for d, t in set(rows):
        s = [plain(x) for x in plain_sentences(t or "")]
        n = [x.count(" ") + 1 for x in s]
        for i in range(len(s)):
            # every run up to the longest that is the shortest from its start or to its end
            for k in range(1, max(span, least) + 1):
                if i + k <= len(s) and (k >= span and sum(n[i:i + k]) >= least or k == 1 and n[i] >= lone):
                    places[tuple(s[i:i + k])].add((d, i))
        if 0 < len(s) < span and sum(n) >= least:
            places["whole", tuple(s)].add((d, 0))
    gone = defaultdict(set)
    for run_, p in places.items():
        for d, i in sorted(p)[1:]:
            gone[d] |= set(range(i, i + len(run_[1] if run_[0] == "whole" and isinstance(run_[1], tuple) else run_)))
    return {d: "".join(x for i, x in enumerate(plain_sentences(t or "")) if i not in gone[d]) for d, t in rows}


def test_equals_brute_force_over_all_runs(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r.text or "" for r in substring_dedup.query(spark, sf).collect()}
    want = brute(rows)
    assert {d: (got[d], want[d]) for d in want if got[d] != want[d]} == {}
    assert sum(want[d] != (t or "") for d, t in rows) > 3
