"""Windows of decontamination and licence scan: parts in another order, far apart, common headers, short items."""

import math
import random
from collections import Counter

from popweave.llm import decontaminate, license_scan
from tests.llm.test_text import brute_leaks, brute_licences, tokenised

RNG = random.Random(3)


def phrase(n):
    return ["".join(RNG.choice("bcdfglmnprst") + RNG.choice("aeiou") for _ in range(RNG.randrange(2, 4))) for _ in range(n)]


def passes(text, item, items, least=0.8):
    every = [tokenised(t) for _, t in items]
    df = Counter(s for x in every for s in set(x))
    weight = lambda s: math.log1p(len(items) / df.get(s, 1))
    a, own = Counter(tokenised(item)), tokenised(text)
    for size in {len(x) for x in every}:
        for start in range(len(own)):
            b = Counter(own[start:start + size])
            lo = sum(min(a[s], b[s]) * weight(s) for s in a)
            if lo >= (least - 1e-6) * sum(max(a[s], b[s]) * weight(s) for s in a.keys() | b.keys()):
                return True
    return False


def leaks(spark, docs, items):
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                     spark.createDataFrame(items, "item_id long, text string"))
    return {(r.id, r.item_id): r.similarity for r in got.collect()}


def test_swapped_and_interleaved_copies_are_found(spark):
    item = phrase(60)
    a, b = item[:30], item[30:]
    docs = [(1, " ".join(phrase(7) + b + a + phrase(9))), (2, " ".join(phrase(4) + a + ["odd"] + b)),
            (3, " ".join(b + a)), (4, " ".join(a + phrase(20) + b)), (5, " ".join(item[20:40] + item[:20] + item[40:])),
            (6, " ".join(phrase(80)))]
    items = [(1, " ".join(item)), (2, " ".join(phrase(40)))]
    want = brute_leaks(docs, items)
    got = leaks(spark, docs, items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    assert {(1, 1), (3, 1)} <= got.keys()
    named = [("Own", " ".join(item))]
    found = license_scan.scan(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(named, "license string, text string"))
    assert {(r.id, r.license) for r in found.collect()} == brute_licences(docs, named)


def test_recall_on_edited_copies_with_a_common_header(spark):
    header = phrase(60)
    items = [(i, " ".join((header if i % 2 else []) + phrase(60 + i))) for i in range(16)]
    docs = []
    for i, t in items:
        for copy in range(2):
            w = t.split()
            for _ in range(copy + 1):
                w[RNG.randrange(len(w))] = phrase(1)[0]
            docs.append((10 * i + copy, " ".join(phrase(RNG.randrange(15)) + w + phrase(RNG.randrange(15)))))
    want, got = brute_leaks(docs, items), leaks(spark, docs, items)
    # windows laid for one item are compared with all others, too: what they add must pass by some item's length
    for d, i in got.keys() - want.keys():
        assert passes(dict(docs)[d], dict(items)[i], items), (d, i)
    assert len(got.keys() & want.keys()) >= 0.9 * len(want) and len(want) > 12, (len(got), len(want))


def test_short_items_match_all_their_words(spark):
    docs = [(1, "before the tiny item after"), (2, "the tiny thing"), (3, "tiny item"), (4, None), (5, "")]
    items = [(1, "The tiny item!"), (2, "tiny item"), (3, ""), (4, None)]
    assert leaks(spark, docs, items).keys() == {(1, 1), (1, 2), (3, 2)}
