"""SentencePiece, language ID, substring and line dedup, decontamination, licences."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from popweave.llm import decontaminate, language_id, license_scan, line_dedup, sentencepiece_codec, substring_dedup

HARD = ["", " ", "  ", "▁", "▁ ▁a", "<s>", "\n", " \n x", "<0x0A>", "a" * 3000, "日" * 200, "á", "x\x00y", "�", "12 345.67", "😀 ok"]


@pytest.fixture(scope="module")
def model():
    return sentencepiece_codec.public_model()


def test_sentencepiece_equals_the_library(spark, texts, model):
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    rows = [(i, t) for i, t in enumerate(HARD + [t for _, t in texts])] + [(-1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    coded = sentencepiece_codec.encode(df, model).cache()
    back = {r.id: r.text for r in sentencepiece_codec.decode(coded, model).collect()}
    assert coded.count() == len(rows)
    for r in coded.collect():
        text = dict(rows)[r.id] or ""
        want = sp.encode(text)
        assert r.ids == want
        assert back[r.id] == sp.decode(want)
        at = [len(text[:k].encode()) for k in range(len(text) + 1)] if len(text) < 4000 else None
        if at:
            offsets = sp.encode_as_offset_mapping(text)["offsets"]
            assert [(at[a], at[b]) for a, b in offsets] == list(zip(r.begins, r.ends))


def test_decode_of_any_ids_equals_the_library(model):
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    codec, rng = sentencepiece_codec.codec(model), np.random.default_rng(2)
    for _ in range(500):
        ids = np.where(rng.random(8) < 0.5, rng.integers(0, 262, 8), rng.integers(0, 32000, 8)).astype(np.int32)
        assert codec.decode(ids) == sp.decode(ids.tolist())


def double_array(words):
    """A compiled character map of ``words`` (source to replacement), laid out naively."""
    trie = {}
    for w in words:
        node = trie
        for b in w.encode():
            node = node.setdefault(b, {})
        node[None] = w
    blob, at = b"", {}
    for w, to in words.items():
        at[w] = len(blob)
        blob += to.encode() + b"\0"
    units, base = {0: 0}, 1

    def place(node, pos):
        nonlocal base
        # an offset is xored into the position, so children sit at pos ^ offset ^ byte
        base += 1
        offset = pos ^ (base << 8)
        units[pos] = (units[pos] & 0x1FF) | offset << 10 | (256 if None in node else 0)
        child = pos ^ offset
        if None in node:
            units[child] = at[node[None]] | 1 << 31
        for b in node:
            if b is not None:
                units[child ^ b] = b
        for b, sub in node.items():
            if b is not None:
                place(sub, child ^ b)

    place(trie, 0)
    size = (max(units) | 255) + 1
    array = b"".join((units.get(i, 0)).to_bytes(4, "little") for i in range(size))
    return len(array).to_bytes(4, "little") + array + blob


def test_character_map_takes_the_longest_prefix_and_keeps_offsets():
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.NormalizerSpec(precompiled_charsmap=double_array({"ﬁ": "fi", "a": "b", "ab": "X", "　": " "}),
                                add_dummy_prefix=True, remove_extra_whitespaces=True, escape_whitespaces=True)
    norm = sentencepiece_codec.Normalizer(spec)
    text, align = norm("  ﬁab　 a ")
    assert text == "▁fiX▁b"
    # blanks at the ends are gone; the ligature's two letters both stand for its bytes 2 to 5
    assert align.tolist() == [2, 2, 2, 2, 2, 5, 7, 7, 7, 11, 12]
    assert norm("")[0] == "" and norm("  ")[0] == ""


def test_round_trip_odd_rows(spark, odd, model):
    got = sentencepiece_codec.round_trip(odd, model).collect()
    assert len(got) == odd.count()
    assert {r.n_tokens for r in got if r.id in (1, 2)} == {0}
    assert sentencepiece_codec.round_trip(odd.limit(0), model).count() == 0


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.query(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", "text"), "doc_id")
    right, n, low, high = got.filter("held_out AND lang IS NOT NULL").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert n > 150 and right >= 0.97 and 0 <= low <= high <= 1
    assert got.filter("rejected").count() <= 0.01 * got.count()


def test_language_odd_rows_and_model(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.fit(docs, ~language_id.held_out())
    got = {(r.id, r.lang_pred, r.rejected) for r in language_id.predict(odd, model).collect()}
    assert {(1, "und", True), (2, "und", True), (3, "und", True)} <= got
    assert all(lang in {*model.langs, "und"} for _, lang, _ in got)
    # a proper distribution: what follows a context sums to one over the alphabet and the unknown
    table = model._probabilities(language_id.gram_counts(spark.createDataFrame(
        [("x", "abab", 3), ("x", "ba", 1)], "lang string, word string, n long")).toPandas())
    letters = ["a", "b", language_id.END]
    for context in (language_id.START, language_id.START + "a", "ab", "aba", "zz"):
        known = sum(model._p(table, context + c) for c in letters)
        unknown = model._p(table, context + "?")
        assert known + unknown == pytest.approx(1, abs=1e-9)
    # the sorted arrays say the same as the table they were made from
    word = "then"
    path = [(language_id.START + word + language_id.END)[max(0, i - 3):i + 1] for i in range(1, len(word) + 2)]
    assert model.score([word]).shape == (1, len(model.langs)) and len(path) == len(word) + 1
    empty = language_id.fit(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in language_id.predict(odd, empty).collect()} == {"und"}
    junk = spark.createDataFrame([(1, "zq xw qqj vvk wxz kqj zzx " * 60, "en")], "doc_id long, text string, lang string")
    assert language_id.predict(junk, model).first().rejected


def plain_sentences(text):
    return re.split(substring_dedup.CUT, text)


def brute_spans(rows, span=2, least=10, lone=25):
    """Every run of sentences that is evidence, of any length up to where it must reach both bounds."""
    plain = lambda s: s.replace("\n", " ").replace("\t", " ").replace("\r", " ").strip(" ").lower()
    places = defaultdict(set)
    for d, t in set(rows):
        s = [plain(x) for x in plain_sentences(t or "")]
        n = [x.count(" ") + 1 for x in s]
        for i in range(len(s)):
            for j in range(i + 1, min(len(s), i + max(span, least)) + 1):
                if j - i >= span and sum(n[i:j]) >= least or j - i == 1 and n[i] >= lone:
                    places[tuple(s[i:j]), False].add((d, i))
        if len(s) < span and sum(n) >= least:
            places[tuple(s), True].add((d, 0))
    gone = defaultdict(set)
    for (run, _), p in places.items():
        for d, i in sorted(p)[1:]:
            gone[d] |= set(range(i, i + len(run)))
    return {d: "".join(x for i, x in enumerate(plain_sentences(t or "")) if i not in gone[d]) for d, t in rows}


def test_substring_dedup_equals_brute_force(spark, sf, texts):
    got = {r.doc_id: r.text for r in substring_dedup.query(spark, sf).collect()}
    want = brute_spans(texts)
    assert got == want
    assert sum(want[d] != t for d, t in texts) > 3


def test_substring_dedup_planted_and_odd(spark, odd):
    passage = " ".join(f"Planted sentence number {i} tells of thing {i * i}." for i in range(12))
    rows = [(1, "Start of one. " + passage + " End of one."), (2, "Quite another start.\n" + passage + "\nAnother end."), (3, "Clean text. It stays. As it is.")]
    got = {r.doc_id: r for r in substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text == rows[0][1] and got[3].text == rows[2][1]
    assert got[2].n_removed == 12 and got[2].text == "Quite another start.\nAnother end."
    out = {(r.doc_id, r.text) for r in substring_dedup.dedup(odd).collect()}
    assert (1, "") in out and (2, None) in out and substring_dedup.dedup(odd).count() == odd.count()
    assert substring_dedup.dedup(odd.limit(0)).count() == 0


def fields(line):
    """Tokens with digits become fields; in scripts without blanks only the digits do."""
    out = []
    for token in re.split(r"[ \t\n\x0b\f\r]+", line.strip(" ")):
        if re.search("[0-9]", token):
            letters = re.search("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]", token)
            token = re.sub("[0-9]+", "<*>", token) if letters else "<*>"
        out.append(token)
    return tuple(out)


def brute_lines(rows, depth=4, similarity=0.6, least=5):
    shapes, at = defaultdict(set), defaultdict(list)
    for d, t in rows:
        for pos, line in enumerate((t or "").split("\n")):
            if line.strip():
                shapes[fields(line)].add(t)
                at[fields(line)].append((d, pos))
    leaves = defaultdict(list)
    for k in shapes:
        leaves[len(k), k[:depth]].append(k)
    template = {k: k for k in shapes if len(shapes[k]) >= least}
    for leaf, ks in leaves.items():
        number = 0
        while (len(ks) > 1 or number) and sum(len(shapes[k]) for k in ks) >= least:
            total, fixed = sum(len(shapes[k]) for k in ks), {}
            for p in range(leaf[0]):
                c = Counter()
                for k in ks:
                    c[k[p]] += len(shapes[k])
                token, n = min(c.items(), key=lambda x: (-x[1], x[0].encode()))
                if token != "<*>" and 2 * n >= total:
                    fixed[p] = token
            members = [k for k in ks if sum(k[p] == x for p, x in fixed.items()) >= similarity * leaf[0]]
            if len(fixed) < similarity * leaf[0] or sum(len(shapes[k]) for k in members) < least:
                break
            template.update((k, (leaf, number)) for k in members)
            ks, number = [k for k in ks if k not in members], number + 1
    held = defaultdict(list)
    for k, name in template.items():
        held[name] += at[k]
    gone = defaultdict(set)
    for places in held.values():
        for d, pos in sorted(places)[1:]:
            gone[d].add(pos)
    return {d: "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone[d]) for d, t in rows}


def test_line_dedup_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r.text for r in line_dedup.query(spark, sf).collect()}
    want = brute_lines(rows)
    assert {d: (got[d], want[d]) for d in want if got[d] != want[d]} == {}
    assert any(want[d] != t for d, t in rows)


def test_line_dedup_templates_with_variable_fields(spark, odd):
    rows = [(i, f"{'abcdefghij'[i] * 4} opens this page alone\nPosted on the board by {'ann bob cyd dan eve fay gus hal ida joe'.split()[i]} at 1{i}:30 today\n"
                f"Own words {'klmnopqrst'[i] * 3} close text{i * 7}") for i in range(10)]
    rows += [(100, "This clean line stands alone\nand so does this one here")]
    got = {r.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].text == rows[0][1] and got[100].text == rows[10][1]
    assert all("Posted" not in got[i].text and got[i].n_dropped == 1 for i in range(1, 10))
    out = line_dedup.dedup(odd)
    assert out.count() == odd.count() and set(odd.columns) <= set(out.columns)
    assert line_dedup.dedup(odd.limit(0)).count() == 0


def tokenised(text):
    words = re.sub(r"[\W_]+", " ", text.lower()).strip().split(" ")
    return [tuple(words[i:i + 5]) for i in range(len(words) - 4)]


def brute_leaks(docs, items, least=0.8):
    items = [(i, tokenised(t)) for i, t in items if tokenised(t)]
    df = Counter(s for _, x in items for s in set(x))
    weight = lambda s: round(np.log1p(len(items) / df.get(s, 1)) * 1e6)
    found = {}
    for d, t in docs:
        own = tokenised(t or "")
        for i, x in items:
            if not set(own) & set(x):
                continue
            a = Counter(x)
            for start in range(max(1, len(own))):
                b = Counter(own[start:start + len(x)])
                lo = sum(min(a[s], b[s]) * weight(s) for s in a)
                hi = sum(max(a[s], b[s]) * weight(s) for s in a.keys() | b.keys())
                if lo / hi >= least:
                    found[d, i] = max(found.get((d, i), 0), lo / hi)
    return found


def test_decontamination_equals_brute_force(spark, texts, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.query(spark, sf).collect()}
    want = brute_leaks(texts, items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    assert got


def test_decontamination_planted_and_odd(spark, odd):
    item = "what is the name of the longest river that flows through three capitals before it meets the black sea and how long does it take a boat to travel down all of it in a dry summer or in a wet spring when the water stands high"
    words = item.split()
    edited = " ".join([*words[:-1], "low"])
    docs = spark.createDataFrame([
        (1, f"Some words first. {item.upper()}! And some after."), (2, f"{edited}"), (3, "the name of the longest river is not asked here at all"),
        (4, " ".join(words[:20])), (5, None), (6, "x " * 30000 + item)], "doc_id long, text string")
    items = spark.createDataFrame([(10, item), (11, "too short"), (12, None)], "item_id long, text string")
    got = {(r.id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(1, 10), (2, 10), (6, 10)}
    assert [r.doc_id for r in decontaminate.clean(docs, items).orderBy("doc_id").collect()] == [3, 4, 5]
    assert decontaminate.clean(odd, items).count() == odd.count()
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0


def brute_licences(docs, templates, least=0.8, k=5):
    """Every window of a template's length; of overlapping finds the one with most shingles."""
    known = []
    for name, t in templates:
        w = re.sub(r"[\W_]+", " ", t.lower()).strip().split(" ")
        m = min(k, len(w))
        known.append((name, m, [tuple(w[i:i + m]) for i in range(len(w) - m + 1)]))
    out = set()
    for d, t in docs:
        w = re.sub(r"[\W_]+", " ", (t or "").lower()).strip().split(" ")
        best = {}
        for name, m, x in known:
            own = [tuple(w[i:i + m]) for i in range(len(w) - m + 1)]
            need = set(x)
            if len(need & set(own)) < least * len(need):
                continue
            for s in range(len(own)):
                hits = len(need & set(own[s:s + len(x)]))
                if hits >= least * len(need):
                    end = min(s + len(x), len(own)) + m - 1
                    best[name, s] = max(best.get((name, s), (0, 0, 0)), (hits, hits / len(need), end))
        places = [(n, s, *v) for (n, s), v in best.items()]

        def beaten(a):
            for o in places:
                common = min(o[4], a[4]) - max(o[1], a[1])
                if o[0] != a[0] and common > 0 and 2 * common >= min(o[4] - o[1], a[4] - a[1]) and (-o[2], -o[3], o[0]) < (-a[2], -a[3], a[0]):
                    return True
            return False

        out |= {(d, p[0]) for p in places if not beaten(p)}
    return out


def test_licences_equal_brute_force(spark, texts):
    notices = spark.createDataFrame(list(license_scan.NOTICES), "license string, text string")
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {(r.id, r.license) for r in license_scan.scan(docs, notices).collect()}
    assert got == brute_licences(texts, license_scan.NOTICES)
    assert len(got) > 3


def test_licences_planted_and_odd(spark, sf, odd):
    notices = spark.createDataFrame(list(license_scan.NOTICES), "license string, text string")
    mit = license_scan.NOTICES[8][1].split()
    planted = spark.createDataFrame([(1, " ".join(["before"] * 9 + mit + ["after"] * 9)), (2, " ".join(mit[:15] + ["else"] * 30)),
                                     (3, " ".join(mit[:-2]))], "doc_id long, text string")
    assert {(r.id, r.license) for r in license_scan.scan(planted, notices).collect()} == {(1, "MIT"), (3, "MIT")}
    assert license_scan.scan(odd, notices).count() == 0
    assert license_scan.scan(odd, notices.limit(0)).count() == 0
    assert license_scan.query(spark, sf).columns == ["doc_id", "license", "containment", "start_word"]
