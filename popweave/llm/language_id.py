"""Language identification by character models (operator 7).

Method: one interpolated Kneser-Ney character model per language over the letters of each
word (with marks for its start and end). The models of all languages share one sorted array of
n-gram hashes per order; beside it stand the log probability under each language and the
back-off weight of the n-gram as a context. A text's cross-entropy under a language is the sum
over all its words divided by the characters predicted; the lowest wins. A text whose
cross-entropy lies far above that of its language's calibration texts is rejected.

Fit: ``sample`` labelled texts per language, those with the smallest hash of their id, then of their text (a
bounded sample, a parameter: never more rows, however many share an id); one in five of them calibrates. N-grams are counted by Spark; the model
holds the distinct n-grams of the sample, so its size is bounded by the sample, not the
corpus. Prediction covers every text whole and reads nothing but the text.

Defined cases: null texts and texts without letters are ``und`` with score 0 and rejected; with
no labelled text at all, so is every text; ties go to the language that sorts first; very
long texts are cut between words, never short; repeated rows and null ids are predicted like
any other; other columns of the input are ignored.
"""

from __future__ import annotations

import uuid
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from popweave.llm.anchors import sized
from popweave.llm.common import prepare, read, slices
from popweave.session import materialize

if TYPE_CHECKING:  # not needed in Python workers, where it would cost memory
    import pandas as pd

ORDER = 4
START, END = "\x02", "\x03"
#: A letter and the letters and marks that follow it; numbers (½, Ⅷ, ①) are no letters.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
CACHED_WORDS = 40_000  # scored words that a Python worker keeps
#: Odd multipliers of the n-gram hash, one per place counted from the n-gram's end.
PLACES = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1) ** 5 | 1) & (2**64 - 1) for k in range(ORDER)], np.uint64)


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, part, word, n) of (lang, part, text): words of letters, lower-cased."""
    schema = pa.schema([("lang", pa.string()), ("part", pa.int64()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            for piece in slices(batch, 2):
                rows = []
                for lang, part, text in zip(*(c.to_pylist() for c in piece.columns)):
                    words, n = np.unique(np.array(WORD.findall((text or "").lower()), dtype=object), return_counts=True)
                    rows += [{"lang": lang, "part": part, "word": w, "n": int(k)} for w, k in zip(words, n)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    counted = texts.select("lang", "part", "text").mapInArrow(run, "lang string, part long, word string, n long")
    return counted.groupBy("lang", "part", "word").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, k, gram, value): Kneser-Ney counts of the k-grams. The highest order, and grams
    that begin a word, count occurrences; the others count the distinct characters before them."""
    padded = words.select("lang", "n", F.concat(F.lit(START), "word", F.lit(END)).alias("w"))
    at = padded.select("lang", "n", "w", F.explode(F.sequence(F.lit(2), F.length("w"))).alias("i"))
    raw = at.select("lang", "n", F.expr(f"substring(w, greatest(1, i - {order} + 1), least(i, {order}))").alias("gram"))
    top = raw.groupBy("lang", "gram").agg(F.sum("n").alias("value"))
    out = top
    level = top.select("lang", "gram")
    for k in range(order, 1, -1):
        # distinct (k)-grams hand one count each to the (k-1)-gram they end with
        level = (level.filter(F.length("gram") == k).select("lang", F.expr("substring(gram, 2)").alias("gram"), F.lit(1).alias("c"))
                 .groupBy("lang", "gram").agg(F.sum("c").alias("value")))
        out = out.unionByName(level)
        level = (level.select("lang", "gram")
                 .unionByName(top.filter(F.length("gram") == k - 1).select("lang", "gram")).distinct())
    return out.groupBy("lang", "gram").agg(F.max("value").alias("value"))


class Model:
    """Sorted hash arrays of all languages' models."""

    def __init__(self, grams: pd.DataFrame, order: int = ORDER):
        self.order, self.uid = order, uuid.uuid4().hex
        self.langs = sorted(grams["lang"].unique())
        self.limits: dict[str, tuple[float, float, float]] = {}
        tables = [self._probabilities(g) for _, g in grams.groupby("lang", sort=True)]
        self.unknown = np.log([t["unknown"] for t in tables]).astype(np.float32)
        self.keys, self.logp, self.back = [], [], []
        for k in range(1, order + 1):
            every = sorted({g for t in tables for g in t["p"][k]} | {g for t in tables for g in t["bow"].get(k, ())})
            key = np.array([self._hash_one(g) for g in every], np.uint64)
            p = np.array([[self._p(t, g) for t in tables] for g in every], np.float64).reshape(len(every), len(tables))
            bow = np.array([[t["bow"].get(k, {}).get(g, 1.0) for t in tables] for g in every]).reshape(p.shape)
            by = np.argsort(key)
            self.keys.append(key[by])
            self.logp.append(np.log(p[by]).astype(np.float32))
            self.back.append(np.log(bow[by]).astype(np.float32))

    def _probabilities(self, grams: pd.DataFrame) -> dict:
        by = {k: {} for k in range(1, self.order + 1)}
        for g, v in zip(grams["gram"], grams["value"]):
            by[len(g)][g] = float(v)
        alphabet = len(by[1]) + 1  # one place for characters never met
        p = {k: {} for k in by}
        bow: dict[int, dict[str, float]] = {}
        for k in by:
            values = np.array(list(by[k].values()) or [1.0])
            n1, n2 = (values == 1).sum(), (values == 2).sum()
            d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            total: dict[str, float] = {}
            kinds: dict[str, int] = {}
            for g, v in by[k].items():
                total[g[:-1]] = total.get(g[:-1], 0.0) + v
                kinds[g[:-1]] = kinds.get(g[:-1], 0) + 1
            weight = {h: d * kinds[h] / total[h] for h in total}
            if k == 1:
                base = weight.get("", 1.0) / alphabet
                p[1] = {g: (v - d) / total[""] + base for g, v in by[1].items()}
                unknown = base
            else:
                bow[k - 1] = weight
                low = {"p": p, "bow": bow, "unknown": unknown}
                p[k] = {g: (v - d) / total[g[:-1]] + weight[g[:-1]] * self._p(low, g[1:]) for g, v in by[k].items()}
        return {"p": p, "bow": bow, "unknown": unknown}

    def _p(self, table: dict, gram: str) -> float:
        """Probability of the last character after the others, backing off where unseen."""
        scale = 1.0
        while gram:
            if (p := table["p"][len(gram)].get(gram)) is not None:
                return scale * p
            scale *= table["bow"].get(len(gram) - 1, {}).get(gram[:-1], 1.0)
            gram = gram[1:]
        return scale * table["unknown"]

    @staticmethod
    def _hash_one(gram: str) -> int:
        return sum((ord(c) + 1) * int(m) for c, m in zip(reversed(gram), PLACES)) & (2**64 - 1)

    def score(self, words: list[str]) -> np.ndarray:
        """Log probability of each word, end mark included, under each language."""
        text = "".join(f"{START}{w}{END}" for w in words)
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        n = len(code)
        begin = np.flatnonzero(code == ord(START) + 1)
        depth = np.arange(n) - np.repeat(begin, np.diff([*begin, n]))  # characters before, in the word
        out = np.zeros((n, len(self.langs)), np.float32)
        open_ = depth > 0
        h = np.zeros((self.order + 1, n), np.uint64)
        for k in range(1, self.order + 1):
            h[k] = h[k - 1]
            h[k, k - 1:] += code[:n - k + 1] * PLACES[k - 1]
        todo = open_.copy()
        for k in range(self.order, 0, -1):
            at = np.flatnonzero(todo & (depth >= k - 1))
            row, found = self._find(k, h[k, at])
            out[at[found]] += self.logp[k - 1][row[found]]
            todo[at[found]] = False
            if k > 1:  # the context, which ends one character earlier, gives the back-off weight
                at = at[~found]
                row, found = self._find(k - 1, h[k - 1, at - 1])
                out[at[found]] += self.back[k - 2][row[found]]
        out[todo] += self.unknown
        return np.add.reduceat(out, begin, axis=0) if n else out

    def _find(self, k: int, h: np.ndarray):
        keys = self.keys[k - 1]
        if not len(keys):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        row = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return row, keys[row] == h

    def entropies(self, texts: list[str | None], known: dict, table: list[np.ndarray]):
        """Cross-entropy of each text under each language (nats a character), the number of
        words and of characters predicted. ``known`` and ``table`` keep scored words."""
        found = [WORD.findall((t or "").lower()) for t in texts]
        n = np.array([len(w) for w in found])
        words = [w for ws in found for w in ws]
        sums = np.zeros((len(texts), len(self.langs)))
        chars = np.zeros(len(texts))
        if words:
            new = list({w for w in words if w not in known})
            if new:
                known.update(zip(new, range(len(table[0]), len(table[0]) + len(new))))
                table[0] = np.concatenate([table[0], np.column_stack([self.score(new), [len(w) + 1 for w in new]])])
            rows = table[0][np.fromiter(map(known.__getitem__, words), np.int64, len(words))]
            full = np.flatnonzero(n)
            per = np.add.reduceat(rows, np.concatenate([[0], np.cumsum(n[full])[:-1]]), axis=0)
            sums[full], chars[full] = per[:, :-1], per[:, -1]
            if len(known) > CACHED_WORDS:
                known.clear()
                table[0] = table[0][:0]
        return -sums / np.maximum(chars, 1)[:, None], n, chars

    def judge(self, texts: list[str | None], known: dict, table: list[np.ndarray]):
        """(lang, score, cross-entropy, rejected) of each text."""
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts), bool)
        h, n, chars = self.entropies(texts, known, table)
        best = h.argmin(axis=1)
        low = h[np.arange(len(h)), best]
        # length-normalised odds: as if every text had ``SHARP`` characters
        score = 1 / np.exp(np.clip((low[:, None] - h) * SHARP, -700, 0)).sum(axis=1)
        mid, spread, drift = (np.array([self.limits.get(x, (0, 0, np.inf))[i] for x in self.langs])[best] for i in range(3))
        far = low - mid > REJECT_Z * np.sqrt(spread**2 / np.maximum(chars, 1) + drift**2)
        empty = n == 0
        langs = [("und" if e else self.langs[b]) for b, e in zip(best, empty)]
        return langs, np.where(empty, 0.0, score), low, far | empty

    def calibrate(self, measured: list[tuple[str, float, float]]) -> None:
        """From (lang, cross-entropy, characters) of calibration texts, per language: the median
        cross-entropy, the spread of one character (texts of n characters vary by that over
        sqrt(n)) and the drift between texts. Both are median deviations, scaled to a normal
        one, so that junk among the labelled texts doesn't widen them."""
        for x in self.langs:
            own = np.array([(e, c) for lang, e, c in measured if lang == x and c > 0]).reshape(-1, 2)
            if len(own):
                e, c = own.T
                mid = float(np.median(e))
                off = np.abs(e - mid)
                self.limits[x] = (mid, max(NORMAL * float(np.median(off * np.sqrt(c))), 1.0),
                                  max(NORMAL * float(np.median(off)), 0.1))


NORMAL = 1.4826  # standard deviations of a normal variable in one median deviation
SHARP = 20.0
REJECT_Z = 8.0


_SCORED: dict[str, tuple] = {}


def scored(model: Model):
    """This Python worker's scored words under ``model``, kept between tasks."""
    if model.uid not in _SCORED:
        _SCORED.clear()
        _SCORED[model.uid] = ({}, [np.zeros((0, len(model.langs) + 1))])
    return _SCORED[model.uid]


def fit(docs: DataFrame, learn: Column, sample: int = 400, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model:
    """Train on ``sample`` texts per language among the rows where ``learn`` holds."""
    lang, key = F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.lit(5), F.col(id_col).cast("string")).alias("key")
    rows = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    th = F.xxhash64(F.col(text_col).cast("string")).alias("th")
    # the smallest hashes of each language, found on narrow columns (each task keeps its own
    # smallest before the shuffle); equal ids are told apart by their texts, equal rows counted
    by_hash = Window.partitionBy("lang").orderBy("key", "th")
    edge = materialize(rows.select(lang, key, th).withColumn("r", F.row_number().over(by_hash)).filter(F.col("r") <= sample)
                       .groupBy("lang", "key", "th").agg(F.count("*").cast("int").alias("copies")), "edges")
    # at most ``sample`` rows a language: broadcast behind a count, so that no text is dealt out by language
    text = rows.select(lang, key, th, F.col(text_col).cast("string").alias("text"))
    chosen = materialize(text.join(sized(edge, edge.count()), ["lang", "key", "th"]).dropDuplicates(["lang", "key", "th"])
                         .select("lang", "text", F.expr("explode(sequence(1, copies))").alias("copy"),
                                 (F.pmod("key", F.lit(5)) == 0).cast("long").alias("part")).drop("copy"), "sample")
    grams = gram_counts(word_counts(chosen.filter("part = 0"))).toPandas()  # bounded by the sample
    model = Model(grams)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        m = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                own = part.column(0).to_pylist()
                h, n, chars = m.entropies(part.column(1).to_pylist(), *scored(m))
                at = [m.langs.index(x) if x in m.langs else 0 for x in own]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(h[np.arange(len(at)), at]), pa.array(chars)],
                                                 names=["lang", "e", "c"])

    if model.langs:
        held = chosen.filter("part = 1").select("lang", "text").mapInArrow(measure, "lang string, e double, c double")
        model.calibrate([tuple(r) for r in held.collect()])  # at most ``sample`` rows a language
        model.uid = uuid.uuid4().hex
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, cross_entropy, rejected) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                lang, score, h, rejected = m.judge(part.column(1).to_pylist(), *scored(m))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(h), pa.array(rejected)],
                    names=["id", "lang_pred", "score", "cross_entropy", "rejected"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"id {narrow.schema['id'].dataType.simpleString()}, lang_pred string, "
                                  "score double, cross_entropy double, rejected boolean")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learned from: CRC-32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, ~held_out())
    return predict(docs, model).select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"),
                                       "lang_pred", "score", "cross_entropy", "rejected")


def keep(docs: DataFrame, sample: int = 400) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    model = fit(docs, ~held_out(), sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        m = shared.value
        for batch in batches:
            for part in slices(batch, at):
                rejected = m.judge(part.column(at).to_pylist(), *scored(m))[3]
                yield part.filter(pa.array(~rejected))

    return docs.mapInArrow(run, docs.schema)
