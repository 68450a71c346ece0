"""Substring dedup over sliding sentence spans (operator 5).

Method: a text is cut into sentences and runs of consecutive sentences are hashed and joined by
hash over all documents. The first run (smallest id, then position) of each hash stays;
sentences covered by any other are removed. Runs are

* from every sentence on, the shortest run of at least ``span`` sentences and ``min_words`` words,
  and up to every sentence, the shortest such run that ends there: together they cover every
  repeated stretch of whole sentences that reaches both bounds, however short its sentences;
* every single sentence of ``lone_words`` words or more;
* a whole text of fewer than ``span`` sentences and at least ``min_words`` words (equal only to
  other whole texts).

A sentence ends after . ! or ? before white space, or at a line's end; the cuts lose nothing,
so the sentences of a text concatenate to it. Runs are compared lower-cased with line breaks and
tabs as blanks, by 128 hash bits. Shorter runs aren't evidence: short stock sentences meet by
chance.

Defined cases: null texts stay null and empty texts empty; very long texts are cut whole; rows
with the same id and text are one document (they get the same result); null ids take part; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.llm.common import prepare, read
from popweave.session import materialize

#: Between sentences: after an end mark and before white space, or after a line break that
#: follows other text.
CUT = r"(?<=[.!?])(?=\s)|(?<=[^.!?\s]\n)(?=\S)"


def sentences(text: Column) -> Column:
    return F.split(text, CUT)


def reach(n: Column, span: int, min_words: int) -> Column:
    """How many leading entries of ``n`` (words a sentence) make a run; 0 if all are too few.

    A sentence counts one word at least, so max(span, min_words) entries are enough.
    """
    start = F.struct(F.lit(0).alias("k"), F.lit(0).alias("w"))
    more = lambda a, x: F.when((a.k >= span) & (a.w >= min_words), a).otherwise(
        F.struct((a.k + 1).alias("k"), (a.w + x).alias("w")))
    return F.aggregate(n, start, more, lambda a: F.when((a.k >= span) & (a.w >= min_words), a.k).otherwise(0))


def runs(docs: DataFrame, span: int, min_words: int, lone_words: int) -> DataFrame:
    """(id, th, i, k, h1, h2): the runs of ``k`` sentences from sentence ``i`` (0-based)."""
    plain = F.transform("s", lambda s: F.lower(F.trim(F.translate(s, "\n\t\r", "   "))))
    words = F.transform("p", lambda s: F.length(s) - F.length(F.translate(s, " ", "")) + 1)
    cut = docs.select("id", "th", sentences(F.col("text")).alias("s")).select("id", "th", plain.alias("p"))
    # hashes and word counts once a sentence; a run then combines those of its sentences
    hashed = cut.select("id", "th", F.transform("p", lambda s: F.xxhash64(s)).alias("a"),
                        F.transform("p", lambda s: F.xxhash64(F.lit(1), s)).alias("b"), words.alias("n"))
    longest = max(span, min_words)
    run = lambda i, k, whole: F.struct(i.cast("int").alias("i"), k.cast("int").alias("k"), F.lit(whole).alias("whole"))

    def of(i: Column) -> Column:
        """The runs that start at sentence ``i``, end there, or are it. Where ``span`` sentences
        hold the words (the usual case), the run that starts at the first ends at the last."""
        fits = lambda step: sum((F.get("n", i + step * j) for j in range(1, span)), F.get("n", i)) >= min_words
        onward = F.when(fits(1), span).otherwise(reach(F.slice("n", i + 1, longest), span, min_words))
        low = F.greatest(i - (longest - 1), F.lit(0))
        back = F.when(fits(-1), 0).otherwise(reach(F.reverse(F.slice("n", low + 1, i - low + 1)), span, min_words))
        lone = F.when(F.get("n", i) >= lone_words, 1).otherwise(0)
        return F.array(run(i, onward, 0), run(i - back + 1, back, 0), run(i, lone, 0))

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.size("n") - 1), of))
    total = F.aggregate("n", F.lit(0), lambda x, y: x + y)
    text = F.array(run(F.lit(0), F.when((F.size("n") < span) & (total >= min_words), F.size("n")).otherwise(0), 1))
    found = hashed.select("id", "th", "a", "b", F.filter(F.concat(every, text), lambda r: r.k > 0).alias("r"))
    spelled = F.transform("r", lambda r: F.struct(r.i.alias("i"), r.k.alias("k"), *(
        F.xxhash64(r.whole, F.slice(h, r.i + 1, r.k)).alias(f"{h}h") for h in "ab")))
    # outer: for an inner explode the optimiser would cut each text once more to filter on it
    each = found.select("id", "th", F.explode_outer(spelled).alias("r"))
    return each.filter("r IS NOT NULL").select("id", "th", "r.i", "r.k", F.col("r.ah").alias("h1"), F.col("r.bh").alias("h2"))


def dedup(docs: DataFrame, span: int = 2, min_words: int = 10, lone_words: int = 25, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per input row: id, text without repeated spans, ``n_removed`` (sentences)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    each = materialize(runs(rows, span, min_words, lone_words), "runs")
    at = F.struct("id", "th", "i")
    # one place a hash is carried, not two; rows of one document count twice and meet only themselves
    repeated = (each.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
                .filter("n > 1").drop("n"))
    later = each.join(repeated, ["h1", "h2"]).filter(at != F.col("first"))
    # a document's runs: bounded by its own sentences
    gone = later.groupBy(F.col("id").alias("gid"), F.col("th").alias("gth")).agg(F.collect_set(F.struct("i", "k")).alias("gone"))
    out = rows.join(gone.hint("merge"), rows.id.eqNullSafe(F.col("gid")) & (rows.th == F.col("gth")), "left")
    covered = F.flatten(F.transform(F.coalesce("gone", F.array().cast("array<struct<i:int,k:int>>")),
                                    lambda r: F.sequence(r.i, r.i + r.k - 1)))
    cut = out.select("id", "text", F.when(F.col("gone").isNotNull(), sentences(F.col("text"))).alias("s"),
                     F.array_distinct(covered).alias("c"))
    # set difference of positions, then the sentences that are left
    left = F.array_except(F.sequence(F.lit(0), F.size("s") - 1), F.col("c"))
    kept = F.array_join(F.transform(left, lambda i: F.element_at("s", i + 1)), "")
    return cut.select(F.col("id").alias(id_col), F.when(F.col("s").isNull(), F.col("text")).otherwise(kept).alias(text_col),
                      F.size("c").alias("n_removed"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dedup(read(spark, sf_dir, "documents"))
