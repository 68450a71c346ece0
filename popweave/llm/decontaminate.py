"""Benchmark decontamination (operator 2), in DataFrame functions only.

Method: item-sized windows of the documents (``anchors``) and the benchmark items get a 64-bit
SimHash over weighted five-word shingles. Multi-index Hamming blocks: the fingerprint is cut
into ``blocks`` blocks; two fingerprints within ``radius`` bits agree in some block up to
floor(radius / blocks) bits, so items list their block values within that distance and
windows their own, and the join on block values finds every pair within ``radius``. Pairs
within it are then compared exactly: the weighted similarity of their shingles, multiplicities
counted, sum of minima over sum of maxima, must reach ``similarity``.

A shingle's weight is log(1 + items / items that hold it), in whole millionths, so sums are
exact; shingles of no item weigh as much as those of one. The SimHash adds square roots of weights:
the cosine of two such vectors is then at least 2 s / (1 + s) at similarity s, whatever the weights, so
at 0.8 fingerprints differ by at most 9.7 bits in expectation (deviation 2.9); ``radius`` 15 leaves room for
chance. Recall against brute force is tested on edited copies, items with a long common header included.

Defined cases: null, empty and blank texts hold nothing; an item of fewer than ``k`` words is one shingle
of all its words, as are windows for it; items with equal text are found alike; very long texts are
scanned whole; rows with the same id and text are one document; null ids take part; empty tables
give no rows; other columns of the inputs are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.llm.anchors import hashed, sized, windows, words
from popweave.llm.common import prepare, read
from popweave.session import materialize


def simhash(shingles: DataFrame, key: str) -> DataFrame:
    """(key, fp) of (key, g, c, weight): the sign of the weighted sum of each bit."""
    bit = lambda b: F.when(F.shiftrightunsigned("g", b).bitwiseAND(F.lit(1)) == 1, F.col("x")).otherwise(-F.col("x"))
    x = F.round(F.sqrt(F.col("c") * F.col("weight") * 1_000_000.0)).cast("long")  # whole, so that sums are exact
    sums = shingles.withColumn("x", x).groupBy(key).agg(*(F.sum(bit(b)).alias(f"b{b}") for b in range(64)))
    word = F.lit(0).cast("long")
    for b in range(64):
        one = 1 << b if b < 63 else -(1 << 63)
        word = word.bitwiseOR(F.when(F.col(f"b{b}") > 0, F.lit(one)).otherwise(F.lit(0)).cast("long"))
    return sums.select(key, word.alias("fp"))


def _edges(blocks: int) -> list[tuple[int, int]]:
    cut = [round(i * 64 / blocks) for i in range(blocks + 1)]
    return list(zip(cut, cut[1:]))


def block_values(blocks: int, within: int):
    """Column of (block, value) pairs of ``fp``: each block's bits and, up to ``within`` bits
    flipped, the values near them."""
    pairs = []
    for n, (a, b) in enumerate(_edges(blocks)):
        own = F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1))
        flips = [sum(1 << i for i in chosen) for r in range(within + 1) for chosen in combinations(range(b - a), r)]
        pairs += [F.struct(F.lit(n).alias("block"), own.bitwiseXOR(F.lit(f).cast("long")).alias("value")) for f in flips]
    return F.array(*pairs)


def contaminated(docs: DataFrame, items: DataFrame, similarity: float = 0.8, radius: int = 15, blocks: int = 8,
                 k: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """(id, th, item_id, similarity, start, n): each document and item it holds, with the best
    window (the first word and the number of shingles); ``th`` is the text's hash."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter("text IS NOT NULL").withColumn("th", F.xxhash64("text"))
    named = (items.select(F.col(item_col).alias("item"), F.col(item_text).cast("string").alias("text"))
             .withColumn("w", F.size(words(F.col("text")))).filter(words(F.col("text"))[0] != ""))
    # at most k - 1 lengths; each reads the texts once more, where such items are
    short = [r.w for r in named.filter(F.col("w") < k).select("w").distinct().orderBy("w").collect()]
    each = [_held(rows, named.filter(F.col("w") == m), similarity, radius, blocks, m) for m in short]
    return reduce(DataFrame.unionByName, each, _held(rows, named.filter(F.col("w") >= k), similarity, radius, blocks, k))


def _held(rows: DataFrame, named: DataFrame, similarity: float, radius: int, blocks: int, k: int) -> DataFrame:
    item = materialize(hashed(named, "text", k, "item").distinct().withColumn("ik", F.xxhash64("item", "h")), "items").filter("h IS NOT NULL")
    total = item.select(F.count("*").alias("t")).select("t").scalar()
    counted = lambda df, key: (df.select(key, F.explode("h").alias("g")).groupBy(key, "g")
                               .agg(F.count("*").alias("c")))
    in_items = counted(item, "ik")
    weight = lambda df: F.round(F.log1p(total / df) * 1_000_000).cast("long")
    weights = materialize(in_items.groupBy("g").agg(F.count("*").alias("df")).select("g", weight(F.col("df")).alias("weight")), "weights")
    n_weights = weights.count()

    def weighted(df: DataFrame) -> DataFrame:
        return (df.join(sized(weights, n_weights), "g", "left")
                .withColumn("weight", F.coalesce("weight", weight(F.lit(1)))))

    wins = materialize(windows(rows, item.withColumnRenamed("ik", "tk"), k), "windows")
    in_wins = materialize(weighted(counted(wins, "win")), "window_shingles")
    in_items = materialize(weighted(in_items), "item_shingles")
    w_fp, i_fp = (materialize(simhash(x, key), "fingerprints") for x, key in ((in_wins, "win"), (in_items, "ik")))
    # block values near an item's: a fixed number per item
    near = i_fp.select("ik", F.col("fp").alias("ifp"), F.explode(block_values(blocks, radius // blocks)).alias("v"))
    own = w_fp.select("win", "fp", F.explode(block_values(blocks, 0)).alias("v"))
    pairs = (own.join(near, "v").filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= radius)
             .select("win", "ik").distinct())
    mass = lambda df, key, name: df.groupBy(key).agg(F.sum(F.col("c") * F.col("weight")).alias(name))
    shared = (pairs.join(in_wins.withColumnRenamed("c", "cw"), "win")
              .join(in_items.select("ik", "g", F.col("c").alias("ci")), ["ik", "g"])
              .groupBy("win", "ik").agg(F.sum(F.least("cw", "ci") * F.col("weight")).alias("both")))
    sim = F.col("both") / (F.col("mw") + F.col("mi") - F.col("both"))
    hits = (shared.join(mass(in_wins, "win", "mw"), "win").join(mass(in_items, "ik", "mi"), "ik")
            .withColumn("similarity", sim).filter(F.col("similarity") >= similarity)
            .join(wins.select("win", "id", "th", "start", "n"), "win").join(item.select("ik", "item"), "ik"))
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start", "n")).alias("b")
    return (hits.groupBy("id", "th", "item").agg(best)
            .select("id", "th", F.col("item").alias("item_id"), (-F.col("b.s")).alias("similarity"),
                    F.col("b.start").alias("start"), F.col("b.n").alias("n")))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    gone = contaminated(docs, items).select(F.col("id").alias("_gone"), F.col("th").alias("_th")).distinct()
    # the documents that go are a share of the corpus, so this is a merge join at any size
    return docs.join(gone.hint("merge"), docs.doc_id.eqNullSafe(F.col("_gone")) & (F.xxhash64(docs.text) == F.col("_th")), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return (contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
            .select(F.col("id").alias("doc_id"), "item_id", F.round("similarity", 6).alias("similarity"),
                    F.col("start").alias("start_word"), F.col("n").alias("n_shingles")))
