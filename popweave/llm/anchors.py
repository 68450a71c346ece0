"""Windows of documents that may hold a needle (a benchmark item, a licence text), natively.

Texts become words (runs of letters and digits, lower-cased) and every word position starts a
shingle of ``k`` words, as a 64-bit hash. A window that shares no shingle with any needle has
similarity and containment zero with all of them, so windows are laid only where a shingle of
some needle stands, needle-sized: from where the needle would begin if the shingle stood in its place,
and from the shared shingles from which a needle's length holds most shared ones (within half a needle
either way), so that needles whose parts stand in another order or far apart are covered too: moving a window up to
its first shared shingle loses none. The retrieval is thus an exact join on shingles, and bands
and blocks decide which of the windows are compared with which needle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popweave.session import materialize

#: Rows of the needles' shingle table (about 50 bytes each) up to which it is broadcast.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def shingles(w: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` words; texts of fewer words have none."""
    return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)),
                                              lambda i: F.xxhash64(F.slice(w, i, k))))


def hashed(df: DataFrame, text: str, k: int, *keep: str) -> DataFrame:
    """``keep`` columns, ``h`` (shingle hashes; null if there are none) and ``n`` (their number).

    Rows without shingles aren't filtered here, and callers explode with ``outer``: the
    optimiser would push such a filter below the projections and cut every text into words anew
    for each use.
    """
    w = df.select(*keep, words(F.col(text)).alias("w"))
    return w.select(*keep, shingles(F.col("w"), k).alias("h")).withColumn("n", F.size("h"))


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` for a join: broadcast behind a check of its row count, shuffled beyond it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def windows(docs: DataFrame, needles: DataFrame, k: int, least: float | None = None) -> DataFrame:
    """(win, id, th, start, n, h): needle-sized windows of ``docs`` (id, th, text) around shared
    shingles; ``start`` and ``n`` count shingles. ``needles`` has ``tk`` (a name), ``h`` and ``n``.

    With ``least``, windows are laid for a needle only in documents that hold that
    share of its distinct shingles: in the others no window could."""
    if least is not None:
        return laid(docs, holding(docs, needles, k, least), k)
    vocabulary = materialize(needles.select("tk", "n", F.lit(1).alias("need"), F.posexplode("h").alias("off", "g")).distinct(), "vocabulary")
    each = hashed(docs, "text", k, "id", "th").select("id", "th", F.posexplode_outer("h").alias("pos", "g"))
    met = materialize(each.join(sized(vocabulary, vocabulary.count()), "g")
                      .select("id", "th", "tk", "n", "need", "pos", "off").distinct(), "met")
    return laid(docs, begun(met), k)


def begun(met: DataFrame) -> DataFrame:
    """(id, th, start, n) of the windows for the shared shingles ``met`` (id, th, tk, n, need, pos, off)."""
    # a window that would begin before the text begins with it
    aligned = met.select("id", "th", F.greatest(F.col("pos") - F.col("off"), F.lit(0)).alias("start"), "n")
    # places in needle lengths; a document's places of one needle: bounded by its own words
    place = met.select("id", "th", "tk", "n", "need", "pos").distinct().withColumn("x", F.col("pos") / F.col("n"))
    over = "OVER (PARTITION BY id, th, tk ORDER BY x RANGE BETWEEN"
    held = place.withColumn("c", F.expr(f"count(*) {over} CURRENT ROW AND 0.9999999D FOLLOWING)"))
    most = held.withColumn("m", F.expr(f"max(c) {over} 0.5D PRECEDING AND 0.5D FOLLOWING)"))
    rich = most.filter("c = m AND c >= need").select("id", "th", F.col("pos").alias("start"), "n")
    return aligned.unionByName(rich).distinct()


def holding(docs: DataFrame, needles: DataFrame, k: int, least: float) -> DataFrame:
    """(id, th, start, n): the needle-sized windows of documents that hold ``least`` of a needle."""
    need = F.ceil(F.size(F.array_distinct("h")) * F.lit(least) - F.lit(1e-9)).alias("need")
    vocabulary = materialize(needles.select("tk", "n", need, F.posexplode("h").alias("off", "g")).distinct(), "vocabulary")
    each = hashed(docs, "text", k, "id", "th").select("id", "th", F.posexplode_outer("h").alias("pos", "g"))
    met = materialize(each.join(sized(vocabulary, vocabulary.count()), "g")
                      .select("id", "th", "tk", "n", "need", "g", "pos", "off").distinct(), "met")
    enough = (met.select("id", "th", "tk", "need", "g").distinct().groupBy("id", "th", "tk", "need").agg(F.count("*").alias("c"))
              .filter("c >= need").select(F.col("id").alias("eid"), F.col("th").alias("eth"), F.col("tk").alias("etk")))
    on = met.id.eqNullSafe(F.col("eid")) & (met.th == F.col("eth")) & (met.tk == F.col("etk"))
    return begun(met.join(enough, on, "left_semi"))


def laid(docs: DataFrame, spots: DataFrame, k: int) -> DataFrame:
    """The windows of ``docs`` at ``spots`` (id, th, start, n)."""
    # a document's windows: bounded by its words times the needle sizes
    spots = materialize(spots.groupBy("id", "th").agg(F.collect_list(F.struct("start", "n")).alias("at"))
                        .select(F.col("id").alias("sid"), F.col("th").alias("sth"), "at"), "spots")
    met = docs.join(spots, docs.id.eqNullSafe(F.col("sid")) & (docs.th == F.col("sth"))).dropDuplicates(["id", "th"])
    met = hashed(met, "text", k, "id", "th", "at")
    return (met.select("id", "th", "h", F.explode("at").alias("a"))
            .select("id", "th", F.col("a.start").alias("start"), F.slice("h", F.col("a.start") + 1, F.col("a.n")).alias("h"))
            .withColumn("n", F.size("h")).filter("n > 0").distinct()
            .withColumn("win", F.xxhash64("id", "th", "start", "n")))
