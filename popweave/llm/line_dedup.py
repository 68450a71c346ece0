"""Line dedup by log templates (operator 4), in DataFrame functions only.

Method: a parse tree of fixed depth. A line's tokens are its runs without white space, tokens
that hold a digit being variable fields (in scripts written without blanks, where a token can be
a whole sentence, only the digits are); its leaf is the token count and the first ``depth``
tokens, so lines of up to ``depth`` tokens merge only where they are equal but for the fields. In a leaf, a position whose most frequent token covers at least half of the leaf's
documents is constant and the others are variable; where at least ``similarity`` of the
positions are constant, the leaf has a template, and the lines that agree with it at ``similarity`` of
their positions are the template's (not at all constants: a hot source's own fields look constant).
Where such a template recurs, the step is taken again on what is left of the leaf, until no new one is
found. Any other line is a template of its own. A template that lines of
``min_docs`` or more different texts share is recurring: its lines are dropped.

One line of a recurring template stays, the first (smallest id, then position), so that no
content vanishes altogether; ``keep_first=False`` drops that one too. Exact copies of a document
count as one text: a page copied many times isn't boilerplate.

Defined cases: null texts stay null, empty texts empty; blank lines always stay (and lines of
fewer than ``min_tokens`` tokens, where that is set above 1); very long texts and lines are parsed whole; ties for a
position's token go to the one that sorts first; rows with the same id and text are one
document; null ids take part; an empty table gives no rows; ``dedup`` ignores other columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.llm.common import prepare, read
from popweave.session import materialize

FIELD = "<*>"
#: Letters of scripts written without blanks: Thai, Lao, Burmese, Khmer, Han and kana.
UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
#: A token that holds a digit and no such letter; else a run of digits.
VARIABLE = rf"(?<!\S)[^\s\d{UNSPACED}]*+\d[^\s{UNSPACED}]*+(?!\S)|\d++"


def tokens(line: Column) -> Column:
    # few lines hold a digit: only those go through the pattern
    return F.split(F.trim(F.when(line.rlike("[0-9]"), F.regexp_replace(line, VARIABLE, FIELD)).otherwise(line)), r"\s+")


def parsed(rows: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    """(id, th, pos, leaf, shape) of every line that can be dropped."""
    lines = rows.select("id", "th", F.posexplode_outer(F.split("text", "\n")).alias("pos", "line"))
    cut = lines.select("id", "th", "pos", F.col("line").rlike(r"(?U)\S").alias("filled"), tokens(F.col("line")).alias("t"))
    # null for blank and short lines, left out after the write: as a filter here, every line would be cut twice
    leaf = F.when(F.col("filled") & (F.size("t") >= min_tokens), F.xxhash64(F.size("t"), F.slice("t", 1, depth)))
    return cut.select("id", "th", "pos", leaf.alias("leaf"), F.xxhash64("t").alias("shape"))


def templates(rows: DataFrame, lines: DataFrame, depth: int, similarity: float, min_docs: int) -> DataFrame:
    """(leaf, shape, template) of the line shapes that belong to recurring templates."""
    shapes = materialize(lines.select("leaf", "shape", "th").distinct()
                         .groupBy("leaf", "shape").agg(F.count("*").alias("docs")), "shapes")
    # leaves that could hold a template of several shapes
    wide = (shapes.groupBy("leaf").agg(F.count("*").alias("k"), F.sum("docs").alias("leaf_docs"))
            .filter((F.col("k") > 1) & (F.col("leaf_docs") >= min_docs)).select("leaf", "leaf_docs"))
    many = materialize(shapes.join(wide, "leaf"), "many")
    # the tokens of one line of each such shape
    one = (lines.join(many.select("leaf", "shape"), ["leaf", "shape"], "left_semi")
           .groupBy("leaf", "shape").agg(F.min(F.struct("id", "th", "pos")).alias("at")))
    one = one.groupBy(F.col("at.id").alias("oid"), F.col("at.th").alias("oth")).agg(
        F.collect_list(F.struct("leaf", "shape", F.col("at.pos").alias("pos"))).alias("of"))
    # about every other document holds such a shape, at any size: a merge join from the start
    texts = rows.join(one.hint("merge"), rows.id.eqNullSafe(F.col("oid")) & (rows.th == F.col("oth")))
    spelled = (texts.select(F.split("text", "\n").alias("l"), F.explode("of").alias("o"))
               .select("o.leaf", "o.shape", tokens(F.element_at("l", F.col("o.pos") + 1)).alias("t"))
               .dropDuplicates(["leaf", "shape"]))
    each = materialize(many.join(spelled, ["leaf", "shape"])
                       .select("leaf", "shape", "docs", F.posexplode("t").alias("p", "token")), "tokens")
    several, free = [], each
    while True:
        members = materialize(grown(free, similarity, min_docs, len(several)), "members")
        if members.isEmpty():
            break
        several.append(members)
        # what is left of the leaves that gave a template may hold another
        free = materialize(free.join(members.select("leaf").distinct(), "leaf", "left_semi")
                           .join(members.select("leaf", "shape"), ["leaf", "shape"], "left_anti"), "free")
    several = reduce(DataFrame.unionByName, several, members)
    alone = (shapes.filter(F.col("docs") >= min_docs).select("leaf", "shape")
             .join(several, ["leaf", "shape"], "left_anti").select("leaf", "shape", F.col("shape").alias("template")))
    return several.unionByName(alone)


def grown(each: DataFrame, similarity: float, min_docs: int, number: int) -> DataFrame:
    """(leaf, shape, template): one template a leaf, where there is one, and the shapes it takes in."""
    size = each.filter("p = 0").groupBy("leaf").agg(F.sum("docs").alias("leaf_docs"))
    counts = each.groupBy("leaf", "p", "token").agg(F.sum("docs").alias("c"))
    top = counts.groupBy("leaf", "p").agg(F.min(F.struct((-F.col("c")).alias("c"), "token")).alias("m")).join(size, "leaf")
    constant = top.withColumn("constant", (F.col("m.token") != FIELD) & (F.col("m.c") * -2 >= F.col("leaf_docs")))
    model = (constant.groupBy("leaf").agg(F.count("*").alias("n"), F.sum(F.col("constant").cast("int")).alias("n_constant"))
             .filter(F.col("n_constant") >= F.col("n") * F.lit(similarity)).select("leaf", "n"))
    agree = (each.join(constant.filter("constant").select("leaf", "p", F.col("m.token").alias("token")), ["leaf", "p", "token"])
             .groupBy("leaf", "shape").agg(F.count("*").alias("agreed"), F.max("docs").alias("docs")))
    members = agree.join(model, "leaf").filter(F.col("agreed") >= F.col("n") * F.lit(similarity))
    enough = members.groupBy("leaf").agg(F.sum("docs").alias("all_docs")).filter(F.col("all_docs") >= min_docs)
    return members.join(enough, "leaf").select("leaf", "shape", F.xxhash64("leaf", F.lit(number)).alias("template"))


def dropped(rows: DataFrame, depth: int, similarity: float, min_docs: int, min_tokens: int, keep_first: bool) -> DataFrame:
    """(gid, gth, gone): the dropped line positions of each document that loses any."""
    lines = materialize(parsed(rows, depth, min_tokens), "lines").filter("leaf IS NOT NULL")
    recurring = materialize(templates(rows, lines, depth, similarity, min_docs), "templates")
    hit = lines.join(recurring, ["leaf", "shape"])
    if keep_first:
        hit = materialize(hit.select("id", "th", "pos", "template"), "hits")
        first = hit.groupBy("template").agg(F.min(F.struct("id", "th", "pos")).alias("first"))
        hit = hit.join(first, "template").filter(F.struct("id", "th", "pos") != F.col("first"))
    # a document's positions: bounded by its own lines
    return hit.groupBy(F.col("id").alias("gid"), F.col("th").alias("gth")).agg(F.collect_set("pos").alias("gone"))


def dedup(docs: DataFrame, depth: int = 4, similarity: float = 0.6, min_docs: int = 5, min_tokens: int = 1,
          keep_first: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines of recurring templates dropped from its texts, and the added
    columns ``n_lines`` and ``n_dropped``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    gone = dropped(rows, depth, similarity, min_docs, min_tokens, keep_first)
    text = docs[text_col].cast("string")
    out = docs.join(gone.hint("merge"), docs[id_col].eqNullSafe(F.col("gid")) & (F.xxhash64(text) == F.col("gth")), "left")
    split = F.split(text, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone"))
    kept = F.array_join(F.transform(left, lambda i: F.element_at(split, i + 1)), "\n")
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*(F.when(F.col("gone").isNull(), text).otherwise(kept).alias(c) if c == text_col else docs[c] for c in names),
                      F.when(text.isNull(), 0).otherwise(F.size(split)).alias("n_lines"),
                      F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("n_dropped"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
