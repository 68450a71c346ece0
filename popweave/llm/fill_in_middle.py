"""Fill-in-middle transformation (operator 11).

Method: counted-quantifier regular expressions. ``regexp_count`` gives the number ``n`` of
units (code points) of a text; two hashed draws cut it after ``a`` and after ``b`` units; the
pattern of that row, ``\\A(unit{a}+)(unit{b-a}+)(unit*+)\\z`` with possessive quantifiers, captures
prefix, middle and suffix in one match, and the row's replacement puts them in the order of
its form. A possessive group never gives units back, so a match is one pass over the text, in a
loop rather than by recursion, whatever its length.

Forms: ``plain`` (the text as it is), ``psm`` (prefix, suffix, middle) and ``spm`` (suffix,
prefix, middle), each part after its sentinel. A text that is empty or holds a sentinel is
plain, so ``restore`` gets the exact text back from output and form.

``regexp_count`` builds one string a match. Units are therefore counted in runs of ``RUN`` and
only the units after the last whole run one by one: the strings held at a time add up to one copy
of the text, not to one object a unit.

Everything is a narrow projection of built-in functions: no shuffle, no Python worker.

Defined cases: a null text is an empty one (plain, 0 units); a null id is hashed as the empty
string; ties and repeated rows draw alike, each row on its own; lone surrogates can't occur in
UTF-8; an empty table gives no rows; other columns are carried along, those named like an output
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.llm.common import prepare, read

UNIT = "."         # with (?s): any code point
RUN = 4096         # units counted by one match
SENTINELS = ("<P>", "<S>", "<M>")
OUT = ("n", "form", "prefix_chars", "middle_chars", "output")


def _checked(sentinels: tuple[str, str, str]) -> tuple[str, str, str]:
    """Sentinels that can be found again: no part of one may begin another, wherever they meet
    the text, or the text could not be restored."""
    if len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different, non-empty sentinels are needed")
    if any(s[0] in t[1:] for s in sentinels for t in sentinels):
        raise ValueError("a sentinel's first character may stand at the head of sentinels only")
    if any(s != t and t.startswith(s) for s in sentinels for t in sentinels):
        raise ValueError("no sentinel may begin with another")
    return sentinels


def _pattern(s: str) -> str:
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _literal(s: str) -> str:
    return s.replace("\\", "\\\\").replace("$", "\\$")


def draws(key: Column, count: int) -> list[Column]:
    """``count`` unsigned 32-bit numbers: the 8-digit groups of the key's hex SHA-256."""
    digest = F.sha2(key, 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(count)]


def units(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``, the number of units of ``text`` (a string without nulls)."""
    run = F.lit(f"(?s){UNIT}{{{RUN}}}+")
    whole = df.withColumn("_runs", F.regexp_count(text, run).cast("long") * RUN)
    # the part after the whole runs is shorter than one run
    skip = F.concat(F.lit(f"(?s)\\A{UNIT}{{"), F.col("_runs").cast("string"), F.lit(f"}}+({UNIT}*+)\\z"))
    rest = whole.withColumn("_rest", F.call_function("regexp_extract", F.col(text), skip, F.lit(1)))
    return (rest.withColumn(out, F.col("_runs") + F.regexp_count("_rest", F.lit(f"(?s){UNIT}")))
            .drop("_runs", "_rest"))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
              plain_percent: int = 10, spm_percent: int = 20,
              sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``docs`` with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` (null if plain) and
    ``output``, the transformed text. ``plain_percent`` of the texts stay plain and
    ``spm_percent`` of the others become spm."""
    p, s, m = _checked(sentinels)
    keep = [c for c in docs.columns if c not in OUT]
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    df = docs.select(*keep).withColumn("_t", F.coalesce(F.col(text_col), F.lit("")))
    df = units(df, "_t", "n").withColumn("_h", F.array(*draws(key, 4)))
    h = [F.col("_h")[i] for i in range(4)]
    cut1, cut2 = h[0] % (F.col("n") + 1), h[1] % (F.col("n") + 1)
    marked = F.col("_t").contains(p) | F.col("_t").contains(s) | F.col("_t").contains(m)
    plain = (F.col("n") == 0) | marked | (h[2] % 100 >= 100 - plain_percent)
    df = (df.withColumn("form", F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm"))
          .withColumn("prefix_chars", F.when(F.col("form") != "plain", F.least(cut1, cut2)))
          .withColumn("middle_chars", F.when(F.col("form") != "plain", F.abs(cut1 - cut2))))
    split = F.concat(F.lit(f"(?s)\\A({UNIT}{{"), F.col("prefix_chars").cast("string"), F.lit(f"}}+)({UNIT}{{"),
                     F.col("middle_chars").cast("string"), F.lit(f"}}+)({UNIT}*+)\\z"))
    p, s, m = map(_literal, sentinels)
    order = F.when(F.col("form") == "psm", f"{p}$1{s}$3{m}$2").otherwise(f"{s}$3{p}$1{m}$2")
    output = F.when(F.col("form") == "plain", F.col("_t")).otherwise(F.regexp_replace("_t", split, order))
    return df.withColumn("output", output).select(*keep, *OUT)


def restore(df: DataFrame, out: str = "restored", sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Add ``out``, the exact text rebuilt from ``output`` and ``form`` alone."""
    p, s, m = map(_pattern, _checked(sentinels))
    psm, spm = f"(?s)\\A{p}(.*?){s}(.*?){m}(.*+)\\z", f"(?s)\\A{s}(.*?){p}(.*?){m}(.*+)\\z"
    return df.withColumn(out, F.when(F.col("form") == "psm", F.regexp_replace("output", F.lit(psm), F.lit("$1$3$2")))
                         .when(F.col("form") == "spm", F.regexp_replace("output", F.lit(spm), F.lit("$2$3$1")))
                         .otherwise(F.col("output")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return restore(transform(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
             CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1, n - b) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""
