"""Language ID: what a letter is, the sample's bound."""

from pyspark.sql import functions as F

from popweave.llm import language_id


def test_numbers_are_no_letters_and_marks_stay_in_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.fit(docs, F.lit(True), sample=60)
    rows = [(1, "½ ² Ⅷ ① 12 _ !"), (2, "́̈"), (3, None), (4, ""), (5, "the then and there")]
    got = {r.id: r for r in language_id.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 4)) and got[5].lang_pred != "und"
    assert language_id.WORD.findall("क्षि न् a1b½c") == ["क्षि", "न्", "a", "b", "c"]


def test_the_sample_is_bounded_whatever_ids_are_shared(spark, monkeypatch):
    rows = [(None, f"words of text number {chr(97 + i % 26)}{chr(97 + i // 26)}", "en") for i in range(300)]
    rows += [(7, "mots du même texte", "fr")] * 50 + [(8, f"mots {chr(97 + i % 26)}", "fr") for i in range(30)]
    taken = []
    real = language_id.materialize
    monkeypatch.setattr(language_id, "materialize", lambda df, name: taken.append((name, real(df, name))) or taken[-1][1])
    language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), sample=10)
    (sample,) = [df for name, df in taken if name == "sample"]
    assert {r.lang: r["count"] for r in sample.groupBy("lang").count().collect()} == {"en": 10, "fr": 10}


def test_a_language_left_out_of_the_fit_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang IS NOT NULL")
    long = F.length("text") >= 300
    for left in ("en", "es"):
        model = language_id.fit(docs.filter(F.col("lang") != left), ~language_id.held_out())
        got = (language_id.predict(docs.filter(long), model).join(docs.select(F.col("doc_id").alias("id"), "lang"), "id")
               .groupBy((F.col("lang") == left).alias("out")).agg(F.avg(F.col("rejected").cast("int")).alias("share")))
        share = {r.out: r.share for r in got.collect()}
        assert share[True] >= 0.9 and share[False] <= 0.02, (left, share)
