"""Labelled texts are taken apart once for all folds."""

from pyspark.sql import functions as F

from marketlake.operators import relevance


def counting(spark):
    seen = spark.sparkContext.accumulator(0)

    def text(k):
        seen.add(1)
        return f"a{k % 7} b{k % 11} c{k % 3}"

    return seen, F.udf(text, "string").asNondeterministic()


def test_labelled_texts_are_taken_apart_once_for_all_folds(spark):
    seen, text = counting(spark)
    notes = spark.range(400).select("id", (F.col("id") % 7 < 3).cast("int").alias("label"))
    _, report = relevance.scored(notes, text("id"), "label", F.lit(0), features=1024)
    assert report["f1"] is not None and seen.value == 400


def test_the_model_is_fitted_on_all_labelled_rows(spark, monkeypatch):
    monkeypatch.setattr(relevance, "MOST_LABELS", 200, raising=False)  # a bound of 200,000 rows was called so
    saved = []

    class Kept(relevance.Scratch):
        def save(self, df, name):
            saved.append(super().save(df, name))
            return saved[-1]

    monkeypatch.setattr(relevance, "Scratch", Kept)
    notes = spark.range(400).select("id", (F.col("id") % 7 < 3).cast("int").alias("label"), F.concat(F.lit("a"), F.col("id") % 7).alias("text"))
    scores, report = relevance.scored(notes, F.col("text"), "label", F.lit(0), features=1024)
    assert report["labels"] == saved[0].count() == 400 and report["model"] and scores.count() == 400
