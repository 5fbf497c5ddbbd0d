"""Relevance of notes: TF-IDF and a linear classifier that is used only if it has proved itself.

The model is fitted on all labelled rows, however many; scores cover every note. It counts only with LEAST_LABELS labels and an F1
of LEAST_F1 over FOLDS folds; otherwise notes get the keyword score.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.folders import Scratch

LEAST_LABELS, LEAST_F1, FOLDS = 150, 0.80, 5


def _counted(rows: DataFrame, features: int) -> DataFrame:
    words = RegexTokenizer(inputCol="__text", outputCol="__words", pattern=r"[\p{L}\p{N}]+", gaps=False)
    counts = HashingTF(inputCol="__words", outputCol="__counts", numFeatures=features)
    return counts.transform(words.transform(rows)).drop("__words")


def _pipeline() -> Pipeline:
    return Pipeline(stages=[IDF(inputCol="__counts", outputCol="__tfidf"), LogisticRegression(featuresCol="__tfidf", labelCol="__label", predictionCol="__guess", rawPredictionCol="__raw", probabilityCol="__probability", maxIter=20, regParam=0.05)])


def f1_of(guesses: DataFrame) -> float:
    """F1 of the class 1 in (label, guess)."""
    r = guesses.agg(F.count_if(F.expr("label = 1 AND guess = 1")).alias("tp"), F.count_if(F.expr("label = 0 AND guess = 1")).alias("fp"), F.count_if(F.expr("label = 1 AND guess = 0")).alias("fn")).first()
    return 2 * r["tp"] / max(2 * r["tp"] + r["fp"] + r["fn"], 1)


def scored(notes: DataFrame, text: Column, label: str, fallback: Column, features: int = 1 << 14, key: str = "id") -> tuple[DataFrame, dict]:
    """(notes with probability (NULL without a model) and score in 0..10, report): label is 0, 1 or NULL; fallback is the keyword score."""
    rows = notes.withColumns({"__text": F.coalesce(text, F.lit("")), "__fallback": fallback.cast("double")})
    known = rows.where(F.col(label).isNotNull()).withColumn("__label", F.col(label).cast("double")).withColumn("__fold", F.pmod(F.xxhash64(key), F.lit(FOLDS)))
    n = known.count()
    report = {"labels": n, "f1": None, "model": False}
    plain = rows.withColumns({"probability": F.lit(None).cast("double"), "score": F.col("__fallback")}).drop("__text", "__fallback")
    if n < LEAST_LABELS or known.select("__label").distinct().count() < 2:
        return plain, report
    # each fold reads the counts, the texts are taken apart once
    known = Scratch(notes.sparkSession, "relevance").save(_counted(known, features).select("__counts", "__label", "__fold"), "counts")
    parts = []
    for k in range(FOLDS):
        model = _pipeline().fit(known.where(F.col("__fold") != k))
        parts.append(model.transform(known.where(F.col("__fold") == k)).select(F.col("__label").alias("label"), F.col("__guess").alias("guess")))
    guesses = parts[0]
    for part in parts[1:]:
        guesses = guesses.union(part)
    report["f1"] = f1_of(guesses)
    if report["f1"] < LEAST_F1:
        return plain, report
    report["model"] = True
    out = _pipeline().fit(known).transform(_counted(rows, features))
    probability = F.round(F.get(vector_to_array("__probability"), F.lit(1)), 6)
    made = [c for c in out.columns if c.startswith("__")]
    return out.withColumn("probability", probability).withColumn("score", F.round(F.col("probability") * 10, 1)).drop(*made), report
