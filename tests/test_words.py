"""Word rules: results by plain patterns, and that no text is folded for each word."""

import re

from pyspark.sql import functions as F

from marketlake.catalog import QUERIES
from marketlake.functions.text import has_word

ROOT = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_stand_between_other_characters(spark):
    texts = ["bank", "the bank.", "banks", "xbank", "bank\n", "9bank bank", "bankbank bank", "river-bank", "embank", "bank0 é bank", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", has_word(F.col("t"), "bank").alias("hit")).collect()
    assert [r.hit for r in rows] == [bool(re.search("(^|[^0-9a-z])bank([^0-9a-z]|$)", t)) for t in texts]


def test_texts_are_folded_once(spark):
    for name in ("p04_keywords_of_two_texts", "m06_entities", "m04_evaluation_cascade", "m09_gallery_slug"):
        assert plan(QUERIES[name](spark, ROOT)).count("translate(") == 1, name
