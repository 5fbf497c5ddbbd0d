"""Notes are made from their texts once however many steps read them, and unlike ones don't become candidates."""

import pytest
from pyspark.sql import functions as F

from marketlake.operators import events


def counting(spark):
    seen = spark.sparkContext.accumulator(0)

    def text(k):
        seen.add(1)
        return f"a{k % 7} b{k % 11} c{k % 3}"

    return seen, F.udf(text, "string").asNondeterministic()


@pytest.mark.parametrize("step", [lambda n: events.repeated(n), lambda n: events.greedy_groups(n, [])])
def test_notes_are_made_once(spark, step):
    seen, text = counting(spark)
    none = F.array().cast("array<string>")
    notes = spark.range(200).select("id", F.expr("date_add(DATE '2024-01-01', CAST(id % 9 AS INT))").alias("fecha"), (F.col("id") % 5).alias("score"), events.tokens(text("id")).alias("tokens"), none.alias("entities"), none.alias("amounts"))
    assert step(notes).count() == 200 and seen.value == 200


def test_bitmaps_keep_unlike_notes_out_of_the_candidates(spark):
    # a token in all, which is among the rarest, and 19 that only some other notes have
    rows = [(k, ["all", *[f"t{(k * 19 + i * (k % 5 + 1)) % 400}" for i in range(19)]]) for k in range(200)]
    notes = events.ranked_tokens(spark.createDataFrame(rows, "n long, tokens array<string>").withColumn("tokens", F.array_distinct("tokens")), ["n"])
    found = {(r.a, r.b) for r in events.candidates(notes, notes, 0.55, None, [], F.col("a.n") < F.col("b.n")).collect()}
    sets = {n: set(t) for n, t in rows}
    true = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.55 * max(len(sets[a]), len(sets[b]))}
    assert true <= found and len(found) <= len(true) + 200
