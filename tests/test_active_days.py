"""Active days: results by plain loops, and that no row is made for a day."""

import datetime
import random

from pyspark.sql import functions as F

from marketlake.operators import facts


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_active_days_make_no_row_for_a_day(spark):
    rng = random.Random(5)
    day = lambda k: datetime.date(1996, 1, 1) + datetime.timedelta(k)
    rows = []
    for _ in range(300):
        start = rng.randint(-40, 400)
        rows.append((rng.choice(["a", "b", None]), rng.randint(0, 5), day(start), None if rng.random() < 0.05 else day(start + rng.randint(-3, 9))))
    ranges = spark.createDataFrame(rows, "k string, c int, start date, end date")
    last = day(380)
    out = facts.active_days(ranges, ["k", "c"], "1996-01-01", F.lit(last))
    want = {}
    for k, c, start, end in rows:
        for n in range((last - day(0)).days + 1):
            if start <= day(n) <= min(end or last, last):
                want.setdefault((k, c), set()).add(n)
    assert {(r.k, r.c): r.days for r in out.collect()} == {k: len(v) for k, v in want.items()}
    assert "explode" not in plan(out)
