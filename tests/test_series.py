"""Golden cases of the daily series."""

import datetime as dt

from marketlake.operators import series as op
from marketlake.sources.tables import insert_absent, keyed_replace, merge_fields


def d(s):
    return dt.date.fromisoformat(s)


def test_closes_and_deltas(spark):
    ticks = [("2026-07-02", 1050), ("2026-07-08", 1060), ("2026-07-08", 1074), ("2026-07-09", 1073)]
    rows = [(k, dt.datetime.fromisoformat(f"{day}T{14 + k}:00:00"), c) for k, (day, c) in enumerate(ticks)]
    frame = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, cents long")
    last = op.with_deltas(op.closes(frame)).orderBy("fecha").collect()[-1]
    assert (last.fecha, last.cents, last.day_delta, last.week_delta) == (d("2026-07-09"), 1073, -1, 23)


def test_weekend_moves_and_fills(spark):
    series = spark.createDataFrame([(d("2026-07-03"), 1), (d("2026-07-04"), 2), (d("2026-07-05"), 3), (d("2026-07-07"), 4)], "fecha date, rate long")
    assert [(str(r.fecha), r.rate) for r in op.redated_weekends(series).orderBy("fecha").collect()] == [("2026-07-03", 1), ("2026-07-06", 2), ("2026-07-07", 4)]
    friday = spark.createDataFrame([(d("2026-07-03"), 1), (d("2026-07-06"), 4)], "fecha date, rate long")
    assert [(str(r.fecha), r.rate, r.filled) for r in op.weekend_fill(friday).orderBy("fecha").collect()] == [("2026-07-03", 1, 0), ("2026-07-04", 1, 1), ("2026-07-05", 1, 1), ("2026-07-06", 4, 0)]


def test_retention_is_idempotent(spark):
    days = spark.createDataFrame([(d("2026-01-01") + dt.timedelta(k),) for k in range(200)], "fecha date")
    once = op.retention(days).select("fecha")
    assert {r.fecha for r in op.retention(once).collect()} <= {r.fecha for r in once.collect()}
    assert op.retention(days.limit(0)).count() == 0


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "k int, p string, q string")
    new = spark.createDataFrame([(2, None, "y"), (3, "c", "z")], "k int, p string, q string")
    assert sorted(tuple(r) for r in merge_fields(old, new, ["k"], ["p", "q"]).collect()) == [(1, "a", "x", "kept"), (2, "b", "y", "updated"), (3, "c", "z", "new")]
    assert merge_fields(old, old, ["k"], ["p", "q"]).where("verdict <> 'equal'").count() == 0
    assert insert_absent(old, new, ["k"]).count() == 3
    assert keyed_replace(old, new, ["k"], ["q"]).count() == 3
