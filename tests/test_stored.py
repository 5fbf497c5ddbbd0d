"""The versioned table under replays, readers, writers and crashes; keyed state and timers of streams; retention step by step."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake.sources.retention import STEPS, Retention, Stopped
from marketlake.sources.tables import insert_absent
from marketlake.sources.versioned import Conflict, VersionedTable
from marketlake.streaming import stateful


@pytest.fixture
def stored(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t", "id long, v string", ["id"], ["v"], file_rows=500)
    table.replace(spark.range(10_000).selectExpr("id * 10 AS id", "'a' AS v"))
    return table


def paths(version):
    return {f["path"] for f in version.files}


def test_replacing_one_percent_touches_its_files_only(spark, stored):
    before = stored.version()
    after = stored.upsert(spark.range(100).selectExpr("40000 + id * 10 AS id", "'b' AS v"))
    assert len(before.files) >= 15 and len(paths(before) - paths(after)) <= 2
    assert stored.read().count() == 10_000 and stored.read().where("v = 'b'").count() == 100
    ranges = [(int(f["low"]), int(f["high"])) for f in after.files]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_scattered_keys_and_new_ones_in_gaps(spark, stored):
    before = stored.version()
    after = stored.upsert(spark.createDataFrame([(5, "c"), (99_995, "c"), (-3, "c"), (50_000, "c"), (500_000, "c")], "id long, v string"))
    assert len(paths(before) - paths(after)) <= 3
    assert stored.read().count() == 10_004 and sorted(r.id for r in stored.read().where("v = 'c'").collect()) == [-3, 5, 50_000, 99_995, 500_000]
    ranges = [(int(f["low"]), int(f["high"])) for f in after.files]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_many_runs_are_closed_up(spark, stored, monkeypatch):
    from marketlake.sources import versioned

    monkeypatch.setattr(versioned, "RUNS", 2)
    assert stored._runs([0, 1, 5, 9], []) == [(0, 1), (5, 9)] or stored._runs([0, 1, 5, 9], []) == [(0, 5), (9, 9)]
    stored.upsert(spark.createDataFrame([(k * 12_345, "z") for k in range(8)], "id long, v string"))
    assert stored.read().where("v = 'z'").count() == 8 and stored.read().groupBy("id").count().where("count > 1").isEmpty()


def test_readers_keep_the_version_they_opened(spark, stored):
    old = stored.read()
    number = stored.version().number
    stored.upsert(spark.createDataFrame([(0, "new")], "id long, v string"))
    stored.replace(spark.createDataFrame([(1, "only")], "id long, v string"))
    assert old.where("id = 0").first().v == "a" and old.count() == 10_000
    assert stored.read(number).count() == 10_000 and stored.read().count() == 1
    assert stored.vacuum() > 10 and stored.read().count() == 1


def test_a_repeated_batch_changes_nothing(spark, stored):
    rows = spark.createDataFrame([(0, "b0")], "id long, v string")
    first = stored.upsert(rows, once=("feed", 0))
    again = stored.upsert(spark.createDataFrame([(0, "zz")], "id long, v string"), once=("feed", 0))
    assert again.number == first.number and stored.read().where("id = 0").first().v == "b0"
    assert stored.upsert(rows, once=("other", 0)).number == first.number + 1


def test_two_writers_of_one_version(spark, stored, tmp_path):
    """The slower one merges again onto what the faster one committed."""
    rival = VersionedTable(spark, f"file://{tmp_path}/t", "id long, v string", ["id"], ["v"], file_rows=500)
    seen = []

    def merge(old, new):
        if not seen:
            seen.append(rival.upsert(spark.createDataFrame([(20, "rival")], "id long, v string")).number)
        return insert_absent(old, new, ["id"])

    stored.upsert(spark.createDataFrame([(20, "late"), (7, "late")], "id long, v string"), merge)
    assert {r.id: r.v for r in stored.read().where("id IN (7, 20)").collect()} == {7: "late", 20: "rival"}
    with pytest.raises(Conflict):
        stored._publish(stored.version())


def test_a_writer_that_dies_leaves_the_table(spark, stored):
    def broken(old, new):
        return new.withColumn("v", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception, match="lost"):
        stored.upsert(spark.createDataFrame([(0, "x")], "id long, v string"), broken)
    assert stored.version().number == 1 and stored.read().count() == 10_000


def test_empty_tables_dates_and_null_parts_of_keys(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/d", "day date, k string, v int", ["day", "k"], ["v"])
    assert table.read().isEmpty() and table.version().number == 0
    rows = spark.sql("SELECT * FROM VALUES (DATE '2024-01-01', NULL, 1), (DATE '2024-01-01', NULL, 3), (DATE '2024-01-02', 'a', 2) AS t(day, k, v)")
    table.upsert(rows)
    assert sorted(r.v for r in table.read().collect()) == [2, 3]
    table.delete_up_to(dt.date(2024, 1, 1))
    assert [r.v for r in table.read().collect()] == [2]
    table.upsert(rows.limit(0))
    assert table.read().count() == 1


# ---- streams


def add(spark, root, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(root)


def test_a_stale_alarm_comes_before_the_next_tick(spark, tmp_path):
    root, out, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "cp"))
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)

    def run():
        stream = spark.readStream.schema("ts timestamp, name string").parquet(root)
        with stateful.rocksdb(spark):
            stateful.to_folder(stateful.feed_alarms(stream, "name"), out, checkpoint)
        return sorted((r.feed, r.alarm, r.minutes) for r in spark.read.parquet(out).collect())

    add(spark, root, [(at(8, 0), "a"), (at(8, 10), "a"), (at(8, 5), "b")], "ts timestamp, name string")
    assert run() == []
    add(spark, root, [(at(10, 0), "b"), (at(9, 50), "b")], "ts timestamp, name string")  # only b goes on
    assert run() == [("a", "stale", 15), ("b", "stale", 15)]
    add(spark, root, [(at(10, 10), "a"), (at(13, 0), "b")], "ts timestamp, name string")
    assert run() == [("a", "gap", 120), ("a", "stale", 15), ("a", "stale", 15), ("b", "gap", 105), ("b", "stale", 15), ("b", "stale", 15)]


def test_marks_end_late_items_are_counted_and_unsettled_ones_do_not_mark(spark, tmp_path):
    root, out, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "cp"))
    schema = "ts timestamp, url string, item long, done boolean"
    at = lambda d, h=0: dt.datetime(2024, 1, d, h)
    parts = [
        [(at(1), "u", 1, False), (at(1, 1), "u", 2, True), (at(2), "u", 3, True)],  # 1 doesn't mark, 2 does
        [(at(8), "u", 4, True), (at(1, 5), "v", 5, True)],  # 5 is a day late
        [(at(8, 2), "u", 6, True), (at(20), "w", 7, True)],  # 7 days after 2 the mark is gone
        [(at(20, 1), "u", 8, True)],
    ]
    for rows in parts:
        add(spark, root, rows, schema)
        stream = spark.readStream.schema(schema).parquet(root)
        with stateful.rocksdb(spark):
            stateful.to_folder(stateful.settled_once(stream, F.col("url"), "item", F.col("done")), out, checkpoint)
    assert {r.item: r.verdict for r in spark.read.parquet(out).collect()} == {1: "new", 2: "new", 3: "seen", 4: "seen", 5: "late", 6: "new", 7: "new", 8: "new"}


def test_membership_is_kept_by_trader(spark, tmp_path):
    root, out, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "cp"))
    for rows in ([("BUY", 1, "d1"), ("BUY", 2, "d1"), ("SELL", 9, "d1")], [("BUY", 2, "d2"), ("BUY", 3, "d2"), ("BUY", 4, "d2")], [("SELL", 8, "d3"), ("BUY", 7, "d1"), ("BUY", 2, "d1")]):
        add(spark, root, rows, "side string, member long, snapshot string")
        stream = spark.readStream.schema("side string, member long, snapshot string").parquet(root)
        with stateful.rocksdb(spark):
            stateful.to_folder(stateful.last_snapshots(stream), out, checkpoint)
    found = {(r.side, r.snapshot): (r.n, r.new, r.gone) for r in stateful.flow_of(spark.read.parquet(out)).collect()}
    # trader 7 of d1 comes with a later part and counts; trader 2 was seen in d2 already
    assert found == {("BUY", "d1"): (3, 0, 0), ("BUY", "d2"): (3, 2, 2), ("SELL", "d1"): (1, 0, 0), ("SELL", "d3"): (1, 1, 1)}


def test_candles_count_what_is_too_late_and_take_each_batch_once(spark, tmp_path):
    table, side = stateful.candle_table(spark, f"file://{tmp_path}/t"), f"file://{tmp_path}/late"
    load = stateful.candle_intake(table, side)
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    schema = "ts timestamp, event_id long, cents long"
    first = spark.createDataFrame([(at(8, 0), 1, 5), (at(8, 20), 2, 9), (at(9, 30), 3, 4)], schema)
    second = spark.createDataFrame([(at(8, 29), 4, 1), (at(8, 40), 5, 7), (at(9, 31), 6, 8)], schema)  # 8:29 is over an hour late
    for n, batch in enumerate((first, second)):
        load(batch, n)
        load(batch, n)
    rows = {r.start_us // 60_000_000 % 1440: (r.open, r.high, r.low, r.close, r.volume) for r in table.read().collect()}
    assert rows == {480: (5, 9, 5, 9, 2), 510: (7, 7, 7, 7, 1), 570: (4, 8, 4, 8, 2)}
    assert table.version().properties["late"] == 1 and spark.read.parquet(f"{side}/batch=1").first().event_id == 4


@pytest.mark.parametrize("step", STEPS)
def test_retention_goes_on_after_a_stop(spark, tmp_path, step):
    tables = [VersionedTable(spark, f"file://{tmp_path}/{n}", "fecha date, id long", ["fecha", "id"]) for n in ("notes", "archive")]
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(60)]
    tables[0].replace(spark.createDataFrame([(d, k) for k, d in enumerate(days)], "fecha date, id long"))
    job = Retention(*tables)
    job.run(dt.date(2024, 2, 10))
    with pytest.raises(Stopped):
        job.run(dt.date(2024, 2, 20), stop_after=step)
    kept, archived = ({r.id for r in t.read().collect()} for t in tables)
    assert set(range(60)) - kept <= archived  # nothing is gone that isn't archived
    job.run(dt.date(2024, 2, 20))
    kept, archived = ([r.id for r in t.read().collect()] for t in tables)
    cut = lambda n: {k for k, d in enumerate(days) if d <= dt.date(2024, 2, 20) - dt.timedelta(days=n)}
    assert set(kept) == set(range(60)) - cut(30) and sorted(archived) == sorted(cut(20)) and job.marker() == "2024-01-31"
