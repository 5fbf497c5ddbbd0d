"""Streams over split files equal the batch result."""

from pyspark.sql import functions as F

from marketlake.bindings import tick
from marketlake.streaming import jobs

SF = "/root/testdata/sf0.001"


def split(spark, path):
    rows = tick(spark, SF).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "cents")
    for k in range(3):
        rows.where(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(path)
    return rows


def run(stream, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return q


def test_candles_equal_batch(spark, tmp_path):
    rows = split(spark, str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    run(jobs.candles(stream, late="60 days"), "candles", "complete")
    assert sorted(spark.table("candles").collect()) == sorted(jobs.candles(rows).collect())


def test_first_seen(spark, tmp_path):
    rows = split(spark, str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    run(jobs.first_seen(stream, ["user_id"], "60 days"), "seen")
    assert spark.table("seen").count() == rows.select("user_id").distinct().count()


def test_intake_replays_a_batch(spark, tmp_path):
    """The same files under a new checkpoint are all loaded again: nothing changes."""
    rows = split(spark, str(tmp_path / "in"))
    want = {(r.user_id, r.e) for r in rows.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("e")).collect()}
    for checkpoint in ("cp", "cp2"):
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        jobs.intake(stream, str(tmp_path / "out"), str(tmp_path / checkpoint), ["user_id"], ["ts", "event_id"], F.col("user_id") % 4).awaitTermination(240)
        assert {(r.user_id, r.event_id) for r in spark.read.parquet(str(tmp_path / "out" / "rows")).collect()} == want


def test_late_ticks_are_dropped(spark, tmp_path):
    rows = tick(spark, SF).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "cents").orderBy("ts")
    rows.where("ts >= '2024-01-10'").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    write = lambda: jobs.candles(stream(), late="1 hour").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start().awaitTermination(240)
    write()
    rows.where("ts < '2024-01-05'").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))  # days behind the watermark
    write()
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.agg(F.min("start")).first()[0].isoformat() >= "2024-01-10"
    closed = jobs.candles(rows.where("ts >= '2024-01-10'")).join(found.select("start"), "start", "left_semi")
    assert sorted(found.collect()) == sorted(closed.collect()) and found.count() > 100


def test_sessions_and_volatility_equal_batch(spark, tmp_path):
    rows = split(spark, str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    run(jobs.sessions(stream(), late="60 days"), "visits", "complete")
    assert sorted(spark.table("visits").collect()) == sorted(jobs.sessions(rows).collect())
    run(jobs.sliding_volatility(stream(), late="60 days"), "vol", "complete")
    close = lambda df: sorted((r.start, r.n, None if r.volatility is None else round(r.volatility, 6)) for r in df.collect())
    assert close(spark.table("vol")) == close(jobs.sliding_volatility(rows))


def test_membership_flow_keeps_the_snapshot_before(spark, tmp_path):
    days = [("BUY", "d1", [1, 2]), ("SELL", "d1", [9]), ("BUY", "d2", [2, 3, 4]), ("BUY", "d1", [7]), ("SELL", "d3", [])]
    for k, row in enumerate(days):  # one file a batch; the fourth comes late
        spark.createDataFrame([row], "side string, snapshot string, members array<long>").coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/k={k}"))
    base = spark.createDataFrame([], "side string, snapshot string, members array<long>").schema
    stream = spark.readStream.schema(base).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "in/*"))
    run(jobs.membership_flow(stream), "flow")
    found = sorted(tuple(r) for r in spark.table("flow").collect())
    assert found == [("BUY", "d1", 2, 0, 0), ("BUY", "d2", 3, 2, 1), ("SELL", "d1", 1, 0, 0), ("SELL", "d3", 0, 0, 1)]


def test_on_time_lanes(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP '2024-01-01 00:00:00'), (2, TIMESTAMP '2024-01-02 10:00:00'), (3, NULL) AS t(id, published)").withColumn("seen", F.lit("2024-01-03 00:00:00").cast("timestamp"))
    assert [r.id for r in jobs.on_time(rows, "published", "seen").orderBy("id").collect()] == [2, 3]
    assert [r.id for r in jobs.on_time(rows, "published", "seen", 24, keep_undated=False).collect()] == [2]


def test_official_value_supersedes(spark, tmp_path):
    spark.createDataFrame([("2026-05", 1.0), ("2026-06", 2.0)], "periodo string, valor double").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("periodo string, valor double").parquet(str(tmp_path / "in"))
    official = spark.createDataFrame([("2026-05", 1.5)], "periodo string, valor double")
    run(jobs.official_first(stream, official, ["periodo"]), "facts")
    assert sorted((r.periodo, r.valor, r.provisional) for r in spark.table("facts").collect()) == [("2026-05", 1.5, 0), ("2026-06", 2.0, 1)]


def test_a_failing_side_log_leaves_the_main_write(spark, tmp_path):
    rows = split(spark, str(tmp_path / "in"))

    def log(batch, n):
        raise RuntimeError("no disk")

    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = jobs.with_side_log(stream, lambda batch, n: batch.write.mode("overwrite").parquet(str(tmp_path / f"out/b{n}")), log, str(tmp_path / "cp"))
    query.awaitTermination(120)
    assert query.exception() is None and spark.read.parquet(str(tmp_path / "out/*")).count() == rows.count()
