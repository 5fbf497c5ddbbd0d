"""Queries that run as streams: the given rows come in parts, each taken by a query of its own that goes on from the checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..bindings import BOOK, MACRO, TICK, book, macro, tick
from ..registry import query
from ..sources.folders import shared_folder
from ..sources.versioned import VersionedTable
from ..streaming import jobs, stateful

#: Ticks come in files of eight days each, in which every tick is up to so many minutes late.
EPOCH_US, FILE_US = 1_704_067_200_000_000, 8 * stateful.DAY


def in_parts(rows: DataFrame, part: Column, parts: list, take: Callable[[DataFrame, str], None]) -> None:
    """Add the rows of each part to a folder and let take(stream, checkpoint) run over what is new, starting anew each time."""
    spark, root, checkpoint = rows.sparkSession, shared_folder(rows.sparkSession, "stream"), shared_folder(rows.sparkSession, "checkpoint")
    for p in parts:
        rows.where(part == p).write.mode("append").parquet(root)
        take(spark.readStream.schema(rows.schema).parquet(root), checkpoint)


def taken(rows: DataFrame, part: Column, parts: list, job: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a stream over the parts gives, in a Parquet folder."""
    spark, out = rows.sparkSession, shared_folder(rows.sparkSession, "taken")
    schema = []

    def take(stream: DataFrame, checkpoint: str) -> None:
        made = job(stream)
        schema[:] = [made.schema]
        stateful.to_folder(made, out, checkpoint)

    with stateful.rocksdb(spark):
        in_parts(rows, part, parts, take)
    return spark.read.schema(schema[0]).parquet(out)


def tick_rows(spark, sf_dir) -> DataFrame:
    return tick(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "cents")


def file_of(minutes: int) -> Column:
    """The number of the file that a tick comes in."""
    return F.floor((F.unix_micros("ts") - EPOCH_US + F.pmod(F.col("event_id") * 37, F.lit(minutes)) * stateful.MINUTE) / FILE_US)


FILES = [0, 1, 2, 3]


def filed(minutes: int) -> str:
    """SQL: ticks with their file and the newest tick of the files before."""
    file = f"CAST(floor((epoch_us(ts) - {EPOCH_US} + (event_id * 37 % {minutes}) * 60000000) / {FILE_US}) AS BIGINT)"
    return f"""{TICK}, f AS (SELECT *, epoch_us(ts) AS us, {file} AS file FROM tick), newest AS (SELECT file, max(us) AS newest FROM f GROUP BY file),
 t AS (SELECT f.*, (SELECT max(newest) FROM newest n WHERE n.file < f.file) AS known FROM f)"""


def ticks(spark, sf_dir):
    """All ticks as a stream of files, as many as there are partitions."""
    rows, root = tick_rows(spark, sf_dir), shared_folder(spark, "stream")
    rows.repartition(3, "event_id").write.parquet(root)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(root)


@query("x01_stream_intake", f"WITH {TICK} SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id FROM tick GROUP BY user_id")
def x01(spark, sf_dir):
    """The last tick of each user, loaded twice under different checkpoints."""
    target = shared_folder(spark, "intake")
    for _ in range(2):
        jobs.intake(ticks(spark, sf_dir), target, shared_folder(spark, "checkpoint"), ["user_id"], ["ts", "event_id"], F.col("user_id") % 4).awaitTermination()
    return spark.read.parquet(f"{target}/rows").select("user_id", "event_id")


@query("x02_stream_candles", f"""WITH {filed(180)}, k AS (SELECT *, us - us % 1800000000 AS start_us, coalesce(us <= known - 3600000000, false) AS late FROM t)
SELECT make_timestamp(start_us) AS start, CASE WHEN late THEN 'late' WHEN start_us + 1800000000 <= (SELECT max(us) FROM t) - 3600000000 THEN 'closed' ELSE 'open' END AS kind, CASE WHEN NOT late THEN arg_min(cents, (us, event_id)) END AS open,
 CASE WHEN NOT late THEN max(cents) END AS high, CASE WHEN NOT late THEN min(cents) END AS low, CASE WHEN NOT late THEN arg_max(cents, (us, event_id)) END AS close, count(*) AS volume FROM k GROUP BY start_us, late""")
def x02(spark, sf_dir):
    """Candles of ticks that come up to three hours late, where one hour is waited for; what came later is counted beside them."""
    table, side = stateful.candle_table(spark, shared_folder(spark, "candles"), file_rows=500), shared_folder(spark, "late")
    in_parts(tick_rows(spark, sf_dir), file_of(180), FILES, lambda stream, checkpoint: stateful.to_table(stream, stateful.candle_intake(table, side), checkpoint))
    newest = F.lit(table.version().properties.get("newest_us"))
    kind = F.when(F.col("start_us") + 30 * stateful.MINUTE <= newest - 60 * stateful.MINUTE, "closed").otherwise("open")
    kept = table.read().select("start_us", kind.alias("kind"), "open", "high", "low", "close", "volume")
    if table.version().properties.get("late"):
        none = [F.lit(None).cast("long").alias(c) for c in ("open", "high", "low", "close")]
        late = spark.read.schema("start_us long").option("recursiveFileLookup", True).parquet(side).groupBy("start_us").agg(F.count("*").alias("volume"))
        kept = kept.unionByName(late.select("start_us", F.lit("late").alias("kind"), *none, "volume"))
    return kept.select(F.timestamp_micros("start_us").cast("timestamp_ntz").alias("start"), "kind", "open", "high", "low", "close", "volume")


SETTLED = "cents % 3 <> 0"


@query("x03_stream_first_seen", f"""WITH RECURSIVE {filed(180)}, late AS (SELECT *, coalesce(us - us % 1000 <= known - known % 1000 - 3600000000, false) AS late FROM t),
 o AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY file, us, event_id) AS k FROM late WHERE NOT late),
 r AS (SELECT user_id, event_type, k, event_id, CASE WHEN {SETTLED} THEN us END AS mark, 'new' AS verdict FROM o WHERE k = 1
  UNION ALL SELECT o.user_id, o.event_type, o.k, o.event_id, CASE WHEN r.mark IS NOT NULL AND o.us <= r.mark + 604800000000 THEN r.mark WHEN o.{SETTLED} THEN o.us ELSE r.mark END, CASE WHEN r.mark IS NOT NULL AND o.us <= r.mark + 604800000000 THEN 'seen' ELSE 'new' END
  FROM r JOIN o ON o.user_id = r.user_id AND o.event_type = r.event_type AND o.k = r.k + 1)
SELECT event_id AS item, verdict FROM r UNION ALL SELECT event_id, 'late' FROM late WHERE late""")
def x03(spark, sf_dir):
    """A user's items of a type, seen for 7 days once one is settled; items over an hour late are told apart."""
    key = F.concat_ws(":", "user_id", "event_type")
    return taken(tick_rows(spark, sf_dir), file_of(180), FILES, lambda s: stateful.settled_once(s, key, "event_id", F.expr(SETTLED)))


@query("x05_stream_alarms", f"""WITH {filed(50)}, d AS (SELECT DISTINCT event_type AS feed, us FROM t), p AS (SELECT feed, us, lag(us) OVER w AS before, lead(us) OVER w AS after FROM d WINDOW w AS (PARTITION BY feed ORDER BY us)),
 sure AS (SELECT * FROM p WHERE us + 900000000 < (SELECT max(us) - max(us) % 1000 FROM t) - 3600000000)
SELECT feed, 'gap' AS alarm, before AS start_us, us AS end_us, (us - before + 30000000) // 60000000 AS minutes FROM sure WHERE us - before > 1200000000
UNION ALL SELECT feed, 'stale', us, us + 900000000, 15 FROM sure WHERE after IS NULL OR after - us > 900000000""")
def x05(spark, sf_dir):
    """Gaps of over 20 minutes, and 15 minutes without a tick, in feeds whose ticks come up to 50 minutes late."""
    return taken(tick_rows(spark, sf_dir), file_of(50), FILES, lambda s: stateful.feed_alarms(s, "event_type"))


@query("x10_stream_sessions", f"""WITH {filed(50)}, g AS (SELECT user_id, us, event_id, CASE WHEN us - lag(us) OVER w < 1800000000 THEN 0 ELSE 1 END AS opens FROM t WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
 s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY us, event_id) AS k FROM g), v AS (SELECT user_id, min(us) AS start_us, max(us) + 1800000000 AS end_us, count(*) AS n FROM s GROUP BY user_id, k)
SELECT user_id, start_us, end_us, n FROM v WHERE end_us <= (SELECT max(us) - max(us) % 1000 FROM t) - 3600000000""")
def x10(spark, sf_dir):
    """Visits that are over, half an hour after their last tick."""
    made = taken(tick_rows(spark, sf_dir), file_of(50), FILES, jobs.sessions)
    return made.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


SEEN = "TIMESTAMP '2024-01-16 00:00:00'"


@query("x04_stream_on_time", f"WITH {TICK}, p AS (SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN ts END AS ts FROM tick) SELECT event_id, coalesce(epoch_us({SEEN}) - epoch_us(ts) <= 86400000000, false) AS lane FROM p WHERE coalesce(epoch_us({SEEN}) - epoch_us(ts) <= 100800000000, true)")
def x04(spark, sf_dir):
    """At most 28 hours old, undated ones included; the strict lane's are marked."""
    rows = tick_rows(spark, sf_dir).withColumn("published", F.when(F.col("event_id") % 9 != 0, F.col("ts"))).withColumn("seen", F.lit("2024-01-16 00:00:00").cast("timestamp"))
    part = F.pmod("event_id", F.lit(3))
    passed = taken(rows, part, [0, 1, 2], lambda s: jobs.on_time(s, "published", "seen").select("event_id"))
    strict = taken(rows, part, [0, 1, 2], lambda s: jobs.on_time(s, "published", "seen", 24, keep_undated=False).select("event_id")).withColumn("lane", F.lit(True))
    return passed.join(strict, "event_id", "left").select("event_id", F.coalesce("lane", F.lit(False)).alias("lane"))


@query("x06_stream_membership", f"WITH {BOOK}, m AS (SELECT side, snapshot, list(DISTINCT trader) AS members FROM book GROUP BY ALL), p AS (SELECT *, lag(members) OVER (PARTITION BY side ORDER BY snapshot) AS before FROM m) SELECT side, snapshot, CAST(len(members) AS BIGINT) AS n, CASE WHEN before IS NULL THEN 0 ELSE len(members) - len(list_intersect(members, before)) END AS new, CASE WHEN before IS NULL THEN 0 ELSE len(before) - len(list_intersect(members, before)) END AS gone FROM p")
def x06(spark, sf_dir):
    """Snapshots come in three parts; the state is the last snapshot of each trader on each side."""
    rows = book(spark, sf_dir).select("side", F.col("trader").alias("member"), "snapshot")
    part = F.when(F.col("snapshot") < "1994", 0).when(F.col("snapshot") < "1997", 1).otherwise(2)
    return stateful.flow_of(taken(rows, part, [0, 1, 2], stateful.last_snapshots))


@query("x07_stream_volatility", f"""WITH {filed(180)}, w AS (SELECT us - us % 600000000 - 600000000 * i AS start_us, known, cents FROM t, range(0, 6) r(i)), k AS (SELECT * FROM w WHERE coalesce(start_us + 3600000000 > known - known % 1000 - 3600000000, true))
SELECT make_timestamp(start_us) AS start, count(*) AS n, round(stddev_samp(cents), 4) AS volatility FROM k GROUP BY start_us HAVING start_us + 3600000000 <= (SELECT max(us) - max(us) % 1000 FROM t) - 3600000000""")
def x07(spark, sf_dir):
    """Windows that are over; a tick over an hour late no longer counts in those that were."""
    rows = taken(tick_rows(spark, sf_dir), file_of(180), FILES, jobs.sliding_volatility)
    return rows.select(F.col("start").cast("timestamp_ntz").alias("start"), "n", F.round("volatility", 4).alias("volatility"))


@query("x09_stream_official_first", f"WITH {MACRO} SELECT m.periodo, m.slug, m.valor + CASE WHEN substr(m.periodo, 6, 2) = '06' THEN 1 ELSE 0 END AS valor, CAST(substr(m.periodo, 6, 2) = '06' AS INTEGER) AS provisional FROM macro m")
def x09(spark, sf_dir):
    """Provisional values, one larger, in a stream; the official ones lack every June."""
    rows = macro(spark, sf_dir)
    official = rows.where("substr(periodo, 6, 2) <> '06'")
    made = taken(rows.withColumn("valor", F.col("valor") + 1), F.col("periodo") < "1997", [True, False], lambda s: jobs.official_first(s, official, ["periodo", "slug"]))
    return made.select("periodo", "slug", "valor", "provisional")


@query("x11_stream_side_log", f"WITH {TICK} SELECT event_type, count(*) AS n FROM tick GROUP BY 1")
def x11(spark, sf_dir):
    """The log fails in every batch; the rows are written all the same."""
    target = shared_folder(spark, "main")

    def log(batch: DataFrame, n: int) -> None:
        raise OSError("the log is full")

    jobs.with_side_log(ticks(spark, sf_dir), lambda batch, n: batch.write.mode("overwrite").parquet(f"{target}/n={n}"), log, shared_folder(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(target).groupBy("event_type").agg(F.count("*").alias("n"))
