"""Queries that write files below the shared folder from the given tables and read them back, and those on outputs and guards."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..bindings import MACRO, NOTE, RATE, TICK, TRADE, macro, note, rate, tick, trade
from ..registry import query
from ..session import table
from ..sources import documents as docs
from ..sources import sinks
from ..sources.folders import shared_folder
from ..sources.snapshots import SnapshotTable, bad_files, failed_pages, flatten, one_per_stem, listed, read_documents

#: Orders of one document: with the month and the quarter they bound its size at any scale.
ORDERS = 20_000
#: Documents of one Arrow batch on their way to the files, some 30 KB each.
DOCUMENTS = 256
STEM = f"strftime(l_shipdate, '%Y%m01') || 'T' || l_orderkey % 4 || '-' || l_orderkey // {ORDERS}"
GOOD = "strftime(l_shipdate, '%Y') >= '1993' AND l_linenumber <> 7"


def snapshot_files(spark, sf_dir, root: str, odd_only: bool = False, plus: int = 0, where: str = "true") -> None:
    """One file for each month and quarter of a block of ORDERS orders: .json.gz for even quarters and the second root, else .json.

    Ads of line 7 are a page that failed, the sizes of line 6 are no numbers, and months before 1993 have another version.
    """
    lines = table(spark, sf_dir, "lineitem").where(where)
    ad = F.struct(
        F.col("l_orderkey").alias("ad_id"), F.col("l_linenumber").alias("line"), F.expr("CAST(round(l_extendedprice * 100) AS BIGINT)").alias("price4"),
        F.when(F.col("l_linenumber") == 6, "n/a").otherwise((F.col("l_quantity") + plus).cast("long").cast("string")).alias("size"), F.col("l_suppkey").alias("trader"),
        F.array(F.struct(F.concat(F.lit("B"), F.col("l_suppkey") % 3).alias("identifier")), F.struct(F.lit("").alias("identifier"))).alias("banks"),
    )
    stem = F.concat(F.date_format("l_shipdate", "yyyyMM01"), F.lit("T"), F.col("l_orderkey") % 4, F.lit("-"), F.expr(f"l_orderkey DIV {ORDERS}"))
    side = F.when(F.col("l_linestatus") == "O", "BUY").otherwise("SELL")
    pages = lines.groupBy(stem.alias("stem"), side.alias("side"), F.col("l_linenumber").cast("long").alias("page")).agg(F.collect_list(ad).alias("data"))
    page = F.struct("page", F.when(F.col("page") == 7, "timeout").alias("error"), F.when(F.col("page") != 7, F.struct("data")).alias("response"))
    sides = pages.groupBy("stem", "side").agg(F.struct(F.collect_list(page).alias("pages")).alias("content"))
    made = sides.groupBy("stem").agg(F.map_from_entries(F.collect_list(F.struct("side", "content"))).alias("sides"))
    version = F.when(F.substring("stem", 1, 4) < "1993", "v0").otherwise("v1")
    text = F.to_json(F.struct(version.alias("schema_version"), F.concat(F.col("stem"), F.lit("Z")).alias("captured_at"), "sides"))
    rows = made.select("stem", text.alias("text"), F.lit(odd_only).alias("second"))
    rows = rows.where("substring(stem, 10, 1) IN ('1', '3')") if odd_only else rows

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(root)
        for frame in frames:
            for name, body, second in zip(frame["stem"], frame["text"], frame["second"], strict=True):
                packed = second or name[9] in "02"
                store.create_dir(f"{folder}/{name[:4]}")
                with store.open_output_stream(f"{folder}/{name[:4]}/{name}.json{'.gz' if packed else ''}", compression=None) as out:
                    out.write(gzip.compress(body.encode(), mtime=0) if packed else body.encode())
            yield frame[["stem"]]

    # a batch of documents is what a worker holds; the setting is read when the job runs, and only ever lowered
    most = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(most)) <= DOCUMENTS:
        spark.conf.set(most, str(DOCUMENTS))
    if not rows.mapInPandas(write, "stem string").count():
        raise ValueError("no snapshots were written")


def broken_file(root: str) -> None:
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(root)
    store.create_dir(folder)
    with store.open_output_stream(f"{folder}/19921201T9.json", compression=None) as out:
        out.write(b'{"schema_version": "v1", "sides": {"BUY": ')


def by_stem(rows: DataFrame) -> DataFrame:
    return rows.groupBy("stem").agg(F.count("*").alias("n"), F.sum("size").alias("depth"), F.sum(F.size("banks")).alias("n_banks"))


PLUS = "CASE WHEN l_orderkey % 2 = 1 THEN 1 ELSE 0 END"
BY_STEM = f"SELECT {STEM} AS stem, count(*) AS n, CAST(sum(CASE WHEN l_linenumber <> 6 THEN l_quantity + {PLUS} END) AS BIGINT) AS depth, count(*) AS n_banks FROM lineitem WHERE {GOOD} GROUP BY 1"


@query("s01_snapshot_files", BY_STEM)
def s01(spark, sf_dir):
    """Of the odd quarters the second root has .json.gz files, with sizes one larger, which win (S02); S03 and S04 too."""
    first, second, target = (shared_folder(spark, n) for n in ("snapshots-a", "snapshots-b", "ads"))
    snapshot_files(spark, sf_dir, first)
    snapshot_files(spark, sf_dir, second, odd_only=True, plus=1)
    tables = SnapshotTable(spark, [first, second], target)
    tables.rebuild()
    tables.rebuild()  # S07: the same again
    return by_stem(tables.rows())


@query("s02_one_file_a_stem", f"SELECT DISTINCT {STEM} AS stem, CAST(l_orderkey % 2 AS INTEGER) AS root, '.json.gz' AS ext FROM lineitem")
def s02(spark, sf_dir):
    first, second = (shared_folder(spark, n) for n in ("snapshots-a", "snapshots-b"))
    snapshot_files(spark, sf_dir, first)
    snapshot_files(spark, sf_dir, second, odd_only=True)
    return one_per_stem(listed(spark, [first, second])).select("stem", "root", F.regexp_extract("path", r"(\.json(\.gz)?)$", 1).alias("ext"))


@query("s04_failed_pages", f"SELECT DISTINCT {STEM} AS stem, CASE WHEN l_linestatus = 'O' THEN 'BUY' ELSE 'SELL' END AS side, CAST(7 AS BIGINT) AS page, 'timeout' AS error FROM lineitem WHERE l_linenumber = 7")
def s04(spark, sf_dir):
    root = shared_folder(spark, "snapshots")
    snapshot_files(spark, sf_dir, root)
    return failed_pages(read_documents(spark, [root]))


@query("p01_flatten_snapshots", f"SELECT {STEM} AS stem, CASE WHEN l_linestatus = 'O' THEN 'BUY' ELSE 'SELL' END AS side, count(*) AS n, CAST(sum(CASE WHEN l_linenumber <> 6 THEN l_quantity END) AS BIGINT) AS depth, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS prices FROM lineitem WHERE {GOOD} GROUP BY ALL")
def p01(spark, sf_dir):
    root = shared_folder(spark, "snapshots")
    snapshot_files(spark, sf_dir, root)
    ads = flatten(read_documents(spark, [root]))
    return ads.groupBy("stem", "side").agg(F.count("*").alias("n"), F.sum("size").alias("depth"), F.sum("price4").alias("prices"))


@query("p03_bank_ids", f"SELECT {STEM} AS stem, 'B' || l_suppkey % 3 AS bank, count(*) AS n FROM lineitem WHERE {GOOD} GROUP BY ALL")
def p03(spark, sf_dir):
    root = shared_folder(spark, "snapshots")
    snapshot_files(spark, sf_dir, root)
    ads = flatten(read_documents(spark, [root]))
    return ads.select("stem", F.explode("banks").alias("bank")).groupBy("stem", "bank").agg(F.count("*").alias("n"))


@query("s05_bad_files", f"SELECT count(DISTINCT {STEM}) + 1 AS n_files, CAST(1 AS BIGINT) AS n_bad, (SELECT count(*) FROM lineitem WHERE {GOOD}) AS n_rows FROM lineitem")
def s05(spark, sf_dir):
    root = shared_folder(spark, "snapshots")
    snapshot_files(spark, sf_dir, root)
    broken_file(root)
    read = read_documents(spark, [root])
    return bad_files(read).crossJoin(flatten(read).agg(F.count("*").alias("n_rows")))  # one row each


@query("s06_incremental_load", f"SELECT stem, n, depth, n_banks FROM ({BY_STEM.replace('CASE WHEN l_orderkey % 2 = 1 THEN 1 ELSE 0 END', '0')}) UNION ALL SELECT 'state', count(DISTINCT {STEM}), NULL, NULL FROM lineitem WHERE strftime(l_shipdate, '%Y') >= '1997'")
def s06(spark, sf_dir):
    """Files before 1997, then those that come later: the row `state` has the number of files of the second load."""
    root, target = shared_folder(spark, "snapshots"), shared_folder(spark, "ads")
    snapshot_files(spark, sf_dir, root, where="year(l_shipdate) < 1997")
    tables = SnapshotTable(spark, [root], target)
    tables.rebuild()
    snapshot_files(spark, sf_dir, root, where="year(l_shipdate) >= 1997")
    load = tables.load_new()
    rows = by_stem(tables.rows().withColumn("stem", F.col("stem").cast("string")))
    return rows.unionByName(spark.createDataFrame([("state", load.files, None, None)], "stem string, n long, depth long, n_banks long"))


@query("s08_reload_since", f"WITH f AS (SELECT DISTINCT {STEM} AS stem FROM lineitem) SELECT max(stem) AS watermark, count(*) FILTER (stem >= '19980101') AS files, (SELECT count(*) FROM lineitem WHERE {GOOD}) AS n_rows, (SELECT count(DISTINCT {STEM}) FROM lineitem WHERE {GOOD}) AS snapshots, CAST(0 AS BIGINT) AS pending FROM f")
def s08(spark, sf_dir):
    root, target = shared_folder(spark, "snapshots"), shared_folder(spark, "ads")
    snapshot_files(spark, sf_dir, root)
    tables = SnapshotTable(spark, [root], target)
    tables.rebuild()
    load = tables.reload_since("1998-01-01")
    state = tables.status()
    return spark.createDataFrame([(load.watermark, load.files, state["rows"], state["snapshots"], state["pending"])], "watermark string, files long, n_rows long, snapshots long, pending long")


def rate_lines(spark, sf_dir, root: str) -> None:
    """A report for each day: detail lines of two prices, a published line, and a total that is none."""
    days = rate(spark, sf_dir).select("fecha", (F.col("rate") % 900).alias("k"))
    day = F.date_format("fecha", "dd/MM/yyyy")
    number = lambda cents: F.concat((cents / 100).cast("int"), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))
    line = lambda label, price, amount: F.concat_ws(";", F.lit("x"), day, label, price, amount)
    p = F.col("k") + 500
    lines = F.array(line(F.lit("bid"), number(p), F.lit("1.000,00")), line(F.lit("ask"), number(p + 10), F.lit("3.000,00")), line(F.lit("TCO"), number(p + 8), F.lit("")), line(F.lit("TOTAL"), F.lit(""), F.lit("4.000,00")))
    days.select(F.explode(lines).alias("value")).write.text(root)


@query("s13_rate_reports", f"WITH {RATE} SELECT fecha, round((rate % 900 + 508) / 100.0 :: DOUBLE, 4) AS published, round((rate % 900 + 500 + (rate % 900 + 510) * 3) / 400.0 :: DOUBLE, 4) AS recomputed FROM rate WHERE rate % 900 + 508 BETWEEN 400 AND 3000")
def s13(spark, sf_dir):
    root = shared_folder(spark, "reports")
    rate_lines(spark, sf_dir, root)
    lines = docs.fields(spark, root, ";", 5)
    detail = lines.where("c2 IN ('bid', 'ask')")
    published = docs.published_rates(lines, "c2", "c1", "c3", "TCO").withColumnRenamed("rate", "published")
    both = published.join(docs.recomputed_rates(detail, "c1", "c3", "c4").withColumnRenamed("rate", "recomputed"), "fecha")
    return both.select("fecha", F.round("published", 4).alias("published"), F.round("recomputed", 4).alias("recomputed"))


@query("s14_incident_file", "SELECT c_custkey AS id, round(-10 - c_custkey / 1000.0 :: DOUBLE, 5) AS lat, round(-60 - c_nationkey / 10.0 :: DOUBLE, 5) AS lon FROM customer WHERE c_custkey % 5 <> 0")
def s14(spark, sf_dir):
    root = shared_folder(spark, "incidents")
    k = F.col("c_custkey")
    lat = F.when(k % 5 == 0, F.when(k % 2 == 0, "s/d").otherwise("")).otherwise((F.lit(-10) - k / 1000).cast("string"))
    sinks.write_csv(table(spark, sf_dir, "customer").select(k.alias("id"), lat.alias("lat"), (F.lit(-60) - F.col("c_nationkey") / 10).alias("lon")), root)
    return docs.incident_file(spark, root).select(F.col("id").cast("long").alias("id"), "lat", "lon")


@query("s15_archive", "SELECT doc_id AS id, quality + 1 AS quality FROM labels WHERE doc_id IS NOT NULL")
def s15(spark, sf_dir):
    """Archived twice; the second time counts."""
    root = shared_folder(spark, "archive")
    rows = table(spark, sf_dir, "labels").where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("quality").cast("long").alias("quality"))
    sinks.append_archive(rows, root)
    sinks.append_archive(rows.withColumn("quality", F.col("quality") + 1), root)
    return sinks.read_archive(spark, root, "id long, quality long", ["id"])


@query("s16_csv_outputs", f"WITH {MACRO} SELECT * FROM macro")
def s16(spark, sf_dir):
    root = shared_folder(spark, "csv")
    sinks.write_csv(macro(spark, sf_dir), root)
    return spark.read.schema("periodo string, slug string, valor long").option("header", True).csv(root)


@query("s17_one_document")
def s17(spark, sf_dir):
    rows = macro(spark, sf_dir)
    parts = {"totals": rows.groupBy("periodo").agg(F.sum("valor").alias("valor")), "slugs": rows.groupBy("slug").agg(F.count("*").alias("n"))}
    return sinks.one_document(parts, {"totals": "periodo", "slugs": "slug"}, 5_000_000)


@query("s18_group_shards", f"WITH {TRADE} SELECT label, count(*) AS n, CAST(0 AS BIGINT) AS faults FROM trade GROUP BY label")
def s18(spark, sf_dir):
    """Written twice, first with a group more, whose shard has to go."""
    root = shared_folder(spark, "shards")
    rows = trade(spark, sf_dir).select("label", "fob", "kg")
    sinks.write_shards(rows.withColumn("label", F.lit("GONE")).unionByName(rows), "label", root)
    index = sinks.write_shards(rows, "label", root)
    faults = sinks.shard_faults(index, spark.read.parquet(f"{root}/shards"), "label", F.col("kg") > 0).groupBy("label").agg(F.count("*").alias("faults"))
    return index.join(faults, "label", "left").select("label", "n", F.coalesce("faults", F.lit(0)).alias("faults"))


@query("s19_month_folders", f"WITH {NOTE} SELECT fecha, count(*) AS n FROM note GROUP BY fecha")
def s19(spark, sf_dir):
    root = shared_folder(spark, "months")
    rows = note(spark, sf_dir).select("id", "fecha", "portal")
    sinks.write_months(rows, "fecha", root)
    return sinks.write_months(rows, "fecha", root)


@query("s24_changed_tables", f"WITH {MACRO} SELECT * FROM (VALUES ('macro', true), ('rates', false), ('ticks', true))  t(name, changed) WHERE (SELECT count(*) FROM macro) > 0")
def s24(spark, sf_dir):
    """The macro table gets a month more, ticks are new, the rates stay."""
    m, r = macro(spark, sf_dir), rate(spark, sf_dir)
    t = tick(spark, sf_dir).select(F.to_date("ts").alias("fecha"), "cents")
    before = sinks.state_of({"macro": (m.where("periodo < '1998-01'"), "periodo", "valor"), "rates": (r, "fecha", "rate")})
    now = sinks.state_of({"macro": (m, "periodo", "valor"), "rates": (r, "fecha", "rate"), "ticks": (t, "fecha", "cents")})
    return sinks.changed(now, before)


@query("s24_changed_releases", "SELECT page_id AS key, md5(html || '!') AS digest FROM pages WHERE page_id % 4 = 0")
def s24b(spark, sf_dir):
    """Every fourth page has another body than the one known."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("key"), F.col("html").alias("body"))
    known = pages.select("key", F.md5("body").alias("digest"))
    return sinks.changed_releases(pages.withColumn("body", F.when(F.col("key") % 4 == 0, F.concat("body", F.lit("!"))).otherwise(F.col("body"))), known)


@query("s25_shrink_guard", f"WITH {TICK} SELECT event_type, count(*) FILTER (ts < TIMESTAMP '2024-01-12') AS n_new, count(*) AS n_old, CASE WHEN count(*) FILTER (ts < TIMESTAMP '2024-01-12') < 0.5 * count(*) OR count(*) FILTER (ts < TIMESTAMP '2024-01-12') < 10 THEN 'refused' ELSE 'ok' END AS verdict FROM tick WHERE event_type = 'view' GROUP BY 1")
def s25(spark, sf_dir):
    rows = tick(spark, sf_dir).where("event_type = 'view'")
    return sinks.shrink_guard(rows.where("ts < TIMESTAMP_NTZ '2024-01-12 00:00:00'"), rows, 10, 0.5).select(F.lit("view").alias("event_type"), "n_new", "n_old", "verdict")


@query("x08_archive_and_delete", f"WITH {NOTE} SELECT 'archive' AS fate, id FROM note WHERE (fecha > DATE '2024-01-05' AND fecha <= DATE '2024-02-05' - 20) OR fecha <= DATE '2024-02-05' - 30 UNION ALL SELECT 'kept', id FROM note WHERE fecha > DATE '2024-02-05' - 30 UNION ALL SELECT 'deleted', id FROM note WHERE fecha <= DATE '2024-02-05' - 30")
def x08(spark, sf_dir):
    rows = note(spark, sf_dir).select("id", "fecha")
    parts = zip(("archive", "kept", "deleted"), sinks.archive_and_delete(rows, "2024-01-05", "2024-02-05"), strict=True)
    made = [part.select(F.lit(name).alias("fate"), "id") for name, part in parts]
    return made[0].union(made[1]).union(made[2])
