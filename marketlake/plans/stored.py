"""Queries on tables that are replaced atomically: keyed replace, field merge, mirror, file streams into them, retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..bindings import BOOK, NOTE, RATE, book, note, rate
from ..registry import query
from ..session import table
from ..sources.folders import shared_folder
from ..sources.retention import Retention
from ..sources.snapshots import document_stream, flatten
from ..sources.tables import merge_fields
from ..sources.versioned import VersionedTable
from ..streaming import stateful
from .files import GOOD, STEM, by_stem, snapshot_files


@query("s10_versioned_replace", f"WITH {BOOK} SELECT ad_id, line, snapshot, side, price4, size, trader FROM (SELECT *, row_number() OVER (PARTITION BY ad_id, line ORDER BY snapshot DESC, price4 DESC, size DESC, trader DESC, side DESC) AS k FROM book) WHERE k = 1")
def s10(spark, sf_dir):
    """The book up to 1998 as a table, later rows upserted, and one batch of them sent a second time."""
    rows = book(spark, sf_dir).select("ad_id", "line", "snapshot", "side", "price4", "size", "trader")
    stored = VersionedTable(spark, shared_folder(spark, "book"), rows.schema, ["ad_id", "line"], ["snapshot", "price4", "size", "trader", "side"], file_rows=200_000)
    stored.replace(rows.where("snapshot < '1998'"))
    for batch, when in enumerate(("snapshot >= '1998-06'", "snapshot >= '1998' AND snapshot < '1998-06'")):
        for _ in range(2):
            stored.upsert(rows.where(when), once=("book", batch))
    return stored.read()


@query("s12_versioned_merge", f"""WITH {RATE}, o AS (SELECT fecha, CASE WHEN day(fecha) % 5 = 0 THEN NULL ELSE rate END AS compra, rate + 5 AS venta FROM rate WHERE fecha < DATE '1997-01-01'),
 n AS (SELECT fecha, CASE WHEN day(fecha) % 7 = 0 THEN NULL ELSE rate END AS compra, rate + 6 AS venta FROM rate WHERE fecha >= DATE '1996-01-01') SELECT coalesce(o.fecha, n.fecha) AS fecha, coalesce(n.compra, o.compra) AS compra, coalesce(n.venta, o.venta) AS venta FROM o FULL JOIN n ON o.fecha = n.fecha""")
def s12(spark, sf_dir):
    rows = rate(spark, sf_dir)
    stored = VersionedTable(spark, shared_folder(spark, "rates"), "fecha date, compra bigint, venta bigint", ["fecha"], file_rows=365)
    stored.replace(rows.where("fecha < DATE '1997-01-01'").selectExpr("fecha", "if(day(fecha) % 5 = 0, NULL, rate) AS compra", "rate + 5 AS venta"))
    new = rows.where("fecha >= DATE '1996-01-01'").selectExpr("fecha", "if(day(fecha) % 7 = 0, NULL, rate) AS compra", "rate + 6 AS venta")
    stored.upsert(new, lambda old, rows: merge_fields(old, rows, ["fecha"], ["compra", "venta"]).drop("verdict"))
    return stored.read()


@query("s20_versioned_mirror", "SELECT DISTINCT substr(md5(CAST(doc_id AS VARCHAR)), 1, 16) AS id FROM labels WHERE quality = 1")
def s20(spark, sf_dir):
    """All labelled ids, then only those of good quality: nothing of the first version is left."""
    ids = table(spark, sf_dir, "labels").select(F.expr("substr(md5(CAST(doc_id AS STRING)), 1, 16)").alias("id"), "quality")
    mirror = VersionedTable(spark, shared_folder(spark, "mirror"), "id string", ["id"])
    mirror.replace(ids.select("id"))
    mirror.replace(ids.where("quality = 1").select("id"))
    mirror.vacuum()
    return mirror.read()


ADS = f"SELECT {STEM} AS stem, l_linestatus AS side, l_orderkey AS ad_id, l_linenumber AS line, CAST(round(l_extendedprice * 100) AS BIGINT) AS price4, CASE WHEN l_linenumber <> 6 THEN CAST(l_quantity AS BIGINT) END AS size FROM lineitem WHERE {GOOD}"


@query("s06_file_stream", f"SELECT stem, count(*) AS n, CAST(sum(size) AS BIGINT) AS depth, count(*) AS n_banks FROM (SELECT *, row_number() OVER (PARTITION BY stem, side, ad_id, line ORDER BY price4 DESC, size DESC) AS k FROM ({ADS})) WHERE k = 1 GROUP BY stem")
def s06(spark, sf_dir):
    """Files from 1997 on, then older ones, which a watermark would pass over; each file is taken once, and a repeated batch changes nothing."""
    root, checkpoint, names = (shared_folder(spark, n) for n in ("snapshots", "checkpoint", "snapshot-names"))
    ads = VersionedTable(spark, shared_folder(spark, "ads"), "stem string, side string, ad_id long, line int, price4 long, size long, banks array<string>", ["stem", "side", "ad_id", "line"], ["price4", "size"], file_rows=500_000)
    load = stateful.upsert_intake(ads, "snapshots", flatten)
    for where in ("year(l_shipdate) >= 1997", "year(l_shipdate) < 1997"):
        snapshot_files(spark, sf_dir, root, where=where)
        stateful.to_table(document_stream(spark, root, names), load, checkpoint)
    return by_stem(ads.read())


@query("x08_retention_job", f"WITH {NOTE} SELECT 'archive' AS fate, id FROM note WHERE fecha <= DATE '2024-02-05' - 20 UNION ALL SELECT 'kept', id FROM note WHERE fecha > DATE '2024-02-05' - 30")
def x08(spark, sf_dir):
    """Retention as of three days: what is deleted was archived before."""
    rows = note(spark, sf_dir).select("fecha", "id")
    stored, archive = (VersionedTable(spark, shared_folder(spark, n), rows.schema, ["fecha", "id"], file_rows=100_000) for n in ("notes", "archive"))
    stored.replace(rows)
    job = Retention(stored, archive)
    for day in (dt.date(2024, 1, 25), dt.date(2024, 2, 5), dt.date(2024, 2, 5)):
        job.run(day)
    return archive.read().select(F.lit("archive").alias("fate"), "id").union(stored.read().select(F.lit("kept").alias("fate"), "id"))
