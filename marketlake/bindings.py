"""The driver tables in the shapes that the operators take, and the same shapes as SQL for the oracles.

Money and sizes are whole numbers (1/10000 and 1/100 of a unit), so that sums don't depend on their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import table


def cents(column: str):
    return F.round(F.col(column) * 100).cast("long")


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order book: snapshot (month), side, price4 (1/10000), size, trader, merchant, ad_id, line."""
    return table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-01").alias("snapshot"),
        F.when(F.col("l_linestatus") == "O", "BUY").otherwise("SELL").alias("side"),
        F.expr("CAST(round(l_extendedprice * 100) AS BIGINT) * 100 DIV CAST(l_quantity AS BIGINT)").alias("price4"),
        F.col("l_quantity").cast("long").alias("size"),
        F.col("l_suppkey").alias("trader"),
        (F.col("l_returnflag") != "N").cast("int").alias("merchant"),
        F.col("l_orderkey").alias("ad_id"),
        F.col("l_linenumber").alias("line"),
    )


BOOK = """book AS (SELECT strftime(l_shipdate, '%Y-%m-01') AS snapshot, CASE WHEN l_linestatus = 'O' THEN 'BUY' ELSE 'SELL' END AS side,
 CAST(round(l_extendedprice * 100) AS BIGINT) * 100 // CAST(l_quantity AS BIGINT) AS price4, CAST(l_quantity AS BIGINT) AS size, l_suppkey AS trader,
 CAST(l_returnflag <> 'N' AS INTEGER) AS merchant, l_orderkey AS ad_id, l_linenumber AS line FROM lineitem)"""


def tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks: event_id, ts, user_id, event_type, cents, props."""
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", cents("value").alias("cents"), "props")


TICK = "tick AS (SELECT event_id, ts, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents, props FROM events)"


def rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series: fecha, rate (mean order price in cents, whole)."""
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("fecha"), cents("o_totalprice").alias("c"))
    return orders.groupBy("fecha").agg(F.expr("sum(c) DIV count(*)").alias("rate"))


RATE = "rate AS (SELECT CAST(o_orderdate AS DATE) AS fecha, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) // count(*) AS BIGINT) AS rate FROM orders GROUP BY 1)"


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly facts: periodo, slug (market segment), valor (order value in cents)."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("periodo"), cents("o_totalprice").alias("c"))
    segments = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lower("c_mktsegment").alias("slug"))
    return orders.join(segments, "o_custkey").groupBy("periodo", "slug").agg(F.sum("c").alias("valor"))


MACRO = """macro AS (SELECT strftime(o_orderdate, '%Y-%m') AS periodo, lower(c_mktsegment) AS slug, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS valor
 FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)"""


def trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade records: month, country, code (10 digits), label, fob (cents), kg."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", cents("l_extendedprice").alias("fob"), F.col("l_quantity").cast("long").alias("kg"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.lpad(F.regexp_extract("p_brand", "([0-9]+)", 1), 10, "0").alias("code"), F.col("p_type").alias("label"))
    # nations are a fixed dimension of 25 rows; the other joins are left to Spark's statistics
    rows = lines.join(orders, "l_orderkey").join(customers, "o_custkey").join(F.broadcast(nations), "n_nationkey").join(parts, "l_partkey")
    return rows.select("month", "country", "code", "label", "fob", "kg")


TRADE = """trade AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, n_name AS country, lpad(regexp_extract(p_brand, '([0-9]+)', 1), 10, '0') AS code, p_type AS label,
 CAST(round(l_extendedprice * 100) AS BIGINT) AS fob, CAST(l_quantity AS BIGINT) AS kg
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey)"""


def note(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News notes: id, fecha, portal, title (first line), body, score (0 to 10, from the length), quality."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 28).cast("int")).alias("fecha"),
        F.col("source").alias("portal"),
        "lang",
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("text").alias("body"),
        (F.col("n_chars") % 101).cast("int").alias("score10"),
        "quality",
    )


NOTE = r"""note AS (SELECT d.doc_id AS id, CAST(DATE '2024-01-01' + CAST(d.doc_id % 28 AS INTEGER) AS DATE) AS fecha, source AS portal, lang, split_part(text, chr(10), 1) AS title, text AS body,
 CAST(n_chars % 101 AS INTEGER) AS score10, quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
