"""Queries over bonds: every supplier has issued one, its deliveries are the trades, and the daily rate makes the curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import RATE, rate
from ..operators import bonds as op
from ..registry import query
from ..session import table

TERMS = """terms AS (SELECT s_suppkey AS k, 'B' || s_suppkey AS bond, make_date(CAST(1990 + s_suppkey % 6 AS INTEGER), CAST(1 + s_suppkey % 12 AS INTEGER), CAST(1 + s_suppkey % 28 AS INTEGER)) AS issue,
 2.0 :: DOUBLE + s_nationkey * 0.25 :: DOUBLE AS base, s_suppkey % 3 = 0 AS steps, s_suppkey % 4 = 0 AS amortises, CAST(round(s_acctbal * 100) AS BIGINT) AS amount FROM supplier),
 dated AS (SELECT *, CAST(issue + to_months(CAST(60 + 12 * (k % 8) AS INTEGER)) AS DATE) AS maturity FROM terms),
 flows AS (SELECT d.*, CAST(maturity - to_months(CAST(6 * r.i AS INTEGER)) AS DATE) AS pay_day FROM dated d, range(0, 40) r(i) WHERE maturity - to_months(CAST(6 * r.i AS INTEGER)) > issue),
 paid AS (SELECT bond, k, amount, issue, maturity, pay_day, CASE WHEN amortises AND pay_day > maturity - to_months(12) THEN 0.5 :: DOUBLE ELSE 1.0 :: DOUBLE END * (base + CASE WHEN steps AND pay_day > issue + to_months(36) THEN 1.0 :: DOUBLE ELSE 0.0 :: DOUBLE END) / 100 * 0.5 :: DOUBLE * 100 AS coupon,
  CASE WHEN amortises AND pay_day >= maturity - to_months(12) AND (pay_day = maturity OR pay_day = maturity - to_months(12)) THEN 50.0 :: DOUBLE WHEN NOT amortises AND pay_day = maturity THEN 100.0 :: DOUBLE ELSE 0.0 :: DOUBLE END AS principal FROM flows)"""
DAYS_360 = "((year({b}) - year({a})) * 360 + (month({b}) - month({a})) * 30 + CASE WHEN least(day({a}), 30) = 30 AND day({b}) = 31 THEN 30 ELSE day({b}) END - least(day({a}), 30))"
TRADES = TERMS + """, trades AS (SELECT DISTINCT 'B' || l_suppkey AS bond, CAST(l_shipdate AS DATE) AS settle, CAST(l_quantity AS BIGINT) AS q FROM lineitem JOIN dated ON k = l_suppkey WHERE issue <= CAST(l_shipdate AS DATE) AND CAST(l_shipdate AS DATE) < maturity),
 ahead AS (SELECT t.bond, settle, q, list({'t': """ + DAYS_360.format(a="settle", b="pay_day") + """ / 180.0 :: DOUBLE, 'total': coupon + principal, 'principal': principal} ORDER BY pay_day) AS fl FROM trades t JOIN paid p ON p.bond = t.bond AND pay_day > settle GROUP BY ALL)"""
PV = "list_sum(list_transform(fl, lambda f: f.total / pow(1 + ({y}) / 2, f.t)))"


def terms(spark, sf_dir):
    """One bond of each supplier: some step up after three years, some repay half a year before the end."""
    s = table(spark, sf_dir, "supplier").withColumn("issue", F.expr("make_date(1990 + s_suppkey % 6, 1 + s_suppkey % 12, 1 + s_suppkey % 28)"))
    s = s.withColumn("maturity", F.expr("add_months(issue, CAST(60 + 12 * (s_suppkey % 8) AS INT))"))
    base = F.lit(2.0) + F.col("s_nationkey") * 0.25
    step = lambda since, r: F.struct(since.alias("since"), r.alias("rate"))
    steps = F.when(F.col("s_suppkey") % 3 == 0, F.array(step(F.col("issue"), base), step(F.add_months("issue", 36), base + 1))).otherwise(F.array(step(F.col("issue"), base)))
    half = lambda day: F.struct(day.alias("day"), F.lit(0.5).alias("share"))
    repaid = F.when(F.col("s_suppkey") % 4 == 0, F.array(half(F.add_months("maturity", -12)), half(F.col("maturity"))))
    return s.select(F.concat(F.lit("B"), F.col("s_suppkey")).alias("bond"), "issue", "maturity", F.lit(6).alias("months"), steps.alias("steps"), repaid.alias("repaid"), F.round(F.col("s_acctbal") * 100).cast("long").alias("amount"))


def trades(spark, sf_dir):
    """bond, settle, q: the different deliveries while the supplier's bond is out."""
    rows = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("B"), F.col("l_suppkey")).alias("bond"), F.to_date("l_shipdate").alias("settle"), F.col("l_quantity").cast("long").alias("q"))
    # by bond, as the joins with terms and flows need them: one shuffle of narrow rows
    return op.dealt_out(rows, "bond").distinct().join(terms(spark, sf_dir).select("bond", "issue", "maturity"), "bond").where("issue <= settle AND settle < maturity").select("bond", "settle", "q")


def curves(spark, sf_dir):
    """fecha, par: tenors of 1, 2, 5, 10 and 30 years."""
    y = F.lit(2.0) + (F.col("rate") % 100) / 100
    return rate(spark, sf_dir).select("fecha", F.array(*[F.struct(F.lit(float(t)).alias("t"), (y + 0.05 * t).alias("y")) for t in (1, 2, 5, 10, 30)]).alias("par"))


@query("m21_cashflows", f"WITH {TERMS} SELECT bond, pay_day, round(coupon, 8) AS coupon, principal FROM paid")
def m21(spark, sf_dir):
    return op.cashflows(terms(spark, sf_dir)).withColumn("coupon", F.round("coupon", 8))


@query("m22_accrued", f"""WITH {TRADES}, x AS (SELECT t.bond, t.settle, q, d.issue, max(CASE WHEN p.pay_day <= t.settle THEN p.pay_day END) AS last, min(CASE WHEN p.pay_day > t.settle THEN p.pay_day END) AS following, any_value(d.base) AS base, any_value(d.steps) AS steps, any_value(d.amortises) AS amortises, any_value(d.maturity) AS maturity
 FROM trades t JOIN dated d USING (bond) JOIN paid p USING (bond) GROUP BY t.bond, t.settle, q, d.issue), y AS (SELECT *, coalesce(last, issue) AS start FROM x)
SELECT bond, settle, q, round(CASE WHEN amortises AND settle >= maturity - to_months(12) THEN 0.5 :: DOUBLE ELSE 1.0 :: DOUBLE END * (base + CASE WHEN steps AND following > issue + to_months(36) THEN 1.0 :: DOUBLE ELSE 0.0 :: DOUBLE END) / 100 * ({DAYS_360.format(a="start", b="settle")} / 360.0 :: DOUBLE) * 100, 8) AS accrued FROM y""")
def m22(spark, sf_dir):
    return op.accrued(terms(spark, sf_dir), trades(spark, sf_dir)).withColumn("accrued", F.round("accrued", 8))


def with_flows(spark, sf_dir):
    return trades(spark, sf_dir).join(op.flows_of(op.cashflows(terms(spark, sf_dir))), "bond")


@query("m23_price_of_yield", f"WITH {TRADES} SELECT bond, settle, q, round({PV.format(y='q / 500.0 :: DOUBLE')}, 6) AS dirty FROM ahead")
def m23(spark, sf_dir):
    price = op.present_value(F.col("q") / 500)
    return with_flows(spark, sf_dir).select("bond", "settle", "q", F.round(price, 6).alias("dirty"))


@query("m24_yield_of_price", f"""WITH RECURSIVE {TRADES}, b AS (SELECT bond, settle, q, fl, 60.0 :: DOUBLE + q AS dirty, -0.5 :: DOUBLE AS lo, 5.0 :: DOUBLE AS hi, 0 AS i FROM ahead
 UNION ALL SELECT bond, settle, q, fl, dirty, CASE WHEN {PV.format(y='(lo + hi) / 2')} > dirty THEN (lo + hi) / 2 ELSE lo END, CASE WHEN {PV.format(y='(lo + hi) / 2')} > dirty THEN hi ELSE (lo + hi) / 2 END, i + 1 FROM b WHERE i < 60),
 s AS (SELECT *, (lo + hi) / 2 AS y FROM b WHERE i = 60)
SELECT bond, settle, q, round(y, 7) AS ytm, round(list_sum(list_transform(fl, lambda f: f.total / pow(1 + y / 2, f.t) * f.t / 2)) / list_sum(list_transform(fl, lambda f: f.total / pow(1 + y / 2, f.t))), 6) AS duration,
 round(list_sum(list_transform(fl, lambda f: f.principal * f.t / 2)) / nullif(list_sum(list_transform(fl, lambda f: f.principal)), 0), 6) AS life FROM s""")
def m24(spark, sf_dir):
    rows = op.yields(with_flows(spark, sf_dir).withColumn("dirty", F.lit(60.0) + F.col("q")))
    return rows.select("bond", "settle", "q", F.round("ytm", 7).alias("ytm"), F.round("duration", 6).alias("duration"), F.round("life", 6).alias("life"))


PAR = RATE + ", par AS (SELECT fecha, 2.0 :: DOUBLE + (rate % 100) / 100.0 :: DOUBLE AS a FROM rate)"
CURVES = PAR + """, boot AS (SELECT fecha, a, 0 AS k, 0.0 :: DOUBLE AS s, 0.0 :: DOUBLE AS df FROM par UNION ALL SELECT fecha, a, k + 1, s + (1 - p * s) / (1 + p), (1 - p * s) / (1 + p) FROM (SELECT *, (a + 0.05 :: DOUBLE * least(greatest((k + 1) / 2.0 :: DOUBLE, 1), 30)) / 200 AS p FROM boot WHERE k < 80))"""


@query("m25_zero_curves", f"WITH RECURSIVE {CURVES} SELECT fecha, k / 2.0 :: DOUBLE AS t, round(2 * (pow(df, -1.0 :: DOUBLE / k) - 1), 8) AS z FROM boot WHERE k > 0")
def m25(spark, sf_dir):
    rows = op.zero_curves(curves(spark, sf_dir)).select("fecha", F.inline("zero"))
    return rows.select("fecha", "t", F.round("z", 8).alias("z"))


@query("f28_interpolated", f"WITH {PAR} SELECT fecha, round(a + 0.05 :: DOUBLE * least(greatest((CAST(rate AS BIGINT) % 370) / 10.0 :: DOUBLE, 1), 30), 8) AS y FROM par JOIN rate USING (fecha)")
def f28(spark, sf_dir):
    t = (F.col("rate") % 370) / 10
    return curves(spark, sf_dir).join(rate(spark, sf_dir), "fecha").select("fecha", F.round(op.interpolated(F.col("par"), t), 8).alias("y"))


def priced(spark, sf_dir):
    """The trades on days with a curve, at a price of 60 and the quantity."""
    zero = op.zero_curves(curves(spark, sf_dir)).withColumnRenamed("fecha", "settle")
    rows = with_flows(spark, sf_dir).join(F.broadcast(zero), "settle")  # a row for each day of the calendar
    return rows.withColumn("dirty", F.lit(60.0) + F.col("q"))


@query("m26_z_spreads")
def m26(spark, sf_dir):
    return op.z_spreads(priced(spark, sf_dir)).select("bond", "settle", "q", F.round("z_spread", 6).alias("z_spread"))


@query("a25_market_value_mean", f"WITH {TRADES}, p AS (SELECT DISTINCT t.settle, t.bond, q, amount, 60.0 :: DOUBLE + q AS dirty FROM trades t JOIN dated USING (bond)) SELECT settle, count(*) AS n, round(sum(amount * dirty / 100 * q) / nullif(sum(amount * dirty / 100), 0), 6) AS q FROM p GROUP BY settle")
def a25(spark, sf_dir):
    rows = trades(spark, sf_dir).join(terms(spark, sf_dir).select("bond", "amount"), "bond").withColumn("dirty", F.lit(60.0) + F.col("q"))
    return op.market_value_mean(rows, "q", "settle").withColumn("q", F.round("q", 6))


@query("m27_spread_history")
def m27(spark, sf_dir):
    days = rate(spark, sf_dir).select("fecha", (F.lit(200.0) + F.col("rate") % 400).alias("market_bp"))
    return op.spread_history(terms(spark, sf_dir), days, curves(spark, sf_dir), "1996-06-24", 434.0).withColumn("spread_bp", F.round("spread_bp", 1))


@query("a41_debt_service", f"""WITH {TERMS}, s AS (SELECT CAST(year(pay_day) AS INTEGER) AS year, bond, sum((coupon + principal) * amount / 100) AS paid FROM paid GROUP BY ALL), t AS (SELECT year, sum(paid) AS paid FROM s GROUP BY 1)
SELECT year, bond, round(paid, 6) AS paid, false AS peak FROM s UNION ALL SELECT year, NULL, round(paid, 6), row_number() OVER (ORDER BY paid DESC, year) = 1 FROM t""")
def a41(spark, sf_dir):
    return op.debt_service(terms(spark, sf_dir)).withColumn("paid", F.round("paid", 6))


@query("m31_spread_checks", f"WITH {RATE}, r AS (SELECT fecha, CAST(rate % 40 AS DOUBLE) / 4 AS own, CASE WHEN rate % 11 <> 0 THEN CAST(rate % 28 AS DOUBLE) / 4 END AS pub FROM rate), g AS (SELECT fecha, own - pub - 1.5 :: DOUBLE AS gap_bp FROM r) SELECT fecha, gap_bp, CASE WHEN gap_bp IS NULL THEN 'missing' WHEN abs(gap_bp) > 5 THEN 'fail' WHEN abs(gap_bp) > 2 THEN 'warn' ELSE 'ok' END AS verdict FROM g")
def m31(spark, sf_dir):
    rows = rate(spark, sf_dir).select("fecha", ((F.col("rate") % 40) / 4).alias("own_bp"), F.when(F.col("rate") % 11 != 0, (F.col("rate") % 28) / 4).alias("published_bp"))
    return op.spread_checks(rows, F.lit(1.5)).select("fecha", "gap_bp", "verdict")
