"""Bond operators over tables of bonds and dates: cash flows, accrued interest, prices, yields, curves, spreads.

terms has bond, issue, maturity, months (between coupons), steps (array of (since, rate): coupon rates in per cent, in force
after `since`) and repaid (array of (day, share of the face); NULL for a bullet). All arrays are a bond's terms or a curve's
tenors, a few dozen entries. Prices and solvers take Arrow batches of rows and work on all their cash flows at once
(pricing.py), in the partitions that Spark has made.

Rates are decimals with semiannual compounding unless said otherwise; days are counted 30/360.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import pricing


def days_30_360(a: Column, b: Column) -> Column:
    """Days from a to b; the 31st counts as the 30th at the start, and at the end if the start is a month's end."""
    start = F.least(F.dayofmonth(a), F.lit(30))
    end = F.when((start == 30) & (F.dayofmonth(b) == 31), 30).otherwise(F.dayofmonth(b))
    return (F.year(b) - F.year(a)) * 360 + (F.month(b) - F.month(a)) * 30 + end - start


def semi_to_annual(y: Column) -> Column:
    return F.pow(1 + y / 2, 2) - 1


def annual_to_semi(y: Column) -> Column:
    return 2 * (F.sqrt(1 + y) - 1)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _repaid() -> Column:
    """The repayments, those of a bullet included."""
    bullet = F.array(F.struct(F.col("maturity").alias("day"), F.lit(1.0).alias("share")))
    return F.coalesce("repaid", bullet)


def coupon_days(terms: DataFrame) -> DataFrame:
    """terms with days: the coupon days from maturity back to the issue, ascending, each a step before the one after it."""
    n = F.ceil(F.months_between("maturity", "issue") / F.col("months")).cast("int") + 1
    back = lambda acc, _: F.concat(acc, F.array(F.add_months(F.element_at(acc, -1), -F.col("months"))))
    days = F.aggregate(F.sequence(F.lit(1), n), F.array("maturity"), back)
    return terms.withColumn("days", F.array_sort(F.filter(days, lambda d: d > F.col("issue"))))


def rate_on(day: Column) -> Column:
    """The coupon rate in force on a day: of the last step before it, else of the first."""
    steps = F.array_sort("steps")
    return F.aggregate(steps, F.element_at(steps, 1)["rate"], lambda acc, s: F.when(day > s["since"], s["rate"]).otherwise(acc))


def cashflows(terms: DataFrame) -> DataFrame:
    """bond, pay_day, coupon, principal per 100 of face; a bond whose principal doesn't add up to 100 is an error."""
    rows = coupon_days(terms).withColumn("back", _repaid())
    shares = lambda keep: _total(F.transform(F.filter("back", lambda a: F.array_contains("days", a["day"]) & keep(a["day"])), lambda a: a["share"]))
    rows = rows.withColumn("all", shares(lambda _: F.lit(True)))
    wrong = F.raise_error(F.format_string("principal of %s doesn't add up to 100", F.col("bond")))
    rows = rows.withColumn("bond", F.when(F.abs(F.col("all") - 1) < 1e-8, F.col("bond")).otherwise(wrong))
    rows = rows.select("bond", "months", "steps", "back", "days", F.explode("days").alias("pay_day"))
    day = F.col("pay_day")
    left = 1 - shares(lambda d: d < day)
    coupon = left * rate_on(day) / 100 * (F.col("months") / 12) * 100
    return rows.select("bond", "pay_day", coupon.alias("coupon"), (shares(lambda d: d == day) * 100).alias("principal"))


def accrued(terms: DataFrame, positions: DataFrame) -> DataFrame:
    """positions (bond, settle) with accrued: interest since the last coupon day on what is outstanding, per 100 of face."""
    rows = positions.join(coupon_days(terms).withColumn("back", _repaid()), "bond")
    settle = F.col("settle")
    last = F.coalesce(F.array_max(F.filter("days", lambda d: d <= settle)), F.col("issue"))
    following = F.coalesce(F.array_min(F.filter("days", lambda d: d > settle)), F.array_max("days"))
    left = 1 - _total(F.transform(F.filter("back", lambda a: a["day"] <= settle), lambda a: a["share"]))
    value = left * rate_on(following) / 100 * (days_30_360(last, settle) / 360) * 100
    return rows.select(*[positions[c] for c in positions.columns], value.alias("accrued"))


def flows_of(flows: DataFrame) -> DataFrame:
    """bond, flows: the cash flows of each bond as one array, by pay day."""
    return flows.groupBy("bond").agg(F.array_sort(F.collect_list(F.struct("pay_day", "coupon", "principal"))).alias("flows"))


def dealt_out(rows: DataFrame, *keys: str) -> DataFrame:
    """rows over all shuffle partitions: a solver takes far more time a row than its few bytes let adaptive execution expect.

    Deal narrow rows, before cash flows and curves are joined to them: those are a hundred times as wide.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def present_value(y: Column) -> Column:
    """Value of the flows after settle (columns flows, settle) at one yield: the dirty price."""
    return pricing.price()("flows", "settle", y)


def yields(priced: DataFrame) -> DataFrame:
    """priced (flows, settle, dirty, ...) with ytm, duration (years) and life (years): NULL where no flow is to come."""
    rows = priced.withColumn("__solved", pricing.yields()("flows", "settle", F.col("dirty").cast("double")))
    return rows.select(*[rows[c] for c in priced.columns], "__solved.ytm", "__solved.duration", "__solved.life")


def interpolated(points: Column, t: Column, x: str = "t", y: str = "y") -> Column:
    """Value at t on the line through points (x, y), flat beyond the ends."""
    line = F.array_sort(points)
    first, last = F.element_at(line, 1), F.element_at(line, -1)
    below = F.element_at(F.filter(line, lambda p: p[x] <= t), -1)
    above = F.element_at(F.filter(line, lambda p: p[x] > t), 1)
    between = below[y] + (t - below[x]) / (above[x] - below[x]) * (above[y] - below[y])
    return F.when(t <= first[x], first[y]).when(t >= last[x], last[y]).otherwise(between)


def zero_curves(curves: DataFrame, years: int = 40) -> DataFrame:
    """fecha, zero: array of (t, z) on half years, bootstrapped from par curves (fecha, par: array of (t, y in per cent))."""
    return curves.select("fecha", pricing.zero(2 * years)("par").alias("zero"))


def z_spreads(priced: DataFrame) -> DataFrame:
    """priced (flows, settle, dirty, zero) with z_spread: what is added to the zero curve to meet the dirty price."""
    return priced.withColumn("z_spread", pricing.z_spread()("flows", "settle", F.col("dirty").cast("double"), F.col("zero")["z"]))


def outstanding(terms: DataFrame, days: DataFrame, settle_days: int = 2) -> DataFrame:
    """days (fecha, ...) x bonds that are out then: settle is `settle_days` after fecha, issue <= settle < maturity.

    A bond is listed under each of its months, so that the join is by equality; the days, one row for each of the calendar, go to
    the bonds, which stay where they are.
    """
    month = lambda c: F.trunc(c, "month")
    listed = terms.withColumn("__month", F.explode(F.sequence(month("issue"), month("maturity"), F.expr("INTERVAL 1 MONTH"))))
    dated = days.withColumn("settle", F.date_add("fecha", settle_days)).withColumn("__month", month("settle"))
    return listed.join(F.broadcast(dated), "__month").where("issue <= settle AND settle < maturity").drop("__month")


def market_value_mean(rows: DataFrame, value: str, by: str = "fecha") -> DataFrame:
    """by, n and the mean of value weighted by market value (amount * dirty / 100)."""
    mv = F.col("amount") * F.col("dirty") / 100
    return rows.where("dirty > 0").groupBy(by).agg(F.count("*").alias("n"), (F.sum(mv * F.col(value)) / F.nullif(F.sum(mv), F.lit(0.0))).alias(value))


def spread_history(terms: DataFrame, days: DataFrame, curves: DataFrame, anchor_day: str | None = None, anchor_bp: float | None = None) -> DataFrame:
    """fecha, n, spread_bp: on each day (fecha, market_bp) with a curve (fecha, par), the mean Z-spread of the bonds out then.

    The market's yield stands for prices: the par rate at the time to maturity and the market's spread. With an anchor the
    whole series is shifted to meet it on the nearest day, the earlier of two.
    """
    flows = terms.select("bond", "issue", "maturity", "amount").join(flows_of(cashflows(terms)), "bond")
    # bonds with the same flows have the same price and spread on every day: solved once, weighted by all their amounts
    alike = flows.groupBy("issue", "maturity", "flows").agg(F.count("*").alias("bonds"), F.sum("amount").alias("amount"))
    calendar = days.join(curves, "fecha").join(zero_curves(curves), "fecha")
    rows = outstanding(dealt_out(alike), calendar)
    years = days_30_360(F.col("settle"), F.col("maturity")) / 360
    market = pricing.line()("par", years) / 100 + F.col("market_bp") / 10000
    rows = rows.withColumn("dirty", present_value(market)).where("dirty > 0")
    mv = F.col("amount") * F.col("dirty") / 100
    mean = F.sum(mv * F.col("z_spread")) / F.nullif(F.sum(mv), F.lit(0.0))
    means = z_spreads(rows).groupBy("fecha").agg(F.sum("bonds").alias("n"), (mean * 10000).alias("spread_bp"))
    if anchor_day is None:
        return means
    near = F.struct(F.abs(F.datediff("fecha", F.lit(anchor_day).cast("date"))), F.col("fecha"))
    basis = means.agg(F.min_by("spread_bp", near).alias("there"))
    return means.crossJoin(F.broadcast(basis)).select("fecha", "n", (F.col("spread_bp") + anchor_bp - F.col("there")).alias("spread_bp"))  # one row


def debt_service(terms: DataFrame) -> DataFrame:
    """year, bond (NULL: all of them), paid: coupons and principal of the amounts issued; peak marks the year that pays most."""
    paid = cashflows(terms).join(terms.select("bond", "amount"), "bond")
    sums = paid.groupBy(F.year("pay_day").alias("year"), "bond").agg(F.sum((F.col("coupon") + F.col("principal")) * F.col("amount") / 100).alias("paid"))
    whole = sums.groupBy("year").agg(F.lit(None).cast("string").alias("bond"), F.sum("paid").alias("paid"))
    # a row per year
    whole = whole.withColumn("peak", F.row_number().over(Window.orderBy(F.desc("paid"), "year")) == 1)
    return sums.withColumn("peak", F.lit(False)).unionByName(whole)


def spread_checks(rows: DataFrame, offset_bp: Column, warn_bp: float = 2.0, fail_bp: float = 5.0) -> DataFrame:
    """rows (own_bp, published_bp) with gap_bp after the offset, and verdict: ok, warn, fail or missing."""
    gap = F.col("own_bp") - F.col("published_bp") - offset_bp
    size = F.abs(F.col("gap_bp"))
    verdict = F.when(size.isNull(), "missing").when(size > fail_bp, "fail").when(size > warn_bp, "warn").otherwise("ok")
    return rows.withColumn("gap_bp", gap).withColumn("verdict", verdict)
