"""Bonds against plain loops and golden values."""

import datetime
import random

from pyspark.sql import functions as F

from marketlake.operators import bonds

D = datetime.date
TERMS = "bond string, issue date, maturity date, months int, steps array<struct<since:date,rate:double>>, repaid array<struct<day:date,share:double>>, amount double"
ROWS = [
    ("flat", D(2017, 3, 20), D(2028, 3, 20), 6, [(D(2017, 3, 20), 4.5)], None, 1000.0),
    ("step", D(2020, 8, 31), D(2030, 8, 31), 6, [(D(2020, 8, 31), 1.0), (D(2024, 8, 28), 5.0)], None, 500.0),
    ("sink", D(2020, 1, 15), D(2026, 1, 15), 6, [(D(2020, 1, 15), 6.0)], [(D(2025, 1, 15), 0.4), (D(2026, 1, 15), 0.6)], 250.0),
]


def days(a, b):
    start = min(a.day, 30)
    end = 30 if start == 30 and b.day == 31 else b.day
    return (b.year - a.year) * 360 + (b.month - a.month) * 30 + end - start


def months_back(d, n):
    y, m = divmod(d.year * 12 + d.month - 1 - n, 12)
    last = (D(y + (m == 11), (m + 1) % 12 + 1, 1) - datetime.timedelta(1)).day
    return D(y, m + 1, min(d.day, last))


def plain_flows(row):
    _, issue, maturity, months, steps, repaid, _ = row
    coupons, d = [], maturity
    while d > issue:
        coupons.append(d)
        d = months_back(d, months)
    back, left, out = dict(repaid or [(maturity, 1.0)]), 1.0, []
    for d in sorted(coupons):
        rate = steps[0][1]
        for since, r in steps:
            rate = r if d > since else rate
        out.append((d, left * rate / 100 * months / 12 * 100, back.get(d, 0.0) * 100))
        left -= back.get(d, 0.0)
    return out


def pv(flows, settle, y):
    return sum((c + p) / (1 + y / 2) ** (days(settle, d) / 180) for d, c, p in flows if d > settle)


def solved(value, target, lo, hi):
    for _ in range(80):
        m = (lo + hi) / 2
        lo, hi = (m, hi) if value(m) > target else (lo, m)
    return (lo + hi) / 2


def test_cashflows_and_accrued(spark):
    terms = spark.createDataFrame(ROWS, TERMS)
    found = {}
    for r in bonds.cashflows(terms).orderBy("pay_day").collect():
        found.setdefault(r.bond, []).append((r.pay_day, round(r.coupon, 9), r.principal))
    assert found == {row[0]: [(d, round(c, 9), p) for d, c, p in plain_flows(row)] for row in ROWS}
    positions = spark.createDataFrame([("flat", D(2026, 6, 23)), ("sink", D(2025, 4, 15)), ("flat", D(2017, 4, 20))], "bond string, settle date")
    got = [(r.bond, round(r.accrued, 6)) for r in bonds.accrued(terms, positions).orderBy("bond", "settle").collect()]
    # 30 and 93 days of 4.5, and 90 days of 6 on 60 per cent
    assert got == [("flat", round(4.5 * 30 / 360, 6)), ("flat", round(4.5 * 93 / 360, 6)), ("sink", round(0.6 * 6 * 90 / 360, 6))]


def test_principal_that_does_not_add_up_is_an_error(spark):
    import pytest

    bad = spark.createDataFrame([("bad", D(2020, 1, 15), D(2022, 1, 15), 6, [(D(2020, 1, 15), 6.0)], [(D(2022, 1, 15), 0.6)], 1.0)], TERMS)
    with pytest.raises(Exception, match="add up"):
        bonds.cashflows(bad).collect()


def test_yields_prices_and_spreads_equal_the_loops(spark):
    rng = random.Random(2)
    flows = {row[0]: plain_flows(row) for row in ROWS}
    rows = [(row[0], D(2021 + rng.randrange(4), rng.randint(1, 12), rng.randint(1, 28)), rng.uniform(40, 130)) for row in ROWS for _ in range(8)]
    par = {1.0: 3.9, 2.0: 4.1, 5.0: 4.3, 10.0: 4.6, 30.0: 4.9}
    terms = spark.createDataFrame(ROWS, TERMS)
    priced = spark.createDataFrame(rows, "bond string, settle date, dirty double").join(bonds.flows_of(bonds.cashflows(terms)), "bond")
    curve = spark.createDataFrame([(D(2021, 1, 1), sorted(par.items()))], "fecha date, par array<struct<t:double,y:double>>")
    zero = bonds.zero_curves(curve)
    found = {(r.bond, r.settle, r.dirty): r for r in bonds.z_spreads(bonds.yields(priced).crossJoin(zero.select("zero"))).collect()}

    def line(points, t):
        points = sorted(points.items())
        if t <= points[0][0] or t >= points[-1][0]:
            return points[0 if t <= points[0][0] else -1][1]
        (a, u), (b, v) = next((p, q) for p, q in zip(points, points[1:]) if p[0] <= t <= q[0])
        return u + (t - a) / (b - a) * (v - u)

    factors, nodes = [], {}
    for k in range(1, 81):
        p = line(par, k / 2) / 200
        factors.append((1 - p * sum(factors)) / (1 + p))
        nodes[k / 2] = 2 * (factors[-1] ** (-1 / k) - 1)
    assert all(abs(x.z - nodes[x.t]) < 1e-12 for x in zero.first().zero)
    for bond, settle, dirty in rows:
        r, mine = found[bond, settle, dirty], flows[bond]
        y = solved(lambda y: pv(mine, settle, y), dirty, -0.5, 5.0)
        assert abs(r.ytm - y) < 1e-9 and abs(pv(mine, settle, r.ytm) - dirty) < 1e-6
        ahead = [(days(settle, d) / 360, c + p, p) for d, c, p in mine if d > settle]
        weights = [(t, a / (1 + y / 2) ** (2 * t)) for t, a, _ in ahead]
        assert abs(r.duration - sum(t * w for t, w in weights) / sum(w for _, w in weights)) < 1e-6
        assert abs(r.life - sum(t * p for t, _, p in ahead) / sum(p for _, _, p in ahead)) < 1e-9
        s = solved(lambda s: sum(a / (1 + (line(nodes, t) + s) / 2) ** (2 * t) for t, a, _ in ahead), dirty, -0.05, 0.6)
        assert abs(r.z_spread - s) < 1e-9


def test_golden_yield_of_a_bullet(spark):
    """Clean 95.38 and accrued 1.1875 on the 4.5 % bond of 2028: a yield of 7.51 % a year; the settlement day follows from the accrued
    interest, 95 days after the coupon of 20 March."""
    terms = spark.createDataFrame(ROWS[:1], TERMS)
    rows = spark.createDataFrame([("flat", D(2026, 6, 25), 95.38 + 1.1875)], "bond string, settle date, dirty double")
    assert round(bonds.accrued(terms, rows.drop("dirty")).first().accrued, 4) == 1.1875
    y = bonds.yields(rows.join(bonds.flows_of(bonds.cashflows(terms)), "bond")).select(bonds.semi_to_annual(F.col("ytm")).alias("y")).first().y
    assert abs(y - 0.0751) < 1e-4


def test_history_meets_its_anchor(spark):
    terms = spark.createDataFrame(ROWS, TERMS)
    series = spark.createDataFrame([(D(2022, 1, 3), 400.0), (D(2022, 1, 4), 420.0), (D(2022, 1, 10), 380.0)], "fecha date, market_bp double")
    curves = spark.createDataFrame([(d, [(1.0, 4.0), (30.0, 4.0)]) for d in (D(2022, 1, 3), D(2022, 1, 4), D(2022, 1, 10))], "fecha date, par array<struct<t:double,y:double>>")
    free = {r.fecha: r for r in bonds.spread_history(terms, series, curves).collect()}
    assert {d: r.n for d, r in free.items()} == dict.fromkeys(free, 3)
    # on a flat curve the yield's spread is the Z-spread
    assert all(abs(free[d].spread_bp - bp) < 1e-6 for d, bp in ((D(2022, 1, 3), 400), (D(2022, 1, 4), 420)))
    shifted = {r.fecha: r.spread_bp for r in bonds.spread_history(terms, series, curves, "2022-01-05", 434.0).collect()}
    assert abs(shifted[D(2022, 1, 4)] - 434) < 1e-6 and abs(shifted[D(2022, 1, 3)] - 414) < 1e-6


def test_debt_service_peak(spark):
    rows = bonds.debt_service(spark.createDataFrame(ROWS, TERMS)).collect()
    whole = {r.year: r for r in rows if r.bond is None}
    assert [y for y, r in whole.items() if r.peak] == [2028]
    assert abs(whole[2028].paid - sum(r.paid for r in rows if r.year == 2028 and r.bond)) < 1e-9


def test_narrow_rows_are_dealt_out(spark):
    """Cash flows and curves come to the trades after their shuffle; a solver doesn't send them around."""
    from marketlake import catalog

    for name in ("m23_price_of_yield", "m24_yield_of_price", "m26_z_spreads", "m27_spread_history"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        dealt = [x for x in plan.splitlines() if "Exchange" in x and "REPARTITION_BY_NUM" in x]
        assert dealt and not any("dirty" in x or "fecha" in x for x in dealt)


def test_bonds_alike_are_weighted_by_all_their_amounts(spark):
    twin = ("twin", *ROWS[0][1:6], 3000.0)
    days = spark.createDataFrame([(D(2022, 1, 3), 400.0)], "fecha date, market_bp double")
    curves = spark.createDataFrame([(D(2022, 1, 3), [(30.0, 5.0), (1.0, 3.0)])], "fecha date, par array<struct<t:double,y:double>>")
    of = lambda *rows: bonds.spread_history(spark.createDataFrame(rows, TERMS), days, curves).first()
    one, other, both = of(*ROWS[:1]), of(ROWS[1]), of(ROWS[0], twin, ROWS[1])
    more = of((*ROWS[0][:6], 4000.0), ROWS[1])
    assert (one.n, other.n, both.n) == (1, 1, 3) and abs(both.spread_bp - more.spread_bp) < 1e-9
    assert min(one.spread_bp, other.spread_bp) < both.spread_bp < max(one.spread_bp, other.spread_bp)
