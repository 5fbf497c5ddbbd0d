"""Golden and constructed cases of the order book."""

import random

from marketlake.operators import book as op


def make(spark, rows):
    return spark.createDataFrame(rows, "snapshot string, side string, price4 long, size long, trader long, merchant int, ad_id long, line int")


def walk(side, ads, pct):
    """The plain loop: up on BUY, down on SELL, until pct of the depth; a size of 0 ends it."""
    ads = sorted(ads, key=lambda a: (a[0] if side == "BUY" else -a[0], a[1] <= 0))
    left = sum(max(0, s) for _, s in ads) * pct / 100
    got = cost = 0
    for price, size in ads:
        take = min(size, left)
        if take <= 0:
            break
        got, cost, left = got + take, cost + take * price, left - take
    return cost / got / 10000 if got else None


def test_vwap_equals_the_loop(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for k in range(60):
        ads = [(rng.randint(1, 9) * 10000, rng.choice([0, 1, 5, 20]) if k % 3 == 0 else rng.randint(1, 30)) for _ in range(rng.randint(1, 12))]
        side = "BUY" if k % 2 else "SELL"
        rows += [(f"s{k:02}", side, p, s, 1, 1, 1, 1) for p, s in ads]
        want[f"s{k:02}"] = [walk(side, ads, p) for p in (5, 10, 25, 50)]
    for r in op.vwap_by_depth(make(spark, rows)).collect():
        for found, expected in zip((r.vwap_5, r.vwap_10, r.vwap_25, r.vwap_50), want[r.snapshot], strict=True):
            assert (found is None) == (expected is None) and (found is None or abs(found - expected) < 1e-9), r


def test_best_price_without_size_gives_null(spark):
    book = make(spark, [("a", "BUY", 10000, 0, 1, 1, 1, 1), ("a", "BUY", 20000, 5, 1, 1, 2, 1)])
    assert op.vwap_by_depth(book).first().vwap_10 is None


def test_golden_book_of_two_sides(spark):
    """By hand: BUY 10 at 6.90, 30 at 7.00, 60 at 7.10; SELL 20 at 6.80, 80 at 6.70. 25 % of 100 is 25 on either side."""
    ads = [("BUY", 71000, 60), ("BUY", 69000, 10), ("BUY", 70000, 30), ("SELL", 67000, 80), ("SELL", 68000, 20)]
    vwaps = op.vwap_by_depth(make(spark, [("a", side, p, s, 1, 1, k, 1) for k, (side, p, s) in enumerate(ads)]))
    found = {r.side: r.vwap_25 for r in vwaps.collect()}
    assert abs(found["BUY"] - (10 * 6.9 + 15 * 7.0) / 25) < 1e-9 and abs(found["SELL"] - (20 * 6.8 + 5 * 6.7) / 25) < 1e-9
    assert abs(op.spreads(vwaps).first().spread_25 - (found["BUY"] - found["SELL"])) < 1e-9


def test_spread_needs_both_sides(spark):
    book = make(spark, [("a", "SELL", 10000, 5, 1, 1, 1, 1)])
    assert op.spreads(op.vwap_by_depth(book)).first().spread_10 is None


def test_empty_book(spark):
    empty = make(spark, [])
    for f in (op.vwap_by_depth, op.summary, op.depth_ratio, op.concentration, op.traders, op.flow, op.dictionary):
        assert f(empty).count() == 0


def test_flow_of_first_snapshot_is_zero(spark):
    book = make(spark, [("a", "SELL", 1, 1, 1, 1, 1, 1), ("b", "SELL", 1, 1, 2, 1, 1, 1)])
    found = {r.snapshot: (r.n, r.new, r.gone) for r in op.flow(book).collect()}
    assert found == {"a": (1, 0, 0), "b": (1, 1, 1)}
