"""Prices and solvers on Arrow batches: the cash flows of all rows of a batch lie in flat arrays, a row's place beside each.

flows is an array of (pay_day, coupon, principal), settle a day; flows up to it are over. t counts half years, 30/360.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

#: Most rounds of a solver; six make an error of 1e-12 for bonds of thirty years.
ROUNDS = 12


def _numbers(values: pa.Array) -> np.ndarray:
    return values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)


def _parts(days: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Months since 1970 and the day of the month."""
    dates = days.astype("datetime64[D]")
    months = dates.astype("datetime64[M]")
    return months.astype(np.int64), (dates - months).astype(np.int64) + 1


def _ahead(flows: pa.Array, settle: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the flows after settle: row, t, total, principal."""
    sizes = pc.list_value_length(flows).fill_null(0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(flows)), sizes)
    flat = flows.flatten()
    pay = flat.field("pay_day").cast(pa.int32()).to_numpy(zero_copy_only=False).astype(np.int64)
    # without a day nothing is to come
    day = settle.cast(pa.int32()).fill_null(2**31 - 1).to_numpy(zero_copy_only=False).astype(np.int64)
    later = pay > day[row]
    row, pay = row[later], pay[later]
    (month_a, day_a), (month_b, day_b) = _parts(day), _parts(pay)
    start = np.minimum(day_a, 30)[row]
    days = (month_b - month_a[row]) * 30 + np.where((start == 30) & (day_b == 31), 30, day_b) - start
    principal = _numbers(flat.field("principal"))[later]
    return row, days / 180, _numbers(flat.field("coupon"))[later] + principal, principal


def _sums(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, values, n)


def _solved(row: np.ndarray, t: np.ndarray, total: np.ndarray, z: np.ndarray | float, target: np.ndarray, lo: float, hi: float) -> np.ndarray:
    """The y between lo and hi at which the flows at rates z + y are worth the target; NaN without flows or a positive target.

    The logarithm of the value falls in y and is convex, so Newton's steps for it, begun at lo, close in from one side and
    need a few rounds.
    """
    n = len(target)
    y = np.full(n, lo)
    with np.errstate(all="ignore"):
        for _ in range(ROUNDS):
            base = 1 + (z + y[row]) / 2
            worth = total / np.power(base, t)
            value, slope = _sums(row, worth, n), _sums(row, t / 2 * worth / base, n)
            last, y = y, np.fmax(lo, np.fmin(hi, y + value / slope * np.log(value / target)))
            if np.abs(y - last).max(initial=0) < 1e-15:
                break
    return np.where((np.bincount(row, minlength=n) > 0) & (target > 0), y, np.nan)


def _column(values: np.ndarray) -> pa.Array:
    return pa.array(values, from_pandas=True)


def price_of(flows: pa.Array, settle: pa.Array, y: pa.Array) -> pa.Array:
    """Value of the flows to come at one yield."""
    row, t, total, _ = _ahead(flows, settle)
    with np.errstate(all="ignore"):
        worth = _sums(row, total / np.power(1 + _numbers(y)[row] / 2, t), len(y))
    return _column(np.where(np.isnan(_numbers(y)), np.nan, worth))


def yields_of(flows: pa.Array, settle: pa.Array, dirty: pa.Array) -> pa.Array:
    """ytm, duration and life in years."""
    n = len(dirty)
    row, t, total, principal = _ahead(flows, settle)
    y = _solved(row, t, total, 0.0, _numbers(dirty), -0.5, 5.0)
    with np.errstate(all="ignore"):
        worth = total / np.power(1 + y[row] / 2, t)
        duration = _sums(row, worth * t / 2, n) / _sums(row, worth, n)
        life = _sums(row, principal * t / 2, n) / _sums(row, principal, n)
    return pa.StructArray.from_arrays([_column(y), _column(duration), _column(life)], ["ytm", "duration", "life"])


def z_spread_of(flows: pa.Array, settle: pa.Array, dirty: pa.Array, zero: pa.Array) -> pa.Array:
    """What is added to the zero rates (at 1, 2, ... half years, on lines between them, flat beyond) to meet the dirty price."""
    row, t, total, _ = _ahead(flows, settle)
    nodes = _numbers(zero.flatten())
    size = pc.list_value_length(zero).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    first = (np.cumsum(size) - size)[row]
    last = size[row] - 1
    if not len(nodes):
        return pa.nulls(len(dirty), pa.float64())
    z = lambda k: nodes[np.minimum(first + np.clip(k, 0, np.maximum(last, 0)), len(nodes) - 1)]
    below = np.floor(t).astype(np.int64)
    w = np.where((t <= 1) | (t >= last + 1), 0.0, t - below)
    rates = np.where(last < 0, np.nan, z(below - 1) + w * (z(below) - z(below - 1)))
    found = _solved(row, t, total, rates, _numbers(dirty), -0.05, 0.6)
    return _column(np.where(size > 0, found, np.nan))


def _interpolated(points: pa.Array, t: np.ndarray) -> np.ndarray:
    """Values at t (a row of times for each array of points t, y) on the lines through the points, flat beyond their ends."""
    n = len(points)
    sizes = pc.list_value_length(points).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row, flat = np.repeat(np.arange(n), sizes), points.flatten()
    x, y = _numbers(flat.field("t")), _numbers(flat.field("y"))
    order = np.lexsort((y, x, row))
    column = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    # beyond a row's points its times are infinite
    xs, ys = np.full((n, max(sizes.max(initial=0), 1)), np.inf), np.full((n, max(sizes.max(initial=0), 1)), np.nan)
    xs[row, column], ys[row, column] = x[order], y[order]
    at = lambda m, k: np.take_along_axis(m, np.clip(k, 0, m.shape[1] - 1), 1)
    below = np.zeros(t.shape, dtype=np.int64) - 1
    for k in range(xs.shape[1]):
        below += xs[:, k : k + 1] <= t
    last = np.maximum(sizes - 1, 0)[:, None]
    with np.errstate(all="ignore"):
        between = at(ys, below) + (t - at(xs, below)) / (at(xs, below + 1) - at(xs, below)) * (at(ys, below + 1) - at(ys, below))
    return np.where(t <= xs[:, :1], ys[:, :1], np.where(t >= at(xs, last), at(ys, last), between))


def zero_of(par: pa.Array, halves: int) -> pa.Array:
    """(t, z) on half years by bootstrapping: a node's discount factor is (1 - p/2 * those before) / (1 + p/2)."""
    n, t = len(par), np.arange(1, halves + 1) / 2
    p = _interpolated(par, np.broadcast_to(t, (n, halves))) / 200
    total, z = np.zeros(n), np.empty((n, halves))
    with np.errstate(all="ignore"):
        for k in range(halves):
            df = (1 - p[:, k] * total) / (1 + p[:, k])
            total = total + df
            z[:, k] = 2 * (np.power(df, -1 / (2 * t[k])) - 1)
    nodes = pa.StructArray.from_arrays([pa.array(np.tile(t, n)), _column(z.ravel())], ["t", "z"])
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * halves, pa.int32()), nodes)


def price():
    return F.arrow_udf(price_of, "double")


def yields():
    return F.arrow_udf(yields_of, "ytm double, duration double, life double")


def z_spread():
    return F.arrow_udf(z_spread_of, "double")


def line():
    """The value at a time on the lines through points."""
    return F.arrow_udf(lambda points, t: _column(_interpolated(points, _numbers(t)[:, None])[:, 0]), "double")


def zero(halves: int):
    return F.arrow_udf(lambda par: zero_of(par, halves), "array<struct<t:double,z:double>>")
