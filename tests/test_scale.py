"""Quantiles without a buffer and polygons by a grid, against plain versions, and their plans."""

import random

import numpy as np
from pyspark.sql import functions as F

from marketlake.operators import facts
from marketlake.operators.quantiles import exact_quantiles


def test_quantiles_equal_numpy(spark):
    rng = random.Random(2)
    groups = {
        "wide": [rng.randint(-(10**12), 10**12) for _ in range(301)], "one": [7], "same": [5] * 40, "two": [1, 2], "ties": [rng.randint(0, 3) for _ in range(500)], "dense": list(range(1000)),
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("wide", None), (None, 3)]
    points = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    found = {(r.g, r.point): r.value for r in exact_quantiles(spark.createDataFrame(rows, "g string, v long"), "g", "v", points, digit=5).collect()}
    assert len(found) == len(groups) * len(points)
    for (g, p), value in found.items():
        assert np.isclose(value, np.quantile(np.array(groups[g], dtype=float), p), rtol=1e-12)


def test_quantiles_of_no_rows(spark):
    assert exact_quantiles(spark.createDataFrame([], "g string, v long"), "g", "v", [0.5]).isEmpty()


def polygon(name, order, rng):
    """Edges of a star-shaped outline of any size."""
    cx, cy, r = rng.uniform(-100, 100), rng.uniform(-100, 100), 10 ** rng.uniform(-2, 1.5)
    n = rng.randint(3, 9)
    angles = sorted(rng.uniform(0, 6.283) for _ in range(n))
    dots = [(cx + r * rng.uniform(0.3, 1) * np.cos(a), cy + r * rng.uniform(0.3, 1) * np.sin(a)) for a in angles]
    return [(name, order, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for a, b in zip(dots, dots[1:] + dots[:1], strict=True)]


def inside(x, y, edges):
    return sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for _, _, x1, y1, x2, y2 in edges) % 2 == 1


def test_polygons_of_all_sizes_equal_ray_casting(spark):
    rng = random.Random(6)
    outlines = [polygon(f"p{k}", k, rng) for k in range(60)] + [[("square", 60, 0.0, 0.0, 4.0, 0.0), ("square", 60, 4.0, 0.0, 4.0, 4.0), ("square", 60, 4.0, 4.0, 0.0, 4.0), ("square", 60, 0.0, 4.0, 0.0, 0.0)]]
    points = [(k, rng.uniform(-110, 110), rng.uniform(-110, 110)) for k in range(1500)] + [(2000 + k, float(x), float(y)) for k, (x, y) in enumerate((x, y) for x in range(-1, 6) for y in range(-1, 6))]
    want = {k: next((e[0][0] for e in outlines if inside(x, y, e)), None) for k, x, y in points}
    edges = spark.createDataFrame([e for o in outlines for e in o], "name string, order int, x1 double, y1 double, x2 double, y2 double")
    found = facts.in_polygon(spark.createDataFrame([*points, (9, None, 1.0)], "id long, x double, y double"), edges).collect()
    assert {r.id: r.name for r in found if r.x is not None} == want and sum(w is not None for w in want.values()) > 50


def test_ten_thousand_polygons_meet_points_by_equality(spark):
    rng = random.Random(8)
    edges = spark.createDataFrame([e for k in range(10_000) for e in polygon(f"p{k}", k, rng)], "name string, order int, x1 double, y1 double, x2 double, y2 double")
    points = spark.range(2000).select("id", (F.rand(3) * 200 - 100).alias("x"), (F.rand(4) * 200 - 100).alias("y"))
    joined = facts.in_polygon(points, edges)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("NestedLoopJoin") == 1 and "Cartesian" not in plan  # the one row of the sizes that occur
    assert joined.count() == 2000 and joined.where("name IS NOT NULL").count() > 500


def test_visitors_of_the_month_so_far(spark):
    from marketlake.operators import series

    rows = [(1, "2024-01-30"), (1, "2024-01-31"), (2, "2024-01-31"), (1, "2024-02-01"), (1, "2024-02-01"), (3, "2024-02-03"), (1, "2024-02-03")]
    visits = spark.createDataFrame(rows, "user_id long, fecha string").select("user_id", F.to_date("fecha").alias("fecha"))
    found = [(str(r.fecha), r.visitors, r.month_to_date) for r in series.visitors_to_date(visits).orderBy("fecha").collect()]
    assert found == [("2024-01-30", 1, 1), ("2024-01-31", 2, 2), ("2024-02-01", 1, 1), ("2024-02-03", 2, 2)]
