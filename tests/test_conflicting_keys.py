"""Counts by key move their rows once."""


def test_conflicting_keys_move_once(spark):
    import os

    from marketlake.catalog import QUERIES

    made = QUERIES["a35_conflicting_keys"](spark, os.environ.get("SF_DIR", "/root/testdata/sf0.001"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
