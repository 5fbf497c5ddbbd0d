"""Exact quantiles by rounds of histograms: no task or driver holds a group's values.

A value's distance from its group's least is read digit by digit, the highest first. A round counts, in each task before the shuffle,
the next digit of the values that begin like a wanted rank, and takes the digit in which the rank falls; after the last digit the
value itself is known. A round's rows are a digit's values for each open beginning, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.folders import Scratch


def exact_quantiles(rows: DataFrame, group: str, value: str, points: list[float], digit: int = 12) -> DataFrame:
    """group, point, value (double): quantiles by linear interpolation between ranks, as percentile() has them.

    value is a whole number; nulls count in neither column. An empty table gives no rows.
    """
    scratch = Scratch(rows.sparkSession, "quantiles")
    base = rows.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(group, F.col(value).cast("long").alias("__v"))
    ends = scratch.save(base.groupBy(group).agg(F.min("__v").alias("__low"), F.max("__v").alias("__high"), F.count("*").alias("__n")), "ends")
    span = ends.agg(F.max(F.col("__high") - F.col("__low"))).first()[0]
    place = F.col("__point") * (F.col("__n") - 1)
    wanted = ends.select(group, "__low", "__n", F.explode(F.array(*[F.lit(float(p)) for p in points])).alias("__point"))
    wanted = wanted.select(group, "__low", "__point", place.alias("__place"), F.floor(place).alias("__lower"), F.ceil(place).alias("__upper"))
    ranks = wanted.select(group, F.explode(F.array("__lower", "__upper")).alias("__rank")).distinct()
    open_ = ranks.withColumns({"__begin": F.lit(0).cast("long"), "__below": F.lit(0).cast("long")})
    distances = base.join(ends.select(group, "__low"), group).select(group, (F.col("__v") - F.col("__low")).alias("__d"))
    shift = int(span or 0).bit_length()
    while shift > 0:
        width = min(digit, shift)
        shift -= width
        begins = open_.select(group, "__begin").distinct()
        mine = distances.withColumn("__begin", F.shiftright("__d", shift + width)).join(begins, [group, "__begin"], "left_semi")
        counts = mine.groupBy(group, "__begin", F.shiftright("__d", shift).alias("__next")).agg(F.count("*").alias("__k"))
        # at most 2^digit rows for each beginning
        before = F.sum("__k").over(Window.partitionBy(group, "__begin").orderBy("__next")) - F.col("__k")
        steps = counts.withColumn("__before", before)
        left = F.col("__rank") - F.col("__below")
        inside = open_.join(steps, [group, "__begin"]).where((left >= F.col("__before")) & (left < F.col("__before") + F.col("__k")))
        open_ = scratch.save(inside.select(group, "__rank", F.col("__next").alias("__begin"), (F.col("__below") + F.col("__before")).alias("__below")), "open")
    found = {side: open_.select(group, F.col("__rank").alias(f"__{side}"), F.col("__begin").alias(f"__{side}_value")) for side in ("lower", "upper")}
    both = wanted.join(found["lower"], [group, "__lower"]).join(found["upper"], [group, "__upper"])
    between = F.col("__place") - F.col("__lower")
    exact = (F.col("__low") + F.col("__lower_value")) + (F.col("__upper_value") - F.col("__lower_value")) * between
    return both.select(group, F.col("__point").alias("point"), exact.cast("double").alias("value"))
