"""Profiles that add up: moments and quantile sketches of each column, stored per day, merged over days. A profile of a
year reads a row per day and column, not the year's rows. Exact quartiles are left to :mod:`riskbook.operators.profile`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.functions.common import number
from riskbook.operators.profile import QUARTILES

# A sketch of this size is off by less than RANK_ERROR of the rows, after any number of merges, at 99 % confidence.
SKETCH_SIZE = 1024
RANK_ERROR = 0.005


def profile_state(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column, from one scan. Missing values, NaN and non-numbers are left out; a column without any has a
    count of 0 and nulls."""

    def state(c: str) -> Column:
        value = F.col(f"`{c}`")
        return F.struct(
            F.lit(c).alias("column"),
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count(value)).alias("squares"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.when(F.count(value) > 0, F.expr(f"kll_sketch_agg_double(`{c}`, {SKETCH_SIZE})")).alias("sketch"),
        )

    values = df.select(*[number(c).alias(c) for c in columns])
    return values.agg(F.array(*[state(c) for c in columns]).alias("states")).select(F.inline("states"))


def merged_states(states: DataFrame) -> DataFrame:
    """States of several days as one per column. The sum of squares is that of the days plus what their means differ
    from the common one, which does not cancel as a difference of large sums would. A column gathers one small struct a
    day."""
    held = F.col("count") > 0
    parts = F.collect_list(F.when(held, F.struct("count", "mean", "squares")))
    merged = states.groupBy("column").agg(
        F.sum("count").alias("total"),
        F.sort_array(parts).alias("parts"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.expr(f"kll_merge_agg_double(sketch, {SKETCH_SIZE}) FILTER (WHERE count > 0)").alias("sketch"),
    )
    nothing = F.lit(0.0)
    mean = F.aggregate("parts", nothing, lambda sum_, p: sum_ + p["mean"] * (p["count"] / F.col("total")))
    merged = merged.withColumn("mean", F.when(F.col("total") > 0, mean))

    def apart(sum_: Column, p: Column) -> Column:
        return sum_ + p["squares"] + p["count"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean"))

    squares = F.when(F.col("total") > 0, F.aggregate("parts", nothing, apart))
    return merged.select(
        "column", F.col("total").alias("count"), "mean", squares.alias("squares"), "min", "max",
        F.when(F.col("total") > 0, F.col("sketch")).alias("sketch"),
    )


def profile_of_states(states: DataFrame) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per column, over all days given. The quartiles are values of the
    columns whose ranks are off by at most ``RANK_ERROR`` of the rows."""
    asked = ", ".join(f"{p}D" for _, p in QUARTILES)
    merged = merged_states(states)
    found = F.when(F.col("count") > 0, F.expr(f"kll_sketch_get_quantile_double(sketch, array({asked}))"))
    merged = merged.withColumn("quartiles", found)
    deviation = F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1)))
    return merged.select(
        "column", "count", "mean", deviation.alias("std"), "min",
        *[F.col("quartiles")[k].alias(name) for k, (name, _) in enumerate(QUARTILES)], "max",
    )
