"""Numeric profile of columns: count, mean, deviation, extremes and exact quartiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from riskbook.functions.common import number

QUARTILES = (("p25", 0.25), ("p50", 0.50), ("p75", 0.75))
# Size of the quantile sketches; the ranks they are asked for lie this far around the wanted one.
SKETCH_SIZE = 2048
SKETCH_MARGIN = 0.005
BINS = 1 << 17


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column. Quartiles are exact and interpolated; missing values, NaN and non-numbers are left out.

    The first scan of ``df``, which should be a stored table, takes the moments and a quantile sketch of each column.
    After it, rounds of one scan count the values below and between the ranges in which the wanted ranks lie, and those
    inside by bins, until every range is down to one value; mostly one round is enough, seldom two. No column is gathered
    in one task: a task keeps at most ``BINS`` counts per range, and the driver gets one row per rank and round.
    """
    values = df.select(*[number(c).alias(c) for c in columns])
    moments = _moments(values, columns).collect()
    places = {(r["column"], p): (r["count"] - 1) * p for r in moments if r["count"] for _, p in QUARTILES}
    at_rank = _values_at(values, moments, places)
    rows = []
    for r in moments:
        quartiles = [None] * len(QUARTILES)
        if r["count"]:
            quartiles = [_between(at_rank, r["column"], places[r["column"], p]) for _, p in QUARTILES]
        rows.append((r["column"], r["count"], r["mean"], r["std"], r["min"], *quartiles, r["max"]))
    names = ["mean", "std", "min", *[name for name, _ in QUARTILES], "max"]
    schema = "column string, count long, " + ", ".join(f"{name} double" for name in names)
    return df.sparkSession.createDataFrame(rows, schema)


def _between(at_rank: dict, column: str, place: float) -> float:
    below, above = at_rank[column, math.floor(place)], at_rank[column, math.ceil(place)]
    return below if below == above else below + (above - below) * (place - math.floor(place))


def _moments(values: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Moments of each column, and for each quartile a range that most likely holds its ranks."""
    ends = [min(1.0, max(0.0, p + side * SKETCH_MARGIN)) for _, p in QUARTILES for side in (-1, 1)]

    def figures(c: str) -> Column:
        sketch = F.expr(f"kll_sketch_agg_double(`{c}`, {SKETCH_SIZE})")
        return F.struct(
            F.lit(c).alias("column"),
            F.count(f"`{c}`").alias("count"),
            F.avg(f"`{c}`").alias("mean"),
            F.stddev_samp(f"`{c}`").alias("std"),
            F.min(f"`{c}`").alias("min"),
            F.max(f"`{c}`").alias("max"),
            sketch.alias("sketch"),
        )

    rows = values.agg(F.array(*[figures(c) for c in columns]).alias("rows")).select(F.inline("rows"))
    asked = ", ".join(f"{e}D" for e in ends)
    ranges = F.expr(f"CASE WHEN count > 0 THEN kll_sketch_get_quantile_double(sketch, array({asked})) END")
    return rows.select("column", "count", "mean", "std", "min", "max", ranges.alias("ranges"))


def _log_bin(value: Column) -> Column:
    """A whole number that never falls as the value rises; a bin spans 1/64 of a unit of the natural logarithm."""
    size = F.least(F.log(F.abs(value)), F.lit(800.0))
    return F.when(value == 0, 0).otherwise(F.signum(value) * (F.floor((size + 746) * 64) + 1)).cast("long")


def _bin(value: Column, low: float, high: float) -> Column:
    """Bins of equal width, or by logarithm where the width is not finite."""
    if not math.isfinite(high - low):
        return _log_bin(value)
    share = (value - F.lit(low)) / F.lit(high - low) * BINS if high > low else F.lit(0.0)
    return F.least(F.floor(share), F.lit(BINS)).cast("long")


def _values_at(values: DataFrame, moments: list[Row], places: dict) -> dict[tuple[str, int], float]:
    """The value at each wanted rank of each column."""
    open_: dict[tuple[str, int], tuple[float, float]] = {}
    found: dict[tuple[str, int], float] = {}
    for r in moments:
        for k, (_, p) in enumerate(QUARTILES if r["count"] else ()):
            place = places[r["column"], p]
            for rank in {math.floor(place), math.ceil(place)}:
                open_[r["column"], rank] = (r["ranges"][2 * k], r["ranges"][2 * k + 1])
    while open_:
        ranges: dict[str, list[tuple[float, float]]] = {}
        for (column, _), bounds in open_.items():
            ranges.setdefault(column, []).append(bounds)
        bins = _bins_of(values, {c: _apart(found_) for c, found_ in ranges.items()})
        for r in _locate(bins, list(ranges), list(open_)):
            key = r["column"], r["rank"]
            # A rank outside of its range, where the sketch was off, goes on with the stretch it fell in.
            open_[key] = (r["low"], r["high"])
            if r["low"] == r["high"]:
                found[key] = r["low"]
                del open_[key]
    return found


def _apart(ranges: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Ranges in order, those that overlap as one."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _bins_of(values: DataFrame, ranges: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """Counts of the values of each column by stretch, in order: below the first range, in it, between it and the next,
    and so on; inside a range by bin. One scan; a row is one value per column."""

    def placed(number: int, c: str) -> Column:
        value = F.col(f"`{c}`")
        stretch, bin_ = F.when(value < F.lit(ranges[c][0][0]), 0), F.lit(None).cast("long")
        for k, (low, high) in enumerate(ranges[c]):
            inside = value.between(F.lit(low), F.lit(high))
            # What is below a range has passed those before it.
            stretch = stretch.when(value < F.lit(low), 2 * k).when(value <= F.lit(high), 2 * k + 1)
            if high > low:
                bin_ = F.when(inside, _bin(value, low, high)).otherwise(bin_)
        stretch = stretch.otherwise(2 * len(ranges[c]))
        fields = [F.lit(number).alias("column"), stretch.alias("stretch"), bin_.alias("bin"), value.alias("value")]
        return F.when(value.isNotNull(), F.struct(*fields))

    rows = values.select(F.inline(F.array(*[placed(*x) for x in enumerate(ranges)]))).where("column is not null")
    figures = [F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")]
    return rows.groupBy("column", "stretch", "bin").agg(*figures)


def _locate(bins: DataFrame, columns: list[str], targets: list[tuple[str, int]]) -> list[Row]:
    """The extremes of the bin or stretch that each target, a column and a rank, falls in."""
    order = Window.partitionBy("column").orderBy("stretch", "bin")
    running = bins.withColumn("upto", F.sum("n").over(order)).withColumn("before", F.col("upto") - F.col("n"))
    # Two ranks per column and quartile at most.
    wanted = [[rank for column, rank in targets if column == c] for c in columns]
    ranks = F.get(F.array(*[F.array(*[F.lit(r).cast("long") for r in some]) for some in wanted]), F.col("column"))
    hit = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("upto"))
    each = running.withColumn("rank", F.explode(ranks)).where(hit)
    names = F.array(*[F.lit(c) for c in columns])
    return each.select(F.get(names, F.col("column")).alias("column"), "rank", "low", "high").collect()
