"""Duplicate counts kept up from day to day: the rows of each pair of keys as a stored state, to which a day adds and
from which it takes away. Reports come from the state; earlier days are not read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.operators.quality import pair_counts
from riskbook.sources.publish import publish, published_days, read_published


def pair_changes(
    added: DataFrame, removed: DataFrame | None = None, first: str = "id", second: str = "uprn"
) -> DataFrame:
    """Signed counts of a day: rows that came minus rows that went, by pair. Missing keys are keys too."""
    signed = added.select(first, second, F.lit(1).cast("long").alias("sign"))
    if removed is None:
        return pair_counts(added, first, second)
    both = signed.unionByName(removed.select(first, second, F.lit(-1).cast("long").alias("sign")))
    changes = both.groupBy(first, second).agg(F.sum("sign").alias("count"))
    return changes.where(F.col("count") != 0)


def folded(state: DataFrame, changes: DataFrame, first: str = "id", second: str = "uprn") -> DataFrame:
    """The state with changes. Pairs that are used up leave it; one of which more went than came stays with a negative
    count, which rows that come later make up for."""
    both = state.select(first, second, "count").unionByName(changes.select(first, second, "count"))
    return both.groupBy(first, second).agg(F.sum("count").alias("count")).where(F.col("count") != 0)


def keep_pair_counts(
    spark: SparkSession,
    base: str,
    run_date: str,
    added: DataFrame,
    removed: DataFrame | None = None,
    first: str = "id",
    second: str = "uprn",
) -> DataFrame:
    """Publishes the state of a day, made from that of the newest earlier day, and returns it. A day that is run again
    starts from the same earlier state, so its rows are never counted twice."""
    state = pair_changes(added, removed, first, second)
    earlier = [day for day in published_days(spark, base) if day < run_date]
    if earlier:
        state = folded(read_published(spark, base, earlier[-1]), state, first, second)
    publish(state, base, run_date)
    return read_published(spark, base, run_date).drop("dt")
