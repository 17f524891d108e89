"""Duplicate-key reports, group filters, category counts, value lists and row counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from riskbook.operators.skew import hot_keys, skew_join


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, most frequent first. Missing keys form one group."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("count"))
        .where(F.col("count") > 1)
        .orderBy(F.desc("count"), *keys)
    )


def duplicate_report(df: DataFrame, first: str = "id", second: str = "uprn") -> DataFrame:
    """Duplicates of the pair and of each single key from one scan, in no particular order."""
    return duplicates_of_pairs(pair_counts(df, first, second), first, second)


def pair_counts(df: DataFrame, first: str = "id", second: str = "uprn") -> DataFrame:
    """Rows of each pair of keys as ``count``; missing keys are keys too."""
    return df.groupBy(first, second).agg(F.count("*").alias("count"))


def joined_pair_counts(
    pairs: DataFrame, right: DataFrame, first: str = "id", second: str = "uprn"
) -> DataFrame:
    """The pair counts of a table after its left join with ``right`` by ``first``, without the join of their rows: the
    rows of a pair times those of its key on the right, or once if there are none."""
    times = right.where(F.col(first).isNotNull()).groupBy(F.col(first).alias("_first")).agg(F.count("*").alias("_times"))
    joined = pairs.join(times, F.col(first) == F.col("_first"), "left")
    return joined.select(first, second, (F.col("count") * F.coalesce("_times", F.lit(1))).alias("count"))


def duplicates_of_pairs(pairs: DataFrame, first: str = "id", second: str = "uprn") -> DataFrame:
    """What occurs more than once: pairs, and each single key.

    The single keys are counted from the pairs, combined once more before their shuffle, so that neither all rows are
    sent three times nor the rows of a crowded key meet in one task.
    """
    nothing = {c: F.lit(None).cast(pairs.schema[c].dataType).alias(c) for c in (first, second)}

    def of(key: str, counts: DataFrame, *shown) -> DataFrame:
        return counts.where(F.col("count") > 1).select(F.lit(key).alias("key"), *shown, "count")

    def single(key: str) -> DataFrame:
        return pairs.groupBy(key).agg(F.sum("count").alias("count"))

    return (
        of(f"{first}+{second}", pairs, first, second)
        .union(of(first, single(first), first, nothing[second]))
        .union(of(second, single(second), nothing[first], second))
    )


def duplicate_members(
    df: DataFrame,
    key: str = "uprn",
    member: str = "id",
    members_of: DataFrame | None = None,
    salted: bool = False,
) -> DataFrame:
    """Every member of a key that occurs more than once in ``df``, with the key's count.

    ``members_of`` is the table that lists the members (``df`` itself by default); a duplicated key it does not
    know stays with a missing member.
    """
    listing = (df if members_of is None else members_of).select(F.col(key).alias("_member_key"), member)
    repeated = df.groupBy(key).agg(F.count("*").alias("count")).where(F.col("count") > 1)
    hot = hot_keys(listing, "_member_key") if salted else {}
    return skew_join(repeated, listing, key, "_member_key", "left", hot_right=hot)


def rows_with_min_group(df: DataFrame, key: str, at_least: int, salted: bool = False) -> DataFrame:
    """All rows of the keys that occur at least ``at_least`` times. Rows without a key belong to no group.

    Counts are combined before the shuffle and joined back, so no group has to fit in one task.
    """
    large = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_group"))
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") >= at_least)
        .select("_group")
    )
    hot = hot_keys(df, key) if salted else {}
    return skew_join(df, large, key, "_group", "left_semi", hot_left=hot)


def category_counts(df: DataFrame, key: str, value: str | None = None) -> DataFrame:
    """Rows with a value per category; the category itself by default. Rows without a category are left out."""
    counted = F.count(F.col(value or key)).alias("count")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(counted)


def all_category_counts(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """:func:`category_counts` of several (key, value) pairs in one pass, as (key, value, category, count)."""
    entries = [
        F.struct(
            F.lit(key).alias("key"),
            F.lit(value).alias("value"),
            F.col(key).cast("string").alias("category"),
            F.col(value).isNotNull().cast("int").alias("present"),
        )
        for key, value in pairs
    ]
    return (
        df.select(F.inline(F.array(*entries)))
        .where(F.col("category").isNotNull())
        .groupBy("key", "value", "category")
        .agg(F.sum("present").alias("count"))
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct values of several columns as text, the missing one included, in one pass."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*entries))).distinct()


def first_rows(df: DataFrame, order: Sequence, n: int = 40) -> DataFrame:
    return df.orderBy(*order).limit(n)


def last_rows(df: DataFrame, order: Sequence[str], n: int = 40) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def lookup_properties(df: DataFrame, key: str, wanted: Sequence | DataFrame, salted: bool = False) -> DataFrame:
    """Rows whose key is wanted. ``wanted`` is a list, which becomes a filter, or a one-column DataFrame, which is
    joined; with ``salted`` hot keys of ``df`` are spread for that join."""
    if not isinstance(wanted, DataFrame):
        return df.where(F.col(key).isin(list(wanted)))
    hot = hot_keys(df, key) if salted else {}
    return skew_join(df, wanted.toDF("_wanted").distinct(), key, "_wanted", "left_semi", hot_left=hot)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The DataFrame with a row counter that fills while the next action runs, so that no job is spent on it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def row_counts(steps: dict[str, DataFrame], name: str = "step") -> DataFrame:
    """Number of rows of several tables, as one small table; an empty one shows 0."""
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(step).alias(name), "rows") for step, df in steps.items()]
    return reduce(DataFrame.unionByName, counts)
