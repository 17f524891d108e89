"""Portfolio use case: merge of portfolio, risk scores and coordinates, with duplicate reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.functions.energy import initial_capital
from riskbook.operators.merges import lower_columns, merge_portfolio, with_key
from riskbook.operators.pair_state import keep_pair_counts
from riskbook.operators.quality import (
    duplicate_keys,
    duplicate_members,
    duplicates_of_pairs,
    joined_pair_counts,
    pair_counts,
)
from riskbook.sources.ledger import Ledger
from riskbook.sources.publish import publish, read_published
from riskbook.sources.readers import blank_to_null, lost_in_row, read_raw_csv, typed_columns
from riskbook.sources.schemas import PORTFOLIO_TYPES
from riskbook.sources.types import form_counts, key_type, number_of


def _landed(
    spark: SparkSession, path: str, staged: str, run_date: str, source: str, ledger: Ledger
) -> DataFrame:
    """Rows with an id of an all-text CSV, stored once as Parquet so that the reports do not parse the file again.
    Values that later lose out when numbers become numbers are counted on the way."""
    rows = lower_columns(read_raw_csv(spark, path))
    rows = ledger.watch(rows, source, rejected=F.col("id").isNull(), lost=lost_in_row(rows, PORTFOLIO_TYPES))
    publish(with_key(rows, "id"), f"{staged}/{source}", run_date)
    return read_published(spark, f"{staged}/{source}", run_date).drop("dt")


def _id_type(others: list[DataFrame]) -> str | None:
    """The type in which the ids of both other files are compared: numbers, if all of them are."""
    # A row per file.
    return key_type(reduce(DataFrame.union, [form_counts(df, ["id"]) for df in others]).collect())


def _merged_by_number(portfolio: DataFrame, others: list[DataFrame], how: str, kind: str) -> DataFrame:
    """The merge on ids as numbers, with the portfolio's ids as they were written."""
    number = number_of(F.col("id"), kind)
    keyed = with_key(portfolio.select(F.col("id").alias("_written"), "*").withColumn("id", number), "id")
    merged = merge_portfolio(keyed, *[df.withColumn("id", number) for df in others], how=how, salted=True)
    return merged.withColumn("id", F.col("_written")).drop("_written")


def portfolio_merge_job(
    spark: SparkSession,
    portfolio_csv: str,
    risk_scores_csv: str,
    latlong_csv: str,
    merged: str,
    staged: str,
    run_date: str,
    how: str = "inner",
    ledger: str | None = None,
) -> int:
    """Merges the three files by id and publishes the day as Parquet, CSV and JSON lines under ``merged``.
    Returns the number of rows written.

    The inner merge finds out types: if all ids of both other files are numbers, ids are compared as numbers, so that
    ``007``, ``7.0`` and ``7e0`` all meet 7, and a portfolio id that is none meets nothing. The left merge compares texts
    as they are. Either way the portfolio's id is published as it was written. The counts of the steps are published at
    ``ledger``, if a place is given.
    """
    steps = Ledger()
    portfolio, *others = (
        _landed(spark, path, staged, run_date, source, steps)
        for path, source in ((portfolio_csv, "portfolio"), (risk_scores_csv, "risk_scores"), (latlong_csv, "latlong"))
    )
    kind = _id_type(others) if how == "inner" else None
    if kind:
        table = _merged_by_number(portfolio, others, how, kind)
    else:
        table = merge_portfolio(portfolio, *others, how=how, salted=True)
    publish(steps.watch(table, "merged", after="portfolio"), f"{merged}/parquet", run_date)
    stored = read_published(spark, f"{merged}/parquet", run_date).drop("dt")
    publish(stored, f"{merged}/csv", run_date, fmt="csv")
    publish(stored, f"{merged}/json", run_date, fmt="json")
    steps.publish(spark, ledger, "merge-portfolio", run_date)
    return steps.rows_out("merged")


def portfolio_conversion_job(
    spark: SparkSession,
    portfolio_csv: str,
    risk_scores_csv: str,
    latlong_csv: str,
    merged: str,
    reports: str,
    staged: str,
    run_date: str,
    ledger: str | None = None,
) -> int:
    """The merge that keeps every portfolio row, with duplicate reports of the inputs, of both joins, and the list of
    ids behind each duplicated property number. Returns the number of rows written."""
    rows = portfolio_merge_job(spark, portfolio_csv, risk_scores_csv, latlong_csv, merged, staged, run_date, "left", ledger)

    def stage(source: str) -> DataFrame:
        return read_published(spark, f"{staged}/{source}", run_date).drop("dt")

    table = read_published(spark, f"{merged}/parquet", run_date).drop("dt")
    keys = {source: stage(source).select("id", "uprn") for source in ("portfolio", "risk_scores", "latlong")}
    pairs = {source: pair_counts(df) for source, df in keys.items()}
    # The join with the scores repeats a row as often as they hold its id; counts tell, no row is joined again.
    pairs["portfolio_scored"] = joined_pair_counts(pairs["portfolio"], keys["risk_scores"])
    pairs["portfolio_merged"] = pair_counts(table.select("id", "uprn"))
    for step, counts in pairs.items():
        publish(duplicates_of_pairs(counts), f"{reports}/duplicates/step={step}", run_date, fmt="csv")

    publish(duplicate_keys(table, ["uprn"]), f"{reports}/duplicate_uprns", run_date, fmt="csv")
    members = duplicate_members(table, "uprn", "id", members_of=keys["latlong"])
    publish(members, f"{reports}/duplicate_uprn_ids", run_date, fmt="csv")
    return rows


def duplicate_update_job(
    spark: SparkSession,
    added_csv: str,
    state: str,
    reports: str,
    staged: str,
    run_date: str,
    removed_csv: str | None = None,
    ledger: str | None = None,
) -> None:
    """Brings the duplicate counts of a portfolio up to a day by the rows that came and, if given, those that went, and
    publishes the report of the whole portfolio as it then stands. Rows of earlier days are not read."""
    steps = Ledger()
    added = _landed(spark, added_csv, staged, run_date, "added", steps)
    removed = _landed(spark, removed_csv, staged, run_date, "removed", steps) if removed_csv else None
    counts = keep_pair_counts(spark, state, run_date, added, removed)
    publish(duplicates_of_pairs(counts), f"{reports}/duplicates", run_date, fmt="csv")
    steps.publish(spark, ledger, "update-duplicates", run_date)


def typed_portfolio(df: DataFrame) -> DataFrame:
    """A merged portfolio with lower-case names, missing values as null, numbers as numbers, and the capital implied
    by loan and loan-to-value."""
    typed = typed_columns(blank_to_null(lower_columns(df)), PORTFOLIO_TYPES)
    return typed.withColumn("initial_borrow_capital", initial_capital("currentloan", "currentltv"))
