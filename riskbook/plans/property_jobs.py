"""Property use case: merge of property, energy and flood files, and loan-book enrichment."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.operators.merges import enrich_loan_book, merge_property_risk
from riskbook.sources import schemas
from riskbook.sources.keyed import publish_by_key, read_by_key
from riskbook.sources.ledger import Ledger
from riskbook.sources.publish import publish, read_published, write_rejects
from riskbook.sources.readers import land_csv

UNIT = "ecad_id"


def _valid_rows(
    spark: SparkSession, path: str, schema, staged: str, rejected: str, run_date: str, source: str, ledger: Ledger
) -> DataFrame:
    """Lands a file under ``staged/<source>/dt=<run_date>`` and stores its rejects."""
    watch = partial(ledger.watch, step=source, rejected=F.col(schemas.CORRUPT).isNotNull())
    valid, rejects = land_csv(spark, path, schema, f"{staged}/{source}/dt={run_date}", watch=watch)
    write_rejects(rejects, rejected, run_date, source)
    return valid


def merge_property_risk_job(
    spark: SparkSession,
    property_csv: str,
    energy_csv: str,
    flood_csv: str,
    merged: str,
    rejected: str,
    staged: str,
    run_date: str,
    loans_csv: str | None = None,
    ledger: str | None = None,
    keyed: str | None = None,
    buckets: int = 512,
) -> int:
    """Merges the three files (and the loan book, if given) and publishes the day's table at ``merged`` and, if places
    are given, the counts of its steps at ``ledger`` and the table once more, stored by unit, at ``keyed``. Returns the
    number of rows written."""
    steps = Ledger()

    def land(path: str, schema, source: str) -> DataFrame:
        return _valid_rows(spark, path, schema, staged, rejected, run_date, source, steps)

    table = merge_property_risk(
        land(property_csv, schemas.PROPERTY, "ecad"),
        land(energy_csv, schemas.ENERGY_RATING, "energy_rating"),
        land(flood_csv, schemas.FLOOD_INDEX, "flood_index"),
        land(loans_csv, schemas.LOAN_BOOK, "loan_book") if loans_csv else None,
    )
    publish(steps.watch(table, "merged", after="ecad"), merged, run_date)
    if keyed is not None:
        publish_by_key(read_published(spark, merged, run_date).drop("dt"), keyed, run_date, UNIT, buckets)
    steps.publish(spark, ledger, "merge-property", run_date)
    return steps.rows_out("merged")


def enrich_loan_book_job(
    spark: SparkSession,
    merged: str,
    loans_csv: str,
    enriched: str,
    enriched_csv: str,
    rejected: str,
    staged: str,
    run_date: str,
    ledger: str | None = None,
    keyed: str | None = None,
) -> int:
    """Adds the loan book to the day's merged table, from ``keyed`` where it is stored by unit: then only the loans are
    shuffled. The result is published as Parquet, which the later jobs read,
    and as CSV. Returns the number of rows written."""
    steps = Ledger()
    loans = _valid_rows(spark, loans_csv, schemas.LOAN_BOOK, staged, rejected, run_date, "loan_book", steps)
    if keyed is None:
        properties = read_published(spark, merged, run_date).drop("dt")
    else:
        properties = read_by_key(spark, keyed, UNIT, run_date)
    publish(steps.watch(enrich_loan_book(properties, loans), "enriched", after="loan_book"), enriched, run_date)
    publish(read_published(spark, enriched, run_date).drop("dt"), enriched_csv, run_date, fmt="csv")
    steps.publish(spark, ledger, "enrich-loan-book", run_date)
    return steps.rows_out("enriched")
