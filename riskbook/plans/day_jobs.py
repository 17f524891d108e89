"""A day of a use case as one run: all of its tables appear together, or none does."""

from __future__ import annotations

from pyspark.sql import SparkSession

from riskbook.plans.layer_jobs import portfolio_layers_job, property_layers_job
from riskbook.plans.portfolio_jobs import portfolio_conversion_job
from riskbook.plans.property_jobs import enrich_loan_book_job, merge_property_risk_job
from riskbook.plans.regulatory_jobs import portfolio_report_job, property_report_job
from riskbook.sources.runs import complete_run


def property_day_job(
    spark: SparkSession,
    property_csv: str,
    energy_csv: str,
    flood_csv: str,
    loans_csv: str,
    base: str,
    run_date: str,
    unit: float = 1.0,
) -> None:
    """Merge, loan book, report and layers of a day, with their ledgers, as one complete run under ``base``."""
    with complete_run(spark, base, run_date) as run:
        rejected, staged, ledger = f"{run}/rejected", f"{run}/staged", f"{run}/ledger"
        merge_property_risk_job(
            spark, property_csv, energy_csv, flood_csv, f"{run}/merged", rejected, staged, run_date, ledger=ledger
        )
        enrich_loan_book_job(
            spark, f"{run}/merged", loans_csv, f"{run}/enriched", f"{run}/enriched_csv", rejected, staged, run_date, ledger
        )
        property_report_job(spark, f"{run}/enriched", f"{run}/reports", run_date, unit)
        property_layers_job(spark, f"{run}/enriched", f"{run}/layers", run_date)


def portfolio_day_job(
    spark: SparkSession,
    portfolio_csv: str,
    risk_scores_csv: str,
    latlong_csv: str,
    boundaries_json: str,
    base: str,
    run_date: str,
    unit: float = 1.0,
) -> None:
    """Conversion, report and layers of a portfolio day, with the ledger, as one complete run under ``base``."""
    with complete_run(spark, base, run_date) as run:
        portfolio_conversion_job(
            spark, portfolio_csv, risk_scores_csv, latlong_csv,
            f"{run}/merged", f"{run}/reports", f"{run}/staged", run_date, f"{run}/ledger",
        )
        portfolio_report_job(spark, f"{run}/merged", f"{run}/reports", run_date, unit)
        portfolio_layers_job(spark, f"{run}/merged", boundaries_json, f"{run}/layers", run_date)
