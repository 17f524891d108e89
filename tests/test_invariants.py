"""Relations between results that hold on any data, checked on the driver tables."""

import pytest
from pyspark.sql import functions as F

from catalogue import exposure, files, quality
from catalogue.tables import table
from riskbook.operators import report
from riskbook.operators.merges import enrich_loan_book, unmatched_loans
from riskbook.operators.quality import duplicate_keys, rows_with_min_group

SF_DIR = "/root/testdata/sf0.001"


def test_sections_add_up_to_the_total(spark):
    book = exposure.book(spark, SF_DIR)
    total = report.total_exposure(book, "capital").first()[0]
    for section in (
        report.exposure_by_label(book, "rating", "capital"),
        report.exposure_by_band(book, "kwh", "capital"),
    ):
        figures = section.agg(F.sum("exposure"), F.sum("total_count")).first()
        assert figures[0] == pytest.approx(total)
        assert figures[1] == book.count()


def test_enrichment_keeps_properties_and_accounts_for_loans(spark):
    properties = table(spark, SF_DIR, "orders").selectExpr("o_orderkey AS ecad_id")
    loans = table(spark, SF_DIR, "events").selectExpr("event_id AS ecad_id", "value AS amount")
    book = enrich_loan_book(properties, loans)
    assert book.count() >= properties.count()
    assert book.select("ecad_id").distinct().count() == properties.count()
    matched = book.where("amount IS NOT NULL").count()
    assert matched + unmatched_loans(loans, properties).count() == loans.count()


def test_valid_and_rejected_rows_are_all_lines(spark):
    valid, rejects = files.landed_items(spark, SF_DIR)
    assert valid.count() + rejects.count() == table(spark, SF_DIR, "lineitem").count()
    assert valid.count() > 0 and rejects.count() > 0


def test_group_filter_and_duplicate_report_agree(spark):
    items = table(spark, SF_DIR, "lineitem")
    kept = rows_with_min_group(items, "l_orderkey", 2)
    counts = duplicate_keys(items, ["l_orderkey"])
    assert kept.count() == counts.agg(F.sum("count")).first()[0]
    assert kept.select("l_orderkey").distinct().count() == counts.count()


def test_both_profiles_agree(spark):
    def plain(df):
        return sorted(tuple(r) for r in df.collect())

    assert plain(quality.numeric_profile(spark, SF_DIR)) == plain(quality.narrowed_profile(spark, SF_DIR))
