"""What the plans of the queries must not contain, and what the scans must read."""

import re

import pytest

import catalogue
import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"
# The jobs and file queries write before they return; their plans only read the result back.
PLANNED = sorted(n for n in catalogue.QUERIES if not n.startswith(("job_", "roundtrip", "read_", "rejects", "valid")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLANNED)
def test_no_unscalable_operator(spark, name):
    text = plan(driver.queries()[name](spark, SF_DIR))
    unwanted = (
        "CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInArrow", "MapInPandas", "InMemoryTableScan",
    )
    for operator in unwanted:
        assert operator not in text, operator
    # The windows of the profile are over bins, those of a document over the pieces of one block and over blocks.
    if not name.startswith("profile") and name != "boundary_document":
        assert "Window" not in text


def read_columns(text):
    return [set(re.findall(r"(\w+)#", columns)) for columns in re.findall(r"FileScan parquet \[([^\]]*)\]", text)]


def test_scans_are_pruned(spark):
    read = read_columns(plan(driver.queries()["pillar3_matrix"](spark, SF_DIR)))
    assert sorted(map(len, read)) == [1, 6]
    read = read_columns(plan(driver.queries()["category_counts"](spark, SF_DIR)))
    assert read == [{"o_orderpriority"}]
    read = read_columns(plan(driver.queries()["council_layer"](spark, SF_DIR)))
    assert {"l_partkey", "l_extendedprice"} in read


def test_heat_layer_stays_small(spark):
    assert len(plan(driver.queries()["heat_layer"](spark, SF_DIR))) < 10_000


def test_duplicate_report_does_not_sort_or_expand(spark):
    text = plan(driver.queries()["duplicate_report"](spark, SF_DIR))
    assert "rangepartitioning" not in text and "Expand" not in text and "Sort " not in text


def test_report_scans_the_book_once(spark):
    text = plan(driver.queries()["pillar3_matrix"](spark, SF_DIR))
    assert text.count("FileScan") == 2


def test_filters_are_pushed(spark):
    from riskbook.operators.layers import type_layer

    parts = spark.read.parquet(f"{SF_DIR}/part.parquet")
    text = plan(type_layer(parts, "p_partkey", "p_size", "p_retailprice", "p_type", ("PROMO", "LARGE")))
    assert re.search(r"PushedFilters: \[[^\]]*In\(p_type", text)


def test_layers_do_not_shuffle(spark):
    from catalogue.books import portfolio_book
    from riskbook.operators.layers import heat_layer

    stored = portfolio_book(spark, SF_DIR)
    assert plan(heat_layer(stored, "latitude", "longitude")).count("Exchange") == plan(stored).count("Exchange")


@pytest.mark.parametrize("name,shuffles", [
    # One shuffle per input: the second join on the same key reuses the partitioning of the first.
    ("portfolio_left_merge", 3),
    ("portfolio_inner_merge", 3),
    ("enrich_loan_book", 2),
    # One more for the change from unit to building, and one for the flood table.
    ("merge_property_risk", 4),
    ("merge_with_loans", 5),
    # Counts are combined before their shuffle, which the join back reuses.
    ("duplicate_members", 2),
    ("rows_with_min_group", 2),
    ("unmatched_loans", 2),
    ("exposure_by_label", 4),
    ("category_counts", 1),
    ("all_category_counts", 3),
])
def test_number_of_shuffles(spark, name, shuffles):
    """Shuffles when no side is small enough to be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(driver.queries()[name](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning") + text.count("Exchange rangepartitioning") == shuffles, text
