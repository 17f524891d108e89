"""Merges: J1-J5, P1-P3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.tables import table
from riskbook.operators.merges import (
    enrich_loan_book,
    lower_columns,
    merge_portfolio,
    merge_property_risk,
    unmatched_loans,
    with_key,
)


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS ecad_id", "o_custkey AS building_id", "o_orderpriority"
    )


def flood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS ecad_id", "c_acctbal AS flood_value", "c_mktsegment AS flood_index"
    )


def property_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    energy = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS ecad_id", "concat(l_returnflag, l_linenumber) AS ber_rating", "l_quantity * 12 AS ber_rating_kwh"
    )
    return merge_property_risk(properties(spark, sf_dir), energy, flood(spark, sf_dir))


def property_risk_with_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    energy = table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS ecad_id", "lang AS ber_rating", "n_chars AS ber_rating_kwh"
    )
    loans = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS ecad_id", "l_linenumber AS asset_id", "l_extendedprice AS amount"
    )
    return merge_property_risk(properties(spark, sf_dir), energy, flood(spark, sf_dir), loans)


def crowded_building(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as units of five buildings, each holding a fifth of all units: the building join is salted."""
    events = table(spark, sf_dir, "events")
    units = events.selectExpr("event_id AS ecad_id", "event_type AS building_id", "value AS area")
    ratings = events.selectExpr("event_id AS ecad_id", "user_id AS ber_rating")
    buildings = events.groupBy(F.col("event_type").alias("ecad_id")).agg(F.max("value").alias("flood_value"))
    return merge_property_risk(units, ratings, buildings, salted=True)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS ecad_id", "o_totalprice AS valuation")
    loans = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS ecad_id", "l_linenumber AS asset_id", "l_extendedprice AS amount", "l_discount AS ltv"
    )
    return enrich_loan_book(merged, loans)


def unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return unmatched_loans(loans, table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")


def portfolio_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Portfolio, risk scores and coordinates with upper-case names, as they arrive."""
    portfolio = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS ID", "o_custkey AS UPRN", "o_totalprice AS EASTING", "o_orderstatus AS TENURE"
    )
    scores = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS ID", "l_suppkey AS UPRN", "l_linenumber AS NPD_CLAY", "l_quantity AS COMBINEDSCORE"
    )
    latlong = table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS ID", "n_chars AS UPRN", "n_chars AS EASTING", "n_chars AS NORTHING",
        "50 + n_chars / 1e6D AS LATITUDE", "-2 - n_chars / 1e6D AS LONGITUDE",
    )
    return tuple(with_key(lower_columns(df), "id") for df in (portfolio, scores, latlong))


def portfolio_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_portfolio(*portfolio_parts(spark, sf_dir), how="left", grid=("easting", "northing"))


def portfolio_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_portfolio(*portfolio_parts(spark, sf_dir), how="inner", grid=("easting", "northing"))


_PORTFOLIO_SQL = """
    SELECT o_orderkey AS id, o_custkey AS uprn, o_totalprice AS easting, o_orderstatus AS tenure,
           l_linenumber AS npd_clay, l_quantity AS combinedscore,
           50 + n_chars / 1e6 AS latitude, -2 - n_chars / 1e6 AS longitude
    FROM orders {how} JOIN lineitem ON o_orderkey = l_orderkey {how} JOIN documents ON o_orderkey = doc_id
"""

QUERIES = {
    "merge_property_risk": property_risk,
    "merge_with_loans": property_risk_with_loans,
    "merge_crowded_building": crowded_building,
    "enrich_loan_book": enriched,
    "unmatched_loans": unmatched,
    "portfolio_left_merge": portfolio_left,
    "portfolio_inner_merge": portfolio_inner,
}

SQL = {
    "merge_property_risk": """
        SELECT o_orderkey AS ecad_id, o_custkey AS building_id, o_orderpriority,
               l_returnflag || l_linenumber AS ber_rating, l_quantity * 12 AS ber_rating_kwh,
               c_acctbal AS flood_value, c_mktsegment AS flood_index
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
    """,
    "merge_with_loans": """
        SELECT o_orderkey AS ecad_id, o_custkey AS building_id, o_orderpriority,
               lang AS ber_rating, n_chars AS ber_rating_kwh, l_linenumber AS asset_id, l_extendedprice AS amount,
               c_acctbal AS flood_value, c_mktsegment AS flood_index
        FROM orders JOIN documents ON o_orderkey = doc_id JOIN lineitem ON o_orderkey = l_orderkey
             JOIN customer ON o_custkey = c_custkey
    """,
    "merge_crowded_building": """
        SELECT e.event_id AS ecad_id, e.event_type AS building_id, e.value AS area, r.user_id AS ber_rating,
               b.flood_value
        FROM events e JOIN events r ON e.event_id = r.event_id
             JOIN (SELECT event_type, max(value) AS flood_value FROM events GROUP BY event_type) b
               ON e.event_type = b.event_type
    """,
    "enrich_loan_book": """
        SELECT o_orderkey AS ecad_id, o_totalprice AS valuation, l_linenumber AS asset_id,
               l_extendedprice AS amount, l_discount AS ltv
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    """,
    "unmatched_loans": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """,
    "portfolio_left_merge": _PORTFOLIO_SQL.format(how="LEFT"),
    "portfolio_inner_merge": _PORTFOLIO_SQL.format(how="INNER"),
}
