"""Driver tables in the column layout of the two use cases, with SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.tables import table
from riskbook.functions.details import RETURN_PERIODS, return_period_profile

# The flood index by line number; the seventh is no index of the palette.
INDEXES = ("No Colour", "green", "amber", "red", "black 1", "black 2", "white")


def property_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with the columns of the enriched loan book that the layers show."""
    index = F.element_at(F.array(*[F.lit(x) for x in INDEXES]), F.col("l_linenumber"))
    depths = {depth: F.col("l_quantity") * i / 10 for i, (_, _, depth, _) in enumerate(RETURN_PERIODS, start=1)}
    scores = {score: F.col("l_linenumber") * i for i, (_, _, _, score) in enumerate(RETURN_PERIODS, start=1)}
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return rows.select(
        F.col("l_orderkey").alias("ecad_id"),
        (50 + F.col("l_extendedprice") / 1e5).alias("etrs89_lat"),
        (F.col("o_totalprice") / 1e6 - 8).alias("etrs89_long"),
        F.col("o_orderstatus").alias("address_line_1"),
        F.col("o_orderpriority").alias("address_line_2"),
        F.expr("nullif(l_linestatus, 'F')").alias("address_line_3"),
        F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("ber_rating"),
        (F.col("l_quantity") * 12).alias("ber_rating_kwh"),
        F.col("l_tax").alias("co2_emission"),
        *[F.col("l_linenumber").alias(c) for c in ("riverrp", "coastaludrp", "swaterrp", "floodscore_ud")],
        *[F.col("l_linestatus").alias(c) for c in ("model_river", "model_coastal", "model_sw")],
        *[expr.alias(c) for c, expr in {**depths, **scores}.items()],
        index.alias("floodability_index_ud"),
        F.col("l_linenumber").alias("Asset_id"),
        F.col("o_orderpriority").alias("product"),
        (F.col("l_linenumber") * 12).alias("term"),
        F.col("l_discount").alias("Rate/Margin"),
        *[F.col("o_orderstatus").alias(c) for c in ("Disbursment_Date", "Closing_Date")],
        F.col("o_totalprice").alias("Initial_Borrow_Capital"),
        F.col("l_tax").alias("LTV"),
        *[F.col("l_extendedprice").alias(c) for c in ("Monthly_Repayment", "Mortgage_Outstanding")],
    )


_INDEX_SQL = "CASE l_linenumber " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(INDEXES, start=1)) + " END"

PROPERTY_BOOK_SQL = f"""property_book AS (
    SELECT l_orderkey AS ecad_id, 50 + l_extendedprice / 1e5 AS etrs89_lat, o_totalprice / 1e6 - 8 AS etrs89_long,
           o_orderstatus || ' ' || o_orderpriority || ' ' || nullif(l_linestatus, 'F') AS address,
           l_returnflag || l_linenumber AS ber_rating, l_quantity * 12 AS ber_rating_kwh, l_tax AS co2_emission,
           {_INDEX_SQL} AS floodability_index_ud, l_linenumber, l_quantity, l_linestatus, l_discount, l_tax,
           o_orderpriority, o_orderstatus, o_totalprice, l_extendedprice
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

TYPES = ("ECONOMY", "STANDARD", "PROMO", "LARGE")

TEXTS = (
    "built_form", "construction_age_band", "glazed_type", "hotwater_description", "hot_water_energy_eff",
    "hot_water_env_eff", "floor_description", "floor_energy_eff", "floor_env_eff", "windows_description",
    "windows_energy_eff", "windows_env_eff", "walls_description", "walls_energy_eff", "walls_env_eff",
    "roof_description", "roof_energy_eff", "roof_env_eff",
)
NUMBERS = (
    "postcode_flag", "energy_consumption_current", "energy_consumption_potential", "co2_emissions_current",
    "co2_emissions_potential", "current_energy_efficiency", "potential_energy_efficiency", "rhighscore",
    "rhighscore_adj", "chighscore", "chighscore_adj", "swhighscore", "swhighscore_adj", "gwhighscore",
    "canal_failure_value", "dam_break_value", "unflood_value", "sop_river_value", "sop_surface_water_value",
    "npd_peat", "npd_sand", "npd_silt", "npd_soft", "environment_impact_current", "environment_impact_potential",
)


def portfolio_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with the columns of the typed portfolio that the layers show."""
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    rating = "substring('ABCDEFG', l_linenumber, 1)"
    return rows.select(
        F.col("l_partkey").alias("uprn"),
        F.col("l_orderkey").alias("easting"),
        F.col("l_partkey").alias("northing"),
        (50 + F.col("l_extendedprice") / 1e5).alias("latitude"),
        (F.col("p_retailprice") / 1e3 - 3).alias("longitude"),
        F.expr("nullif(p_type, 'MEDIUM')").alias("property_type"),
        *[F.concat(F.col("p_brand"), F.lit(f" {i}")).alias(c) for i, c in enumerate(TEXTS)],
        *[(F.col("l_linenumber") + i).alias(c) for i, c in enumerate(NUMBERS)],
        F.expr(f"nullif({rating}, 'D')").alias("current_energy_rating"),
        F.expr(rating).alias("potential_energy_rating"),
        F.expr(f"nullif({rating}, 'E')").alias("current_environmental_rating"),
        F.expr("l_returnflag").alias("potential_environmental_rating"),
        F.expr("nullif(l_quantity, 25) * 2.5D - 10").alias("combinedscore_adj"),
        F.expr("p_size * 2 - 10").alias("combinedscore"),
        F.concat(F.lit("NATION_"), F.col("p_size")).alias("local_authority_label"),
        F.col("l_extendedprice").alias("currentloan"),
        F.col("l_discount").alias("currentltv"),
        F.try_divide("l_extendedprice", "l_discount").alias("initial_borrow_capital"),
    )


PORTFOLIO_BOOK_SQL = """portfolio_book AS (
    SELECT *, CASE WHEN a > b THEN a ELSE b END AS v FROM (
        SELECT *, l_partkey AS uprn, 50 + l_extendedprice / 1e5 AS latitude, p_retailprice / 1e3 - 3 AS longitude,
               nullif(p_type, 'MEDIUM') AS property_type, substr('ABCDEFG', l_linenumber, 1) AS letter,
               nullif(l_quantity, 25) * 2.5 - 10 AS a, p_size * 2 - 10 AS b, 'NATION_' || p_size AS council
        FROM lineitem JOIN part ON l_partkey = p_partkey))"""


def number_of(name: str) -> str:
    return f"l_linenumber + {NUMBERS.index(name)}"


def text_of(name: str) -> str:
    return f"p_brand || ' {TEXTS.index(name)}'"


def profile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return return_period_profile(property_book(spark, sf_dir), ["ecad_id", "Asset_id"])


def column_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The few columns of the enriched book that the loan overview keeps."""
    return property_book(spark, sf_dir).select(
        "ecad_id", "ber_rating_kwh", "co2_emission", "Asset_id", "Mortgage_Outstanding"
    )


QUERIES = {"return_period_profile": profile_rows, "column_subset": column_subset}

SQL = {
    "column_subset": """
        SELECT l_orderkey AS ecad_id, l_quantity * 12 AS ber_rating_kwh, l_tax AS co2_emission,
               l_linenumber AS "Asset_id", l_extendedprice AS "Mortgage_Outstanding"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "return_period_profile": " UNION ALL ".join(
        f"""SELECT l_orderkey AS ecad_id, l_linenumber AS Asset_id, '{hazard}' AS hazard, {years} AS return_period,
            l_quantity * {i} / 10 AS depth_m, l_linenumber * {i} AS score
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
        for i, (hazard, years, _, _) in enumerate(RETURN_PERIODS, start=1)
    ),
}
