"""Map layers: L1-L3, L5, L6, L8, P15. The detail structs are flattened to columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalogue.books import (
    PORTFOLIO_BOOK_SQL,
    PROPERTY_BOOK_SQL,
    TYPES,
    number_of,
    portfolio_book,
    property_book,
    text_of,
)
from catalogue.scores import RATING_SQL
from catalogue.tables import sql_values
from riskbook.functions import details
from riskbook.functions.palettes import (
    BER_COLOURS,
    ENVIRONMENT_COLOURS,
    EPC_COLOURS,
    FLOOD_INDEX_COLOURS,
    FLOOD_SCORE_COLOURS,
)
from riskbook.operators import layers

PROPERTY_POINT = ("ecad_id", "etrs89_lat", "etrs89_long")
PORTFOLIO_POINT = ("uprn", "latitude", "longitude")
COUNCILS = tuple(f"NATION_{i}" for i in (1, 4, 9, 16, 25, 36, 49))


def energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = layers.energy_layer(
        property_book(spark, sf_dir), *PROPERTY_POINT, "ber_rating", BER_COLOURS, details.property_energy_detail()
    )
    return layer.select("id", "lat", "lon", "colour", "label", "detail.*")


def flood_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = layers.flood_layer(
        property_book(spark, sf_dir), *PROPERTY_POINT, mode="index", detail=details.property_flood_detail()
    )
    return layer.select(
        "id", "lat", "lon", "colour", "label", "detail.address", "detail.riverrp", "detail.floodscore_ud",
        "detail.model_sw",
    ).withColumnRenamed("riverrp", "river_return_period")


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = layers.index_layer(property_book(spark, sf_dir), *PROPERTY_POINT, details.property_index_detail())
    return layer.select("id", "lat", "lon", "label", "detail.address", "detail.ber_rating", "detail.loan.*")


def certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = layers.energy_layer(
        portfolio_book(spark, sf_dir), *PORTFOLIO_POINT, "current_energy_rating", EPC_COLOURS,
        details.portfolio_energy_detail(),
    )
    return layer.selectExpr(
        "id", "lat", "lon", "colour", "label", "detail.description", "detail.potential_energy_rating",
        "detail.energy_consumption_potential AS consumption", "detail.fabric[4].part AS part",
        "detail.fabric[4].description AS part_description",
        "detail.fabric[4].environment_efficiency AS part_efficiency",
        "detail.loan.currentloan", "detail.loan.ltv_percent",
    )


def flood_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = layers.flood_layer(
        portfolio_book(spark, sf_dir), *PORTFOLIO_POINT, mode="score", detail=details.portfolio_flood_detail()
    )
    return layer.selectExpr(
        "id", "lat", "lon", "colour", "label", "detail.scores[1].hazard AS hazard",
        "detail.scores[1].defended AS defended", "detail.scores[1].undefended AS undefended", "detail.npd_soft",
    )


def portfolio_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = layers.index_layer(portfolio_book(spark, sf_dir), *PORTFOLIO_POINT, details.portfolio_index_detail())
    return layer.selectExpr(
        "id", "lat", "lon", "label", "detail.current_energy_rating", "detail.co2_emissions_current AS co2",
        "detail.scores[3].defended AS defended", "detail.scores[3].undefended AS undefended",
    )


def types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.type_layer(portfolio_book(spark, sf_dir), *PORTFOLIO_POINT, kinds=TYPES)


def councils(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.council_layer(portfolio_book(spark, sf_dir), *PORTFOLIO_POINT, names=COUNCILS)


def environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = layers.environment_layer(
        portfolio_book(spark, sf_dir), *PORTFOLIO_POINT, detail=details.portfolio_environment_detail()
    )
    return layer.selectExpr("id", "lat", "lon", "border_colour", "fill_colour", "label",
                            "detail.environment_impact_potential AS impact")


def _pairs(palette) -> str:
    return sql_values((code, colour) for code, colour in palette.items() if code is not None)


_POINT = "uprn AS id, latitude AS lat, longitude AS lon"

QUERIES = {
    "energy_layer": energy,
    "flood_index_layer": flood_index,
    "index_layer": index,
    "certificate_layer": certificate,
    "flood_layer": flood_score,
    "portfolio_index_layer": portfolio_index,
    "type_layer": types,
    "council_layer": councils,
    "environment_layer": environment,
}

SQL = {
    "energy_layer": f"""WITH {PROPERTY_BOOK_SQL}
        SELECT ecad_id AS id, etrs89_lat AS lat, etrs89_long AS lon, colour, ber_rating AS label, address,
               ber_rating, ber_rating_kwh, co2_emission
        FROM property_book LEFT JOIN {_pairs(BER_COLOURS)} p(code, colour) ON ber_rating = code""",
    "flood_index_layer": f"""WITH {PROPERTY_BOOK_SQL}
        SELECT ecad_id AS id, etrs89_lat AS lat, etrs89_long AS lon, colour, floodability_index_ud AS label, address,
               l_linenumber AS river_return_period, l_linenumber AS floodscore_ud, l_linestatus AS model_sw
        FROM property_book LEFT JOIN {_pairs(FLOOD_INDEX_COLOURS)} p(code, colour) ON floodability_index_ud = code""",
    "index_layer": f"""WITH {PROPERTY_BOOK_SQL}
        SELECT ecad_id AS id, etrs89_lat AS lat, etrs89_long AS lon, CAST(ecad_id AS VARCHAR) AS label, address,
               ber_rating, l_linenumber AS "Asset_id", o_orderpriority AS product, l_linenumber * 12 AS term,
               round(l_discount * 100, 2) AS rate_percent, o_orderstatus AS "Disbursment_Date",
               o_orderstatus AS "Closing_Date", o_totalprice AS "Initial_Borrow_Capital",
               CAST(floor(l_tax * 100) AS BIGINT) AS ltv_percent, l_extendedprice AS "Monthly_Repayment",
               l_extendedprice AS "Mortgage_Outstanding"
        FROM property_book""",
    "certificate_layer": f"""WITH {PORTFOLIO_BOOK_SQL}
        SELECT {_POINT}, CASE WHEN letter = 'D' THEN '#deebf6' ELSE colour END AS colour,
               nullif(letter, 'D') AS label,
               'Property_type=' || coalesce(property_type, 'nan') || '. ' || {text_of("built_form")} || '. '
               || ({number_of("postcode_flag")}) || '. Easting/Norting=' || l_orderkey || '/' || l_partkey
               || '. Latitude/Longitude=' || latitude || '/' || longitude AS description,
               letter AS potential_energy_rating, {number_of("energy_consumption_potential")} AS consumption,
               'roof' AS part, {text_of("roof_description")} AS part_description,
               {text_of("roof_env_eff")} AS part_efficiency, l_extendedprice AS currentloan,
               round(l_discount * 100, 4) AS ltv_percent
        FROM portfolio_book LEFT JOIN {_pairs(EPC_COLOURS)} p(code, colour) ON letter = code""",
    "flood_layer": f"""WITH {PORTFOLIO_BOOK_SQL}, rated AS (SELECT *, {RATING_SQL} AS label FROM portfolio_book)
        SELECT {_POINT}, colour, label, 'coastal' AS hazard, CAST({number_of("chighscore")} AS DOUBLE) AS defended,
               CAST({number_of("chighscore_adj")} AS DOUBLE) AS undefended, {number_of("npd_soft")} AS npd_soft
        FROM rated LEFT JOIN {_pairs(FLOOD_SCORE_COLOURS)} p(code, colour) ON label = code""",
    "portfolio_index_layer": f"""WITH {PORTFOLIO_BOOK_SQL}
        SELECT {_POINT}, CAST(uprn AS VARCHAR) AS label, nullif(letter, 'D') AS current_energy_rating,
               {number_of("co2_emissions_current")} AS co2, CAST(b AS DOUBLE) AS defended, a AS undefended
        FROM portfolio_book""",
    "type_layer": f"""WITH {PORTFOLIO_BOOK_SQL}
        SELECT {_POINT}, property_type AS layer FROM portfolio_book WHERE property_type IN {TYPES}""",
    "council_layer": f"""WITH {PORTFOLIO_BOOK_SQL}
        SELECT {_POINT}, council AS layer FROM portfolio_book WHERE council IN {COUNCILS}""",
    "environment_layer": f"""WITH {PORTFOLIO_BOOK_SQL}
        SELECT {_POINT}, c.colour AS border_colour, f.colour AS fill_colour, nullif(letter, 'E') AS label,
               {number_of("environment_impact_potential")} AS impact
        FROM portfolio_book
             LEFT JOIN {_pairs(ENVIRONMENT_COLOURS)} c(code, colour) ON coalesce(nullif(letter, 'E'), 'Blank') = c.code
             LEFT JOIN {_pairs(ENVIRONMENT_COLOURS)} f(code, colour) ON l_returnflag = f.code""",
}
