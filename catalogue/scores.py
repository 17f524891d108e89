"""Flood scores, colours, display figures and coordinates: P8-P11, P14, P19, L4, L9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.tables import sql_values, table
from riskbook.functions import display
from riskbook.functions.flood import flood_rating
from riskbook.functions.grid import with_wgs84
from riskbook.functions.palettes import (
    BER_COLOURS,
    EPC_COLOURS_CLASSIC,
    FLOOD_SCORE_COLOURS,
    FLOOD_SCORE_LABELS,
    legend,
    unknown_codes,
    with_colour,
)
from riskbook.operators.layers import energy_layer, heat_layer


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with two scores that take zeros, fractions, negatives, values over 100 and missing values."""
    items = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "nullif(l_quantity, 25) * 2.5D - 10 AS a"
    )
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey", "nullif(p_size, 7) * 2 - 10 AS b", "p_retailprice")
    return items.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("l_orderkey", "l_linenumber", "a", "b", flood_rating("a", "b").alias("rating"))


def heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heat_layer(scored(spark, sf_dir), "l_extendedprice", "p_retailprice", "a", "b")


def rated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "concat(l_returnflag, l_linenumber) AS rating",
        "nullif(l_returnflag, 'N') AS class",
    )


def colours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = with_colour(rated_items(spark, sf_dir), "rating", BER_COLOURS, "rating_colour")
    return with_colour(rated, "class", EPC_COLOURS_CLASSIC, "class_colour")


def unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unknown_codes(rated_items(spark, sf_dir), "rating", BER_COLOURS)


def flood_legend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legend of the flood map with the number of points of each colour."""
    points = ratings(spark, sf_dir).groupBy("rating").agg(F.count("*").alias("points"))
    rows = legend(spark, FLOOD_SCORE_COLOURS, FLOOD_SCORE_LABELS)
    return rows.join(points, rows["code"] == points["rating"], "left").drop("rating")


def display_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ("c_name", "segment", "n_name")
    return (
        table(spark, sf_dir, "customer")
        .withColumn("segment", F.expr("nullif(c_mktsegment, 'BUILDING')"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            display.address_line(parts).alias("address"),
            display.address_line(parts, skip_missing=True).alias("known_address"),
            display.description_line(
                "c_mktsegment", "segment", "c_nationkey", "c_custkey", "c_custkey", "n_regionkey", "n_regionkey"
            ).alias("description"),
        )
    )


def loan_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        display.rate_percent("l_discount").alias("rate_percent"),
        display.ltv_whole_percent("l_tax").alias("ltv_whole_percent"),
        display.ltv_percent("l_tax").alias("ltv_percent"),
        display.money("l_extendedprice").alias("amount"),
    )


def wgs84(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "200000 + l_extendedprice * 4 AS easting",
        "50000 + l_quantity * 18000 AS northing",
    )
    placed = with_wgs84(points, "easting", "northing")
    return placed.withColumns({c: F.round(c, 5) for c in ("latitude", "longitude")})


def placed_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rated points whose position comes from the grid, per map cell and colour."""
    points = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS uprn", "l_returnflag AS rating", "200000 + l_extendedprice * 4 AS easting",
        "50000 + l_quantity * 18000 AS northing",
    )
    placed = with_wgs84(points, "easting", "northing")
    layer = energy_layer(placed, "uprn", "latitude", "longitude", "rating", EPC_COLOURS_CLASSIC)
    return layer.groupBy(
        F.floor(F.round("lat", 5)).alias("south"), F.floor(F.round("lon", 5)).alias("west"), "colour", "label"
    ).agg(F.count("*").alias("points"))


_SCORED = """scored AS (
    SELECT l_orderkey, l_linenumber, l_extendedprice, p_retailprice, a, b, CASE WHEN a > b THEN a ELSE b END AS v FROM (
        SELECT *, nullif(l_quantity, 25) * 2.5 - 10 AS a, nullif(p_size, 7) * 2 - 10 AS b
        FROM lineitem JOIN part ON l_partkey = p_partkey))"""

RATING_SQL = """CASE WHEN v IS NULL OR v < 0 OR v > 100 OR v <> floor(v) THEN 'purple' WHEN v = 0 THEN 'no-colour'
    WHEN v <= 10 THEN 'green' WHEN v <= 29 THEN 'amber' WHEN v <= 45 THEN 'red' WHEN v <= 60 THEN 'black-1'
    ELSE 'black-2' END"""


def _wgs84_sql(kept: str = "") -> str:
    """The iterated conversion as a chain of subqueries, one per step, in degrees and metres."""
    e2 = "(1 - 6356256.909 * 6356256.909 / (6377563.396 * 6377563.396))"
    w2 = "(1 - 6356752.3141 * 6356752.3141 / (6378137.0 * 6378137.0))"
    n = "((6377563.396 - 6356256.909) / (6377563.396 + 6356256.909))"
    af, bf, lat0 = "(6377563.396 * 0.9996012717)", "(6356256.909 * 0.9996012717)", "radians(49e0)"
    arc = f"""{bf} * ((1 + {n} + 1.25 * {n} * {n} + 1.25 * {n} * {n} * {n}) * (f - {lat0})
        - (3 * {n} + 3 * {n} * {n} + 2.625 * {n} * {n} * {n}) * sin(f - {lat0}) * cos(f + {lat0})
        + (1.875 * {n} * {n} + 1.875 * {n} * {n} * {n}) * sin(2 * (f - {lat0})) * cos(2 * (f + {lat0}))
        - 35e0 / 24 * {n} * {n} * {n} * sin(3 * (f - {lat0})) * cos(3 * (f + {lat0})))"""
    q = f"""SELECT l_orderkey, l_linenumber{kept}, 200000 + l_extendedprice * 4 AS easting,
        50000 + l_quantity * 18000 AS northing FROM lineitem"""
    q = f"SELECT *, (northing + 100000) / {af} + {lat0} AS f FROM ({q})"
    for _ in range(6):
        q = f"SELECT * REPLACE (f + (northing + 100000 - ({arc})) / {af} AS f) FROM ({q})"
    q = f"SELECT *, {af} / sqrt(1 - {e2} * sin(f) * sin(f)) AS nu, tan(f) * tan(f) AS t2 FROM ({q})"
    q = f"SELECT *, nu * (1 - {e2}) / (1 - {e2} * sin(f) * sin(f)) AS rho, (easting - 400000) AS d FROM ({q})"
    q = f"""SELECT *, f - tan(f) / (2 * rho * nu) * d**2
            + tan(f) / (24 * rho * nu**3) * (5 + 3 * t2 + (nu / rho - 1) - 9 * t2 * (nu / rho - 1)) * d**4
            - tan(f) / (720 * rho * nu**5) * (61 + 90 * t2 + 45 * t2**2) * d**6 AS la,
        radians(-2e0) + d / (cos(f) * nu) - d**3 / (6 * cos(f) * nu**3) * (nu / rho + 2 * t2)
            + d**5 / (120 * cos(f) * nu**5) * (5 + 28 * t2 + 24 * t2**2)
            - d**7 / (5040 * cos(f) * nu**7) * (61 + 662 * t2 + 1320 * t2**2 + 720 * t2**3) AS lo FROM ({q})"""
    q = f"SELECT *, 6377563.396 / sqrt(1 - {e2} * sin(la) * sin(la)) AS r FROM ({q})"
    q = f"SELECT *, r * cos(la) * cos(lo) AS x, r * cos(la) * sin(lo) AS y, r * (1 - {e2}) * sin(la) AS z FROM ({q})"
    rx, ry, rz = "radians(0.1502e0 / 3600)", "radians(0.2470e0 / 3600)", "radians(0.8421e0 / 3600)"
    s = "(1 - 20.4894e0 / 1000000)"
    q = f"""SELECT *, 446.448 + {s} * x - {rz} * y + {ry} * z AS x2, -125.157 + {rz} * x + {s} * y - {rx} * z AS y2,
        542.060 - {ry} * x + {rx} * y + {s} * z AS z2 FROM ({q})"""
    q = f"SELECT *, atan2(z2, sqrt(x2 * x2 + y2 * y2) * (1 - {w2})) AS p FROM ({q})"
    for _ in range(5):
        q = f"""SELECT * REPLACE (atan2(z2 + {w2} * 6378137.0 / sqrt(1 - {w2} * sin(p) * sin(p)) * sin(p),
            sqrt(x2 * x2 + y2 * y2)) AS p) FROM ({q})"""
    return f"""SELECT l_orderkey, l_linenumber{kept}, easting, northing, round(degrees(p), 5) AS latitude,
        round(degrees(atan2(y2, x2)), 5) + 0 AS longitude FROM ({q})""".replace("6377563.396", "6377563.396e0").replace(
        "6356256.909", "6356256.909e0").replace("6378137.0", "6378137.0e0").replace("6356752.3141", "6356752.3141e0")


QUERIES = {
    "flood_rating": ratings,
    "heat_layer": heat,
    "colour_lookup": colours,
    "unknown_codes": unknown,
    "legend": flood_legend,
    "display_columns": display_columns,
    "loan_figures": loan_figures,
    "wgs84": wgs84,
    "placed_energy_layer": placed_layer,
}

_FLOOD_LEGEND = sql_values([
    (i, code, label, colour)
    for i, ((code, colour), label) in enumerate(zip(FLOOD_SCORE_COLOURS.items(), FLOOD_SCORE_LABELS))
])

SQL = {
    "flood_rating": f"WITH {_SCORED} SELECT l_orderkey, l_linenumber, a, b, {RATING_SQL} AS rating FROM scored",
    "heat_layer": f"""WITH {_SCORED} SELECT l_extendedprice AS lat, p_retailprice AS lon,
        round(CAST(v AS DOUBLE) / 100 * 1.4 + 0.001, 4) AS weight FROM scored""",
    "colour_lookup": f"""
        SELECT l_orderkey, l_linenumber, l_returnflag || l_linenumber AS rating, nullif(l_returnflag, 'N') AS class,
               r.colour AS rating_colour, c.colour AS class_colour
        FROM lineitem
             LEFT JOIN {sql_values(BER_COLOURS.items())} r(code, colour) ON l_returnflag || l_linenumber = r.code
             LEFT JOIN {sql_values(EPC_COLOURS_CLASSIC.items())} c(code, colour)
               ON coalesce(nullif(l_returnflag, 'N'), 'Blank') = c.code""",
    "unknown_codes": f"""
        SELECT l_returnflag || l_linenumber AS code, count(*) AS rows FROM lineitem
        WHERE l_returnflag || l_linenumber NOT IN (SELECT code FROM {sql_values(BER_COLOURS.items())} r(code, colour))
        GROUP BY 1""",
    "legend": f"""WITH {_SCORED}, points AS (
            SELECT {RATING_SQL} AS rating, count(*) AS points FROM scored GROUP BY 1)
        SELECT CAST(l.n AS INTEGER) AS position, l.code, l.label, l.colour, p.points
        FROM {_FLOOD_LEGEND} l(n, code, label, colour) LEFT JOIN points p ON l.code = p.rating""",
    "display_columns": """
        SELECT c_custkey, c_name || ' ' || nullif(c_mktsegment, 'BUILDING') || ' ' || n_name AS address,
               concat_ws(' ', c_name, nullif(c_mktsegment, 'BUILDING'), n_name) AS known_address,
               'Property_type=' || c_mktsegment || '. ' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'nan') || '. '
               || c_nationkey || '. Easting/Norting=' || c_custkey || '/' || c_custkey || '. Latitude/Longitude='
               || n_regionkey || '/' || n_regionkey AS description
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "loan_figures": """
        SELECT l_orderkey, l_linenumber, round(l_discount * 100, 2) AS rate_percent,
               CAST(floor(l_tax * 100) AS BIGINT) AS ltv_whole_percent, round(l_tax * 100, 4) AS ltv_percent,
               round(l_extendedprice, 2) AS amount
        FROM lineitem""",
    "wgs84": _wgs84_sql(),
    "placed_energy_layer": f"""
        SELECT CAST(floor(latitude) AS BIGINT) AS south, CAST(floor(longitude) AS BIGINT) AS west, colour,
               l_returnflag AS label, count(*) AS points
        FROM ({_wgs84_sql(", l_returnflag")}) LEFT JOIN {sql_values(EPC_COLOURS_CLASSIC.items())} c(code, colour)
             ON l_returnflag = code
        GROUP BY ALL""",
}
