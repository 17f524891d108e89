"""Council counts, boundaries and clusters: A8, A9, A13, A14, J7, J8, S13."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.tables import table
from riskbook.operators import councils, layers
from riskbook.sources.boundaries import read_boundaries, write_boundaries
from riskbook.sources.publish import scratch_path

KINDS = ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
NAMED = tuple(f"NATION_{i}" for i in (2, 3, 5, 7, 11, 13, 17))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))


def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the customer's nation and segment; some pairs of these have no event."""
    return table(spark, sf_dir, "events").join(customers(spark, sf_dir), F.col("user_id") == F.col("c_custkey"))


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr("n_nationkey AS LAD13CD", "n_name AS LAD13NM")


_WHERE = {"code": "c_nationkey", "kind": "c_mktsegment", "kinds": KINDS, "label": "n_name"}


def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return councils.council_type_counts(customers(spark, sf_dir), **_WHERE)


def boundary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return councils.boundary_property_counts(nations(spark, sf_dir), active(spark, sf_dir), **_WHERE)


def stored_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundaries with further properties (a number, a text, a null, a nested value) and their counts, written as GeoJSON
    features and read back."""
    shape = F.format_string('{"type":"Point","coordinates":[%d,%d]}', "LAD13CD", "LAD13CD")
    given = F.format_string(
        '{"LAD13CD":"%s","size":%d.5,"name":"N%s","none":null,"box":{"corner":[%d,1]}}', *["LAD13CD"] * 4
    )
    counted = boundary_counts(spark, sf_dir).withColumns({"properties": given, "geometry": shape})
    path = scratch_path(spark, "boundaries")
    write_boundaries(counted, path)
    stored = read_boundaries(spark, path, ("LAD13CD", "LAD13NM", *KINDS), by_line=True)

    def at(path: str, kind: str, of: str = "properties"):
        return F.get_json_object(of, path).cast(kind)

    return stored.withColumns({k: F.col(k).cast("long") for k in ("LAD13CD", *KINDS)}).select(
        "LAD13CD", "LAD13NM", *KINDS,
        at("$.coordinates[0]", "int", "geometry").alias("x"),
        at("$.size", "double").alias("size"),
        at("$.name", "string").alias("text"),
        at("$.box.corner[0]", "int").alias("corner"),
        F.size(F.json_object_keys("properties")).cast("long").alias("properties"),
    )


def council_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return councils.council_counts(customers(spark, sf_dir), "n_name", "c_nationkey", "c_mktsegment")


def choropleth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return councils.choropleth_counts(
        nations(spark, sf_dir), active(spark, sf_dir), name="n_name", code="c_nationkey", constituency="c_mktsegment"
    )


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("lat", "lon")})


def named_councils(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(councils.county_clusters(active(spark, sf_dir), NAMED, "n_name", "value", "c_acctbal"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "lineitem").selectExpr(
        "l_extendedprice / 2000 AS latitude", "l_quantity - 25 AS longitude"
    )
    return _rounded(councils.grid_clusters(points, zoom=6))


def pyramid(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "lineitem").selectExpr(
        "l_extendedprice / 2000 AS latitude", "l_quantity - 25 AS longitude"
    )
    clusters = councils.cluster_pyramid(points, finest=12, coarsest=1)
    # Sums have six decimals, means may end in ties.
    return clusters.withColumns({c: F.round(F.col(c) * F.col("count"), 6) for c in ("lat", "lon")})


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounts as weights; every seventh line has none. The kernel's shares are 256ths."""
    points = table(spark, sf_dir, "lineitem").selectExpr(
        "l_extendedprice / 2000 AS lat", "l_quantity - 25 AS lon", "if(l_linenumber = 7, NULL, l_discount) AS weight"
    )
    surface = layers.heat_raster(points, "lat", "lon", zoom=8)
    return surface.withColumn("intensity", F.round(F.col("intensity") * 256, 4))


def whole_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' nations as one GeoJSON document, whose texts hold braces, quotes and the word Feature; read back by its
    features."""
    feature = F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.col("LAD13CD").cast("string").alias("LAD13CD"), "LAD13NM",
            F.format_string('},{"type":"Feature" \\ %d', "LAD13CD").alias("note"),
        ).alias("properties"),
        F.expr("named_struct('type', 'Point', 'coordinates', array(LAD13CD, 1))").alias("geometry"),
    ))
    rows = nations(spark, sf_dir).select("LAD13CD", feature.alias("f"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("LAD13CD", "f"))), lambda x: x.f)
    listed = rows.agg(F.array_join(in_order, ", ").alias("features"))
    document = listed.select(F.concat(F.lit('{"type": "FeatureCollection", "features": [ '), "features", F.lit("]}")))
    path = scratch_path(spark, "document")
    document.write.text(path)
    return read_boundaries(spark, path, ("LAD13CD", "LAD13NM", "note")).select(
        F.col("LAD13CD").cast("int").alias("code"), F.col("LAD13NM").alias("name"), "note",
        F.get_json_object("geometry", "$.coordinates[0]").cast("int").alias("x"),
    )


_ACTIVE = "events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey"
_PIVOT = ", ".join(f"count(*) FILTER (c_mktsegment = '{k}') AS \"{k}\"" for k in KINDS)
_BOUNDARIES = f"""SELECT b.n_nationkey AS "LAD13CD", b.n_name AS "LAD13NM", """ + ", ".join(
    f'coalesce("{k}", 0) AS "{k}"' for k in KINDS
) + "{extra}" + f""" FROM nation b LEFT JOIN (SELECT c_nationkey, {_PIVOT} FROM {_ACTIVE} GROUP BY c_nationkey) c
    ON b.n_nationkey = c.c_nationkey"""

QUERIES = {
    "council_type_counts": type_counts,
    "boundary_property_counts": boundary_counts,
    "boundary_roundtrip": stored_boundaries,
    "council_counts": council_counts,
    "choropleth_counts": choropleth,
    "county_clusters": named_councils,
    "grid_clusters": cells,
    "cluster_pyramid": pyramid,
    "heat_raster": raster,
    "boundary_document": whole_documents,
}

SQL = {
    "council_type_counts": f"SELECT c_nationkey, {_PIVOT} FROM customer GROUP BY c_nationkey",
    "boundary_property_counts": _BOUNDARIES.replace("{extra}", ""),
    "boundary_roundtrip": _BOUNDARIES.replace(
        "{extra}",
        """, b.n_nationkey AS x, b.n_nationkey + 0.5e0 AS size, 'N' || b.n_nationkey AS text, b.n_nationkey AS corner,
        CAST(10 AS BIGINT) AS properties""",
    ),
    "council_counts": """SELECT n_name, c_nationkey, c_mktsegment, count(*) AS count
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
    "choropleth_counts": f"""SELECT n_nationkey AS "LAD13CD", b.n_name AS "LAD13NM", count
        FROM nation b LEFT JOIN (SELECT n_name, count(*) AS count FROM {_ACTIVE} GROUP BY n_name) c USING (n_name)""",
    "county_clusters": f"""SELECT n_name, count(*) AS count, round(avg(value), 6) AS lat,
        round(avg(c_acctbal), 6) AS lon FROM {_ACTIVE} WHERE n_name IN {NAMED} GROUP BY n_name""",
    "grid_clusters": """
        SELECT CAST(floor(lat / 5.625) AS BIGINT) AS cell_y, CAST(floor(lon / 5.625) AS BIGINT) AS cell_x, count(*) AS count, round(avg(lat), 6) AS lat, round(avg(lon), 6) AS lon
        FROM (SELECT l_extendedprice / 2000 AS lat, l_quantity - 25 AS lon FROM lineitem) GROUP BY 1, 2""",
    "cluster_pyramid": """
        SELECT CAST(zoom AS INTEGER) AS zoom, CAST(floor(lat / (360.0::DOUBLE / 2 ** zoom)) AS BIGINT) AS cell_y,
               CAST(floor(lon / (360.0::DOUBLE / 2 ** zoom)) AS BIGINT) AS cell_x, count(*) AS count,
               round(sum(lat), 6) AS lat, round(sum(lon), 6) AS lon
        FROM (SELECT l_extendedprice / 2000 AS lat, l_quantity - 25 AS lon, unnest(range(1, 13)) AS zoom FROM lineitem)
        GROUP BY 1, 2, 3""",
    "heat_raster": """
        WITH p AS (SELECT CAST(floor(l_extendedprice / 2000 / 1.40625) AS BIGINT) AS y,
                          CAST(floor((l_quantity - 25) / 1.40625) AS BIGINT) AS x, l_discount AS w
                   FROM lineitem WHERE l_linenumber <> 7),
        k AS (SELECT * FROM (VALUES (-2, 1), (-1, 4), (0, 6), (1, 4), (2, 1)) AS t(d, share))
        SELECT y + a.d AS cell_y, x + b.d AS cell_x, round(sum(w * a.share * b.share), 4) AS intensity,
               (y + a.d + 0.5) * 1.40625::DOUBLE AS lat, (x + b.d + 0.5) * 1.40625::DOUBLE AS lon
        FROM p, k a, k b GROUP BY ALL""",
    "boundary_document": r"""SELECT n_nationkey AS code, n_name AS name,
        '},{"type":"Feature" \ ' || n_nationkey AS note, n_nationkey AS x FROM nation""",
}
