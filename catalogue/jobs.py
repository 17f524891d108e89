"""The batch jobs end to end, on files written from the driver tables: Q1-Q7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.books import NUMBERS, TEXTS
from catalogue.tables import table
from riskbook.operators.quality import row_counts
from riskbook.plans.layer_jobs import portfolio_layers_job, property_layers_job
from riskbook.plans.portfolio_jobs import portfolio_conversion_job, portfolio_merge_job, typed_portfolio
from riskbook.plans.property_jobs import enrich_loan_book_job, merge_property_risk_job
from riskbook.plans.regulatory_jobs import portfolio_report_job, property_report_job
from riskbook.sources import schemas
from riskbook.sources.boundaries import read_boundaries
from riskbook.sources.publish import even_tasks, published_tables, read_published, remove_folder, scratch_path, wide_rows

DAY = "20230427"
# A compressed file is read by one task; files of this many rows keep as many tasks at work as there are cores.
ROWS_PER_INPUT = 100_000


def _file(df: DataFrame, path: str) -> str:
    compressed = df.write.option("compression", "gzip")
    with wide_rows(df.sparkSession), even_tasks(df.sparkSession):
        compressed.option("header", True).option("maxRecordsPerFile", ROWS_PER_INPUT).csv(path)
    return path


def _filled(df: DataFrame, schema: T.StructType, **known: str) -> DataFrame:
    """All columns of a file schema: the known ones as given, the others empty."""
    return df.select(*[
        F.expr(known.get(f.name.replace("/", "_"), "NULL")).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def _property_files(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    properties = _filled(
        orders, schemas.PROPERTY, ecad_id="o_orderkey", building_id="o_custkey", address_line_1="o_orderpriority",
        address_line_2="o_orderstatus", address_line_3="'Town'", etrs89_lat="54.25D", etrs89_long="-8.5D",
    )
    energy = _filled(
        orders, schemas.ENERGY_RATING, ecad_id="o_orderkey",
        ber_rating="concat(substring('ABCDEFG', cast(o_totalprice / 75000 AS int) + 1, 1), '1')",
        ber_rating_kwh="o_totalprice / 800", co2_emission="o_totalprice / 1000",
    )
    flood = _filled(
        table(spark, sf_dir, "customer"), schemas.FLOOD_INDEX, ecad_id="c_custkey", riverrp="c_nationkey",
        rmax20="c_acctbal", r20matrix="c_nationkey", floodability_index_ud="if(c_acctbal < 0, 'No Colour', 'green')",
    )
    loans = _filled(
        items, schemas.LOAN_BOOK, ecad_id="l_orderkey", Asset_id="l_linenumber", product="l_returnflag",
        Rate_Margin="l_discount", Initial_Borrow_Capital="l_extendedprice", LTV="l_tax",
    )
    frames = {"property": properties, "energy": energy, "flood": flood, "loans": loans}
    return {name: _file(df, f"{root}/in/{name}") for name, df in frames.items()}


def _run_property_jobs(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "property-jobs")
    files = _property_files(spark, sf_dir, root)
    merge_property_risk_job(
        spark, files["property"], files["energy"], files["flood"],
        f"{root}/merged", f"{root}/rejected", f"{root}/staged", DAY,
    )
    enrich_loan_book_job(
        spark, f"{root}/merged", files["loans"], f"{root}/enriched", f"{root}/enriched_csv",
        f"{root}/rejected", f"{root}/staged", DAY,
    )
    return root


def property_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run_property_jobs(spark, sf_dir)
    book = read_published(spark, f"{root}/enriched_csv", fmt="csv", schema=schemas.ENRICHED_LOAN_BOOK)
    return book.select(
        "ecad_id", "building_id", "address_line_1", "ber_rating", "riverrp", "floodability_index_ud", "Asset_id",
        F.col("Rate/Margin").alias("rate"), "Initial_Borrow_Capital", "dt",
    )


def property_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run_property_jobs(spark, sf_dir)
    property_report_job(spark, f"{root}/enriched", f"{root}/reports")
    cells = read_published(spark, f"{root}/reports/pillar3_long", DAY)
    return cells.select("row_no", "section", "item", F.round("amount", 2).alias("amount"))


def property_flood_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run_property_jobs(spark, sf_dir)
    property_layers_job(spark, f"{root}/enriched", f"{root}/layers", DAY)
    return read_published(spark, f"{root}/layers/flood").select(
        "id", "lat", "lon", "colour", "label", "detail.address", F.col("detail.profile")[0]["depth_m"].alias("rmax20")
    )


def _portfolio_files(
    spark: SparkSession, sf_dir: str, root: str, order_id: str = "o_orderkey", score_id: str = "l_orderkey"
) -> list[str]:
    """Orders as portfolio, line items as risk scores, documents as coordinates. The score file brings loan, rating
    and energy columns, the portfolio the rest of the columns that the layers show."""
    from_scores = {"current_energy_efficiency", "energy_consumption_current"}
    portfolio = table(spark, sf_dir, "orders").select(
        F.expr(order_id).alias("ID"),
        F.col("o_custkey").alias("UPRN"),
        F.col("o_totalprice").alias("EASTING"),
        F.col("o_totalprice").alias("NORTHING"),
        *[F.col("o_orderpriority").alias(c.upper()) for c in TEXTS],
        *[F.col("o_custkey").alias(c.upper()) for c in NUMBERS if c not in from_scores],
        *[F.col("o_orderstatus").alias(c) for c in (
            "POTENTIAL_ENERGY_RATING", "CURRENT_ENVIRONMENTAL_RATING", "POTENTIAL_ENVIRONMENTAL_RATING")],
        *[F.col("o_orderkey").alias(c) for c in ("COMBINEDSCORE", "COMBINEDSCORE_ADJ")],
        F.lit("House").alias("PROPERTY_TYPE"),
        F.expr("concat('E', o_custkey)").alias("LOCAL_AUTHORITY"),
        F.lit("Wiltshire").alias("LOCAL_AUTHORITY_LABEL"),
        F.col("o_orderpriority").alias("CONSTITUENCY"),
        F.lit("2021-01-18").alias("INSPECTION_DATE"),
    )
    scores = table(spark, sf_dir, "lineitem").selectExpr(
        f"{score_id} AS ID", "l_suppkey AS UPRN", "l_extendedprice AS CURRENTLOAN",
        "if(l_linenumber = 7, 'N/A', CAST(l_discount AS string)) AS CURRENTLTV",
        "l_returnflag AS CURRENT_ENERGY_RATING",
        "if(l_linenumber = 6, 'NODATA!', CAST(CAST(l_quantity * 12 AS int) AS string)) AS CURRENT_ENERGY_EFFICIENCY",
        "l_quantity AS ENERGY_CONSUMPTION_CURRENT",
    )
    latlong = table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS ID", "n_chars AS UPRN", "n_chars AS EASTING", "n_chars AS NORTHING", "51.5D AS LATITUDE",
        "-2.5D AS LONGITUDE",
    )
    frames = {"portfolio": portfolio, "scores": scores, "latlong": latlong}
    return [_file(df, f"{root}/in/{name}") for name, df in frames.items()]


def portfolio_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "portfolio-merge")
    files = _portfolio_files(spark, sf_dir, root)
    portfolio_merge_job(spark, *files, f"{root}/merged", f"{root}/staged", DAY)
    written = read_published(spark, f"{root}/merged/parquet").drop("dt")
    merged = typed_portfolio(read_published(spark, f"{root}/merged/json", fmt="json", schema=written.schema))
    return merged.select(
        F.col("id").cast("long").alias("id"), "uprn", "easting", "latitude", "currentloan", "initial_borrow_capital"
    )


def portfolio_merged_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV and the Parquet table of the inner merge, one after the other. Every third order is written with zeros
    before its id, which is published as it is and meets the same number."""
    root = scratch_path(spark, "portfolio-merge")
    files = _portfolio_files(spark, sf_dir, root, "concat(if(o_orderkey % 3 = 0, '00', ''), o_orderkey)")
    portfolio_merge_job(spark, *files, f"{root}/merged", f"{root}/staged", DAY)
    tables = [read_published(spark, f"{root}/merged/{fmt}", fmt=fmt).withColumn("fmt", F.lit(fmt)) for fmt in ("csv", "parquet")]
    shown = ("id", "uprn", "easting", "latitude", "currentloan", "currentltv", "fmt", "dt")
    return tables[0].select(*shown).unionByName(tables[1].select(*shown))


def portfolio_mixed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inner merge where the scores write their ids in four ways, which all mean the same number."""
    root = scratch_path(spark, "portfolio-merge")
    score_id = """CASE l_linenumber % 4 WHEN 0 THEN concat(l_orderkey, '.0') WHEN 1 THEN concat('00', l_orderkey)
        WHEN 2 THEN concat(l_orderkey, 'e0') ELSE CAST(l_orderkey AS string) END"""
    files = _portfolio_files(spark, sf_dir, root, "concat(o_orderkey, if(o_orderkey % 2 = 0, '.00', ''))", score_id)
    portfolio_merge_job(spark, *files, f"{root}/merged", f"{root}/staged", DAY)
    merged = typed_portfolio(read_published(spark, f"{root}/merged/parquet").drop("dt"))
    return merged.select("id", "uprn", "latitude", "currentloan")


def _converted(spark: SparkSession, sf_dir: str) -> str:
    """The conversion with all that it publishes. The files written for it and its staged rows, which nothing reads after
    it, go when it ends, so that they do not lie beside the layers."""
    root = scratch_path(spark, "portfolio-conversion")
    files = _portfolio_files(spark, sf_dir, root)
    portfolio_conversion_job(spark, *files, f"{root}/merged", f"{root}/reports", f"{root}/staged", DAY)
    for used in ("in", "staged"):
        remove_folder(spark, f"{root}/{used}")
    return root


def portfolio_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All duplicate reports of the conversion, summed per step and kind of key."""
    reports = f"{_converted(spark, sf_dir)}/reports/duplicates"
    rows = spark.read.option("header", True).option("inferSchema", True).csv(reports)
    return rows.groupBy("step", "key").agg(
        F.count("*").alias("keys"), F.sum(F.col("count").cast("long")).alias("rows")
    )


def duplicate_uprns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_published(spark, f"{_converted(spark, sf_dir)}/reports/duplicate_uprns", DAY, "csv")
    return rows.select(F.col("uprn").cast("long").alias("uprn"), F.col("count").cast("long").alias("count"))


def duplicate_uprn_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_published(spark, f"{_converted(spark, sf_dir)}/reports/duplicate_uprn_ids", DAY, "csv")
    return rows.select(*[F.col(c).cast("long").alias(c) for c in ("uprn", "count", "id")])


def portfolio_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide report as it was published; its first row."""
    root = _converted(spark, sf_dir)
    portfolio_report_job(spark, f"{root}/merged", f"{root}/reports", unit=1e6)
    return _first_row(read_published(spark, f"{root}/reports/pillar3_matrix", DAY, "csv"), 4)


def property_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run_property_jobs(spark, sf_dir)
    property_report_job(spark, f"{root}/enriched", f"{root}/reports")
    return _first_row(read_published(spark, f"{root}/reports/pillar3_matrix", DAY, "csv"), 2)


def _first_row(matrix: DataFrame, digits: int) -> DataFrame:
    names = ("total", "band_le_100", "band_le_300", "band_gt_500", "label_a")
    return matrix.where("row_no = 1").select(*[F.round(F.col(c).cast("double"), digits).alias(c) for c in names])


def portfolio_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _converted(spark, sf_dir)
    portfolio_report_job(spark, f"{root}/merged", f"{root}/reports", unit=1e6)
    cells = read_published(spark, f"{root}/reports/pillar3_long", DAY)
    return cells.select("row_no", "section", "item", F.round("amount", 4).alias("amount"))


def _portfolio_layers(spark: SparkSession, sf_dir: str) -> str:
    """The layer job on the converted portfolio; the boundaries are the nations, with a property more than is used."""
    root = _converted(spark, sf_dir)
    nations = table(spark, sf_dir, "nation").selectExpr(
        "concat('{\"features\":[{\"type\":\"Feature\",\"properties\":{\"LAD13CD\":\"E', n_nationkey, "
        "'\",\"LAD13CDO\":', n_nationkey, ',\"LAD13NM\":\"', if(n_nationkey = 7, 'Wiltshire', n_name), "
        "'\"},\"geometry\":{\"type\":\"Point\",\"coordinates\":[0,0]}}]}') AS value"
    )
    nations.repartition(25).write.text(f"{root}/in/boundaries")
    portfolio_layers_job(spark, f"{root}/merged", f"{root}/in/boundaries", f"{root}/layers", DAY)
    return f"{root}/layers"


def portfolio_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Energy points of the layer job."""
    return read_published(spark, f"{_portfolio_layers(spark, sf_dir)}/energy").select(
        "id", "lat", "lon", "colour", "label", "detail.loan.currentloan", "detail.loan.ltv_percent"
    )


def portfolio_layer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table that the layer job publishes but the boundaries, which are text, and the category counts,
    whose number follows from the values of nine columns."""
    layers = _portfolio_layers(spark, sf_dir)
    names = published_tables(spark, layers, but=("boundaries", "category_counts"))
    return row_counts({name: read_published(spark, f"{layers}/{name}", DAY) for name in names}, "layer")


def property_layer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _run_property_jobs(spark, sf_dir)
    property_layers_job(spark, f"{root}/enriched", f"{root}/layers", DAY)
    names = published_tables(spark, f"{root}/layers")
    return row_counts({name: read_published(spark, f"{root}/layers/{name}", DAY) for name in names}, "layer")


def portfolio_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published boundaries: the given properties and the counts, with the choropleth count of the council's name."""
    layers = _portfolio_layers(spark, sf_dir)
    fields = ("LAD13CD", "LAD13CDO", "LAD13NM", "House", "Flat", "Bungalow", "Maisonette")
    features = read_boundaries(spark, f"{layers}/boundaries/dt={DAY}", fields, by_line=True)
    counts = read_published(spark, f"{layers}/choropleth", DAY).select(F.col("LAD13CD").alias("code"), "count")
    joined = features.join(counts, F.col("LAD13CD") == F.col("code"))
    return joined.select(
        "LAD13CD", "LAD13NM", *[F.col(c).cast("long").alias(c) for c in (fields[1], *fields[3:])], F.col("count").alias("properties")
    )


_ENRICHED = """enriched AS (
    SELECT *, substr('ABCDEFG', CAST(trunc(o_totalprice / 75000) AS INTEGER) + 1, 1) AS label,
           o_totalprice / 800 AS kwh
    FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lineitem ON o_orderkey = l_orderkey)"""

_BANDS = """CASE WHEN kwh <= 100 THEN 'band_le_100' WHEN kwh <= 200 THEN 'band_le_200' WHEN kwh <= 300 THEN
    'band_le_300' WHEN kwh <= 400 THEN 'band_le_400' WHEN kwh <= 500 THEN 'band_le_500' ELSE 'band_gt_500' END"""

_MERGED = """merged AS (
    SELECT *, l_extendedprice / nullif(CASE WHEN l_linenumber <> 7 THEN l_discount END, 0) AS capital,
           CASE WHEN l_linenumber <> 6 THEN l_quantity * 12 END AS kwh, l_returnflag AS label
    FROM orders {how} JOIN lineitem ON o_orderkey = l_orderkey {how} JOIN documents ON o_orderkey = doc_id)"""


def _report_sql(book: str, source: str, capital: str, digits: int, labels: str) -> str:
    return f"""WITH {book}, cells AS (
        SELECT 'total' AS section, 'total' AS item, sum({capital}) AS amount FROM {source}
        UNION ALL SELECT 'band', {_BANDS}, sum({capital}) FROM {source} GROUP BY 2
        UNION ALL SELECT 'label', CASE WHEN label IS NULL THEN 'label_none' WHEN label IN {labels}
            THEN 'label_' || lower(label) ELSE 'label_other' END, sum({capital}) FROM {source} GROUP BY label
        UNION ALL SELECT 'unlabelled', 'without_label', 0)
    SELECT CAST(n AS INTEGER) AS row_no, section, item,
           CASE WHEN n IN (1, 3) THEN round(amount, {digits}) ELSE 0 END AS amount
    FROM range(1, 11) r(n), cells"""


def _matrix_sql(book: str, source: str, capital: str, digits: int) -> str:
    def total(condition: str) -> str:
        return f"round(coalesce(sum({capital}) FILTER ({condition}), 0), {digits})"

    return f"""WITH {book}, b AS (SELECT *, {_BANDS} AS band FROM {source})
        SELECT {total("true")} AS total, {total("band = 'band_le_100'")} AS band_le_100,
               {total("band = 'band_le_300'")} AS band_le_300, {total("band = 'band_gt_500'")} AS band_gt_500,
               {total("label = 'A'")} AS label_a FROM b"""


_LETTERS = "('A', 'B', 'C', 'D', 'E', 'F', 'G')"
_STEPS = {
    "portfolio": "SELECT o_orderkey AS id, o_custkey AS uprn FROM orders",
    "risk_scores": "SELECT l_orderkey AS id, l_suppkey AS uprn FROM lineitem",
    "latlong": "SELECT doc_id AS id, n_chars AS uprn FROM documents",
    "portfolio_scored": """SELECT o_orderkey AS id, o_custkey AS uprn
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
    "portfolio_merged": "SELECT o_orderkey AS id, o_custkey AS uprn FROM merged",
}

QUERIES = {
    "job_property_enriched": property_enriched,
    "job_property_report": property_report,
    "job_property_layers": property_flood_points,
    "job_portfolio_merged": portfolio_merged,
    "job_portfolio_mixed_ids": portfolio_mixed_ids,
    "job_portfolio_duplicates": portfolio_duplicates,
    "job_portfolio_report": portfolio_report,
    "job_portfolio_layers": portfolio_points,
    "job_portfolio_merged_csv": portfolio_merged_csv,
    "job_portfolio_duplicate_uprns": duplicate_uprns,
    "job_portfolio_duplicate_uprn_ids": duplicate_uprn_ids,
    "job_portfolio_matrix": portfolio_matrix,
    "job_property_matrix": property_matrix,
    "job_portfolio_layer_rows": portfolio_layer_rows,
    "job_property_layer_rows": property_layer_rows,
    "job_portfolio_boundaries": portfolio_boundaries,
}

SQL = {
    "job_property_enriched": f"""WITH {_ENRICHED}
        SELECT CAST(o_orderkey AS INTEGER) AS ecad_id, CAST(o_custkey AS INTEGER) AS building_id,
               o_orderpriority AS address_line_1, label || '1' AS ber_rating, c_nationkey AS riverrp,
               CASE WHEN c_acctbal < 0 THEN 'No Colour' ELSE 'green' END AS floodability_index_ud,
               l_linenumber AS "Asset_id", l_discount AS rate, l_extendedprice AS "Initial_Borrow_Capital",
               '{DAY}' AS dt
        FROM enriched""",
    "job_property_report": _report_sql(_ENRICHED, "enriched", "l_extendedprice", 2, _LETTERS),
    "job_property_layers": f"""WITH {_ENRICHED}
        SELECT CAST(o_orderkey AS INTEGER) AS id, 54.25e0 AS lat, -8.5e0 AS lon,
               CASE WHEN c_acctbal < 0 THEN '#deebf6' ELSE '#a5d45d' END AS colour,
               CASE WHEN c_acctbal < 0 THEN 'No Colour' ELSE 'green' END AS label,
               o_orderpriority || ' ' || o_orderstatus || ' Town' AS address, c_acctbal AS rmax20
        FROM enriched""",
    "job_portfolio_merged": f"""WITH {_MERGED.format(how="INNER")}
        SELECT o_orderkey AS id, o_custkey AS uprn, o_totalprice AS easting, 51.5e0 AS latitude,
               l_extendedprice AS currentloan, capital AS initial_borrow_capital
        FROM merged""",
    "job_portfolio_mixed_ids": f"""WITH {_MERGED.format(how="INNER")}
        SELECT o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN '.00' ELSE '' END AS id, o_custkey AS uprn,
               51.5e0 AS latitude, l_extendedprice AS currentloan FROM merged""",
    "job_portfolio_duplicates": f"WITH {_MERGED.format(how='LEFT')} " + " UNION ALL ".join(
        f"""SELECT '{step}' AS step, '{key}' AS key, count(*) AS keys, CAST(sum(n) AS BIGINT) AS rows
        FROM (SELECT count(*) AS n FROM ({rows}) GROUP BY {by} HAVING count(*) > 1) HAVING count(*) > 0"""
        for step, rows in _STEPS.items()
        for key, by in (("id+uprn", "id, uprn"), ("id", "id"), ("uprn", "uprn"))
    ),
    "job_portfolio_report": _report_sql(_MERGED.format(how="LEFT"), "merged", "capital / 1e6", 4, _LETTERS),
    "job_portfolio_layers": f"""WITH {_MERGED.format(how="LEFT")}
        SELECT o_custkey AS id, CASE WHEN doc_id IS NOT NULL THEN 51.5e0 END AS lat,
               CASE WHEN doc_id IS NOT NULL THEN -2.5e0 END AS lon,
               CASE WHEN label IS NULL THEN '#deebf6' WHEN label = 'A' THEN '#00a54f' END AS colour, label,
               l_extendedprice AS currentloan,
               round(CASE WHEN l_linenumber <> 7 THEN l_discount END * 100, 4) AS ltv_percent
        FROM merged""",
    "job_portfolio_merged_csv": f"""WITH {_MERGED.format(how="INNER")}
        SELECT CASE WHEN o_orderkey % 3 = 0 THEN '00' ELSE '' END || o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS uprn,
               CAST(o_totalprice AS VARCHAR) AS easting, '51.5' AS latitude, CAST(l_extendedprice AS VARCHAR) AS currentloan,
               CASE WHEN l_linenumber = 7 THEN 'N/A' ELSE CAST(l_discount AS VARCHAR) END AS currentltv,
               unnest(['csv', 'parquet']) AS fmt, '{DAY}' AS dt
        FROM merged""",
    "job_portfolio_duplicate_uprns": f"""WITH {_MERGED.format(how="LEFT")}
        SELECT o_custkey AS uprn, count(*) AS count FROM merged GROUP BY 1 HAVING count(*) > 1""",
    "job_portfolio_duplicate_uprn_ids": f"""WITH {_MERGED.format(how="LEFT")},
        twice AS (SELECT o_custkey AS uprn, count(*) AS count FROM merged GROUP BY 1 HAVING count(*) > 1)
        SELECT uprn, count, doc_id AS id FROM twice LEFT JOIN documents ON uprn = n_chars""",
    "job_portfolio_matrix": _matrix_sql(_MERGED.format(how="LEFT"), "merged", "capital / 1e6", 4),
    "job_property_matrix": _matrix_sql(_ENRICHED, "enriched", "l_extendedprice", 2),
    "job_portfolio_layer_rows": f"""WITH {_MERGED.format(how="LEFT")}, n AS (SELECT count(*) AS n FROM merged)
        SELECT unnest(['typed', 'energy', 'flood', 'index', 'heat', 'types', 'councils', 'environment']) AS layer, n AS rows FROM n
        UNION ALL SELECT 'clusters', 19 * least(1, count(doc_id)) FROM merged
        UNION ALL SELECT 'heat_raster', 25 * least(1, count(doc_id)) FROM merged
        UNION ALL SELECT 'county_clusters', least(1, count(*)) FROM merged
        UNION ALL SELECT 'choropleth', count(*) FROM nation
        UNION ALL SELECT * FROM (VALUES ('legend_energy', 8), ('legend_flood', 7), ('legend_environment', 8))""",
    "job_property_layer_rows": f"""WITH {_ENRICHED}
        SELECT unnest(['energy', 'flood', 'index']) AS layer, count(*) AS rows FROM enriched
        UNION ALL SELECT 'clusters', 19 * least(1, count(*)) FROM enriched
        UNION ALL SELECT * FROM (VALUES ('legend_energy', 15), ('legend_flood', 6))""",
    "job_portfolio_boundaries": f"""WITH {_MERGED.format(how="LEFT")},
        c AS (SELECT o_custkey, count(*) AS n FROM merged GROUP BY 1)
        SELECT 'E' || n_nationkey AS "LAD13CD", CASE WHEN n_nationkey = 7 THEN 'Wiltshire' ELSE n_name END AS "LAD13NM",
               CAST(n_nationkey AS BIGINT) AS "LAD13CDO", coalesce(n, 0) AS "House", CAST(0 AS BIGINT) AS "Flat",
               CAST(0 AS BIGINT) AS "Bungalow", CAST(0 AS BIGINT) AS "Maisonette",
               CASE WHEN n_nationkey = 7 THEN (SELECT count(*) FROM merged) END AS properties
        FROM nation LEFT JOIN c ON n_nationkey = o_custkey""",
}
