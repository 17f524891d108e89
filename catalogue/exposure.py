"""Exposure report: P5-P7, A1-A4, J9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.tables import sql_values, table
from riskbook.functions.energy import energy_band, initial_capital
from riskbook.operators.merges import join_keep_left
from riskbook.operators.report import (
    BAND_COLUMNS,
    TEMPLATE_ROWS,
    ESTIMATED_HEADING,
    exposure_by_band,
    exposure_by_label,
    pillar3_long,
    pillar3_matrix,
    total_exposure,
    with_headings,
)

LABELS = ("A", "N")
MILLION = 1e6


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their line items: rating, energy use and capital are missing for an order without items."""
    loans = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "concat(l_returnflag, l_linenumber) AS rating", "l_quantity * 12 AS kwh",
        "l_extendedprice", "l_discount",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    joined = join_keep_left(orders, loans, "o_orderkey", "l_orderkey", "left")
    return joined.withColumn("capital", initial_capital("l_extendedprice", "l_discount"))


def _millions(df: DataFrame) -> DataFrame:
    return df.withColumn("exposure", F.round(F.col("exposure") / MILLION, 4))


def total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _millions(total_exposure(book(spark, sf_dir), "capital"))


def by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _millions(exposure_by_label(book(spark, sf_dir), "rating", "capital"))


def by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _millions(exposure_by_band(book(spark, sf_dir), "kwh", "capital"))


def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book(spark, sf_dir).select(
        "o_orderkey", "kwh", energy_band("kwh").alias("band"), energy_band("kwh", None).alias("known_band")
    )


def capital(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", initial_capital("l_extendedprice", "l_discount").alias("capital")
    )


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = pillar3_matrix(book(spark, sf_dir), "capital", "rating", "kwh", labels=LABELS, unit=MILLION)
    amounts = [F.round(c, 4).alias(c) for c in wide.columns[2:]]
    return wide.select("row_no", "sector", *amounts)


def long(spark: SparkSession, sf_dir: str) -> DataFrame:
    tall = pillar3_long(book(spark, sf_dir), "capital", "rating", "kwh", area="UK", labels=LABELS, unit=MILLION)
    return tall.withColumn("amount", F.round("amount", 4))


def headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_headings(long(spark, sf_dir)).drop("sector")


_BAND = """CASE WHEN kwh <= 100 THEN '0; <= 100' WHEN kwh <= 200 THEN '> 100; <= 200'
    WHEN kwh <= 300 THEN '> 200; <= 300' WHEN kwh <= 400 THEN '> 300; <= 400'
    WHEN kwh <= 500 THEN '> 400; <= 500' ELSE '> 500' END"""

_BOOK = f"""book AS (
    SELECT *, {_BAND} AS band, rating[1] AS label FROM (
        SELECT o_orderkey, l_returnflag || l_linenumber AS rating, l_quantity * 12 AS kwh,
               l_extendedprice / nullif(l_discount, 0) AS capital
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey))"""

_CELLS = f"""{_BOOK}, cells AS (
    SELECT 'total' AS section, 'total' AS item, NULL AS text, sum(capital) / 1e6 AS amount FROM book
    UNION ALL SELECT 'band', 'band_' || CASE band WHEN '> 500' THEN 'gt_500'
        ELSE 'le_' || split_part(band, '<= ', 2) END, band, sum(capital) / 1e6 FROM book GROUP BY band
    UNION ALL SELECT 'label', CASE WHEN label IS NULL THEN 'label_none' WHEN label IN ('A', 'N')
        THEN 'label_' || lower(label) ELSE 'label_other' END, label, sum(capital) / 1e6 FROM book GROUP BY label
    UNION ALL SELECT 'unlabelled', 'without_label', '{ESTIMATED_HEADING}', 0)"""


def _template(area: str) -> str:
    rows = sql_values([(i, text.format(area=area)) for i, text in enumerate(TEMPLATE_ROWS, start=1)])
    return f"template AS (SELECT CAST(n AS INTEGER) AS row_no, sector FROM {rows} t(n, sector))"


_ITEMS = ("total", *BAND_COLUMNS, "label_a", "label_n", "label_other", "label_none", "without_label")

QUERIES = {
    "total_exposure": total,
    "exposure_by_label": by_label,
    "exposure_by_band": by_band,
    "energy_band": bands,
    "initial_capital": capital,
    "pillar3_long": long,
    "pillar3_matrix": matrix,
    "pillar3_headed": headed,
}

SQL = {
    "total_exposure": f"WITH {_BOOK} SELECT round(sum(capital) / 1e6, 4) AS exposure FROM book",
    "exposure_by_label": f"""WITH {_BOOK}
        SELECT label, round(sum(capital) / 1e6, 4) AS exposure, count(*) AS total_count FROM book GROUP BY label""",
    "exposure_by_band": f"""WITH {_BOOK}
        SELECT band, round(sum(capital) / 1e6, 4) AS exposure, count(*) AS total_count FROM book GROUP BY band""",
    "energy_band": f"""WITH {_BOOK}
        SELECT o_orderkey, kwh, band, CASE WHEN kwh IS NOT NULL THEN band END AS known_band FROM book""",
    "initial_capital": """
        SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) AS capital FROM lineitem""",
    "pillar3_long": f"""WITH {_CELLS}, {_template("UK")}
        SELECT row_no, sector, section, item, text,
               CASE WHEN row_no IN (1, 3) THEN round(amount, 4) ELSE 0 END AS amount
        FROM template, cells""",
    "pillar3_matrix": f"""WITH {_CELLS}, {_template("EU")}
        SELECT row_no, sector, """
    + ", ".join(
        f"CASE WHEN row_no IN (1, 3) THEN round(sum(CASE WHEN item = '{i}' THEN amount END), 4) ELSE 0 END AS {i}"
        for i in _ITEMS
    )
    + " FROM template, cells GROUP BY row_no, sector",
    "pillar3_headed": f"""WITH {_CELLS}
        SELECT CAST(row_no AS INTEGER) AS row_no, section, item, text,
               CASE WHEN row_no IN (1, 3) THEN round(amount, 4) ELSE 0 END AS amount,
               'Total gross carrying amount (in MEUR)' AS heading,
               CASE section WHEN 'band' THEN 'Level of energy efficiency (EP score in kWh/m² of collateral)'
                   WHEN 'label' THEN 'Level of energy efficiency (EPC label of collateral)'
                   WHEN 'unlabelled' THEN 'Without EPC label of collateral' END AS group_heading
        FROM range(1, 11) r(row_no), cells""",
}
