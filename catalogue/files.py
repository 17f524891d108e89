"""Reading, rejecting, publishing and reading back: S1-S11, A12."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.tables import table
from riskbook.operators.merges import lower_columns
from riskbook.sources import publish, readers
from riskbook.sources.schemas import PORTFOLIO_TYPES, schema_of
from riskbook.sources.types import form_counts, with_types

ITEM = schema_of("l_orderkey bigint, l_linenumber int, l_quantity double, l_returnflag string")
ORDER = schema_of("o_orderkey bigint, o_custkey bigint, o_totalprice double")


def item_lines(spark: SparkSession, sf_dir: str) -> str:
    """Line items as text lines; some have a field too many, one too few, or a word for a number."""
    line = """concat_ws(',', l_orderkey, l_linenumber,
        CASE WHEN l_quantity = 13 THEN 'thirteen' ELSE CAST(l_quantity AS string) END,
        CASE WHEN l_linenumber = 1 AND l_quantity > 45 THEN NULL ELSE l_returnflag END,
        CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'extra' END)"""
    path = publish.scratch_path(spark, "item-lines")
    table(spark, sf_dir, "lineitem").selectExpr(f"{line} AS value").write.text(path)
    return path


def landed_items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = item_lines(spark, sf_dir)
    return readers.land_csv(spark, lines, ITEM, publish.scratch_path(spark, "items"), header=False)


def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed_items(spark, sf_dir)[0]


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows per source, counted in the files they were written to."""
    base = publish.scratch_path(spark, "rejected")
    orders_csv = publish.scratch_path(spark, "orders")
    table(spark, sf_dir, "orders").select(ORDER.fieldNames()).write.option("header", True).csv(orders_csv)
    orders = readers.land_csv(spark, orders_csv, ORDER, publish.scratch_path(spark, "orders-landed"))
    items = landed_items(spark, sf_dir)
    for source, (_, bad) in {"items": items, "orders": orders}.items():
        publish.write_rejects(bad, base, "20230427", source)
    stored = readers.read_raw_csv(spark, f"{base}/dt=20230427/source=items")
    return publish.reject_summary({"items": stored, "orders": orders[1]})


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(ORDER.fieldNames())


def _published(spark: SparkSession, sf_dir: str, fmt: str) -> str:
    """Orders published on two days: halved prices on the first, the true ones on the second."""
    base = publish.scratch_path(spark, f"published-{fmt}")
    orders = _orders(spark, sf_dir)
    publish.publish(orders.withColumn("o_totalprice", F.col("o_totalprice") / 2), base, "20230426", fmt)
    publish.publish(orders, base, "20230427", fmt)
    return base


def newest_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.read_published(spark, _published(spark, sf_dir, "parquet"))


def newest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.read_published(spark, _published(spark, sf_dir, "csv"), fmt="csv", schema=ORDER)


def newest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.read_published(spark, _published(spark, sf_dir, "json"), fmt="json", schema=ORDER)


def one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.read_published(spark, _published(spark, sf_dir, "parquet"), "20230426")


def several_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both published days of one layout, stacked by a single reader."""
    base = _published(spark, sf_dir, "csv")
    return readers.read_csv(spark, [f"{base}/dt=20230426", f"{base}/dt=20230427"], ORDER)


def inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _published(spark, sf_dir, "csv")
    keys = {c: F.col(c).cast("long") for c in ("o_orderkey", "o_custkey")}
    landed = readers.land_inferred_csv(spark, f"{base}/dt=20230427", publish.scratch_path(spark, "inferred"))
    return landed.withColumns(keys)


MIXED = """CASE WHEN n_chars % 4 = 0 THEN concat(n_chars, '.0') WHEN n_chars % 4 = 1 THEN concat('00', n_chars)
    WHEN n_chars % 4 = 2 THEN concat(n_chars, 'e0') ELSE CAST(n_chars AS string) END"""


def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and types of the columns of an all-text table, whose numbers are written in several ways."""
    rows = table(spark, sf_dir, "documents").selectExpr(
        "CAST(doc_id AS string) AS id", "lang", f"{MIXED} AS mixed", f"{SPELLED} AS spelled",
        "CAST(n_chars > 1000 AS string) AS long", "concat(n_chars, '.25') AS quarter", "CAST(NULL AS string) AS nothing",
    )
    path = publish.scratch_path(spark, "texts")
    rows.write.option("header", True).csv(path)
    return with_types(form_counts(readers.read_raw_csv(spark, path)))


def raw_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and their labels as an all-text CSV, cleaned and typed."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "labelled")
    rows = documents.join(labels, F.col("doc_id") == F.col("labelled"), "left").select(
        "doc_id",
        F.when(F.col("lang") == "fr", " N/A ").otherwise(F.col("lang")).alias("lang"),
        F.when(F.col("quality") == 0, "NODATA!").otherwise(F.col("quality").cast("string")).alias("quality"),
        F.when(F.col("toxic") == 1, "unknown").otherwise(F.col("n_chars").cast("string")).alias("n_chars"),
    )
    base = publish.scratch_path(spark, "documents")
    publish.publish(rows, base, "20230427", "csv")
    raw = readers.read_raw_csv(spark, f"{base}/dt=20230427")
    types = {"doc_id": "bigint", "quality": "int", "n_chars": "bigint"}
    spellings = readers.MISSING_SPELLINGS + readers.NO_DATA_SPELLINGS
    return readers.typed_columns(readers.blank_to_null(raw, spellings=spellings, trim=True), types)


SPELLED = """CASE WHEN n_chars % 5 = 0 THEN CAST(n_chars AS string) WHEN n_chars % 5 = 1 THEN concat(n_chars, '.0')
    WHEN n_chars % 5 = 2 THEN concat(n_chars, '.5') WHEN n_chars % 5 = 3 THEN ' ' ELSE 'word' END"""


def _spelled_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lengths as an all-text file spells numbers: plain, with a decimal, with a fraction, blank, as a word."""
    rows = table(spark, sf_dir, "documents").selectExpr("doc_id AS ID", f"{SPELLED} AS UPRN", f"{SPELLED} AS RHIGHSCORE")
    base = publish.scratch_path(spark, "spelled")
    publish.publish(rows, base, "20230427", "csv")
    return lower_columns(readers.read_raw_csv(spark, f"{base}/dt=20230427"))


def spelled_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = readers.typed_columns(_spelled_numbers(spark, sf_dir), PORTFOLIO_TYPES)
    return typed.select(F.col("id").cast("long").alias("id"), "uprn", "rhighscore")


def lost_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that the cast of the same file loses."""
    raw = readers.blank_to_null(_spelled_numbers(spark, sf_dir), trim=True)
    return readers.lost_values(raw, PORTFOLIO_TYPES)


_BAD = """(l_quantity = 13 OR (l_linenumber = 1 AND l_quantity > 45) OR (l_linenumber = 7 AND l_returnflag = 'R'))"""


def _day_sql(day: str, price: str = "o_totalprice") -> str:
    return f"SELECT o_orderkey, o_custkey, {price} AS o_totalprice, '{day}' AS dt FROM orders"


QUERIES = {
    "valid_rows": valid_rows,
    "rejects": rejects,
    "roundtrip_parquet": newest_parquet,
    "roundtrip_csv": newest_csv,
    "roundtrip_json": newest_json,
    "read_published_day": one_day,
    "read_several_files": several_files,
    "read_inferred_csv": inferred,
    "type_counts": type_counts,
    "read_raw_csv": raw_typed,
    "spelled_numbers": spelled_numbers,
    "lost_numbers": lost_numbers,
}

SQL = {
    "valid_rows": f"SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem WHERE NOT {_BAD}",
    "rejects": f"""SELECT 'items' AS source, count(*) AS rows FROM lineitem WHERE {_BAD}
        UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderkey IS NULL""",
    "roundtrip_parquet": _day_sql("20230427"),
    "roundtrip_csv": _day_sql("20230427"),
    "roundtrip_json": _day_sql("20230427"),
    "read_published_day": _day_sql("20230426", "o_totalprice / 2"),
    "read_several_files": """SELECT o_orderkey, o_custkey, o_totalprice / 2 AS o_totalprice FROM orders
        UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders""",
    "read_inferred_csv": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "type_counts": """
        WITH d AS (SELECT *, length(CAST(n_chars AS VARCHAR)) AS w FROM documents)
        SELECT 'id' AS "column", count(doc_id) AS "values", count(doc_id) AS whole, CAST(0 AS BIGINT) AS decimal,
               CAST(0 AS BIGINT) AS fractional, CAST(0 AS BIGINT) AS logical, CAST(0 AS BIGINT) AS other,
               CAST(max(CASE WHEN doc_id = 0 THEN 0 ELSE length(CAST(doc_id AS VARCHAR)) END) AS BIGINT) AS digits, 'bigint' AS type FROM d
        UNION ALL SELECT 'lang', count(lang), 0, 0, 0, 0, count(lang), 0, 'string' FROM d
        UNION ALL SELECT 'mixed', count(n_chars), count(*) FILTER (n_chars % 4 IN (1, 3)),
               count(*) FILTER (n_chars % 4 IN (0, 2)), 0, 0, 0, max(w), 'double' FROM d
        UNION ALL SELECT 'spelled', count(*) FILTER (n_chars % 5 <> 3), count(*) FILTER (n_chars % 5 = 0),
               count(*) FILTER (n_chars % 5 IN (1, 2)), count(*) FILTER (n_chars % 5 = 2), 0,
               count(*) FILTER (n_chars % 5 = 4), max(CASE WHEN n_chars % 5 < 3 THEN w END), 'string' FROM d
        UNION ALL SELECT 'long', count(*), 0, 0, 0, count(*), 0, 0, 'boolean' FROM d
        UNION ALL SELECT 'quarter', count(*), 0, count(*), count(*), 0, 0, max(w), 'double' FROM d
        UNION ALL SELECT 'nothing', 0, 0, 0, 0, 0, 0, 0, 'string'""",
    "read_raw_csv": """
        SELECT doc_id, nullif(lang, 'fr') AS lang, nullif(quality, 0) AS quality,
               CASE WHEN toxic = 1 THEN NULL ELSE n_chars END AS n_chars
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "spelled_numbers": """
        SELECT doc_id AS id, CASE WHEN n_chars % 5 < 2 THEN n_chars END AS uprn,
               CASE n_chars % 5 WHEN 0 THEN n_chars WHEN 1 THEN n_chars WHEN 2 THEN n_chars + 0.5e0 END AS rhighscore
        FROM documents""",
    "lost_numbers": """
        SELECT 'uprn' AS "column", count(*) AS "values", count(*) FILTER (n_chars % 5 IN (2, 4)) AS lost
        FROM documents WHERE n_chars % 5 <> 3
        UNION ALL SELECT 'rhighscore', count(*), count(*) FILTER (n_chars % 5 = 4) FROM documents WHERE n_chars % 5 <> 3""",
}
