"""Duplicates, group filters, counts, profiles and lookups: A5-A7, A10, A11, J6, P13, P17, P18, S12."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.tables import table
from riskbook.operators import quality
from riskbook.operators.profile import profile
from riskbook.sources.readers import union_files


def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS id", "l_suppkey AS uprn")
    return quality.duplicate_report(items)


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_members(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey")


def listed_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with several line items and the label of the document of that number, missing for most of them."""
    items = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS uprn")
    listing = table(spark, sf_dir, "labels").selectExpr("doc_id AS uprn", "quality AS id")
    return quality.duplicate_members(items, members_of=listing)


def top(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = quality.duplicate_keys(table(spark, sf_dir, "orders"), ["o_custkey"])
    return quality.first_rows(counts, [F.desc("count"), "o_custkey"], 40)


def last(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return quality.last_rows(orders, ["o_orderkey"], 20)


def large_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return quality.rows_with_min_group(orders, "o_custkey", 12)


def crowded_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups that each hold a fifth of all events: the join back to the rows is salted."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return quality.rows_with_min_group(events, "event_type", 2, salted=True)


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.category_counts(table(spark, sf_dir, "orders"), "o_orderpriority")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "labelled")
    return documents.join(labels, F.col("doc_id") == F.col("labelled"), "left")


def all_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = (("source", "quality"), ("lang", "lang"), ("quality", "source"))
    return quality.all_category_counts(labelled_documents(spark, sf_dir), pairs)


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distinct_values(labelled_documents(spark, sf_dir), ["lang", "source", "quality", "toxic"])


PROFILED = ("l_quantity", "l_extendedprice", "l_linenumber")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")})


def numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(profile(table(spark, sf_dir, "lineitem"), PROFILED))


def narrowed_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures; the name is kept from the time when large tables took another way."""
    return _rounded(profile(table(spark, sf_dir, "lineitem"), PROFILED))


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return quality.lookup_properties(customers, "c_custkey", table(spark, sf_dir, "events").select("user_id"))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = labelled_documents(spark, sf_dir)
    return quality.row_counts({
        "documents": table(spark, sf_dir, "documents"),
        "with labels": documents,
        "labelled": documents.where(F.col("labelled").isNotNull()),
    })


def stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_name AS name", "c_nationkey AS nation", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_acctbal AS balance", "s_name AS name", "s_nationkey AS nation", "s_suppkey AS supplier"
    )
    return union_files([customers, suppliers])


_LABELLED = "documents LEFT JOIN labels USING (doc_id)"


def _profile_sql(column: str) -> str:
    quartiles = ", ".join(f"round(quantile_cont(CAST({column} AS DOUBLE), 0.{p}), 4) AS p{p}" for p in (25, 50, 75))
    return f"""SELECT '{column}' AS "column", count({column}) AS count, round(avg({column}), 4) AS mean,
        round(stddev_samp({column}), 4) AS std, round(CAST(min({column}) AS DOUBLE), 4) AS min, {quartiles},
        round(CAST(max({column}) AS DOUBLE), 4) AS max FROM lineitem"""


def _single_key(key: str, column: str) -> str:
    name = {"id": "l_orderkey", "uprn": "l_suppkey"}[column]
    shown = ("l_orderkey", "NULL") if column == "id" else ("NULL", "l_suppkey")
    return f"""SELECT '{key}' AS key, {shown[0]} AS id, {shown[1]} AS uprn, count(*) AS count
        FROM lineitem GROUP BY {name} HAVING count(*) > 1"""


QUERIES = {
    "duplicate_keys": duplicates,
    "duplicate_report": report,
    "duplicate_members": members,
    "duplicate_members_listed": listed_members,
    "top_duplicates": top,
    "last_rows": last,
    "rows_with_min_group": large_groups,
    "rows_of_crowded_groups": crowded_groups,
    "category_counts": categories,
    "all_category_counts": all_categories,
    "distinct_values": values,
    "profile": numeric_profile,
    "profile_narrowed": narrowed_profile,
    "lookup_properties": lookup,
    "row_counts": counts,
    "union_files": stacked,
}

SQL = {
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
        GROUP BY ALL HAVING count(*) > 1""",
    "duplicate_report": f"""
        SELECT 'id+uprn' AS key, l_orderkey AS id, l_suppkey AS uprn, count(*) AS count
        FROM lineitem GROUP BY l_orderkey, l_suppkey HAVING count(*) > 1
        UNION ALL {_single_key("id", "id")} UNION ALL {_single_key("uprn", "uprn")}""",
    "duplicate_members": """
        SELECT o_custkey, count, o_orderkey
        FROM (SELECT o_custkey, count(*) AS count FROM orders GROUP BY o_custkey HAVING count(*) > 1)
             JOIN orders USING (o_custkey)""",
    "duplicate_members_listed": """
        SELECT l_orderkey AS uprn, count, quality AS id
        FROM (SELECT l_orderkey, count(*) AS count FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)
             LEFT JOIN labels ON l_orderkey = doc_id""",
    "top_duplicates": """SELECT o_custkey, count(*) AS count FROM orders GROUP BY o_custkey HAVING count(*) > 1
        ORDER BY count DESC, o_custkey LIMIT 40""",
    "last_rows": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 20",
    "rows_with_min_group": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 12)""",
    "rows_of_crowded_groups": """SELECT event_id, event_type FROM events
        WHERE event_type IN (SELECT event_type FROM events GROUP BY event_type HAVING count(*) >= 2)""",
    "category_counts": "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderpriority",
    "all_category_counts": f"""
        SELECT 'source' AS key, 'quality' AS value, source AS category, count(quality) AS count
        FROM {_LABELLED} GROUP BY source
        UNION ALL SELECT 'lang', 'lang', lang, count(lang) FROM {_LABELLED} GROUP BY lang
        UNION ALL SELECT 'quality', 'source', CAST(quality AS VARCHAR), count(source)
        FROM {_LABELLED} WHERE quality IS NOT NULL GROUP BY quality""",
    "distinct_values": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value FROM {_LABELLED} GROUP BY {c}"""
        for c in ("lang", "source", "quality", "toxic")
    ),
    "profile": " UNION ALL ".join(map(_profile_sql, PROFILED)),
    "profile_narrowed": " UNION ALL ".join(map(_profile_sql, PROFILED)),
    "lookup_properties": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events)",
    "row_counts": f"""SELECT 'documents' AS step, count(*) AS rows FROM documents
        UNION ALL SELECT 'with labels', count(*) FROM {_LABELLED}
        UNION ALL SELECT 'labelled', count(quality) FROM {_LABELLED}""",
    "union_files": """
        SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment,
               CAST(NULL AS BIGINT) AS supplier FROM customer
        UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL, s_suppkey FROM supplier""",
}
