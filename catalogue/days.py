"""Tables kept over days: stored by key, complete runs, ledgers, states that add up, several days at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue.jobs import DAY, _file, _portfolio_files, _property_files
from catalogue.merges import SQL as MERGES
from catalogue.quality import PROFILED
from catalogue.tables import table
from riskbook.operators.merges import enrich_loan_book
from riskbook.operators.profile import QUARTILES
from riskbook.operators.profile_state import RANK_ERROR, profile_of_states, profile_state
from riskbook.operators.quality import duplicate_keys
from riskbook.plans.day_jobs import property_day_job
from riskbook.plans.portfolio_jobs import duplicate_update_job, portfolio_merge_job
from riskbook.sources.keyed import publish_by_key, read_by_key
from riskbook.sources.publish import publish, read_days, read_published, scratch_path
from riskbook.sources.readers import read_raw_csv
from riskbook.sources.runs import complete_run, newest_run, read_complete

BEFORE = "20230426"


def keyed_properties(spark: SparkSession, sf_dir: str, buckets: int = 8) -> DataFrame:
    base = scratch_path(spark, "keyed")
    merged = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS ecad_id", "o_totalprice AS valuation")
    publish_by_key(merged, base, DAY, "ecad_id", buckets)
    return read_by_key(spark, base, "ecad_id")


def keyed_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan join on properties stored by key: only the loans are shuffled."""
    loans = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS ecad_id", "l_linenumber AS asset_id", "l_extendedprice AS amount", "l_discount AS ltv"
    )
    return enrich_loan_book(keyed_properties(spark, sf_dir), loans)


def keyed_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicated orders of line items stored by order: counted where they lie."""
    base = scratch_path(spark, "keyed")
    publish_by_key(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), base, DAY, "l_orderkey", 8)
    return duplicate_keys(read_by_key(spark, base, "l_orderkey", DAY), ["l_orderkey"])


def _property_day(spark: SparkSession, sf_dir: str) -> str:
    """A complete day, in whose energy file every seventh rating is no number, and a second run of it that stops between
    two tables."""
    root = scratch_path(spark, "property-day")
    files = _property_files(spark, sf_dir, root)
    spoilt = F.when(F.col("ecad_id").cast("long") % 7 == 0, "bad").otherwise(F.col("ber_rating_kwh"))
    energy = _file(read_raw_csv(spark, files["energy"]).withColumn("ber_rating_kwh", spoilt), f"{root}/in/spoilt")
    property_day_job(spark, files["property"], energy, files["flood"], files["loans"], root, DAY)
    try:
        with complete_run(spark, root, DAY) as run:
            publish(table(spark, sf_dir, "customer"), f"{run}/merged", DAY)
            raise InterruptedError("between two tables")
    except InterruptedError:
        return root


def property_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers find: the tables of the run that ended."""
    book = read_complete(spark, _property_day(spark, sf_dir), "merged")
    return book.select("ecad_id", "building_id", "ber_rating", "riverrp", "dt")


def property_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _property_day(spark, sf_dir)
    run = newest_run(spark, root, DAY)
    ledgers = [
        read_published(spark, f"{root}/{run.folder}/{name}", DAY).select(F.lit(name).alias("ledger"), "*")
        for name in run.tables if name.startswith("ledger/")
    ]
    return ledgers[0].unionByName(ledgers[1])


def portfolio_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of an inner merge whose scores partly have no id, or no number where one is expected."""
    root = scratch_path(spark, "portfolio-merge")
    files = _portfolio_files(spark, sf_dir, root, score_id="if(l_linenumber = 5, NULL, l_orderkey)")
    portfolio_merge_job(spark, *files, f"{root}/merged", f"{root}/staged", DAY, ledger=f"{root}/ledger")
    return read_published(spark, f"{root}/ledger/job=merge-portfolio", DAY)


def kept_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The duplicate report after a second day, on which rows came and others went; the first is not read again."""
    root = scratch_path(spark, "duplicates")
    items = table(spark, sf_dir, "lineitem")

    def rows(name: str, condition: str) -> str:
        return _file(items.where(condition).selectExpr("l_orderkey AS ID", "l_suppkey AS UPRN"), f"{root}/in/{name}")

    places = (f"{root}/state", f"{root}/reports")
    duplicate_update_job(spark, rows("first", "l_linenumber <= 4"), *places, f"{root}/staged", BEFORE)
    came, went = rows("came", "l_linenumber > 4"), rows("went", "l_linenumber = 1")
    duplicate_update_job(spark, came, *places, f"{root}/staged", DAY, went)
    report = read_published(spark, f"{root}/reports/duplicates", DAY, "csv")
    return report.select("key", *[F.col(c).cast("long").alias(c) for c in ("id", "uprn", "count")])


def profile_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of two days from their states, and whether each quartile lies within the bound of the sketches: the
    rows tell, counted anew."""
    base, items = scratch_path(spark, "profile-states"), table(spark, sf_dir, "lineitem")
    for day, condition in ((BEFORE, "l_linenumber <= 2"), (DAY, "l_linenumber > 2")):
        publish(profile_state(items.where(condition), PROFILED), base, day, single_file=True)
    states = read_days(spark, base, profile_state(items, PROFILED).schema)
    # A row per column.
    found = profile_of_states(states).collect()

    def close(row, name: str, p: float):
        value, quartile = F.col(row["column"]), F.lit(row[name])
        ranks = F.avg((value < quartile).cast("double")), F.avg((value <= quartile).cast("double"))
        return ((ranks[0] <= p + RANK_ERROR) & (ranks[1] >= p - RANK_ERROR)).alias(f"{name}_close")

    def figures(row):
        exact = [F.round(F.lit(row[c]), 4).alias(c) for c in ("mean", "std", "min", "max")]
        quartiles = [close(row, name, p) for name, p in QUARTILES]
        return F.struct(F.lit(row["column"]).alias("column"), F.lit(row["count"]).cast("long").alias("count"), *exact, *quartiles)

    return items.agg(F.array(*[figures(row) for row in found]).alias("rows")).select(F.inline("rows"))


def several_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three published days, the first without a column that came later; a table lists the two that are wanted."""
    base, orders = scratch_path(spark, "days"), table(spark, sf_dir, "orders")
    for k, columns in enumerate((("o_orderkey", "o_totalprice"), *[("o_orderkey", "o_totalprice", "o_orderpriority")] * 2)):
        publish(orders.where(F.col("o_orderkey") % 3 == k).select(*columns), base, f"2023042{k}")
    wanted = orders.select(F.concat(F.lit("2023042"), F.col("o_orderkey") % 2).alias("dt"))
    schema = T.StructType([orders.schema[c] for c in ("o_orderkey", "o_totalprice", "o_orderpriority")])
    return read_days(spark, base, schema, wanted)


QUERIES = {
    "enrich_keyed": keyed_enriched,
    "duplicate_keys_keyed": keyed_duplicates,
    "job_property_day": property_day,
    "job_property_ledger": property_ledger,
    "job_portfolio_ledger": portfolio_ledger,
    "job_duplicate_update": kept_duplicates,
    "read_profile_of_days": profile_of_days,
    "read_several_days": several_days,
}

_LEFT = "(SELECT l_orderkey AS id, l_suppkey AS uprn FROM lineitem WHERE l_linenumber <> 1)"


def _steps(ledger: str, steps: dict[str, tuple[str, str, str, str]]) -> str:
    selects = [
        f"SELECT {ledger} '{step}' AS step, ({rows_in}) AS rows_in, ({rows_out}) AS rows_out, "
        f"CAST(({rejected}) AS BIGINT) AS rejected, CAST(({lost}) AS BIGINT) AS lost, '{DAY}' AS dt"
        for step, (rows_in, rows_out, rejected, lost) in steps.items()
    ]
    return " UNION ALL ".join(selects)


def _count(source: str) -> str:
    return f"SELECT count(*) FROM {source}"


def _state_profile_sql(column: str) -> str:
    close = ", ".join(f"true AS {name}_close" for name, _ in QUARTILES)
    return f"""SELECT '{column}' AS "column", count({column}) AS count, round(avg({column}), 4) AS mean,
        round(stddev_samp({column}), 4) AS std, round(CAST(min({column}) AS DOUBLE), 4) AS min,
        round(CAST(max({column}) AS DOUBLE), 4) AS max, {close} FROM lineitem"""


_RATED = "orders WHERE o_orderkey % 7 <> 0"
_SCORED = "orders JOIN lineitem ON o_orderkey = l_orderkey AND l_linenumber <> 5 JOIN documents ON o_orderkey = doc_id"

SQL = {
    "enrich_keyed": MERGES["enrich_loan_book"],
    "duplicate_keys_keyed": "SELECT l_orderkey, count(*) AS count FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    "job_property_day": f"""SELECT CAST(o_orderkey AS INTEGER) AS ecad_id, CAST(o_custkey AS INTEGER) AS building_id,
        substr('ABCDEFG', CAST(trunc(o_totalprice / 75000) AS INTEGER) + 1, 1) || '1' AS ber_rating,
        c_nationkey AS riverrp, '{DAY}' AS dt
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 7 <> 0""",
    "job_property_ledger": _steps("'ledger/job=merge-property' AS ledger,", {
        "ecad": (_count("orders"), _count("orders"), "0", "0"),
        "energy_rating": (_count("orders"), _count(_RATED), _count("orders WHERE o_orderkey % 7 = 0"), "0"),
        "flood_index": (_count("customer"), _count("customer"), "0", "0"),
        "merged": (_count("orders"), _count(_RATED), "0", "0"),
    }) + " UNION ALL " + _steps("'ledger/job=enrich-loan-book' AS ledger,", {
        "loan_book": (_count("lineitem"), _count("lineitem"), "0", "0"),
        "enriched": (_count("lineitem"), _count(f"(SELECT * FROM {_RATED}) LEFT JOIN lineitem ON o_orderkey = l_orderkey"), "0", "0"),
    }),
    "job_portfolio_ledger": _steps("", {
        "portfolio": (_count("orders"), _count("orders"), "0", "0"),
        "risk_scores": (
            _count("lineitem"), _count("lineitem WHERE l_linenumber <> 5"), _count("lineitem WHERE l_linenumber = 5"),
            _count("lineitem WHERE l_linenumber = 6"),
        ),
        "latlong": (_count("documents"), _count("documents"), "0", "0"),
        "merged": (_count("orders"), _count(_SCORED), "0", "0"),
    }),
    "job_duplicate_update": f"""
        SELECT 'id+uprn' AS key, id, uprn, count(*) AS count FROM {_LEFT} GROUP BY id, uprn HAVING count(*) > 1
        UNION ALL SELECT 'id', id, NULL, count(*) FROM {_LEFT} GROUP BY id HAVING count(*) > 1
        UNION ALL SELECT 'uprn', NULL, uprn, count(*) FROM {_LEFT} GROUP BY uprn HAVING count(*) > 1""",
    "read_profile_of_days": " UNION ALL ".join(map(_state_profile_sql, PROFILED)),
    "read_several_days": """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END
        AS o_orderpriority, '2023042' || o_orderkey % 3 AS dt FROM orders WHERE o_orderkey % 3 < 2""",
}
