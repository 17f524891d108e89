"""Tables stored by key: Parquet in buckets of a key and sorted by it, so that joins and counts by that key need no
shuffle of the stored side.

A day lies under ``base/key=<key>/buckets=<n>/dt=<day>``, its columns are spelled in a small file beside it, so any session
can read it back without a shared catalogue, also a day without rows. Reading registers the layout under a passing name only.

A key's rows are all read by one task. That suits keys with few rows each, such as those of properties and loans; a table
in which one key holds a large share is better published plainly and joined with ``salted=True``.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskbook.sources.publish import checked_day, folder_of, names_below, published_days, write_text

BUCKETS = re.compile(r"buckets=(\d+)")


def publish_by_key(df: DataFrame, base: str, run_date: str, key: str, buckets: int = 512) -> None:
    """Writes one day by buckets of ``key``, replacing that day, also where it was stored in another number of buckets.

    Rows are shuffled once by the key. Adaptive execution joins small buckets to one task and cuts a crowded one, which
    is then stored in several files.
    """
    spark, place = df.sparkSession, f"{base}/key={key}"
    name = f"riskbook_{uuid.uuid4().hex}"
    path = f"{place}/buckets={buckets}/dt={checked_day(run_date)}"
    try:
        (
            df.hint("rebalance", buckets, key)
            .write.mode("overwrite")
            .bucketBy(buckets, key)
            .sortBy(key)
            .format("parquet")
            .option("path", path)
            .saveAsTable(name)
        )
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    write_text(spark, f"{place}/buckets={buckets}/{_columns_file(run_date)}", df.schema.json())
    for other in _layouts(spark, place) - {buckets}:
        files, there = folder_of(spark, f"{place}/buckets={other}/dt={run_date}")
        files.delete(there, True)


def _columns_file(run_date: str) -> str:
    return f"columns-{run_date}.json"


def _layouts(spark: SparkSession, place: str) -> set[int]:
    return {int(m.group(1)) for m in map(BUCKETS.fullmatch, names_below(spark, place)) if m}


def read_by_key(spark: SparkSession, base: str, key: str, run_date: str | None = None) -> DataFrame:
    """One stored day, by default the newest, whose plan knows that rows are partitioned by ``key``."""
    place = f"{base}/key={key}"
    layouts = sorted(_layouts(spark, place))
    held = {n: set(names_below(spark, f"{place}/buckets={n}")) for n in layouts}
    if run_date is None:
        run_date = max((day for n in layouts for day in published_days(spark, f"{place}/buckets={n}")), default=None)
        if run_date is None:
            raise FileNotFoundError(f"nothing is stored under {place}")
    buckets = [n for n in layouts if f"dt={checked_day(run_date)}" in held[n]]
    if not buckets:
        raise FileNotFoundError(f"no day {run_date} under {place}")
    path = f"{place}/buckets={buckets[0]}/dt={run_date}"
    said = spark.read.text(f"{place}/buckets={buckets[0]}/{_columns_file(run_date)}", wholetext=True).first()[0]
    columns = T.StructType.fromJson(json.loads(said)).toDDL()
    name, quoted = f"riskbook_{uuid.uuid4().hex}", path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {buckets[0]} BUCKETS LOCATION '{quoted}'"
    )
    try:
        return spark.table(name)
    finally:
        # The files stay: the table only lent its layout to the DataFrame.
        spark.sql(f"DROP TABLE {name}")
