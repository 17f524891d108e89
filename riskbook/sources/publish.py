"""Tables published by run day, rejects, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskbook.operators.quality import row_counts

DAY = re.compile(r"dt=(\d{8})")
# Texts repeat the names or places of their columns in every row and are published compressed.
TEXT_FORMATS = ("csv", "json")
# A compressed text is read by one task as a whole, so that a file of it holds at most this many rows.
ROWS_PER_TEXT = 500_000
# From this many fields on, nested ones counted, the steps of a write are not merged into one generated method.
WIDE = 24
_MAX_FIELDS = "spark.sql.codegen.maxFields"
_PARQUET_CODEC = "spark.sql.parquet.compression.codec"
# A merge repeats a row's values a few times in a row, which zstd finds in values, not in numbers of dictionary entries,
# whose bits do not end at bytes. So only columns of few values, whose numbers are short, get a dictionary.
DICTIONARY_BYTES = 16 * 1024
ZSTD_LEVEL = 9
# Parts of a read or a shuffle that each core gets of a write, at least, where the rows are many enough.
TASKS_PER_CORE = 4
_LEAST_PARTS = ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum")
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session, as long as the block runs."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """Spark's setting for writes of wide rows, as long as the block runs; a lower one of the session stays.

    Merged steps over many columns make one method that the JVM does not compile, so that every value is interpreted.
    Step by step the same work is done in small methods. Results do not depend on it.
    """
    before = spark.conf.get(_MAX_FIELDS, None)
    with _setting(spark, _MAX_FIELDS, str(WIDE if before is None else min(WIDE, int(before)))):
        yield


@contextmanager
def even_tasks(spark: SparkSession) -> Iterator[None]:
    """Spark's settings for how many tasks a write has at least, as long as the block runs; those of the session stay.

    Otherwise files are packed, and shuffles joined, to about as many parts as there are cores, by bytes. Dense files make
    such a part long, and the one part more than cores takes as long again while most cores wait.
    """
    least = str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    with ExitStack() as settings:
        for name in _LEAST_PARTS:
            if spark.conf.get(name, None) is None:
                settings.enter_context(_setting(spark, name, least))
        yield


def freed_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Spark's setting by which a query's shuffle files go when it ends, as long as the block runs. Otherwise they stay
    until the driver happens to collect its garbage, beside those of the writes that follow."""
    return _setting(spark, _FREE_SHUFFLES, "true")


def checked_day(run_date: str) -> str:
    if not re.fullmatch(r"\d{8}", run_date):
        raise ValueError(f"run date {run_date!r} is not of the form yyyymmdd")
    return run_date


def publish(
    df: DataFrame,
    base: str,
    run_date: str,
    fmt: str = "parquet",
    max_records_per_file: int = 5_000_000,
    single_file: bool = False,
) -> None:
    """Writes one day of a table under ``base/dt=<run_date>``, replacing that day only.

    The number of files follows the data; ``single_file`` is for reports of a few rows. CSV and JSON lines are compressed
    with gzip, but for single files, and Parquet with zstd, unless the session names a codec; Parquet columns of many values
    have no dictionary. Shuffle files of the write go with it.
    """
    spark = df.sparkSession
    writer = df.coalesce(1).write if single_file else df.write
    if fmt in TEXT_FORMATS and not single_file:
        writer = writer.option("compression", "gzip")
        max_records_per_file = min(max_records_per_file, ROWS_PER_TEXT)
    elif fmt == "parquet":
        writer = writer.option("parquet.dictionary.page.size", DICTIONARY_BYTES)
        if spark.conf.get(_PARQUET_CODEC, None) is None:
            writer = writer.option("compression", "zstd").option("parquet.compression.codec.zstd.level", ZSTD_LEVEL)
    target = f"{base}/dt={checked_day(run_date)}"
    with wide_rows(spark), even_tasks(spark), freed_shuffles(spark):
        (
            writer.mode("overwrite")
            .option("header", True)
            .option("maxRecordsPerFile", max_records_per_file)
            .format(fmt)
            .save(target)
        )


def published_tables(spark: SparkSession, base: str, but: tuple[str, ...] = ()) -> list[str]:
    """Names of the tables published side by side under a folder, without some."""
    return [n for n in names_below(spark, base) if n not in but]


def published_days(spark: SparkSession, base: str) -> list[str]:
    """Days found under a published table, oldest first. Lists one directory; no file is opened."""
    return [m.group(1) for m in map(DAY.fullmatch, names_below(spark, base)) if m]


def names_below(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder, in order; none if it does not exist."""
    files, path = folder_of(spark, folder)
    return sorted(status.getPath().getName() for status in files.listStatus(path)) if files.exists(path) else []


def folder_of(spark: SparkSession, path: str):
    """A path in its Hadoop file system, and that file system."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def remove_folder(spark: SparkSession, folder: str) -> None:
    """A folder with all that is in it, if it exists."""
    files, path = folder_of(spark, folder)
    files.delete(path, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, in place of an earlier one."""
    files, there = folder_of(spark, path)
    out = files.create(there, True)
    out.write(text.encode())
    out.close()


def newest_day(spark: SparkSession, base: str) -> str:
    """The newest day of a published table, whether or not it has rows."""
    days = published_days(spark, base)
    if not days:
        raise FileNotFoundError(f"nothing is published under {base}")
    return days[-1]


def read_published(
    spark: SparkSession,
    base: str,
    run_date: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """All files of one published day, by default the newest, with the day in ``dt``. Give JSON lines a schema: they
    leave out nulls, so a column without values cannot be found in them, and finding the others takes a scan."""
    run_date = newest_day(spark, base) if run_date is None else run_date
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(f"{base}/dt={checked_day(run_date)}").withColumn("dt", F.lit(run_date))


def read_days(
    spark: SparkSession, base: str, schema: T.StructType, days: DataFrame | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Several published days as one table with the given columns and the day in ``dt``; a column that came later is
    null in days before it. ``days`` is a table whose ``dt`` lists the days wanted, by default all; folders of other days
    are left out when the query runs, without its list passing the driver."""
    with_day = T.StructType([*(f for f in schema.fields if f.name != "dt"), T.StructField("dt", T.StringType())])
    table = spark.read.option("header", True).schema(with_day).format(fmt).load(base)
    if days is None:
        return table
    return table.join(days.select(F.col("dt").cast("string").alias("dt")).distinct(), "dt", "left_semi").select(*with_day.names)


def write_rejects(rejects: DataFrame, base: str, run_date: str, source: str) -> bool:
    """Writes the rejected rows of a source as CSV under ``base/dt=<run_date>/source=<source>``, if there are any. Rejects
    of an earlier run of that day and source do not outlive it."""
    target = f"{base}/dt={checked_day(run_date)}/source={source}"
    if rejects.isEmpty():
        remove_folder(rejects.sparkSession, target)
        return False
    rejects.write.mode("overwrite").option("header", True).csv(target)
    return True


def reject_summary(rejects_by_source: dict[str, DataFrame]) -> DataFrame:
    """Number of rejected rows per source; a source without rejects shows 0."""
    return row_counts(rejects_by_source, "source")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder the cluster names in ``spark.checkpoint.dir``; what is written there is
    removed when the application ends. Only a local session without that setting falls back to a temporary folder of
    this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no shared folder for intermediate tables")
        shared = tempfile.mkdtemp(prefix="riskbook-")
    path = f"{shared.rstrip('/')}/riskbook/{name}-{uuid.uuid4().hex}"
    files, folder = folder_of(spark, path)
    files.deleteOnExit(folder)
    return path
