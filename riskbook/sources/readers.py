"""CSV readers and the split of a file into valid and rejected rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskbook.sources.publish import wide_rows
from riskbook.sources.schemas import CORRUPT, with_corrupt
from riskbook.sources.types import as_types, found_types

# Texts that stand for a missing value when the portfolio files are read for the maps and counts.
MISSING_SPELLINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Further such texts in the files. They count as categories of their own unless asked for.
NO_DATA_SPELLINGS = ("NODATA!", "NO DATA!")


def _csv(spark: SparkSession, header: bool):
    """With a header, a schema has to name the columns as the file does: other names or another order are an error,
    not values in the wrong columns."""
    reader = spark.read.option("header", header).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
    return reader.option("enforceSchema", not header)


def read_validated_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, header: bool = True
) -> DataFrame:
    """CSV with a fixed schema. The text of a row that does not fit (too short, too long, a bad value) goes to
    ``_corrupt_record``. Split the rows with :func:`land_csv`: a query on this DataFrame that leaves columns out does
    not parse them and so does not see all bad rows."""
    return (
        _csv(spark, header)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(with_corrupt(schema))
        .csv(path)
    )


def land_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    staged: str,
    header: bool = True,
    watch: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> tuple[DataFrame, DataFrame]:
    """Parses a CSV once into a Parquet table at ``staged`` and returns its valid and its rejected rows. ``watch`` may
    add counters to the rows that are written.

    All columns are parsed in the one write, so a row is judged by all of them; what follows reads columnar files,
    prunes columns, and does not depend on cached blocks of executors that may go away. Rejects are told apart by a
    pushed-down filter; row groups without any are skipped by their statistics.
    """
    with wide_rows(spark):
        watch(read_validated_csv(spark, path, schema, header)).write.mode("overwrite").parquet(staged)
    return split_rejects(spark.read.schema(with_corrupt(schema)).parquet(staged))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the helper column, and rejected rows. ``df`` is a stored table, not a CSV reader."""
    bad = F.col(CORRUPT).isNotNull()
    return df.where(~bad).drop(CORRUPT), df.where(bad)


def land_inferred_csv(spark: SparkSession, path: str | Sequence[str], staged: str) -> DataFrame:
    """CSV whose types are found: parsed once, into a Parquet table of texts at ``staged``; types come from one scan of
    that table, and columns are cast as they are read (see :mod:`riskbook.sources.types`)."""
    texts = read_raw_csv(spark, path)
    texts.write.mode("overwrite").parquet(staged)
    landed = spark.read.schema(texts.schema).parquet(staged)
    return as_types(landed, found_types(landed))


def read_raw_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV with every column as text."""
    return _csv(spark, True).csv(path)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """CSV with a fixed schema; values that do not fit become null."""
    return _csv(spark, True).schema(schema).csv(path)


def blank_to_null(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    spellings: Sequence[str] = MISSING_SPELLINGS,
    trim: bool = False,
) -> DataFrame:
    """Text columns (all by default) with the spellings of a missing value turned into null; with ``trim`` outer
    blanks are removed first."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    chosen = texts if columns is None else [c for c in columns if c in texts]
    values = {c: F.trim(F.col(f"`{c}`")) if trim else F.col(f"`{c}`") for c in chosen}
    return df.withColumns({c: F.when(~v.isin(*spellings), v) for c, v in values.items()})


def _as_type(text: Column, kind: str) -> Column:
    """Text as a value of a type, null if it is none. Whole numbers may be written with decimals (``67.0``, ``6.7e1``)."""
    if kind not in ("int", "bigint"):
        return text.try_cast(kind)
    exact = text.try_cast("decimal(38,10)")
    return F.coalesce(text.try_cast(kind), F.when(exact == F.floor(exact), exact.try_cast(kind)))


def _present(df: DataFrame, types: Mapping[str, str]) -> dict[str, str]:
    present = {c.lower(): c for c in df.columns}
    return {present[name.lower()]: kind for name, kind in types.items() if name.lower() in present}


def typed_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns cast to the given types where they exist; a value that does not fit becomes null (see
    :func:`lost_values`)."""
    wanted = _present(df, types)
    return df.withColumns({c: _as_type(F.col(f"`{c}`"), kind) for c, kind in wanted.items()})


def lost_values(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """For each column that :func:`typed_columns` casts, how many values it has and how many of them are lost."""
    wanted = _present(df, types)
    entries = []
    for c, kind in wanted.items():
        text = F.col(f"`{c}`")
        lost = F.count(F.when(text.isNotNull() & _as_type(text, kind).isNull(), 1))
        entries.append(F.struct(F.lit(c).alias("column"), F.count(text).alias("values"), lost.alias("lost")))
    if not entries:
        return df.sparkSession.createDataFrame([], "column string, values long, lost long")
    return df.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))


def lost_in_row(df: DataFrame, types: Mapping[str, str], spellings: Sequence[str] = MISSING_SPELLINGS) -> Column:
    """How many values of a row :func:`typed_columns` loses, after the spellings of a missing value became null."""
    lost = F.lit(0)
    for c, kind in _present(df, types).items():
        text = F.col(f"`{c}`")
        lost = lost + F.when(~text.isin(*spellings) & _as_type(text, kind).isNull(), 1).otherwise(0)
    return lost


def union_files(frames: Sequence[DataFrame]) -> DataFrame:
    """Tables stacked by column name; a column that a table lacks is null there. For files of one layout pass all
    paths to a single reader instead."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
