"""Access to the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_values(pairs) -> str:
    """A SQL VALUES list of text pairs."""
    def quoted(x) -> str:
        return "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"

    return "(VALUES " + ", ".join("(" + ", ".join(map(quoted, row)) + ")" for row in pairs) + ")"
