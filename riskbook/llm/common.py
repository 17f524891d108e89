"""Small helpers of the operators: stored intermediate tables, shared files, words."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import riskbook
from riskbook.sources.publish import scratch_path

# What the operators call a word, as a regular expression that Java, RE2 and Python read alike.
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of text that Python code takes at a time; a longer text is taken alone.
PORTION = 4 << 20


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers of the application, once. Without it they need the package on their own
    path, as with ``--py-files``; a package that was loaded from such an archive is there already."""
    root, application = Path(riskbook.__file__).parent, spark.sparkContext.applicationId
    if application in _SHIPPED or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="riskbook-")) / "riskbook.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Writes a table to the shared scratch folder and reads it back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_file(spark: SparkSession, path: str):
    """The bytes of a vocabulary file as a broadcast: its size is that of the vocabulary, whatever the input."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def portions(texts: pa.Array, most: int = PORTION) -> Iterator[tuple[int, int]]:
    """Start and length of stretches of a text column that hold about ``most`` bytes, at least one text each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most)))
        yield start, end - start
        start = end


def utf8_size(text: Column) -> Column:
    """Bytes of a text, 0 for none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
