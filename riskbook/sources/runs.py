"""Days that appear as a whole: a run writes its tables to a folder of its own, and one small manifest, written last,
names them. Readers go by the newest manifest, so a run that stops half way leaves the earlier tables readable, and a
second run of a day replaces all tables of the first at once.

``base/runs/dt=<day>/run=<id>/<table>/dt=<day>`` holds the tables, ``base/manifests/dt=<day>/<time>-<id>.json`` names
them. Jobs need not know: they get the run's folder as the place of their tables.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskbook.sources.publish import (
    DAY,
    checked_day,
    folder_of,
    names_below,
    published_days,
    read_published,
    write_text,
)


@dataclass(frozen=True)
class CompleteRun:
    """What a manifest says: the day, the run's folder below ``base``, and its tables."""

    run_date: str
    folder: str
    tables: tuple[str, ...]


@contextmanager
def complete_run(spark: SparkSession, base: str, run_date: str) -> Iterator[str]:
    """The folder of a new run. Its tables count once the block ends without an error, all of them together."""
    run = f"runs/dt={checked_day(run_date)}/run={uuid.uuid4().hex}"
    yield f"{base}/{run}"
    tables = _tables_below(spark, f"{base}/{run}")
    text = json.dumps({"run_date": run_date, "folder": run, "tables": tables})
    _write_whole(spark, f"{base}/manifests/dt={run_date}", f"{time.time_ns():020d}-{run[-32:]}.json", text)


def _tables_below(spark: SparkSession, folder: str, inside: str = "") -> list[str]:
    """Folders that hold days, however deep; what is in a day is not listed."""
    names = names_below(spark, f"{folder}/{inside}")
    if any(DAY.fullmatch(name) for name in names):
        return [inside.rstrip("/")]
    # Files among the folders have nothing below them but themselves.
    deeper = [n for n in names if "." not in n and not n.startswith("_")]
    return [table for name in deeper for table in _tables_below(spark, folder, f"{inside}{name}/")]


def _write_whole(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """A small file that is there as a whole or not at all: written under a hidden name and renamed."""
    files, hidden = folder_of(spark, f"{folder}/_{name}")
    write_text(spark, f"{folder}/_{name}", text)
    if not files.rename(hidden, folder_of(spark, f"{folder}/{name}")[1]):
        raise OSError(f"{folder}/{name} could not be written")


def newest_run(spark: SparkSession, base: str, run_date: str | None = None) -> CompleteRun:
    """The run whose manifest was written last, of a day or of the newest day that has one."""
    days = published_days(spark, f"{base}/manifests") if run_date is None else [checked_day(run_date)]
    for day in reversed(days):
        folder = f"{base}/manifests/dt={day}"
        names = [n for n in names_below(spark, folder) if not n.startswith(("_", "."))]
        if names:
            said = json.loads(spark.read.text(f"{folder}/{max(names)}", wholetext=True).first()[0])
            return CompleteRun(said["run_date"], said["folder"], tuple(said["tables"]))
    raise FileNotFoundError(f"no complete run under {base}")


def read_complete(
    spark: SparkSession,
    base: str,
    table: str,
    run_date: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """A table of the newest complete run of a day, by default of the newest day. Tables read with the same day may come
    from two runs if one ends in between; take :func:`newest_run` once and read below its folder where that matters."""
    run = newest_run(spark, base, run_date)
    if table not in run.tables:
        raise KeyError(f"{table!r} is not among the tables of the run: {', '.join(run.tables)}")
    return read_published(spark, f"{base}/{run.folder}/{table}", run.run_date, fmt, schema)


def unnamed_runs(spark: SparkSession, base: str, run_date: str) -> list[str]:
    """Folders of a day's runs that no manifest names: stopped, or still at work. Nothing is deleted here."""
    names = names_below(spark, f"{base}/manifests/dt={checked_day(run_date)}")
    named = {n.removesuffix(".json").rpartition("-")[2] for n in names if not n.startswith(("_", "."))}
    return [n for n in names_below(spark, f"{base}/runs/dt={run_date}") if n.removeprefix("run=") not in named]
