"""The ledger of a job: what went into each step, what came out, what was rejected or lost, counted while the step's
table is written, so that no job is spent on counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskbook.sources.publish import publish

SCHEMA = "step string, rows_in long, rows_out long, rejected long, lost long"


class Ledger:
    """Steps in the order in which they were begun. A step is watched right where its rows are written, so its figures
    are there when that write has ended."""

    def __init__(self) -> None:
        self._steps: dict[str, tuple[Observation, str | None]] = {}

    def watch(
        self,
        df: DataFrame,
        step: str,
        after: str | None = None,
        rejected: Column | None = None,
        lost: Column | None = None,
    ) -> DataFrame:
        """``df`` with counters. ``rejected`` says which rows the step leaves out, ``lost`` is the number of values of a
        row that do not survive its casts. ``after`` names the step whose rows went in; by default all of ``df``."""
        seen = Observation()
        self._steps[step] = (seen, after)
        return df.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            (F.lit(0) if rejected is None else F.count_if(rejected)).cast("long").alias("rejected"),
            (F.lit(0) if lost is None else F.coalesce(F.sum(lost), F.lit(0))).cast("long").alias("lost"),
        )

    def rows_out(self, step: str) -> int:
        """Rows that a step passed on. Waits for its write."""
        figures = self._steps[step][0].get
        return figures["rows"] - figures["rejected"]

    def rows(self) -> list[tuple]:
        out = []
        for step, (seen, after) in self._steps.items():
            figures = seen.get
            rows_in = figures["rows"] if after is None else self.rows_out(after)
            out.append((step, rows_in, self.rows_out(step), figures["rejected"], figures["lost"]))
        return out

    def publish(self, spark: SparkSession, base: str | None, job: str, run_date: str) -> None:
        """Publishes the day's ledger of a job under ``base/job=<job>``; without a base there is nothing to do."""
        if base is not None:
            table = spark.createDataFrame(self.rows(), SCHEMA)
            publish(table, f"{base}/job={job}", run_date, single_file=True)
