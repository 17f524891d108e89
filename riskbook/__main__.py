"""Runs one batch job: ``spark-submit ... riskbook/__main__.py JOB --run-date yyyymmdd --name value ...``

The options of a job are the parameters of its function; ``JOB --help`` lists them.
"""

from __future__ import annotations

import argparse
import inspect
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from riskbook.plans import day_jobs, layer_jobs, portfolio_jobs, property_jobs, regulatory_jobs

JOBS: dict[str, Callable] = {
    "merge-property": property_jobs.merge_property_risk_job,
    "enrich-loan-book": property_jobs.enrich_loan_book_job,
    "report-property": regulatory_jobs.property_report_job,
    "layers-property": layer_jobs.property_layers_job,
    "merge-portfolio": portfolio_jobs.portfolio_merge_job,
    "convert-portfolio": portfolio_jobs.portfolio_conversion_job,
    "report-portfolio": regulatory_jobs.portfolio_report_job,
    "layers-portfolio": layer_jobs.portfolio_layers_job,
    "update-duplicates": portfolio_jobs.duplicate_update_job,
    "day-property": day_jobs.property_day_job,
    "day-portfolio": day_jobs.portfolio_day_job,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="riskbook", description="Property-risk and loan-book jobs")
    jobs = top.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        options = jobs.add_parser(name, description=inspect.getdoc(job))
        for parameter in list(inspect.signature(job).parameters.values())[1:]:
            required = parameter.default is inspect.Parameter.empty
            kind = type(parameter.default) if isinstance(parameter.default, (int, float)) else str
            options.add_argument(
                "--" + parameter.name.replace("_", "-"),
                dest=parameter.name,
                required=required,
                default=None if required else parameter.default,
                type=kind,
            )
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    options = vars(parser().parse_args(arguments))
    job = JOBS[options.pop("job")]
    rows = job(SparkSession.builder.getOrCreate(), **options)
    if rows is not None:
        print(f"{rows} rows written")


if __name__ == "__main__":
    main(sys.argv[1:])
