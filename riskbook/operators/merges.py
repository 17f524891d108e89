"""Merges of property, energy, flood, loan and portfolio tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.operators.skew import hot_keys, hot_keys_of, skew_join


def _hot(df: DataFrame, key: str, salted: bool) -> dict:
    """Hot keys if the join is to be salted by the library; otherwise skew is left to adaptive execution."""
    return hot_keys(df, key) if salted else {}


def lower_columns(df: DataFrame) -> DataFrame:
    """All column names in lower case; names that then collide are an error."""
    names = [c.lower() for c in df.columns]
    clashes = sorted(n for n, times in Counter(names).items() if times > 1)
    if clashes:
        raise ValueError(f"columns differ only in case: {clashes}")
    return df.toDF(*names)


def with_key(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all present."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def _without(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    gone = {c.lower() for c in columns}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def join_keep_left(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    drop_right: Sequence[str] = (),
    hot_left: Mapping | None = None,
    hot_right: Mapping | None = None,
) -> DataFrame:
    """Equi-join that keeps the left key and leaves out the right key and the listed right columns."""
    right = _without(right, [c for c in drop_right if c.lower() != right_key.lower()])
    shared = {c.lower() for c in left.columns} & {c.lower() for c in right.columns} - {right_key.lower()}
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}; list them in drop_right")
    return skew_join(left, right, left_key, right_key, how, hot_left, hot_right)


def merge_property_risk(
    properties: DataFrame,
    energy: DataFrame,
    flood: DataFrame,
    loans: DataFrame | None = None,
    unit: str = "ecad_id",
    building: str = "building_id",
    energy_key: str = "ecad_id",
    flood_key: str = "ecad_id",
    loan_key: str = "ecad_id",
    salted: bool = False,
) -> DataFrame:
    """Properties with their energy rating (by unit) and flood index (by **building**), inner.

    The flood file is keyed by building although its key column is named like the unit's. With ``loans`` only
    properties that also hold a loan remain. One building may hold a large share of all units: adaptive execution
    splits its tasks, or, with ``salted``, its units are spread beforehand and only its few flood rows are copied.
    """
    crowded = hot_keys_of(properties, [unit, building]) if salted else {unit: {}, building: {}}
    merged = join_keep_left(
        properties, energy, unit, energy_key,
        hot_left=crowded[unit], hot_right=_hot(energy, energy_key, salted),
    )
    if loans is not None:
        merged = join_keep_left(
            merged, loans, unit, loan_key,
            hot_left=crowded[unit], hot_right=_hot(loans, loan_key, salted),
        )
    return join_keep_left(
        merged, flood, building, flood_key,
        hot_left=crowded[building], hot_right=_hot(flood, flood_key, salted),
    )


def enrich_loan_book(
    merged: DataFrame,
    loans: DataFrame,
    key: str = "ecad_id",
    loan_key: str = "ecad_id",
    salted: bool = False,
) -> DataFrame:
    """Every merged property with its loans; a property without a loan stays with empty loan columns, a loan
    without a property is left out (see :func:`unmatched_loans`)."""
    crowded = _hot(merged, key, salted)
    hot = _hot(loans, loan_key, salted)
    return join_keep_left(merged, loans, key, loan_key, "left", hot_left=crowded, hot_right=hot)


def unmatched_loans(
    loans: DataFrame,
    merged: DataFrame,
    loan_key: str = "ecad_id",
    key: str = "ecad_id",
    salted: bool = False,
) -> DataFrame:
    """Loans whose property is not in the merged table."""
    known = merged.select(F.col(key).alias("_known")).distinct()
    hot = _hot(loans, loan_key, salted)
    return skew_join(loans, known, loan_key, "_known", "left_anti", hot_left=hot)


def merge_scores(
    portfolio: DataFrame,
    risk_scores: DataFrame,
    how: str = "left",
    key: str = "id",
    second_key: str = "uprn",
    salted: bool = False,
) -> DataFrame:
    """Portfolio with risk scores by id; the first of the two joins of :func:`merge_portfolio`."""
    return join_keep_left(
        portfolio,
        risk_scores,
        key,
        key,
        how,
        drop_right=(second_key,),
        hot_left=_hot(portfolio, key, salted),
        hot_right=_hot(risk_scores, key, salted),
    )


def merge_portfolio(
    portfolio: DataFrame,
    risk_scores: DataFrame,
    latlong: DataFrame,
    how: str = "left",
    key: str = "id",
    second_key: str = "uprn",
    grid: Sequence[str] = ("easting", "northing"),
    salted: bool = False,
) -> DataFrame:
    """Portfolio with risk scores and coordinates by id. The portfolio's second key and grid columns win.

    An id that occurs several times on the right multiplies its rows. Ids must be present (see :func:`with_key`).
    Both joins share their key, and adaptive execution does not split a task whose output the next join needs as it is;
    ``salted`` looks for hot ids beforehand and spreads their rows.
    """
    portfolio_rows, score_rows, latlong_rows = (
        _hot(df, key, salted) for df in (portfolio, risk_scores, latlong)
    )
    scored = join_keep_left(
        portfolio, risk_scores, key, key, how,
        drop_right=(second_key,), hot_left=portfolio_rows, hot_right=score_rows,
    )
    # The rows of a key after the first join: those of the portfolio times those of the scores.
    scored_rows = {k: portfolio_rows.get(k, 1) * score_rows.get(k, 1) for k in {**portfolio_rows, **score_rows}}
    merged = join_keep_left(
        scored, latlong, key, key, how,
        drop_right=(second_key, *grid), hot_left=scored_rows, hot_right=latlong_rows,
    )
    if how == "inner":
        # The inner variant publishes the coordinates before the scores.
        names = [*portfolio.columns, *merged.columns[len(scored.columns):], *scored.columns[len(portfolio.columns):]]
        merged = merged.select(*[F.col(f"`{name}`") for name in names])
    return merged
