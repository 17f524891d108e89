"""Energy bands, label classes and the derived capital of the exposure report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskbook.functions.common import as_col, number

# Upper bound of each energy-use band in kWh/m2/year and the text the report prints for it.
ENERGY_BANDS = (
    (100, "0; <= 100"),
    (200, "> 100; <= 200"),
    (300, "> 200; <= 300"),
    (400, "> 300; <= 400"),
    (500, "> 400; <= 500"),
)
TOP_BAND = "> 500"

BAND_TEXTS = tuple(text for _, text in ENERGY_BANDS) + (TOP_BAND,)


def energy_band(kwh: Column | str, null_band: str | None = TOP_BAND) -> Column:
    """Band of an energy use. A missing value falls in the top band, as in the regulatory report;
    pass ``null_band`` to keep it apart (``None`` leaves it null)."""
    value = as_col(kwh)
    band = F.when(value.isNull(), F.lit(null_band).cast("string"))
    for upper, text in ENERGY_BANDS:
        band = band.when(value <= upper, text)
    return band.otherwise(TOP_BAND)


def label_class(rating: Column | str) -> Column:
    """First letter of a rating: A1, A2 and A3 are all class A."""
    return F.substring(as_col(rating), 1, 1)


def initial_capital(loan: Column | str, loan_to_value: Column | str) -> Column:
    """Capital implied by a loan balance and its loan-to-value share; null where the share is 0 or missing."""
    return F.try_divide(number(loan), number(loan_to_value))
