"""Colour tables of the map layers and the lookup of a code in them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.functions.common import as_col

BLANK = "Blank"

# Building energy rating (15 steps).
BER_COLOURS = {
    "A1": "#00a54f",
    "A2": "#00a54f",
    "A3": "#00a54f",
    "B1": "#4cb848",
    "B2": "#4cb848",
    "B3": "#4cb848",
    "C1": "#bed630",
    "C2": "#bed630",
    "C3": "#bed630",
    "D1": "#fff101",
    "D2": "#fff101",
    "E1": "#fcb814",
    "E2": "#fcb814",
    "F": "#f36e21",
    "G": "#ee1d23",
}

# Energy performance certificate. None is the colour of a property without a certificate.
EPC_COLOURS = {
    None: "#deebf6",
    "A": "#00a54f",
    "B": "#4cb848",
    "C": "#bed630",
    "D": "#fff101",
    "E": "#fcb814",
    "F": "#f36e21",
    "G": "#ee1d23",
}

# The older certificate colours, where a missing rating is first named "Blank".
EPC_COLOURS_CLASSIC = {
    "A": "#007e2e",
    "B": "#2c9f29",
    "C": "#a1d20e",
    "D": "#f8f400",
    "E": "#f1c300",
    "F": "#e77c17",
    "G": "#df0024",
    BLANK: "#ffffff",
}

# Environment impact rating.
ENVIRONMENT_COLOURS = {
    "A": "#cde2f5",
    "B": "#97c0e6",
    "C": "#73a2d6",
    "D": "#4e84c4",
    "E": "#a5a6a9",
    "F": "#919194",
    "G": "#807f83",
    BLANK: "#ffffff",
}

# Supplied flood index (property use case).
FLOOD_INDEX_COLOURS = {
    "No Colour": "#deebf6",
    "green": "#a5d45d",
    "amber": "#ecc63a",
    "red": "#d92424",
    "black 1": "#919191",
    "black 2": "#242424",
}

# Flood colour derived from scores (portfolio use case).
FLOOD_SCORE_COLOURS = {
    "no-colour": "#deebf6",
    "green": "#a5d45d",
    "amber": "#ecc63a",
    "red": "#d92424",
    "black-1": "#919191",
    "black-2": "#242424",
    "purple": "#9370db",
}

# Legend texts of the flood palettes, in palette order.
FLOOD_INDEX_LABELS = ("Very Low", "Low", "Moderate", "Moderate to High", "High", "Very High")
FLOOD_SCORE_LABELS = FLOOD_INDEX_LABELS + ("ERROR",)

Palette = Mapping[str | None, str]


def colour_of(code: Column | str, palette: Palette) -> Column:
    """Colour of a code; null for a code the palette does not hold. A missing code takes the palette's ``None``
    colour, or its "Blank" colour, if it has one."""
    value = as_col(code)
    missing = palette.get(None, palette.get(BLANK))
    entries = [F.lit(text) for pair in palette.items() if pair[0] is not None for text in pair]
    colour = F.try_element_at(F.create_map(*entries), value)
    return F.when(value.isNull(), F.lit(missing).cast("string")).otherwise(colour)


def with_colour(df: DataFrame, code: str, palette: Palette, out: str = "colour") -> DataFrame:
    return df.withColumn(out, colour_of(code, palette))


def unknown_codes(df: DataFrame, code: str, palette: Palette) -> DataFrame:
    """Codes without a colour and how many rows hold each of them."""
    return (
        df.where(colour_of(code, palette).isNull())
        .groupBy(F.col(code).alias("code"))
        .agg(F.count("*").alias("rows"))
    )


def legend(spark: SparkSession, palette: Palette, labels: tuple[str, ...] | None = None) -> DataFrame:
    """One row per palette entry: position, code, label, colour. The labels default to the codes."""
    texts = tuple(palette) if labels is None else tuple(labels)
    if len(texts) != len(palette):
        raise ValueError(f"a palette of {len(palette)} colours needs as many labels, not {len(texts)}")
    rows = [(i, code, text, colour) for i, ((code, colour), text) in enumerate(zip(palette.items(), texts))]
    return spark.createDataFrame(rows, "position int, code string, label string, colour string")
