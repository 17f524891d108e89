"""Map layers as tables: id, position, colour, label and a detail struct. Drawing them is left to the map tool.

Every layer but the heat raster is a projection (with at most a filter) of the enriched table: no shuffle, no state.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.functions.common import as_col, number
from riskbook.functions.flood import flood_rating, heat_weight
from riskbook.functions.palettes import (
    ENVIRONMENT_COLOURS,
    FLOOD_INDEX_COLOURS,
    FLOOD_SCORE_COLOURS,
    Palette,
    colour_of,
)
from riskbook.operators.councils import COUNTY_MAP_COUNCILS, PROPERTY_TYPES


def _point(id_: str, lat: str, lon: str) -> list[Column]:
    return [F.col(id_).alias("id"), F.col(lat).alias("lat"), F.col(lon).alias("lon")]


def _detail(detail: Column | None) -> list[Column]:
    return [] if detail is None else [detail.alias("detail")]


def energy_layer(
    df: DataFrame, id_: str, lat: str, lon: str, rating: str, palette: Palette, detail: Column | None = None
) -> DataFrame:
    """Points coloured by energy rating."""
    return df.select(
        *_point(id_, lat, lon),
        colour_of(rating, palette).alias("colour"),
        F.col(rating).alias("label"),
        *_detail(detail),
    )


def flood_index_layer(
    df: DataFrame,
    id_: str,
    lat: str,
    lon: str,
    index: str = "floodability_index_ud",
    detail: Column | None = None,
) -> DataFrame:
    """Points coloured by the supplied flood index."""
    return df.select(
        *_point(id_, lat, lon),
        colour_of(index, FLOOD_INDEX_COLOURS).alias("colour"),
        F.col(index).alias("label"),
        *_detail(detail),
    )


def flood_score_layer(
    df: DataFrame,
    id_: str,
    lat: str,
    lon: str,
    first: Column | str = "combinedscore_adj",
    second: Column | str = "combinedscore",
    detail: Column | None = None,
) -> DataFrame:
    """Points coloured by the worse of two flood scores."""
    return df.select(
        *_point(id_, lat, lon), flood_rating(first, second).alias("label"), *_detail(detail)
    ).withColumn("colour", colour_of("label", FLOOD_SCORE_COLOURS))


def flood_layer(df: DataFrame, id_: str, lat: str, lon: str, mode: str = "score", **how) -> DataFrame:
    """:func:`flood_index_layer` (``mode="index"``) or :func:`flood_score_layer` (``mode="score"``)."""
    layers = {"index": flood_index_layer, "score": flood_score_layer}
    return layers[mode](df, id_, lat, lon, **how)


def index_layer(df: DataFrame, id_: str, lat: str, lon: str, detail: Column | None = None) -> DataFrame:
    """Points named by their id, for the id search."""
    return df.select(*_point(id_, lat, lon), F.col(id_).cast("string").alias("label"), *_detail(detail))


def heat_layer(
    df: DataFrame,
    lat: str,
    lon: str,
    first: Column | str = "combinedscore_adj",
    second: Column | str = "combinedscore",
    gain: float = 1.4,
) -> DataFrame:
    """Weighted points of the flood heat map."""
    return df.select(
        F.col(lat).alias("lat"), F.col(lon).alias("lon"), heat_weight(first, second, gain).alias("weight")
    )


def heat_raster(
    df: DataFrame, lat: str, lon: str, weight: Column | str = "weight", zoom: int = 14, radius: int = 2
) -> DataFrame:
    """The heat map's surface at a zoom: ``intensity`` of each map cell, with the cell's middle.

    The weight of a cell is spread over the cells up to ``radius`` away by a fixed kernel (binomial in each direction,
    shares that add up to one), and what a cell gets from all is summed. Weights are added up by cell first, so the
    surface grows with the cells in use, not with the properties; every weight is kept, also beyond the edge of the map.
    Rows without position or weight add nothing.
    """
    step = F.lit(360.0 / 2**zoom)
    points = df.select(number(lat).alias("lat"), number(lon).alias("lon"), number(weight).alias("w")).dropna()
    cells = points.groupBy(F.floor(F.col("lat") / step).alias("y"), F.floor(F.col("lon") / step).alias("x")).agg(
        F.sum("w").alias("w")
    )
    shares = [comb(2 * radius, k) / 4**radius for k in range(2 * radius + 1)]
    stamp = F.array(*[
        F.struct(F.lit(i - radius).alias("dy"), F.lit(j - radius).alias("dx"), F.lit(a * b).alias("share"))
        for i, a in enumerate(shares)
        for j, b in enumerate(shares)
    ])
    stamped = cells.select("y", "x", "w", F.inline(stamp))
    spread = stamped.groupBy((F.col("y") + F.col("dy")).alias("cell_y"), (F.col("x") + F.col("dx")).alias("cell_x")).agg(
        F.sum(F.col("w") * F.col("share")).alias("intensity")
    )
    middle = {c: (F.col(f"cell_{axis}") + 0.5) * step for c, axis in (("lat", "y"), ("lon", "x"))}
    return spread.withColumns(middle)


def type_layer(
    df: DataFrame,
    id_: str,
    lat: str,
    lon: str,
    kind: str = "property_type",
    kinds: Sequence[str] = PROPERTY_TYPES,
    detail: Column | None = None,
) -> DataFrame:
    """Points of the listed property types in one pass; ``layer`` names the type."""
    return df.where(F.col(kind).isin(*kinds)).select(
        *_point(id_, lat, lon), F.col(kind).alias("layer"), *_detail(detail)
    )


def council_layer(
    df: DataFrame,
    id_: str,
    lat: str,
    lon: str,
    council: str = "local_authority_label",
    names: Sequence[str] = COUNTY_MAP_COUNCILS,
    detail: Column | None = None,
) -> DataFrame:
    """Points of the named councils; ``layer`` names the council."""
    return type_layer(df, id_, lat, lon, council, names, detail)


def environment_layer(
    df: DataFrame,
    id_: str,
    lat: str,
    lon: str,
    current: str = "current_environmental_rating",
    potential: str = "potential_environmental_rating",
    palette: Palette = ENVIRONMENT_COLOURS,
    detail: Column | None = None,
) -> DataFrame:
    """Points with a border in the colour of the current rating, filled in that of the potential one."""
    return df.select(
        *_point(id_, lat, lon),
        colour_of(current, palette).alias("border_colour"),
        colour_of(potential, palette).alias("fill_colour"),
        as_col(current).alias("label"),
        *_detail(detail),
    )
