"""Counts and point groups per council, and grid cells for clustered display."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.functions.common import number

PROPERTY_TYPES = ("House", "Flat", "Bungalow", "Maisonette")

# The councils of the published county map.
COUNTY_MAP_COUNCILS = (
    "Camden",
    "Bristol, City of",
    "Bath and North East Somerset",
    "North Somerset",
    "Tower Hamlets",
    "South Gloucestershire",
    "Wiltshire",
)


def council_type_counts(
    df: DataFrame,
    code: str = "local_authority",
    kind: str = "property_type",
    kinds: Sequence[str] = PROPERTY_TYPES,
    label: str | None = "local_authority_label",
) -> DataFrame:
    """Properties per council code, one column per listed type, 0 where there is none. Other types are ignored, as
    are rows without code, type or council name."""
    present = [c for c in (code, kind, label) if c]
    for c in present:
        df = df.where(F.col(c).isNotNull())
    return df.groupBy(code).pivot(kind, list(kinds)).agg(F.count(F.lit(1))).fillna(0, list(kinds))


def boundary_property_counts(
    boundaries: DataFrame,
    df: DataFrame,
    boundary_code: str = "LAD13CD",
    code: str = "local_authority",
    kind: str = "property_type",
    kinds: Sequence[str] = PROPERTY_TYPES,
    label: str | None = "local_authority_label",
) -> DataFrame:
    """Every boundary with the number of properties of each type in it, 0 where there is none."""
    counts = council_type_counts(df, code, kind, kinds, label).withColumnRenamed(code, "_code")
    joined = boundaries.join(counts, boundaries[boundary_code] == counts["_code"], "left").drop("_code")
    return joined.fillna(0, list(kinds))


def council_counts(
    df: DataFrame,
    name: str = "local_authority_label",
    code: str = "local_authority",
    constituency: str = "constituency",
) -> DataFrame:
    """Properties per council name, code and constituency. Rows without one of the three are left out."""
    keys = (name, code, constituency)
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def choropleth_counts(
    boundaries: DataFrame,
    df: DataFrame,
    boundary_name: str = "LAD13NM",
    name: str = "local_authority_label",
    code: str = "local_authority",
    constituency: str = "constituency",
) -> DataFrame:
    """Every boundary with the number of properties of the council of that **name**, missing where there is none.
    A council's constituencies are added up."""
    counts = council_counts(df, name, code, constituency).groupBy(F.col(name).alias("_name")).agg(
        F.sum("count").alias("count")
    )
    return boundaries.join(counts, boundaries[boundary_name] == counts["_name"], "left").drop("_name")


def county_clusters(
    df: DataFrame,
    names: Sequence[str] = COUNTY_MAP_COUNCILS,
    council: str = "local_authority_label",
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """Size and mean position of the named councils; all other rows are dropped."""
    return (
        df.where(F.col(council).isin(*names))
        .groupBy(council)
        .agg(F.count("*").alias("count"), F.avg(lat).alias("lat"), F.avg(lon).alias("lon"))
    )


def grid_clusters(df: DataFrame, zoom: int, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Points per map cell: size and mean position. A cell spans 360 / 2**zoom degrees each way."""
    step = F.lit(360.0 / 2**zoom)
    return (
        df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .groupBy(F.floor(F.col(lat) / step).alias("cell_y"), F.floor(F.col(lon) / step).alias("cell_x"))
        .agg(F.count("*").alias("count"), F.avg(lat).alias("lat"), F.avg(lon).alias("lon"))
    )


def cluster_pyramid(
    df: DataFrame, finest: int = 18, coarsest: int = 0, lat: str = "latitude", lon: str = "longitude"
) -> DataFrame:
    """Clusters at every zoom from ``coarsest`` to ``finest``: ``zoom``, cell, size and mean position, each zoom as
    :func:`grid_clusters` gives it.

    Points are counted once, in the cells of the finest zoom; a cell of a coarser zoom is four of the next finer one, so
    its number is theirs without the last bits, and sums and counts are rolled up from cells. Points move once, combined
    by cell, and what is rolled up grows with the cells in use, not with the points. Positions that are missing or no
    number are left out.
    """
    step = F.lit(360.0 / 2**finest)
    placed = df.select(number(lat).alias("lat"), number(lon).alias("lon")).where("lat is not null and lon is not null")
    cells = placed.groupBy(F.floor(F.col("lat") / step).alias("y"), F.floor(F.col("lon") / step).alias("x")).agg(
        F.count("*").alias("n"), F.sum("lat").alias("lat"), F.sum("lon").alias("lon")
    )
    levels = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(finest - coarsest))).alias("up"))
    by_level = levels.groupBy(
        (F.lit(finest) - F.col("up")).alias("zoom"),
        F.expr("shiftright(y, up)").alias("cell_y"),
        F.expr("shiftright(x, up)").alias("cell_x"),
    )
    sums = by_level.agg(F.sum("n").alias("count"), F.sum("lat").alias("lat"), F.sum("lon").alias("lon"))
    return sums.withColumns({c: F.col(c) / F.col("count") for c in ("lat", "lon")})
