"""Map-layer tables of both use cases, one published table per layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskbook.functions import details
from riskbook.functions.palettes import (
    BER_COLOURS,
    ENVIRONMENT_COLOURS,
    EPC_COLOURS,
    FLOOD_INDEX_COLOURS,
    FLOOD_INDEX_LABELS,
    FLOOD_SCORE_COLOURS,
    FLOOD_SCORE_LABELS,
    legend,
)
from riskbook.operators import layers
from riskbook.operators.councils import (
    boundary_property_counts,
    choropleth_counts,
    cluster_pyramid,
    county_clusters,
)
from riskbook.operators.quality import all_category_counts
from riskbook.plans.portfolio_jobs import typed_portfolio
from riskbook.sources.boundaries import read_boundaries, write_boundaries
from riskbook.sources.publish import publish, read_published

# The category counts shown with the portfolio maps, as (category, counted column).
CATEGORY_PAIRS = (
    ("built_form", "built_form"),
    ("local_authority_label", "local_authority_label"),
    ("currentloan", "currentloan"),
    ("uprn", "currentloan"),
    ("property_type", "construction_age_band"),
    ("construction_age_band", "construction_age_band"),
    ("built_form", "roof_description"),
    ("roof_description", "roof_description"),
    ("inspection_date", "inspection_date"),
)

# Clusters are published for this zoom and all coarser ones.
FINEST_ZOOM = 18


def property_layers(df: DataFrame) -> dict[str, DataFrame]:
    where = ("ecad_id", "etrs89_lat", "etrs89_long")
    return {
        "energy": layers.energy_layer(
            df, *where, "ber_rating", BER_COLOURS, details.property_energy_detail()
        ),
        "flood": layers.flood_index_layer(df, *where, detail=details.property_flood_detail()),
        "index": layers.index_layer(df, *where, details.property_index_detail()),
        "clusters": cluster_pyramid(df, FINEST_ZOOM, 0, where[1], where[2]),
    }


def portfolio_layers(df: DataFrame) -> dict[str, DataFrame]:
    where = ("uprn", "latitude", "longitude")
    return {
        "energy": layers.energy_layer(
            df, *where, "current_energy_rating", EPC_COLOURS, details.portfolio_energy_detail()
        ),
        "flood": layers.flood_score_layer(df, *where, detail=details.portfolio_flood_detail()),
        "index": layers.index_layer(df, *where, details.portfolio_index_detail()),
        "heat": layers.heat_layer(df, where[1], where[2]),
        "heat_raster": layers.heat_raster(layers.heat_layer(df, where[1], where[2]), "lat", "lon"),
        # Points of the flood layer by type and by council; their details are there, by id.
        "types": layers.type_layer(df, *where),
        "councils": layers.council_layer(df, *where),
        "environment": layers.environment_layer(df, *where, detail=details.portfolio_environment_detail()),
        "county_clusters": county_clusters(df),
        "clusters": cluster_pyramid(df, FINEST_ZOOM),
        "category_counts": all_category_counts(df, CATEGORY_PAIRS),
    }


def _publish_all(tables: dict[str, DataFrame], base: str, run_date: str) -> None:
    for name, table in tables.items():
        publish(table, f"{base}/{name}", run_date)


def property_layers_job(spark: SparkSession, enriched: str, out: str, run_date: str) -> None:
    book = read_published(spark, enriched, run_date)
    _publish_all(property_layers(book), out, run_date)
    legends = {
        "legend_energy": legend(spark, BER_COLOURS),
        "legend_flood": legend(spark, FLOOD_INDEX_COLOURS, FLOOD_INDEX_LABELS),
    }
    _publish_all(legends, out, run_date)


def portfolio_layers_job(spark: SparkSession, merged: str, boundaries_json: str, out: str, run_date: str) -> None:
    """All layers of the merged portfolio. The table is typed and stored once; the layers then read only the columns
    they show."""
    typed = typed_portfolio(read_published(spark, f"{merged}/parquet", run_date).drop("dt"))
    publish(typed, f"{out}/typed", run_date)
    book = read_published(spark, f"{out}/typed", run_date).drop("dt")
    _publish_all(portfolio_layers(book), out, run_date)

    councils = read_boundaries(spark, boundaries_json)
    write_boundaries(boundary_property_counts(councils, book), f"{out}/boundaries/dt={run_date}")
    publish(choropleth_counts(councils.drop("geometry", "properties"), book), f"{out}/choropleth", run_date)
    legends = {
        "legend_energy": legend(spark, EPC_COLOURS),
        "legend_flood": legend(spark, FLOOD_SCORE_COLOURS, FLOOD_SCORE_LABELS),
        "legend_environment": legend(spark, ENVIRONMENT_COLOURS),
    }
    _publish_all(legends, out, run_date)
