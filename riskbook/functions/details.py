"""Detail records that go with a map point, as structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.functions.common import as_col
from riskbook.functions.display import (
    address_line,
    description_line,
    ltv_percent,
    ltv_whole_percent,
    money,
    rate_percent,
)

PROPERTY_ADDRESS = ("address_line_1", "address_line_2", "address_line_3")
DESCRIPTION_FIELDS = (
    "property_type", "built_form", "postcode_flag", "easting", "northing", "latitude", "longitude",
)

# Hazard, return period in years, depth column, score column of the flood-index file.
RETURN_PERIODS = (
    ("river", 20, "rmax20", "r20matrix"),
    ("river", 75, "rmax75", "r75matrix"),
    ("river", 100, "rmax100", "r100matrix"),
    ("river", 200, "rmax200", "r200matrix"),
    ("river", 1000, "rmax1000", "r1000matrix"),
    ("coastal", 75, "cudmax75", "cud75matrix"),
    ("coastal", 100, "cudmax100", "cud100matrix"),
    ("coastal", 200, "cudmax200", "cud200matrix"),
    ("coastal", 1000, "cudmax1000", "cud1000matrix"),
    ("surface_water", 75, "swmax75", "sw75matrix"),
    ("surface_water", 200, "swmax200", "sw200matrix"),
    ("surface_water", 1000, "swmax1000", "sw1000matrix"),
)


def _fields(*names: str) -> list[Column]:
    return [F.col(n).alias(n) for n in names]


def _profile_entry(period: tuple[str, int, str, str]) -> Column:
    hazard, years, depth, score = period
    return F.struct(
        F.lit(hazard).alias("hazard"),
        F.lit(years).alias("return_period"),
        as_col(depth).cast("double").alias("depth_m"),
        as_col(score).cast("int").alias("score"),
    )


def return_period_profile(
    df: DataFrame, keys: Sequence[str], periods: Sequence[tuple[str, int, str, str]] = RETURN_PERIODS
) -> DataFrame:
    """Wide depth and score columns as one row per key, hazard and return period."""
    return df.select(*keys, F.inline(F.array(*[_profile_entry(p) for p in periods])))


def property_energy_detail() -> Column:
    return F.struct(
        address_line(PROPERTY_ADDRESS).alias("address"),
        *_fields("ber_rating", "ber_rating_kwh", "co2_emission"),
    )


def property_flood_detail() -> Column:
    return F.struct(
        address_line(PROPERTY_ADDRESS).alias("address"),
        *_fields("riverrp", "coastaludrp", "swaterrp", "floodscore_ud"),
        F.array(*[_profile_entry(p) for p in RETURN_PERIODS]).alias("profile"),
        *_fields("model_river", "model_coastal", "model_sw"),
    )


def property_loan_terms() -> Column:
    return F.struct(
        *_fields("Asset_id", "product", "term"),
        rate_percent("`Rate/Margin`").alias("rate_percent"),
        *_fields("Disbursment_Date", "Closing_Date", "Initial_Borrow_Capital"),
        ltv_whole_percent("LTV").alias("ltv_percent"),
        *_fields("Monthly_Repayment", "Mortgage_Outstanding"),
    )


def property_index_detail() -> Column:
    """Energy, flood and loan fields together, as the id search shows them."""
    return F.struct(
        address_line(PROPERTY_ADDRESS).alias("address"),
        *_fields("ber_rating", "ber_rating_kwh", "co2_emission"),
        *_fields("riverrp", "coastaludrp", "swaterrp", "floodscore_ud"),
        F.array(*[_profile_entry(p) for p in RETURN_PERIODS]).alias("profile"),
        property_loan_terms().alias("loan"),
    )


def portfolio_loan_terms() -> Column:
    return F.struct(
        *_fields("uprn", "currentloan"),
        ltv_percent("currentltv").alias("ltv_percent"),
        money("initial_borrow_capital").alias("initial_borrow_capital"),
    )


def portfolio_fabric() -> Column:
    """Hot water, floor, windows, walls and roof with their energy and environment efficiency."""
    parts = (
        ("hotwater", "hotwater_description", "hot_water_energy_eff", "hot_water_env_eff"),
        ("floor", "floor_description", "floor_energy_eff", "floor_env_eff"),
        ("windows", "windows_description", "windows_energy_eff", "windows_env_eff"),
        ("walls", "walls_description", "walls_energy_eff", "walls_env_eff"),
        ("roof", "roof_description", "roof_energy_eff", "roof_env_eff"),
    )
    return F.array(*[
        F.struct(
            F.lit(part).alias("part"),
            F.col(text).alias("description"),
            F.col(energy).alias("energy_efficiency"),
            F.col(environment).alias("environment_efficiency"),
        )
        for part, text, energy, environment in parts
    ])


def portfolio_energy_detail() -> Column:
    return F.struct(
        description_line(*DESCRIPTION_FIELDS).alias("description"),
        *_fields("construction_age_band", "glazed_type"),
        *_fields("current_energy_rating", "potential_energy_rating"),
        *_fields("energy_consumption_current", "energy_consumption_potential"),
        *_fields("co2_emissions_current", "co2_emissions_potential"),
        *_fields("current_energy_efficiency", "potential_energy_efficiency"),
        portfolio_fabric().alias("fabric"),
        portfolio_loan_terms().alias("loan"),
    )


def portfolio_flood_scores() -> Column:
    """Defended and undefended score of every hazard."""
    hazards = (
        ("river", "rhighscore", "rhighscore_adj"),
        ("coastal", "chighscore", "chighscore_adj"),
        ("surface_water", "swhighscore", "swhighscore_adj"),
        ("combined", "combinedscore", "combinedscore_adj"),
    )
    return F.array(*[
        F.struct(
            F.lit(hazard).alias("hazard"),
            as_col(defended).cast("double").alias("defended"),
            as_col(undefended).cast("double").alias("undefended"),
        )
        for hazard, defended, undefended in hazards
    ])


def portfolio_flood_detail() -> Column:
    return F.struct(
        description_line(*DESCRIPTION_FIELDS).alias("description"),
        portfolio_flood_scores().alias("scores"),
        *_fields("gwhighscore", "canal_failure_value", "dam_break_value", "unflood_value"),
        *_fields("sop_river_value", "sop_surface_water_value"),
        *_fields("npd_peat", "npd_sand", "npd_silt", "npd_soft"),
        portfolio_loan_terms().alias("loan"),
    )


def portfolio_index_detail() -> Column:
    return F.struct(
        description_line(*DESCRIPTION_FIELDS).alias("description"),
        *_fields("current_energy_rating", "potential_energy_rating"),
        *_fields("energy_consumption_current", "energy_consumption_potential"),
        *_fields("co2_emissions_current", "co2_emissions_potential"),
        *_fields("current_energy_efficiency", "potential_energy_efficiency"),
        portfolio_flood_scores().alias("scores"),
        portfolio_loan_terms().alias("loan"),
    )


def portfolio_environment_detail() -> Column:
    return F.struct(
        *_fields("current_environmental_rating", "potential_environmental_rating"),
        *_fields("environment_impact_current", "environment_impact_potential"),
        *_fields("co2_emissions_current", "co2_emissions_potential"),
    )
