"""Schemas of the input files. Field names and types are fixed values of the file formats."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}


def schema_of(text: str) -> T.StructType:
    """Schema of a list of ``name type`` pairs; unlike a DDL string it needs no running session."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Property address file; one row per unit, several units may share a building.
PROPERTY = schema_of("""
    ecad_id int, building_id int,
    address_line_1 string, address_line_2 string, address_line_3 string, address_line_4 string,
    address_line_5 string, address_line_6 string, address_line_7 string, address_line_8 string,
    address_line_9 string,
    etrs89_lat double, etrs89_long double
""")

# Energy rating file, one row per unit.
ENERGY_RATING = schema_of("ecad_id int, ber_rating string, ber_rating_kwh double, co2_emission double")

# Flood index file; its ecad_id holds a building id.
FLOOD_INDEX = schema_of("""
    ecad_id int,
    riverrp int, rmax20 double, rmax75 double, rmax100 double, rmax200 double, rmax1000 double, sop_ri int,
    coastaludrp int, cudmax75 double, cudmax100 double, cudmax200 double, cudmax1000 double,
    swaterrp int, swmax75 double, swmax200 double, swmax1000 double,
    model_river string, model_coastal string, model_sw string,
    r20matrix int, r75matrix int, r100matrix int, r200matrix int, r1000matrix int,
    cud75matrix int, cud100matrix int, cud200matrix int, cud1000matrix int,
    sw75matrix int, sw200matrix int, sw1000matrix int,
    river_floodscore_ud int, coastal_floodscore_ud int, surfacewater_floodscore_ud int,
    river_floodscore_def int, floodscore_ud int, floodscore_def int,
    unflood_value int, unflood_heightband string,
    floodability_index_ud string, floodability_index_def string
""")

# Loan book of the property use case; dates are text.
LOAN_BOOK = schema_of("""
    ecad_id int, Asset_id int, product string, term int, Rate/Margin double,
    Disbursment_Date string, Closing_Date string, Initial_Borrow_Capital double, LTV double,
    Monthly_Repayment double, Next_Payment_Due string, Monthly_Capital_Repayment double,
    Months_Paid int, Months_Due int, Property_Valuation double, Initial_Deposit double,
    Mortgage_Outstanding double
""")


def _after_key(schema: T.StructType) -> list[T.StructField]:
    return schema.fields[1:]


# The published loan book: property, then energy, flood and loan columns without their keys.
ENRICHED_LOAN_BOOK = T.StructType(
    PROPERTY.fields + _after_key(ENERGY_RATING) + _after_key(FLOOD_INDEX) + _after_key(LOAN_BOOK)
)

# Portfolio columns that are computed with, in lower case; all others stay text. Scores and efficiencies
# are mostly whole, but files that went through a data frame with gaps write them with decimals, and fractions occur.
PORTFOLIO_TYPES = {
    "uprn": "bigint",
    "easting": "double",
    "northing": "double",
    "latitude": "double",
    "longitude": "double",
    "currentloan": "double",
    "currentltv": "double",
    "current_energy_efficiency": "double",
    "potential_energy_efficiency": "double",
    "energy_consumption_current": "double",
    "energy_consumption_potential": "double",
    "co2_emissions_current": "double",
    "co2_emissions_potential": "double",
    "environment_impact_current": "double",
    "environment_impact_potential": "double",
    "rhighscore": "double",
    "rhighscore_adj": "double",
    "chighscore": "double",
    "chighscore_adj": "double",
    "swhighscore": "double",
    "swhighscore_adj": "double",
    "gwhighscore": "double",
    "combinedscore": "double",
    "combinedscore_adj": "double",
}


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
