import math
import random

import pytest
from pyspark.sql import functions as F

from riskbook.functions import display
from riskbook.functions.common import rounded
from riskbook.functions.energy import energy_band, initial_capital, label_class
from riskbook.functions.flood import flood_rating, heat_weight
from riskbook.functions.grid import _with_airy_radians, with_wgs84
from riskbook.functions.palettes import (
    BER_COLOURS,
    ENVIRONMENT_COLOURS,
    EPC_COLOURS,
    EPC_COLOURS_CLASSIC,
    FLOOD_INDEX_COLOURS,
    FLOOD_INDEX_LABELS,
    FLOOD_SCORE_COLOURS,
    FLOOD_SCORE_LABELS,
    colour_of,
    legend,
    unknown_codes,
)


def column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_energy_band_edges(spark):
    values = [-1.0, 0.0, 100.0, 100.1, 200.0, 300.0, 400.0, 500.0, 500.1, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "kwh double")
    assert column(df, energy_band("kwh")) == [
        "0; <= 100", "0; <= 100", "0; <= 100", "> 100; <= 200", "> 100; <= 200", "> 200; <= 300", "> 300; <= 400",
        "> 400; <= 500", "> 500", "> 500", "> 500",
    ]
    assert column(df, energy_band("kwh", None))[9] is None
    assert column(df, energy_band("kwh", "unknown"))[9] == "unknown"


def test_label_class(spark):
    df = spark.createDataFrame([("A1",), ("A3",), ("G",), ("",), (None,)], "r string")
    assert column(df, label_class("r")) == ["A", "A", "G", "", None]


def test_initial_capital(spark):
    df = spark.createDataFrame(
        [("100", "0.5"), ("100", "0"), ("100", None), (None, "0.5"), ("x", "0.5"), ("100", "n/a"), ("NaN", "1")],
        "loan string, ltv string",
    )
    assert column(df, initial_capital("loan", "ltv")) == [200.0, None, None, None, None, None, None]


def worst_of(a, b):
    """The pairwise rule on plain numbers, with None never larger than anything."""
    return a if a is not None and b is not None and a > b else b


COLOURS = {0: "no-colour"}
COLOURS.update({v: "green" for v in range(1, 11)})
COLOURS.update({v: "amber" for v in range(11, 30)})
COLOURS.update({v: "red" for v in range(30, 46)})
COLOURS.update({v: "black-1" for v in range(46, 61)})
COLOURS.update({v: "black-2" for v in range(61, 101)})


def test_flood_rating_and_heat_weight(spark):
    pairs = [(float(a), float(b)) for a in range(-2, 103, 3) for b in (-1, 0, 10, 29, 30, 45, 46, 60, 61, 100, 101)]
    pairs += [(45.5, 0.0), (0.5, 0.25), (None, 5.0), (5.0, None), (None, None)]
    pairs += [(float("nan"), 7.0), (7.0, float("nan"))]
    df = spark.createDataFrame(pairs, "a double, b double")
    got = df.select("a", "b", flood_rating("a", "b").alias("rating"), heat_weight("a", "b").alias("weight"),
                    heat_weight("a", "b", 1.0).alias("plain")).collect()
    assert len(got) == len(pairs)
    for a, b, rating, weight, plain in got:
        a, b = (None if x is None or math.isnan(x) else x for x in (a, b))
        worst = worst_of(a, b)
        assert rating == COLOURS.get(worst, "purple"), (a, b)
        assert weight == (None if worst is None else round(worst / 100 * 1.40 + 0.001, 4)), (a, b)
        assert plain == (None if worst is None else round(worst / 100 + 0.001, 4)), (a, b)


def test_flood_rating_of_whole_numbers(spark):
    df = spark.createDataFrame([(5, 3), (45, 45), (0, 0), (-1, -1)], "a int, b int")
    assert column(df, flood_rating("a", "b")) == ["green", "red", "no-colour", "purple"]


def test_colours(spark):
    df = spark.createDataFrame([("A",), ("G",), ("Blank",), ("x",), (None,)], "c string")
    assert column(df, colour_of("c", EPC_COLOURS)) == ["#00a54f", "#ee1d23", None, None, "#deebf6"]
    assert column(df, colour_of("c", EPC_COLOURS_CLASSIC)) == ["#007e2e", "#df0024", "#ffffff", None, "#ffffff"]
    assert column(df, colour_of("c", ENVIRONMENT_COLOURS))[4] == "#ffffff"
    assert column(df, colour_of("c", BER_COLOURS)) == [None, "#ee1d23", None, None, None]


def test_unknown_codes(spark):
    df = spark.createDataFrame([("A1",), ("x",), ("x",), (None,)], "c string")
    assert {tuple(r) for r in unknown_codes(df, "c", BER_COLOURS).collect()} == {("x", 2), (None, 1)}


def test_legends(spark):
    rows = legend(spark, FLOOD_INDEX_COLOURS, FLOOD_INDEX_LABELS).orderBy("position").collect()
    assert [r["label"] for r in rows] == list(FLOOD_INDEX_LABELS)
    assert rows[3]["colour"] == "#d92424"
    assert legend(spark, FLOOD_SCORE_COLOURS, FLOOD_SCORE_LABELS).count() == 7
    assert legend(spark, EPC_COLOURS).count() == 8
    with pytest.raises(ValueError):
        legend(spark, FLOOD_SCORE_COLOURS, FLOOD_INDEX_LABELS)


def test_display(spark):
    df = spark.createDataFrame(
        [("a", "b", 0.0425, 0.876543219, 1234.567), ("a", None, None, None, None)],
        "x string, y string, rate double, ltv double, amount double",
    )
    assert column(df, display.address_line(["x", "y"])) == ["a b", None]
    assert column(df, display.address_line(["x", "y"], skip_missing=True)) == ["a b", "a"]
    assert column(df, display.rate_percent("rate")) == [4.25, None]
    assert column(df, display.ltv_whole_percent("ltv")) == [87, None]
    assert column(df, display.ltv_percent("ltv")) == [87.6543, None]
    assert column(df, display.money("amount")) == [1234.57, None]
    text = display.description_line("x", "y", F.lit(1), F.lit(2), F.lit(3), F.lit(4.5), F.lit(5.5))
    assert column(df, text)[1] == (
        "Property_type=a. nan. 1. Easting/Norting=2/3. Latitude/Longitude=4.5/5.5"
    )


@pytest.mark.parametrize("digits", [2, 4])
def test_rounding_is_that_of_the_stored_value(spark, digits):
    rng = random.Random(digits)
    values = [-0.0, -0.001, -2.675, 2.675, 1.005, 0.125, 0.375, -2.5, -0.125, 1234.565, 0.0, 1e300, -1e17, 4503599627370497.5, 8.5e13]
    values += [rng.randrange(-10**9, 10**9) / 10 ** (digits + 1) for _ in range(3000)]
    values += [(rng.randrange(10**6) + 0.5) / 10**digits for _ in range(3000)]
    values += [rng.randrange(10**8) / 2 ** rng.randrange(1, 12) for _ in range(3000)]
    values += [rng.uniform(-1e6, 1e6) for _ in range(3000)] + [rng.uniform(0, 1) ** 9 for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(rounded("v", digits)).collect()]
    assert list(map(repr, got)) == [repr(round(v, digits)) for v in values]
    assert column(spark.createDataFrame([(None,), (float("nan"),)], "v double"), rounded("v", digits)) == [None, None]


def test_grid_matches_published_points(spark):
    df = spark.createDataFrame([("651409.903", "313177.270")], "e string, n string")
    lat, lon = _with_airy_radians(df, "e", "n", "lat", "lon").select(F.degrees("lat"), F.degrees("lon")).first()
    # The survey office's worked example, on the grid's own datum.
    assert lat == pytest.approx(52 + 39 / 60 + 27.2531 / 3600, abs=2e-8)
    assert lon == pytest.approx(1 + 43 / 60 + 4.5177 / 3600, abs=2e-8)
    # The Royal Observatory lies just west of the WGS84 meridian.
    df = spark.createDataFrame([(538890.0, 177320.0), (None, 177320.0)], "e double, n double")
    first, second = with_wgs84(df, "e", "n").collect()
    assert first["latitude"] == pytest.approx(51.477796, abs=1e-5)
    assert first["longitude"] == pytest.approx(-0.001402, abs=1e-5)
    assert second["longitude"] is None
    placed = with_wgs84(df, "e", "n")
    assert placed.columns == ["e", "n", "latitude", "longitude"]
    # Filters and groupings on the position stay above the conversion.
    near = placed.where((F.col("latitude") > 51) & F.col("longitude").between(-1, 0))
    assert near.groupBy(F.floor("latitude")).count().collect()[0]["count"] == 1
    assert len(near._jdf.queryExecution().optimizedPlan().toString()) < 20_000


def test_grid_inverts_forward_projection(spark):
    """Project known positions forward with the textbook series and convert them back."""
    from riskbook.functions import grid as g

    points = [(math.radians(lat), math.radians(lon)) for lat in (50.1, 52.5, 55.9, 58.6) for lon in (-6.0, -2.0, 1.5)]
    rows = []
    for lat, lon in points:
        n = (g.AIRY_A - g.AIRY_B) / (g.AIRY_A + g.AIRY_B)
        d, t = lat - g.ORIGIN_LAT, lat + g.ORIGIN_LAT
        arc = g.AIRY_B * g.SCALE * (
            (1 + n + 5 / 4 * n**2 + 5 / 4 * n**3) * d
            - (3 * n + 3 * n**2 + 21 / 8 * n**3) * math.sin(d) * math.cos(t)
            + (15 / 8 * n**2 + 15 / 8 * n**3) * math.sin(2 * d) * math.cos(2 * t)
            - 35 / 24 * n**3 * math.sin(3 * d) * math.cos(3 * t)
        )
        s, c, tan2 = math.sin(lat), math.cos(lat), math.tan(lat) ** 2
        nu = g.AIRY_A * g.SCALE / math.sqrt(1 - g.AIRY_E2 * s * s)
        eta2 = nu / (nu * (1 - g.AIRY_E2) / (1 - g.AIRY_E2 * s * s)) - 1
        dl = lon - g.ORIGIN_LON
        north = arc + g.ORIGIN_NORTHING + nu / 2 * s * c * dl**2 + nu / 24 * s * c**3 * (5 - tan2 + 9 * eta2) * dl**4 \
            + nu / 720 * s * c**5 * (61 - 58 * tan2 + tan2**2) * dl**6
        east = g.ORIGIN_EASTING + nu * c * dl + nu / 6 * c**3 * (nu / (nu / (1 + eta2)) - tan2) * dl**3 \
            + nu / 120 * c**5 * (5 - 18 * tan2 + tan2**2 + 14 * eta2 - 58 * tan2 * eta2) * dl**5
        rows.append((east, north, lat, lon))
    df = spark.createDataFrame(rows, "e double, n double, want_lat double, want_lon double")
    for r in _with_airy_radians(df, "e", "n", "lat", "lon").collect():
        assert r["lat"] == pytest.approx(r["want_lat"], abs=1e-9)
        assert r["lon"] == pytest.approx(r["want_lon"], abs=1e-9)
