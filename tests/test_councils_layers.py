import json
from collections import Counter

import pytest

from riskbook.functions.details import RETURN_PERIODS, return_period_profile
from riskbook.functions.palettes import EPC_COLOURS
from riskbook.operators import councils, layers
from riskbook.sources import schemas
from riskbook.sources.boundaries import read_boundaries, write_boundaries


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def portfolio(spark):
    data = [
        (1, "Camden", "E1", "c1", "House", 51.0, -0.1),
        (2, "Camden", "E1", "c2", "House", 51.2, -0.3),
        (3, "Camden", "E1", "c2", "Flat", 51.4, -0.2),
        (4, "Wiltshire", "E2", "c3", "Castle", 51.3, -2.0),
        (5, "Leeds", "E9", "c4", "Bungalow", 53.8, -1.5),
        (6, None, None, None, "House", None, None),
        (7, "Camden", "E1", "c1", None, 51.0, -0.1),
    ]
    return spark.createDataFrame(
        data,
        "uprn int, local_authority_label string, local_authority string, constituency string, property_type string, "
        "latitude double, longitude double",
    )


@pytest.fixture(scope="module")
def boundary_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("boundaries") / "lad.json"
    shapes = [("E1", "Camden"), ("E2", "Wiltshire"), ("E3", "Tower Hamlets")]
    features = [
        {"type": "Feature", "properties": {"LAD13CD": code, "LAD13NM": name, "size": 3},
         "geometry": {"type": "Polygon", "coordinates": [[[0.5, 1], [2, 3]]]}}
        for code, name in shapes
    ]
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=2))
    return str(path)


def test_boundary_counts(spark, portfolio, boundary_file, tmp_path):
    boundaries = read_boundaries(spark, boundary_file)
    counts = councils.boundary_property_counts(boundaries, portfolio)
    assert rows(counts.drop("geometry", "properties")) == Counter([
        ("E1", "Camden", 2, 1, 0, 0), ("E2", "Wiltshire", 0, 0, 0, 0), ("E3", "Tower Hamlets", 0, 0, 0, 0),
    ])
    out = str(tmp_path / "out")
    write_boundaries(counts, out)
    back = read_boundaries(spark, out, ("LAD13CD", "House", "Flat"), by_line=True).orderBy("LAD13CD").collect()
    counted = [(r["LAD13CD"], r["House"], r["Flat"]) for r in back]
    assert counted == [("E1", "2", "1"), ("E2", "0", "0"), ("E3", "0", "0")]
    # All given properties are still there, with their types, and the counts beside them.
    assert json.loads(back[0]["properties"]) == {
        "LAD13CD": "E1", "LAD13NM": "Camden", "size": 3, "House": 2, "Flat": 1, "Bungalow": 0, "Maisonette": 0,
    }
    assert json.loads(back[0]["geometry"]) == {"type": "Polygon", "coordinates": [[[0.5, 1], [2, 3]]]}


def test_council_and_choropleth_counts(spark, portfolio, boundary_file):
    assert rows(councils.council_counts(portfolio)) == Counter([
        ("Camden", "E1", "c1", 2), ("Camden", "E1", "c2", 2), ("Wiltshire", "E2", "c3", 1), ("Leeds", "E9", "c4", 1),
    ])
    boundaries = read_boundaries(spark, boundary_file).drop("geometry", "properties")
    assert rows(councils.choropleth_counts(boundaries, portfolio)) == Counter([
        ("E1", "Camden", 4), ("E2", "Wiltshire", 1), ("E3", "Tower Hamlets", None),
    ])


def test_clusters(portfolio):
    got = {r[0]: r for r in councils.county_clusters(portfolio).collect()}
    assert set(got) == {"Camden", "Wiltshire"} and got["Camden"]["count"] == 4
    assert got["Camden"]["lat"] == pytest.approx(51.15)
    cells = councils.grid_clusters(portfolio, zoom=9)
    assert cells.agg({"count": "sum"}).first()[0] == 6
    assert {(r["cell_y"], r["cell_x"]) for r in cells.collect() if r["count"] == 1} >= {(76, -3)}


def test_point_layers(spark, portfolio):
    point = ("uprn", "latitude", "longitude")
    types = layers.type_layer(portfolio, *point)
    assert rows(types.select("id", "layer")) == Counter(
        [(1, "House"), (2, "House"), (3, "Flat"), (5, "Bungalow"), (6, "House")]
    )
    assert rows(layers.council_layer(portfolio, *point).select("id", "layer")) == Counter(
        [(1, "Camden"), (2, "Camden"), (3, "Camden"), (7, "Camden"), (4, "Wiltshire")]
    )
    assert layers.index_layer(portfolio, *point).columns == ["id", "lat", "lon", "label"]
    scored = spark.createDataFrame(
        [(1, 51.0, -1.0, 10, 30, "A", None), (2, 52.0, -1.0, -1, -1, None, "B")],
        "uprn int, latitude double, longitude double, combinedscore int, combinedscore_adj int, "
        "current_environmental_rating string, potential_environmental_rating string",
    )
    flood = layers.flood_layer(scored, *point, mode="score")
    assert rows(flood.select("id", "label", "colour")) == Counter([(1, "red", "#d92424"), (2, "purple", "#9370db")])
    heat = layers.heat_layer(scored, "latitude", "longitude")
    assert rows(heat) == Counter([(51.0, -1.0, 0.421), (52.0, -1.0, -0.013)])
    environment = layers.environment_layer(scored, *point)
    assert rows(environment.select("id", "border_colour", "fill_colour")) == Counter(
        [(1, "#cde2f5", "#ffffff"), (2, "#ffffff", "#97c0e6")]
    )
    energy = layers.energy_layer(scored, *point, "current_environmental_rating", EPC_COLOURS)
    assert rows(energy.select("id", "colour")) == Counter([(1, "#00a54f"), (2, "#deebf6")])


def test_return_periods(spark):
    names = [f.name for f in schemas.FLOOD_INDEX.fields]
    row = {n: None for n in names} | {"ecad_id": 1, "rmax20": 1.5, "r20matrix": 3, "sw1000matrix": 9}
    df = spark.createDataFrame([tuple(row[n] for n in names)], schemas.FLOOD_INDEX)
    got = [tuple(r) for r in return_period_profile(df, ["ecad_id"]).collect()]
    assert len(got) == len(RETURN_PERIODS) == 12
    assert got[0] == (1, "river", 20, 1.5, 3) and got[-1] == (1, "surface_water", 1000, None, 9)
