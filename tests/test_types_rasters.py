"""Types found by counting, clusters and heat over zooms, GeoJSON documents cut in blocks."""

import json
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riskbook.operators import councils, layers
from riskbook.plans.portfolio_jobs import portfolio_merge_job
from riskbook.sources import boundaries, readers, types
from riskbook.sources.publish import read_published


@pytest.mark.parametrize(
    "values,kind",
    [
        (["1", " 7", "007", "-3"], "bigint"),
        (["67.0", "7"], "double"),
        (["1e3", "7"], "double"),
        ([".5", "-2.", "+1"], "double"),
        (["9" * 19], "decimal(38,0)"),
        (["9" * 39], "string"),
        (["true", "False"], "boolean"),
        (["true", "1"], "string"),
        (["1", "one"], "string"),
        (["1", ""], "string"),
        (["0x1F"], "string"),
        (["1d"], "string"),
        (["NaN"], "string"),
        (["Infinity"], "string"),
        ([None, None], "string"),
        ([], "string"),
        (["1", None], "bigint"),
    ],
)
def test_types(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "`a.b` string")
    assert types.found_types(df) == {"a.b": kind}
    typed = types.as_types(df, {"a.b": kind})
    assert typed.where("`a.b` is null").count() == sum(v is None for v in values)


def test_counts_of_files_add_up(spark):
    files = [["1", "2"], ["3.0", None], ["x", "4.25", "true"]]
    frames = [spark.createDataFrame([(v,) for v in f], "id string") for f in files]
    together = spark.createDataFrame([(v,) for f in files for v in f], "id string")
    for n in (1, 2, 3):
        counts = types.form_counts(frames[0])
        for frame in frames[1:n]:
            counts = counts.union(types.form_counts(frame))
        rows = [v for f in files[:n] for v in f]
        whole = together if n == 3 else spark.createDataFrame([(v,) for v in rows], "id string")
        assert types.summed_counts(counts).collect() == types.form_counts(whole).collect()
    assert types.with_types(types.form_counts(spark.range(3))).count() == 0


def test_inferred_csv_is_parsed_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,ok,share\n67.0,x,true,1\n007,,FALSE,\n 7,NA,true,2.5\n1e3,4,false,3\n")
    got = readers.land_inferred_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "staged"))
    assert dict(got.dtypes) == {"id": "double", "name": "string", "ok": "boolean", "share": "double"}
    assert [r["id"] for r in got.collect()] == [67.0, 7.0, 7.0, 1000.0]
    assert "Scan csv" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "portfolio,scores,places,want",
    [
        (["67", "007", "8"], ["67.0", "7", "8"], ["67", "7", "8"], ["007", "67", "8"]),
        (["67", " 7", "1000", "x"], ["67.0", "7", "1e3"], ["67", "007", "1000.00"], [" 7", "1000", "67"]),
        (["6.5", "7"], ["6.50", "7"], ["6.5", "7"], ["6.5", "7"]),
        (["12345678901234567", "12345678901234568"], ["12345678901234568", "6.5"], ["12345678901234568"], ["12345678901234568"]),
        (["007", "7"], ["7", "a"], ["7"], ["7"]),
    ],
)
def test_ids_meet_as_the_type_found(spark, tmp_path, portfolio, scores, places, want):
    def file(name, columns, rows):
        (tmp_path / name).write_text("\n".join([columns, *rows]) + "\n")
        return str(tmp_path / name)

    files = [
        file("p.csv", "ID,UPRN,EASTING,NORTHING", [f"{i},1,2,3" for i in portfolio]),
        file("s.csv", "ID,UPRN,CURRENTLOAN", [f"{i},1,5" for i in scores]),
        file("l.csv", "ID,UPRN,EASTING,NORTHING,LATITUDE,LONGITUDE", [f"{i},1,2,3,51,-2" for i in places]),
    ]
    portfolio_merge_job(spark, *files, f"{tmp_path}/merged", f"{tmp_path}/staged", "20230427")
    got = read_published(spark, f"{tmp_path}/merged/parquet").select("id").collect()
    assert sorted(r["id"] for r in got) == want


# Clusters and heat


def points(spark, n=400):
    rng = random.Random(5)
    rows = [(rng.uniform(-80, 80), rng.uniform(-180, 180), rng.choice([None, 1.0, 2.5])) for _ in range(n)]
    rows += [(None, 1.0, 1.0), (1.0, None, 1.0), (float("nan"), 1.0, 1.0), (51.5, -2.5, 3.0), (51.5, -2.5, 3.0), (0.0, 0.0, None)]
    return spark.createDataFrame(rows, "latitude double, longitude double, weight double")


def test_pyramid_is_every_zoom(spark):
    df = points(spark)
    got = defaultdict(set)
    for r in councils.cluster_pyramid(df, 9, 2).collect():
        got[r["zoom"]].add((r["cell_y"], r["cell_x"], r["count"], round(r["lat"], 9), round(r["lon"], 9)))
    assert sorted(got) == list(range(2, 10))
    good = df.where("latitude is not null and longitude is not null and not isnan(latitude)")
    for zoom, cells in got.items():
        want = councils.grid_clusters(good, zoom).collect()
        assert cells == {(r[0], r[1], r[2], round(r[3], 9), round(r[4], 9)) for r in want}
    assert councils.cluster_pyramid(df.limit(0)).count() == 0


def test_pyramid_moves_points_once(spark):
    plan = councils.cluster_pyramid(points(spark))._jdf.queryExecution().executedPlan().toString()
    # One exchange of cells of points, one of cells of zooms.
    assert plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("radius", [0, 1, 3])
def test_raster_is_the_kernel_sum(spark, radius):
    df = points(spark)
    step = 360 / 2**7
    want = defaultdict(float)
    for lat, lon, w in df.collect():
        if lat is None or lon is None or math.isnan(lat) or w is None:
            continue
        y, x = math.floor(lat / step), math.floor(lon / step)
        for dy in range(-radius, radius + 1):
            for dx in range(-radius, radius + 1):
                share = math.comb(2 * radius, dy + radius) * math.comb(2 * radius, dx + radius) / 16**radius
                want[y + dy, x + dx] += w * share
    got = layers.heat_raster(df, "latitude", "longitude", zoom=7, radius=radius).collect()
    assert {(r["cell_y"], r["cell_x"]): pytest.approx(r["intensity"]) for r in got} == want
    total = df.where("latitude is not null and longitude is not null and not isnan(latitude)").agg(F.sum("weight")).first()[0]
    assert sum(r["intensity"] for r in got) == pytest.approx(total)
    assert all(r["lat"] == (r["cell_y"] + 0.5) * step for r in got)


# GeoJSON documents

NASTY = ["}", "{", '"', "\\", '\\"', '"Feature"', '},{"type":"Feature","properties":{', "]}", "\n", "é\U0001f600", "\\\\", "{{{", ""]


def document(rng, n, more):
    features = []
    for i in range(n):
        name = "".join(rng.choice(NASTY) for _ in range(rng.randrange(6)))
        deep = {"{" + name: [{"x}": name}, {"type": "Feature"}]}
        shape = None if rng.random() < 0.1 else {"type": "Polygon", "coordinates": [[[i, 1.5]] * rng.randrange(1, 40)]}
        features.append({"type": "Feature", "properties": {"LAD13CD": str(i), "LAD13NM": name, "deep": deep}, "geometry": shape})
    head = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "a{b}"}}} if more else {"type": "FeatureCollection"}
    return {**head, "features": features, **({"bbox": {"low": {"x": 1}}} if more else {})}


@pytest.mark.parametrize("block", ["64", "1000", "128m"])
@pytest.mark.parametrize("indent", [None, 2])
def test_features_come_out_whole(spark, tmp_path, block, indent):
    """Documents cut in blocks of a few bytes, inside strings and escapes."""
    rng = random.Random(3)
    made = [document(rng, n, n % 2) for n in (0, 1, 12, 5)]
    for k, doc in enumerate(made):
        text = json.dumps(doc, indent=indent, ensure_ascii=bool(k % 2))
        (tmp_path / f"{k}.json").write_text(text + "\n" * k)
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        texts = boundaries.split_features(spark, str(tmp_path))
        got = [json.loads(r["value"]) for r in texts.collect()]
        rows = boundaries.read_boundaries(spark, str(tmp_path)).collect()
        tasks = boundaries._pieces(spark, str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = Counter(json.dumps(f, sort_keys=True) for doc in made for f in doc["features"])
    assert Counter(json.dumps(f, sort_keys=True) for f in got) == want
    assert Counter((r["LAD13CD"], r["LAD13NM"]) for r in rows) == Counter(
        (f["properties"]["LAD13CD"], f["properties"]["LAD13NM"]) for doc in made for f in doc["features"]
    )
    assert tasks > 20 if block == "64" else tasks >= 1
