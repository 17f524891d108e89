import random
import statistics
from collections import Counter

import numpy as np
import pytest

from riskbook.operators import quality
from riskbook.operators.profile import profile
from riskbook.sources.readers import union_files


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def portfolio(spark):
    data = [("1", "u1"), ("2", "u1"), ("3", "u2"), ("3", "u2"), ("4", None), ("5", None), ("6", "u3"), (None, "u3")]
    return spark.createDataFrame(data, "id string, uprn string")


def test_duplicate_keys(portfolio):
    got = [tuple(r) for r in quality.duplicate_keys(portfolio, ["uprn"]).collect()]
    assert got == [(None, 2), ("u1", 2), ("u2", 2), ("u3", 2)]
    assert rows(quality.duplicate_keys(portfolio, ["id"])) == Counter([("3", 2)])
    assert rows(quality.duplicate_keys(portfolio, ["id", "uprn"])) == Counter([("3", "u2", 2)])


def test_duplicate_report_equals_single_reports(portfolio):
    report = quality.duplicate_report(portfolio)
    for kind, keys in (("id+uprn", ["id", "uprn"]), ("id", ["id"]), ("uprn", ["uprn"])):
        got = rows(report.where(report["key"] == kind).select(*keys, "count"))
        assert got == rows(quality.duplicate_keys(portfolio, keys))


@pytest.mark.parametrize("salted", [False, True])
def test_duplicate_members(spark, portfolio, salted):
    got = rows(quality.duplicate_members(portfolio, salted=salted))
    assert got == Counter([
        ("u1", 2, "1"), ("u1", 2, "2"), ("u2", 2, "3"), ("u2", 2, "3"), ("u3", 2, "6"), ("u3", 2, None),
        (None, 2, None),
    ])
    listing = spark.createDataFrame([("9", "u1")], "id string, uprn string")
    listed = rows(quality.duplicate_members(portfolio, members_of=listing, salted=salted))
    assert listed == Counter([("u1", 2, "9"), ("u2", 2, None), ("u3", 2, None), (None, 2, None)])


@pytest.mark.parametrize("salted", [False, True])
def test_rows_with_min_group_matches_duplicates(portfolio, salted):
    got = quality.rows_with_min_group(portfolio, "uprn", 2, salted=salted)
    assert got.columns == ["id", "uprn"]
    assert rows(got) == Counter([("1", "u1"), ("2", "u1"), ("3", "u2"), ("3", "u2"), ("6", "u3"), (None, "u3")])
    keys = {r["uprn"] for r in quality.duplicate_keys(portfolio, ["uprn"]).collect()} - {None}
    assert {r["uprn"] for r in got.collect()} == keys
    assert quality.rows_with_min_group(portfolio, "uprn", 3).count() == 0


def test_category_counts(spark):
    df = spark.createDataFrame(
        [("House", "1950"), ("House", None), ("Flat", None), (None, "1950")], "property_type string, age string"
    )
    assert rows(quality.category_counts(df, "property_type")) == Counter([("House", 2), ("Flat", 1)])
    assert rows(quality.category_counts(df, "property_type", "age")) == Counter([("House", 1), ("Flat", 0)])
    pairs = [("property_type", "age"), ("age", "age")]
    assert rows(quality.all_category_counts(df, pairs)) == Counter([
        ("property_type", "age", "House", 1), ("property_type", "age", "Flat", 0), ("age", "age", "1950", 2),
    ])


def test_distinct_values_keep_the_missing_one(spark):
    df = spark.createDataFrame([("A", 1), ("A", None), (None, 1)], "r string, s int")
    assert rows(quality.distinct_values(df, ["r", "s"])) == Counter([("r", "A"), ("r", None), ("s", "1"), ("s", None)])


def test_previews_and_lookup(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(50)], "id int, g int")
    assert [r["id"] for r in quality.first_rows(df, ["id"], 3).collect()] == [0, 1, 2]
    assert [r["id"] for r in quality.last_rows(df, ["id"], 3).collect()] == [49, 48, 47]
    assert quality.lookup_properties(df, "id", [3, 4, 4, 99]).count() == 2
    assert quality.lookup_properties(df, "id", list(range(40, 2040))).count() == 10
    wanted = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert quality.lookup_properties(df, "id", wanted).count() == 1
    for salted in (False, True):
        assert quality.lookup_properties(df, "g", wanted, salted=salted).count() == 17


def test_counts(spark):
    df = spark.range(10)
    seen_df, seen = quality.counted(df, "ten")
    seen_df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 10
    assert rows(quality.row_counts({"all": df, "none": df.limit(0)})) == Counter([("all", 10), ("none", 0)])


def test_union_files(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    assert rows(union_files([a, b]).select("id", "a", "b")) == Counter([(1, "x", None), (2, None, "y")])


def heavy_values():
    rng = random.Random(3)
    values = [rng.lognormvariate(0, 6) * rng.choice([-1, 1]) for _ in range(700)]
    values += [0.0] * 50 + [1e300, -1e300, 5e-324, 1e-200, 2e-200, float("inf")]
    return values + [values[0]] * 400


@pytest.mark.parametrize("values", [
    heavy_values(),
    [float(v) for v in range(101)],
    [7.0],
    [7.0] * 40,
    [1.0, 2.0],
    [1.0, 1.0000000000000002, 1.0000000000000004, 1.0000000000000007],
    [-3.5, -3.5, -1e-9, 0.0, 1e-9],
], ids=["heavy", "even", "one", "same", "two", "close", "signs"])
def test_quartiles_match_numpy(spark, values):
    data = [(v,) for v in values] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(data, "v double").repartition(4)
    want = np.percentile(np.array(values), [25, 50, 75])
    row = profile(df, ["v"]).first()
    assert row["count"] == len(values)
    assert (row["min"], row["max"]) == (min(values), max(values))
    assert [row["p25"], row["p50"], row["p75"]] == pytest.approx(list(want), rel=1e-12)


def test_profile_moments_and_several_columns(spark):
    data = [(float(i % 17), str(i), None) for i in range(500)]
    df = spark.createDataFrame(data, "a double, b string, c double")
    got = {r["column"]: r for r in profile(df, ["a", "b", "c"]).collect()}
    assert got["a"]["std"] == pytest.approx(statistics.stdev(x[0] for x in data))
    assert got["b"]["mean"] == pytest.approx(249.5)
    assert got["b"]["p25"] == pytest.approx(np.percentile(range(500), 25))
    assert got["c"]["count"] == 0 and got["c"]["p50"] is None and got["c"]["mean"] is None


def test_profile_scans(spark, monkeypatch):
    """One scan for moments and sketches, one that counts around the quartiles; a sketch that is off costs more."""
    from riskbook.operators import profile as module

    scans = []
    locate = module._locate

    def counted(bins, *more):
        scans.append(bins._jdf.queryExecution().executedPlan().toString().count("Range ("))
        return locate(bins, *more)

    monkeypatch.setattr(module, "_locate", counted)
    df = spark.range(100_000).selectExpr("CAST(id * 7919 % 100003 AS double) AS v")
    assert module.profile(df, ["v"]).first()["p50"] == pytest.approx(
        np.percentile([i * 7919 % 100003 for i in range(100_000)], 50)
    )
    assert len(scans) <= 2 and set(scans) == {1}
    monkeypatch.setattr(module, "SKETCH_MARGIN", -0.2)
    assert module.profile(df, ["v"]).first()["p25"] == pytest.approx(
        np.percentile([i * 7919 % 100003 for i in range(100_000)], 25)
    )
