import random
from collections import Counter

import pytest

from riskbook.operators import merges
from riskbook.operators.skew import _spread, hot_keys, hot_keys_of, skew_join


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def brute_join(left, right, how):
    """Nested-loop join of (key, x) and (key, y) lists."""
    out = []
    for key, x in left:
        matches = [y for k, y in right if key is not None and k == key]
        if how == "left_semi":
            out += [(key, x)] if matches else []
        elif how == "left_anti":
            out += [] if matches else [(key, x)]
        elif matches:
            out += [(key, x, y) for y in matches]
        elif how == "left":
            out.append((key, x, None))
    return Counter(out)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    left = [(rng.choice([1, 1, 1, 2, 3, 4, None]), i) for i in range(300)]
    right = [(rng.choice([2, 2, 2, 1, 5, 6, None]), i) for i in range(60)]
    return (
        left,
        right,
        spark.createDataFrame(left, "k long, x int").repartition(4),
        spark.createDataFrame(right, "rk long, y int").repartition(3),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_left,hot_right", [
    ({}, {}), ({1: 900}, {}), ({}, {2: 400}), ({1: 900}, {2: 400}), ({1: 300, 2: 100}, {2: 400, 6: 100}),
    ({9: 500}, {5: 200}), ({None: 800, 1: 200}, {None: 300, 2: 100}),
])
def test_skew_join_equals_plain_join(skewed, how, hot_left, hot_right):
    left, right, ldf, rdf = skewed
    joined = skew_join(ldf, rdf, "k", "rk", how, hot_left, hot_right, rows_per_piece=100)
    assert joined.columns == ["k", "x", "y"]
    assert rows(joined) == brute_join(left, right, how)


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_skew_join_filters(skewed, how):
    left, right, ldf, rdf = skewed
    for hot in ({}, {1: 900, 4: 200}, {None: 500, 2: 300}):
        assert rows(skew_join(ldf, rdf, "k", "rk", how, hot, rows_per_piece=100)) == brute_join(left, right, how)
    with pytest.raises(ValueError):
        skew_join(ldf, rdf, "k", "rk", how, hot_right={2: 5})
    with pytest.raises(ValueError):
        skew_join(ldf, rdf, "k", "rk", "full")


def test_skew_join_spreads_identical_rows(spark):
    """A third of the rows are copies of one row; salting sends them to more than one salt."""
    left = spark.createDataFrame([(1, "same")] * 100 + [(i, "x") for i in range(2, 200)], "k int, t string")
    right = spark.createDataFrame([(i, i * 10) for i in range(1, 200)], "rk int, v int")
    joined = skew_join(left.repartition(8), right, "k", "rk", "inner", hot_left={1: 100}, rows_per_piece=25)
    assert joined.count() == 298
    pieces = _spread(left.repartition(8), "k", {1: 100}, {}, 25, "piece").where("k = 1")
    assert pieces.select("piece").distinct().count() == 4


def test_skew_join_with_many_hot_keys(spark):
    left = spark.range(2000).selectExpr("id % 250 AS k", "id AS x")
    right = spark.range(300).selectExpr("id AS rk", "id * 2 AS y")
    hot_left, hot_right = {k: 10 for k in range(200)}, {k: 7 for k in range(150, 300)}
    joined = skew_join(left, right, "k", "rk", "left", hot_left, hot_right, rows_per_piece=3)
    assert joined.count() == 2000 and joined.where("y <> k * 2 OR y IS NULL").count() == 0


def test_hot_keys(spark):
    data = [(1, "a")] * 50 + [(i, "b") for i in range(100, 150)] + [(None, None)] * 100
    df = spark.createDataFrame(data, "k int, s string")
    assert hot_keys(df, "k", share=0.2) == {1: 50, None: 100}
    found = hot_keys_of(df, ["k", "s"], share=0.2)
    assert found == {"k": {1: 50, None: 100}, "s": {"a": 50, "b": 50, None: 100}}
    assert hot_keys(df.limit(0), "k") == {}
    assert hot_keys(df.where("k IS NULL"), "k") == {None: 100}


def test_skew_join_of_rows_with_nested_maps(spark):
    left = spark.range(100).selectExpr("id % 2 AS k", "named_struct('m', map('a', id)) AS s", "array(map(1, id)) AS a")
    right = spark.createDataFrame([(0, "x"), (1, "y")], "rk long, v string")
    assert skew_join(left, right, "k", "rk", "inner", hot_left={1: 50}, rows_per_piece=10).count() == 100


def frames(spark):
    properties = spark.createDataFrame(
        [
            (1, 10, "one"), (2, 10, "two"), (3, 20, "three"), (4, 99, "no flood"), (5, 10, "no rating"),
            (6, None, "nowhere"),
        ],
        "ecad_id int, building_id int, address_line_1 string",
    )
    energy = spark.createDataFrame(
        [(1, "A1"), (2, None), (3, "G"), (4, "B2"), (6, "C1"), (77, "D1")], "ecad_id int, ber_rating string"
    )
    flood = spark.createDataFrame([(10, 5), (20, 7), (1, 100)], "ecad_id int, floodscore_ud int")
    loans = spark.createDataFrame(
        [(1, 500, 100.0), (1, 501, 50.0), (3, 502, 70.0), (88, 503, 10.0)],
        "ecad_id int, Asset_id int, Initial_Borrow_Capital double",
    )
    return properties, energy, flood, loans


@pytest.mark.parametrize("salted", [False, True])
def test_merge_property_risk_uses_the_building_for_flood(spark, salted):
    properties, energy, flood, loans = frames(spark)
    merged = merges.merge_property_risk(properties, energy, flood, salted=salted)
    assert merged.columns == ["ecad_id", "building_id", "address_line_1", "ber_rating", "floodscore_ud"]
    assert rows(merged) == Counter([(1, 10, "one", "A1", 5), (2, 10, "two", None, 5), (3, 20, "three", "G", 7)])

    with_loans = merges.merge_property_risk(properties, energy, flood, loans, salted=salted)
    assert rows(with_loans.select("ecad_id", "Asset_id", "floodscore_ud")) == Counter(
        [(1, 500, 5), (1, 501, 5), (3, 502, 7)]
    )


@pytest.mark.parametrize("salted", [False, True])
def test_enrich_keeps_every_property(spark, salted):
    properties, energy, flood, loans = frames(spark)
    merged = merges.merge_property_risk(properties, energy, flood)
    book = merges.enrich_loan_book(merged, loans, salted=salted)
    assert rows(book.select("ecad_id", "Asset_id")) == Counter([(1, 500), (1, 501), (2, None), (3, 502)])
    left_out = merges.unmatched_loans(loans, merged, salted=salted)
    assert rows(left_out.select("ecad_id", "Asset_id")) == Counter([(88, 503)])


@pytest.mark.parametrize("salted", [False, True])
def test_merge_portfolio(spark, salted):
    portfolio = spark.createDataFrame(
        [("1", "100", "e1"), ("2", "100", "e2"), ("3", "300", "e3"), ("3", "300", "e4")],
        "id string, uprn string, easting string",
    )
    scores = spark.createDataFrame([("1", "x", 5), ("1", "y", 6), ("3", "z", 7)], "id string, uprn string, score int")
    latlong = spark.createDataFrame(
        [("1", "x", "no", "no", 51.0), ("2", "x", "no", "no", 52.0)],
        "ID string, UPRN string, EASTING string, NORTHING string, LATITUDE double",
    )
    tables = (portfolio, scores, merges.lower_columns(latlong))
    left = merges.merge_portfolio(*tables, how="left", salted=salted)
    assert left.columns == ["id", "uprn", "easting", "score", "latitude"]
    assert rows(left) == Counter([
        ("1", "100", "e1", 5, 51.0), ("1", "100", "e1", 6, 51.0), ("2", "100", "e2", None, 52.0),
        ("3", "300", "e3", 7, None), ("3", "300", "e4", 7, None),
    ])
    inner = merges.merge_portfolio(*tables, how="inner", salted=salted)
    assert inner.columns == ["id", "uprn", "easting", "latitude", "score"]
    assert rows(inner) == Counter([("1", "100", "e1", 51.0, 5), ("1", "100", "e1", 51.0, 6)])


def test_join_rejects_columns_on_both_sides(spark):
    a = spark.createDataFrame([(1, 2)], "id int, v int")
    with pytest.raises(ValueError, match="both sides"):
        merges.join_keep_left(a, a, "id", "id")


def test_lower_columns_rejects_collisions(spark):
    assert merges.lower_columns(spark.createDataFrame([(1, 2)], "ID int, Uprn int")).columns == ["id", "uprn"]
    with pytest.raises(ValueError, match="case"):
        merges.lower_columns(spark.createDataFrame([(1, 2)], ["ID", "id"]))


def test_with_key(spark):
    df = spark.createDataFrame([("1", "a"), (None, "b"), ("3", None)], "id string, uprn string")
    assert merges.with_key(df, "id").count() == 2
    assert merges.with_key(df, "id", "uprn").count() == 1
