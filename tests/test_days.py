"""Tables stored by key, complete runs, ledgers, and states that add up over days."""

import math
import random
import statistics
import uuid

import pytest
from pyspark.sql import functions as F

from riskbook.operators.merges import enrich_loan_book
from riskbook.operators.pair_state import keep_pair_counts, pair_changes
from riskbook.operators.profile_state import RANK_ERROR, merged_states, profile_of_states, profile_state
from riskbook.operators.quality import duplicates_of_pairs, pair_counts
from riskbook.plans.portfolio_jobs import portfolio_merge_job
from riskbook.sources.keyed import publish_by_key, read_by_key
from riskbook.sources.ledger import Ledger
from riskbook.sources.publish import publish, read_days, read_published
from riskbook.sources.runs import complete_run, newest_run, read_complete, unnamed_runs

DAY, NEXT = "20230427", "20230428"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def keyed_table(spark, base, n=2000, buckets=8, day=DAY):
    df = spark.range(n).selectExpr("if(id % 50 = 0, NULL, id % 400) AS ecad_id", "id AS valuation")
    publish_by_key(df, base, day, "ecad_id", buckets)
    return df


def test_loan_join_leaves_the_stored_side_where_it_is(spark, tmp_path, no_broadcast):
    keyed_table(spark, str(tmp_path))
    loans = spark.range(900).selectExpr("id AS ecad_id", "id * 3 AS amount")
    joined = enrich_loan_book(read_by_key(spark, str(tmp_path), "ecad_id"), loans)
    assert plan(joined).count("Exchange") == 1, plan(joined)


def test_counts_of_a_stored_day_are_not_shuffled(spark, tmp_path):
    df = keyed_table(spark, str(tmp_path))
    stored = read_by_key(spark, str(tmp_path), "ecad_id")
    counts = stored.groupBy("ecad_id").agg(F.count("*").alias("n"))
    assert "Exchange" not in plan(counts)
    assert rows(counts) == rows(df.groupBy("ecad_id").agg(F.count("*").alias("n")))


def test_stored_rows_come_back_whole(spark, tmp_path):
    df = keyed_table(spark, str(tmp_path))
    assert rows(read_by_key(spark, str(tmp_path), "ecad_id")) == rows(df)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("riskbook_")]


def test_a_crowded_key_stays_whole(spark, tmp_path):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 7, id) AS ecad_id", "repeat('x', 50) AS text")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        publish_by_key(df, str(tmp_path), DAY, "ecad_id", 4)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    counts = read_by_key(spark, str(tmp_path), "ecad_id").groupBy("ecad_id").count()
    assert "Exchange" not in plan(counts)
    assert rows(counts) == rows(df.groupBy("ecad_id").count())


def test_another_number_of_buckets_replaces_the_day(spark, tmp_path):
    keyed_table(spark, str(tmp_path), buckets=4)
    keyed_table(spark, str(tmp_path), n=300, buckets=8)
    keyed_table(spark, str(tmp_path), n=10, buckets=4, day=NEXT)
    assert read_by_key(spark, str(tmp_path), "ecad_id", DAY).count() == 300
    assert read_by_key(spark, str(tmp_path), "ecad_id").count() == 10
    with pytest.raises(FileNotFoundError):
        read_by_key(spark, str(tmp_path), "ecad_id", "20200101")


def test_an_empty_table_can_be_stored_by_key(spark, tmp_path):
    keyed_table(spark, str(tmp_path), n=0)
    stored = read_by_key(spark, str(tmp_path), "ecad_id")
    assert stored.columns == ["ecad_id", "valuation"] and stored.count() == 0


def test_a_stopped_run_leaves_the_earlier_day(spark, tmp_path):
    base = str(tmp_path)
    with complete_run(spark, base, DAY) as run:
        publish(spark.range(3), f"{run}/a", DAY)
        publish(spark.range(4), f"{run}/deep/b", DAY)
    for day in (DAY, NEXT):
        with pytest.raises(ZeroDivisionError), complete_run(spark, base, day) as run:
            publish(spark.range(99), f"{run}/a", day)
            1 / 0
    assert newest_run(spark, base).run_date == DAY
    assert newest_run(spark, base).tables == ("a", "deep/b")
    assert (read_complete(spark, base, "a").count(), read_complete(spark, base, "deep/b").count()) == (3, 4)
    assert len(unnamed_runs(spark, base, DAY)) == 1 and len(unnamed_runs(spark, base, NEXT)) == 1


def test_a_second_run_replaces_all_tables_of_the_day(spark, tmp_path):
    base = str(tmp_path)
    for tables in (("a", "b"), ("b",)):
        with complete_run(spark, base, DAY) as run:
            for name in tables:
                publish(spark.range(len(tables)), f"{run}/{name}", DAY)
    assert newest_run(spark, base, DAY).tables == ("b",)
    assert read_complete(spark, base, "b").count() == 1
    with pytest.raises(KeyError):
        read_complete(spark, base, "a")


def test_nothing_complete_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        newest_run(spark, str(tmp_path))


def test_ledger_counts_rows_rejects_and_losses(spark, tmp_path):
    ledger = Ledger()
    df = spark.range(10).selectExpr("id", "if(id < 3, NULL, id) AS key", "id % 2 AS gone")
    watched = ledger.watch(df, "landed", rejected=F.col("key").isNull(), lost=F.col("gone"))
    publish(watched.where("key IS NOT NULL"), str(tmp_path / "t"), DAY)
    publish(ledger.watch(read_published(spark, str(tmp_path / "t"), DAY).limit(2), "cut", after="landed"), str(tmp_path / "u"), DAY)
    assert ledger.rows() == [("landed", 10, 7, 3, 5), ("cut", 7, 2, 0, 0)]


def portfolio_files(tmp_path, portfolio, scores, latlong):
    texts = {
        "portfolio": "id,uprn,easting,northing\n" + portfolio,
        "scores": "id,uprn,combinedscore\n" + scores,
        "latlong": "id,uprn,easting,northing,latitude,longitude\n" + latlong,
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return [str(tmp_path / f"{name}.csv") for name in texts]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_ledger_of_empty_files(spark, tmp_path, how):
    files = portfolio_files(tmp_path, "", "", "")
    out = str(tmp_path / "out")
    assert portfolio_merge_job(spark, *files, f"{out}/merged", f"{out}/staged", DAY, how, f"{out}/ledger") == 0
    steps = read_published(spark, f"{out}/ledger/job=merge-portfolio", DAY)
    assert rows(steps.select("rows_in", "rows_out", "rejected", "lost")) == [(0, 0, 0, 0)] * 4


def test_ledger_spends_no_jobs_but_its_own_write(spark, tmp_path):
    files = portfolio_files(tmp_path, "1,5,1,1\n,6,1,1\n", "1,5,high\n1,5,3\n", "1,5,1,1,51.5,-2.5\n")

    def jobs(name, ledger):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, name)
        rows_out = portfolio_merge_job(spark, *files, f"{tmp_path}/{name}/m", f"{tmp_path}/{name}/s", DAY, "left", ledger)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert rows_out == 2
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    without, with_ledger = jobs("plain", None), jobs("counted", f"{tmp_path}/ledger")
    assert with_ledger == without + 1
    found = read_published(spark, f"{tmp_path}/ledger/job=merge-portfolio", DAY).drop("dt")
    assert [tuple(r) for r in found.orderBy("step").collect()] == [
        ("latlong", 1, 1, 0, 0), ("merged", 1, 2, 0, 0), ("portfolio", 2, 1, 1, 0), ("risk_scores", 2, 2, 0, 1),
    ]


def pairs(spark, values):
    return spark.createDataFrame(values, "id string, uprn long")


def test_pair_state_equals_a_count_over_all_days(spark, tmp_path):
    rng = random.Random(3)

    def some(n):
        return [(rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, None])) for _ in range(n)]

    first, second = some(60), some(40)
    gone = first[:25]
    base = str(tmp_path)
    keep_pair_counts(spark, base, DAY, pairs(spark, first))
    for _ in range(2):  # the second time repeats the day
        state = keep_pair_counts(spark, base, NEXT, pairs(spark, second), pairs(spark, gone))
    left = pairs(spark, first[25:] + second)
    assert rows(state) == rows(pair_counts(left))
    assert rows(duplicates_of_pairs(state)) == rows(duplicates_of_pairs(pair_counts(left)))


def test_pair_state_drops_what_is_used_up_and_keeps_debts(spark, tmp_path):
    base = str(tmp_path)
    keep_pair_counts(spark, base, DAY, pairs(spark, [("a", 1)]), pairs(spark, [("b", 2)]))
    assert rows(read_published(spark, base, DAY).drop("dt")) == [("a", 1, 1), ("b", 2, -1)]
    state = keep_pair_counts(spark, base, NEXT, pairs(spark, [("b", 2)]), pairs(spark, [("a", 1)]))
    assert rows(state) == []
    assert rows(pair_changes(pairs(spark, []), pairs(spark, []))) == []


def test_merged_profile_matches_a_plain_count(spark):
    rng = random.Random(5)
    days = [[1e9 + rng.gauss(0, 1) for _ in range(n)] for n in (1, 700, 30_000)]
    frames = [spark.createDataFrame([(x, None) for x in day], "x double, nothing double") for day in days]
    states = [profile_state(df, ["x", "nothing"]) for df in frames]
    empty = profile_state(spark.createDataFrame([], "x double, nothing double"), ["x", "nothing"])
    merged = profile_of_states(states[0].union(states[1]).union(states[2]).union(empty))
    found = {r["column"]: r for r in merged.collect()}
    values = sorted(x for day in days for x in day)
    row = found["x"]
    assert (row["count"], row["min"], row["max"]) == (len(values), values[0], values[-1])
    assert math.isclose(row["mean"], statistics.fmean(values), rel_tol=1e-12)
    assert math.isclose(row["std"], statistics.stdev(values), rel_tol=1e-6)
    for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        below = sum(v < row[name] for v in values) / len(values)
        assert abs(below - p) <= RANK_ERROR and row[name] in values
    assert found["nothing"]["count"] == 0 and list(found["nothing"])[2:] == [None] * 7


def test_states_of_states_merge_again(spark):
    parts = [profile_state(spark.range(a, b).selectExpr("CAST(id AS double) AS x"), ["x"]) for a, b in ((0, 10), (10, 500), (500, 501))]
    at_once = profile_of_states(parts[0].union(parts[1]).union(parts[2])).first()
    in_steps = profile_of_states(merged_states(parts[0].union(parts[1])).unionByName(parts[2])).first()
    assert at_once["count"] == in_steps["count"] == 501
    assert math.isclose(at_once["std"], in_steps["std"], rel_tol=1e-12) and at_once["mean"] == pytest.approx(250)


def test_days_are_pruned_by_a_table(spark, tmp_path, no_broadcast):
    base = str(tmp_path)
    publish(spark.range(5).selectExpr("id"), base, "20230401")
    for day in (DAY, NEXT):
        publish(spark.range(5).selectExpr("id", "id * 2 AS late"), base, day)
    schema = read_published(spark, base, DAY).drop("dt").schema
    wanted = spark.range(100).selectExpr("if(id % 2 = 0, '20230401', '20230428') AS dt")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    found = read_days(spark, base, schema, wanted)
    assert "dynamicpruning" in plan(found).lower() or "PartitionFilters: [isnotnull(dt" in plan(found)
    assert rows(found) == sorted([(i, None, "20230401") for i in range(5)] + [(i, 2 * i, NEXT) for i in range(5)], key=repr)
    assert read_days(spark, base, schema).count() == 15


def test_portfolio_day_is_one_run(spark, tmp_path):
    from catalogue.jobs import _portfolio_files
    from riskbook.plans.day_jobs import portfolio_day_job

    base, small = str(tmp_path), "/root/testdata/sf0.001"
    files = _portfolio_files(spark, small, base)
    feature = '{"type":"Feature","properties":{"LAD13CD":"E1","LAD13CDO":1,"LAD13NM":"Wiltshire"},"geometry":{"type":"Point","coordinates":[0,0]}}'
    (tmp_path / "areas.json").write_text('{"features":[' + feature + "]}")
    portfolio_day_job(spark, *files, str(tmp_path / "areas.json"), base, DAY)
    run = newest_run(spark, base)
    assert {"merged/parquet", "merged/csv", "reports/pillar3_matrix", "reports/duplicates/step=portfolio", "layers/energy",
            "layers/boundaries", "ledger/job=merge-portfolio", "staged/portfolio"} <= set(run.tables)
    merged = read_complete(spark, base, "merged/parquet")
    steps = {r["step"]: r for r in read_complete(spark, base, "ledger/job=merge-portfolio").collect()}
    assert steps["merged"]["rows_out"] == merged.count() > 0
    # Without its boundaries the next day stops at the layers: nothing of it is to be seen.
    with pytest.raises(Exception):
        portfolio_day_job(spark, *files, str(tmp_path / "missing.json"), base, NEXT)
    assert newest_run(spark, base).run_date == DAY and unnamed_runs(spark, base, NEXT)


def test_loan_book_of_a_table_stored_by_unit(spark, tmp_path):
    from catalogue.jobs import _property_files
    from riskbook.plans.property_jobs import enrich_loan_book_job, merge_property_risk_job

    base = str(tmp_path)
    files = _property_files(spark, "/root/testdata/sf0.001", base)
    places = (f"{base}/rejected", f"{base}/staged", DAY)
    merge_property_risk_job(
        spark, files["property"], files["energy"], files["flood"], f"{base}/merged", *places, keyed=f"{base}/keyed", buckets=8
    )
    for name, keyed in (("plain", None), ("stored", f"{base}/keyed")):
        enrich_loan_book_job(
            spark, f"{base}/merged", files["loans"], f"{base}/{name}", f"{base}/{name}_csv", *places, keyed=keyed
        )
    plain, stored = (read_published(spark, f"{base}/{name}", DAY) for name in ("plain", "stored"))
    assert plain.columns == stored.columns and plain.count() == stored.count() > 0
    assert plain.exceptAll(stored).isEmpty()


def test_numbers_on_the_command_line():
    from riskbook.__main__ import parser

    options = parser().parse_args(
        "merge-property --property-csv p --energy-csv e --flood-csv f --merged m --rejected r --staged s --run-date "
        "20230427 --keyed k --buckets 64".split()
    )
    assert (options.buckets, options.keyed, options.ledger) == (64, "k", None)
