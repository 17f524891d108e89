"""Periodic runs, decontamination and resampling against SQL or brute force."""

import hashlib
import math
import os
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import oracle  # noqa: E402
from riskbook.llm import decontamination, periodic_runs, queries, resampling  # noqa: E402
from riskbook.llm.common import ship_package  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# Periodic runs


def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_digests(doc_id, text):
    words = SPACED.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    said = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def test_periodic_runs_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = queries.op11_periodic_runs(spark, SF_DIR).collect()
    assert Counter(map(tuple, got)) == Counter(brute_digests(r["doc_id"], r["text"]) for r in rows)
    assert sum(r["n_runs"] > 0 for r in got) > 5


def test_periodic_runs_of_awkward_rows(spark, awkward):
    ship_package(spark)
    short = awkward.where(F.coalesce(F.length("text"), F.lit(0)) < 100_000)
    for df in (short, awkward.limit(0)):
        want = Counter(brute_digests(r["doc_id"], r["text"]) for r in df.collect())
        assert Counter(map(tuple, queries._run_digests(df).collect())) == want
    words = awkward.withColumn("words", periodic_runs.words_of(F.col("text")))
    found = {r["doc_id"]: r for r in periodic_runs.with_runs(words).collect()}
    assert list(map(tuple, found[6]["runs"])) == [(0, 30_000, 1)] and found[6]["collapsed"] == "long " + "x" * 60_000
    assert found[7]["runs"] == [] and found[7]["row"] == "y"
    nulls = spark.createDataFrame([(None,), ([],), (["a"] * 6,)], "words array<string>")
    lists = periodic_runs.with_runs(nulls.select("words", F.lit(1).alias("row"), F.lit(2).alias("r.x"))).collect()
    assert [len(r["runs"]) for r in lists] == [0, 0, 1] and lists[2]["collapsed"] == "a" and lists[0]["r.x"] == 2


@pytest.mark.parametrize("smallest", [1, 4, 16])
def test_runs_of_random_sequences(monkeypatch, smallest):
    """Scales that start at blocks of one word go through transforms alone."""
    monkeypatch.setattr(periodic_runs, "SMALLEST", smallest)
    rng = np.random.default_rng(smallest)
    for _ in range(120):
        parts = []
        for _ in range(rng.integers(1, 6)):
            if rng.random() < 0.5:
                parts.append(rng.integers(0, rng.integers(2, 50), rng.integers(0, 60)))
            else:
                block = rng.integers(0, rng.integers(1, 6), rng.integers(1, 70))
                repeated = np.tile(block, rng.integers(1, 7))
                parts.append(repeated[: len(repeated) - rng.integers(0, len(block))])
        codes = np.concatenate(parts).astype(np.int64)
        assert sorted(map(tuple, periodic_runs.runs_of(codes).tolist())) == brute_runs(codes.tolist())


def test_runs_that_overlap_and_nest(spark):
    inner = [1, 1, 1, 1, 1, 1, 2]
    codes = np.array(inner * 5 + [3, 1] * 6 + [1] * 9)
    assert periodic_runs.runs_of(codes).tolist() == sorted(map(list, brute_runs(codes.tolist())), key=lambda r: (r[0], r[2]))
    # Several texts of equal content after each other are not one run.
    texts = np.array([7] * 5 * 4)
    owner, _ = periodic_runs.runs_of_texts(texts, np.array([0, 5, 10, 15, 20]))
    assert not len(owner)


def test_differences_are_those_of_the_definition(monkeypatch):
    rng = np.random.default_rng(3)
    for size in (2, 8, 32):
        codes = rng.integers(0, 2, 200)
        got = set(zip(*map(list, periodic_runs.zero_differences(codes, size))))
        want = {
            (a, d)
            for a in range(0, 200 - 2 * size + 1, size)
            for d in range(size, 2 * size)
            if a + d + size <= 200 and (codes[a : a + size] == codes[a + d : a + d + size]).all()
        }
        assert got == want
    # With a small prime many sums are zero that are not zero: the extension throws them out.
    monkeypatch.setattr(periodic_runs, "PRIME", 193)
    monkeypatch.setattr(periodic_runs, "GENERATOR", 5)
    monkeypatch.setattr(periodic_runs, "SMALLEST", 2)
    periodic_runs._roots.cache_clear()
    try:
        for _ in range(40):
            codes = np.concatenate([rng.integers(0, 40, 50), np.tile(rng.integers(0, 40, 9), 5), rng.integers(0, 3, 30)])
            assert sorted(map(tuple, periodic_runs.runs_of(codes).tolist())) == brute_runs(codes.tolist())
    finally:
        periodic_runs._roots.cache_clear()


def test_a_long_text_of_one_word():
    runs = periodic_runs.runs_of(np.zeros(200_000, dtype=np.int64))
    assert runs.tolist() == [[0, 200_000, 1]]


# Decontamination

ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven"),
    (2, "Two three four five six seven eight nine ten, eleven twelve"),
    (3, "short item"),
    (4, "x"),
    (5, None),
    (6, " -- "),
    (None, "an item without any id of its own has ten words here"),
    (3, "another text of item three"),
    (7, "one two three four five six seven eight nine ten eleven"),
    (8, "word " * 30),
]
TEXTS = [
    (10, "a One TWO three-four five six seven eight nine ten. b"),
    (11, "one two three four five six seven eight nine"),
    (12, "a short item and x and X y"),
    (13, None),
    (14, ""),
    (15, "word " * 5000),
    (None, "an item without any id of its own has ten words here"),
    (16, "another text of item three " * 3),
    (16, "another text of item three " * 3),
    (17, "zero one two three four five six seven eight nine ten eleven twelve thirteen"),
    (18, "Éa one two ÉA é\U0001f600 short item"),
]


def test_contamination_of_awkward_rows(spark, awkward):
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, digest int")
    docs = spark.createDataFrame(
        [(i, t, 1, "x", 2) for i, t in TEXTS], "doc_id long, text string, size int, window string, item_id int"
    )
    # Spelling out all windows of a text of 30,000 words takes SQL minutes.
    fast = awkward.where("doc_id is null or doc_id <> 6")
    for rows, benchmark in ((docs.unionByName(fast, allowMissingColumns=True), items), (docs.limit(0), items.limit(0)),
                            (docs.repartition(5), items.where("item_id = 4"))):
        con = oracle.duckdb.connect()
        con.register("documents", rows.select("doc_id", "text").toArrow())
        con.register("benchmark", benchmark.select("item_id", "text").toArrow())
        got = decontamination.contamination(rows, benchmark)
        assert oracle.difference(got, con, queries.SQL["op12_decontamination"]) is None


@pytest.mark.parametrize("size", range(1, 11))
def test_equal_stretches_share_a_fingerprint(spark, size):
    rng = np.random.default_rng(size)
    texts = [[int(x) for x in rng.integers(0, 4, 60)] for _ in range(20)]
    df = spark.createDataFrame([(t,) for t in texts], "words array<long>")
    got = df.select("words", decontamination.fingerprints(F.col("words"), size).alias("f")).collect()
    by_window = {}
    for r in got:
        assert len(r["f"]) == 60 - size + 1
        for i, f in enumerate(r["f"]):
            assert by_window.setdefault(tuple(r["words"][i : i + size]), f) == f


def test_fingerprints_pass_the_bitmap(spark):
    fps = spark.range(5000).select(F.xxhash64("id").alias("fp"))
    others = spark.range(100_000, 150_000).select(F.xxhash64("id").alias("fp"))
    bitmap = decontamination._bitmap(fps)
    assert decontamination._in_bitmap(fps, bitmap).count() == 5000
    assert decontamination._in_bitmap(others, bitmap).count() < 20


def test_decontamination_has_no_python_and_bounded_broadcasts(spark):
    docs, items = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        windows = decontamination.stored(decontamination.benchmark_windows(items), "windows")
        plan = decontamination.window_hits(docs, windows)._jdf.queryExecution().executedPlan().toString()
        # Without room for other broadcasts only the bitmap is one, and results stay the same.
        assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" in plan
        got = Counter(map(tuple, decontamination.contamination(docs, items).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not re.search("Python|Arrow|Pandas", plan) and "Cartesian" not in plan and "NestedLoop" not in plan
    assert got == Counter(map(tuple, decontamination.contamination(docs, items).collect()))


# Resampling


def brute_buckets(text):
    words = LETTERS.findall(lowered(text))
    return [zlib.crc32(f.encode()) % 10_000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def test_joined_crcs():
    rng = np.random.default_rng(1)
    pairs = [(rng.bytes(int(a)), rng.bytes(int(b))) for a, b in rng.integers(0, 300, (400, 2))] + [(b"a", b"b" * 100_000)]
    crc = [np.array([zlib.crc32(x) for x in column], dtype=np.uint32) for column in zip(*pairs)]
    got = resampling.joined_crcs(*crc, np.array([len(b) for _, b in pairs]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


@pytest.mark.parametrize("most", [0, 3, 50, 1 << 16])
def test_buckets_do_not_depend_on_the_dictionary(spark, documents, awkward, monkeypatch, most):
    monkeypatch.setattr(resampling, "GROWTH", 10)
    monkeypatch.setattr(resampling, "PORTION", 1000)
    dictionary = resampling.Dictionary(most)
    texts = [r["text"] or "" for df in (documents, awkward) for r in df.collect()]
    texts += ["é1É x x X ÿ\x7fa\x00b -- ", "a", " a", "a ", "\U0001f600 \U0001f600", "l" * 5000 + " l"]
    for low in range(0, len(texts), 30):
        part = texts[low : low + 30]
        got = resampling.buckets_of([t.encode() for t in part], dictionary)
        assert [Counter(b.tolist()) for b in got] == [Counter(brute_buckets(t)) for t in part]
    assert len(dictionary.words) <= most


def test_resampling_of_awkward_rows(spark, awkward):
    ship_package(spark)
    items = spark.createDataFrame([(1, "one two three long"), (2, None), (3, "")], "item_id long, text string")
    long_ = awkward.where("doc_id is null or doc_id < 6").union(awkward.where("doc_id = 1")).withColumn(
        "text", F.concat("text", F.lit(" w x y z" * 8))
    )
    many = long_.union(awkward).withColumn("score", F.lit("x")).withColumn("buckets", F.lit(0))
    for rows, target in ((many, items), (many.limit(0), items.limit(0))):
        con = oracle.duckdb.connect()
        con.register("documents", rows.select("doc_id", "text").toArrow())
        con.register("benchmark", target.select("text").toArrow())
        assert oracle.difference(resampling.resampled(rows, target), con, queries.SQL["op13_resampling"]) is None


def test_ranks_of_a_crowd_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(resampling, "COPIES", 7)
    rows = [(1, 50, 3, 3)] * 100 + [(2, 50, 3, 3)] * 10 + [(3, 50, 9, 9), (4, 10, 99, 99), (None, 50, 3, 3)]
    df = spark.createDataFrame(rows, "id long, n_features long, weight long, score long")
    got = resampling.ranked(df, "id").collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(rows)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 112 * 25 // 100 + 1))
    assert {r["id"] for r in got if r["rank"] == 1} == {3} and all(r["id"] == 1 for r in got if (r["rank"] or 0) > 1)


def test_gain_is_that_of_the_definition(spark):
    made = [spark.createDataFrame(rows, "bucket long, n long") for rows in ([(0, 5), (9, 1)], [(0, 2), (7, 4)])]
    s, t = {0: 5, 9: 1}, {0: 2, 7: 4}
    want = [
        math.floor(1000 * math.log((t.get(k, 0) + 1) * (6 + 10_000) / ((s.get(k, 0) + 1) * (6 + 10_000))))
        for k in range(resampling.BUCKETS)
    ]
    assert resampling.gains(*made).tolist() == want
