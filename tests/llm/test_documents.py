"""Quality rules, SimHash, mixing, sharding and the pipeline against SQL or brute force."""

import base64
import hashlib
import os
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import corpus_pipeline  # noqa: E402
import oracle  # noqa: E402
from riskbook.llm import components, mixing, quality_rules, queries, sharding, simhash  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, con, name):
    assert oracle.difference(queries.QUERIES[name](spark, SF_DIR), con, queries.SQL[name]) is None


def on_rows(df, sql):
    """A twin's result on rows of our own."""
    con = oracle.duckdb.connect()
    con.register("documents", df.select("doc_id", "text", "source").toArrow())
    return con, sql


# Quality rules


def brute_measures(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {p for i, w in enumerate(windows) if times[w] > 1 for p in range(i, i + 8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines),
        len(lines) - len(set(lines)), len(covered),
    )


def test_measures(spark, documents, awkward):
    repeats = "a b c d e f g h i\n" * 3 + "a b c d e f g h"
    more = spark.createDataFrame([(1, repeats), (2, "x " * 9), (3, "#\n#\n\n \n#"), (4, "a\x0bb\x1cc\x85d")], "doc_id long, text string")
    for df in (documents, awkward, more, awkward.limit(0)):
        got = quality_rules.ledger(df).drop("n_capitals", "failures").collect()
        assert Counter(map(tuple, got)) == Counter((r["doc_id"], *brute_measures(r["text"])) for r in df.collect())


def test_windows_that_share_a_hash_are_compared(monkeypatch):
    codes, owner = np.array([1, 2, 3, 1, 2, 9, 1, 2]), np.array([0, 0, 0, 0, 0, 0, 1, 1])
    want = [True, True, False, True, True, False, False, False]
    assert quality_rules._repeated(codes, owner, 2).tolist() == want
    monkeypatch.setattr(np, "argsort", lambda x, kind=None: np.arange(len(x)))  # makes no run of equal hashes
    assert not quality_rules._repeated(np.array([1, 1]), np.array([0, 0]), 8).any()


def test_kept_rows_and_policies(spark, documents, awkward):
    kept = quality_rules.kept(awkward, "v1")
    assert kept.columns == awkward.columns
    assert kept.count() == quality_rules.ledger(awkward).where(quality_rules.passes(F.col("failures"), "v1")).count()
    assert quality_rules.mask_of("base") == 3
    judged = [r["failures"] for r in quality_rules.ledger(documents).collect()]
    for policy in quality_rules.POLICIES:
        mask = quality_rules.mask_of(policy)
        for r in quality_rules.ablations(quality_rules.ledger(documents), policy).collect():
            bit = quality_rules.BITS[r["rule"]]
            assert r["failing"] == sum(f & bit != 0 for f in judged)
            assert r["alone"] == sum(f & mask == bit for f in judged)
            assert r["kept_without"] == sum(f & mask & ~bit == 0 for f in judged)


def test_clean_documents_stay(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(labels, "doc_id", "left_semi")
    book = quality_rules.ledger(docs).where("n_words >= 20")
    lost = book.where(~quality_rules.passes(F.col("failures"), "v1") & quality_rules.passes(F.col("failures"), "base"))
    assert lost.count() <= 0.01 * book.count()


# SimHash


def brute_fingerprint(text, size=4):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, distance):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= distance:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(fps))]


def check_components(df, distance=4):
    rows = sorted(df.select("doc_id", "text").collect(), key=lambda r: (r[0] is None, r[0] or 0))
    fps = [brute_fingerprint(r["text"]) for r in rows]
    roots = brute_components(fps, distance)
    want = Counter((r["doc_id"], f"{f:016x}", rows[k]["doc_id"]) for r, f, k in zip(rows, fps, roots))
    assert Counter(map(tuple, simhash.components(df, 4, distance).collect())) == want
    kept = simhash.one_of_each(df, 4, distance)
    assert kept.columns == df.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(rows[k]["doc_id"] for k in set(roots))


@pytest.mark.parametrize("distance", [0, 1, 4, 7])
def test_components(documents, distance):
    check_components(documents, distance)


def test_components_of_awkward_rows(awkward):
    check_components(awkward)
    check_components(awkward.limit(0))


def random_links(fps, distance):
    return {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= distance}


@pytest.mark.parametrize("short", [2, 32])
def test_links_of_dense_fingerprints(spark, monkeypatch, short):
    """Clusters around a few centres, one with hundreds of members: the same components as all pairs give."""
    monkeypatch.setattr(simhash, "SHORT_RUN", short)
    rng = np.random.default_rng(11)
    fps = set()
    for members in (400, 40, 3, 1, 1):
        centre = int(rng.integers(0, 1 << 63))
        for _ in range(members):
            fps.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(3)
    found = simhash.links(df, 4)
    # A spanning forest in each run, not all pairs.
    assert found.count() < 64 * len(fps) < len(random_links(fps, 4)) * 64
    label = {r["node"]: r["label"] for r in components.connected_components(found).collect()}
    groups = defaultdict(set)
    for s in signed:
        groups[label.get(s, s)].add(s)
    want = defaultdict(set)
    for s, k in zip(signed, brute_components(fps, 4)):
        want[k].add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 100)]
    more = [(5000, 5000), (6000, 6001), (6001, 6000), (6000, 6001), (None, 7), (8, None)]
    edges = spark.createDataFrame(chain + star + more, "a long, b long").repartition(4)
    groups = defaultdict(set)
    for r in components.connected_components(edges).collect():
        groups[r["label"]].add(r["node"])
    assert sorted(map(sorted, groups.values())) == [list(range(201)), list(range(1000, 1100)), [6000, 6001]]
    assert all(label in nodes for label, nodes in groups.items())
    assert components.connected_components(edges.limit(0)).count() == 0


def test_reruns_keep_the_same_row(spark, documents):
    """Rows that agree in id and text but not in other columns, and rows that agree in all."""
    base = documents.select("doc_id", "text")
    many = base.crossJoin(spark.range(4).select((F.col("id") % 3).alias("number"))).withColumn("first", F.lit("x"))
    runs = [simhash.one_of_each(many.repartition(n), 4, 4).collect() for n in (2, 7)]
    assert Counter(runs[0]) == Counter(runs[1])
    assert len(runs[0]) == simhash.components(base, 4, 4).select("component_id").distinct().count()


# Mixing


def test_mixture_of_awkward_rows(awkward):
    con, sql = on_rows(awkward, queries.SQL["op2_mixture"])
    assert oracle.difference(mixing.mixture(awkward), con, sql) is None
    assert mixing.mixture(awkward.limit(0)).count() == 0
    mixed = mixing.mixed_rows(awkward)
    assert mixed.columns == awkward.columns


def brute_targets(sizes, weights, share, most):
    """Sources without room give their excess back until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, budget = {}, sum(sizes.values()) * share
    while True:
        free = [s for s in names if s not in full]
        level = (budget - sum(full.values())) / sum(weight[s] for s in free) if free else 0
        above = [s for s in free if level * weight[s] > most * sizes[s]]
        if not above:
            return {**full, **{s: level * weight[s] for s in free}}
        full.update({s: most * sizes[s] for s in above})


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = {f"s{i}": int(rng.lognormal(5, 2)) for i in range(23)} | {None: 70, "é": 5, "zero": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df, (3, 1, 2), 1.5, 2).collect()}
    assert got == pytest.approx(brute_targets(sizes, (3, 1, 2), 1.5, 2))


def test_mixture_meets_targets(spark, documents):
    got = mixing.mixture(documents).join(documents.select("doc_id", "source"), "doc_id").collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    again = mixing.mixture(documents.repartition(7)).collect()
    assert Counter(again) == Counter(mixing.mixture(documents).collect())
    rows = mixing.mixed_rows(documents).groupBy("doc_id").count().collect()
    times = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in got if r["size"]}
    assert {r["doc_id"]: r["count"] for r in rows} == {d: n for d, n in times.items() if n}


def test_better_documents_come_earlier(spark):
    """With a third of the words asked for, letters are taken more often than digits."""
    rows = [(i, "abcd " * 10 if i % 2 else "1234 " * 10, "s") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixture(df, share=0.33).where("taken > 0").collect()
    letters = sum(r["doc_id"] % 2 for r in got)
    assert len(got) in (660, 661) and letters > 0.7 * len(got)


# Sharding


def shards_of(spark, df, path, **more):
    sharding.shuffled_into_shards(df, path, 8, **more)
    row_type = df.select(F.struct(*df.columns).alias("r")).schema["r"].dataType.simpleString()
    return sharding.read_shards(spark, path, row_type)


def check_shards(df, found):
    rows = found.collect()
    assert Counter(r["row"] for r in rows) == Counter(df.collect())
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["size"] == len((r["row"]["text"] or "").encode()) + 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[k]) for k in range(8)]
    assert max(counts) - min(counts) <= 1


@pytest.mark.parametrize("bucket_bytes", [20_000, 32 << 20])
def test_sharding(spark, documents, awkward, tmp_path, bucket_bytes):
    for k, df in enumerate((documents, awkward, awkward.limit(0))):
        check_shards(df, shards_of(spark, df, f"{tmp_path}/{k}", bucket_bytes=bucket_bytes))


def plain_places(rows, seed, bucket_bytes):
    """Shard and slot of each id, for rows without crowds, one row after the other."""
    def key_of(i):
        with_seed = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
        unsigned = xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), with_seed)
        return unsigned - (unsigned >> 63 << 64)

    held = sum(8 * len(r) + sum(len(v.encode()) for v in r if isinstance(v, str)) for r in rows)
    buckets = [[] for _ in range(max(1, -(-held // bucket_bytes)))]
    for r in rows:
        key = key_of(r["doc_id"])
        buckets[key % sharding.PARTS * len(buckets) // sharding.PARTS].append((key, r["doc_id"]))
    line = []
    for number, bucket in enumerate(buckets):
        bucket.sort()
        line += [bucket[k][1] for k in np.random.default_rng([seed, number]).permutation(len(bucket))]
    places = {}
    for shard in range(8):
        begin, end = (-(-len(line) * k // 8) for k in (shard, shard + 1))
        places.update({i: (shard, slot) for slot, i in enumerate(line[begin:end])})
    return places


@pytest.mark.parametrize("bucket_bytes, seed", [(20_000, 0), (32 << 20, 7)])
def test_places_are_those_of_a_plain_shuffle(spark, documents, tmp_path, bucket_bytes, seed):
    found = shards_of(spark, documents, f"{tmp_path}/plain", seed=seed, bucket_bytes=bucket_bytes)
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in found.select("row.doc_id", "shard", "slot").collect()}
    assert got == plain_places(documents.collect(), seed, bucket_bytes)


def test_sharding_does_not_depend_on_layout(spark, documents, tmp_path):
    runs = [
        shards_of(spark, df, f"{tmp_path}/{k}", seed=seed).select("row.doc_id", "shard", "slot").collect()
        for k, (df, seed) in enumerate([(documents, 1), (documents.repartition(5), 1), (documents, 2)])
    ]
    assert Counter(runs[0]) == Counter(runs[1]) != Counter(runs[2])
    # A permutation: neighbours of the table are not neighbours in the shards.
    place = {r["doc_id"]: (r["shard"], r["slot"]) for r in runs[0]}
    near = sum(place[i][0] == place[i + 1][0] and abs(place[i][1] - place[i + 1][1]) == 1 for i in range(len(place) - 1))
    assert near < 0.05 * len(place)


def test_a_crowd_of_copies_is_spread(spark, documents, tmp_path):
    """A third of all rows are copies of one row, and a third share one id."""
    n = documents.count()
    copies = spark.range(n).select(F.lit(77).cast("long").alias("doc_id"), F.lit("the same text").alias("text"))
    one_id = spark.range(n).select(F.lit(78).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    df = documents.select("doc_id", "text").union(copies).union(one_id).repartition(4)
    found = shards_of(spark, df, f"{tmp_path}/crowd", bucket_bytes=2_000).cache()
    check_shards(df, found)
    share = found.where("row.doc_id = 77").groupBy("shard").count().collect()
    assert len(share) == 8 and max(r["count"] for r in share) < 2 * n / 8


def test_only_crowds_are_spread(spark, documents, monkeypatch, tmp_path):
    """Buckets of a few rows: rows whose id is their own keep their key, however small a bucket is."""
    seen = []
    spread = sharding._spread_crowds

    def watched(rows, large, *more):
        out = spread(rows, large, *more)
        keys = rows.select("row.doc_id", "key").exceptAll(out.select("row.doc_id", "key"))
        seen.append({r["doc_id"] for r in keys.collect()})
        return out

    monkeypatch.setattr(sharding, "_spread_crowds", watched)
    crowd = spark.range(300).select(F.lit(77_777).cast("long").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    df = documents.select("doc_id", "text").union(crowd)
    check_shards(df, shards_of(spark, df, f"{tmp_path}/crowd", bucket_bytes=4_000))
    assert seen == [{77_777}]


def test_wide_rows_count_whole(spark, monkeypatch, tmp_path):
    df = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.repeat(F.lit("y"), 5000).alias("more"))
    seen = []
    per_bucket = sharding._per_bucket
    monkeypatch.setattr(sharding, "_per_bucket", lambda rows, n: seen.append(n) or per_bucket(rows, n))
    check_shards(df, shards_of(spark, df, f"{tmp_path}/wide", bucket_bytes=100_000))
    assert seen[0] >= 10


def test_sharding_query(spark):
    rows = queries.op3_sharding(spark, SF_DIR).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(rows) == len(texts) and {r["law"] for r in rows} == {"rows"}
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) and r["grown_shard"] is None for r in rows)


# The pipeline


def test_stages(spark, documents, awkward, tmp_path):
    for k, start in enumerate((documents, awkward, awkward.limit(0))):
        docs, seen = start, {}
        for name, stage in corpus_pipeline.STAGES:
            path = f"{tmp_path}/{k}/{name.replace(' ', '-')}"
            stage(spark, docs, SF_DIR).write.parquet(path)
            seen[name] = (docs, spark.read.parquet(path))
            docs = seen[name][1]
        for name, (before, after) in list(seen.items())[:-1]:
            assert after.columns == start.columns, name
        check_stages(seen)


def check_stages(seen):
    (before, kept), (_, single), (_, hidden), (_, mixed), (_, encoded) = seen.values()
    passed = []
    for r in before.collect():
        words, chars, symbols, lines, dup, repeat = brute_measures(r["text"])
        capitals = sum(c.isupper() for c in r["text"] or "")
        if not (words < 20 or 100 * repeat > 30 * words or 10 * symbols > words or 2 * dup > lines
                or chars < 2 * words or chars > 15 * words or 2 * capitals > chars):
            passed.append(r)
    assert Counter(kept.collect()) == Counter(passed)
    rows = sorted(passed, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    roots = set(brute_components([brute_fingerprint(r["text"]) for r in rows], 4))
    assert Counter(r["doc_id"] for r in single.collect()) == Counter(rows[k]["doc_id"] for k in roots)
    assert Counter(r["doc_id"] for r in hidden.collect()) == Counter(r["doc_id"] for r in single.collect())
    taken = {(r["doc_id"], r["size"]): r["taken"] for r in mixing.mixture(hidden).collect()}
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert times == +Counter({i: int(t / n + 0.5) for (i, n), t in taken.items()})
    check_ids(mixed, encoded)
    check_hidden(single, hidden)


def check_ids(mixed, encoded):
    """The ids of each text of the mix as the library gives them, and the text from its ids."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(queries.RANKS_50K), "rb"))}
    encoding = tiktoken.Encoding("whole", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [(r["doc_id"], r["text"] or "") for r in mixed.select("doc_id", "text").collect()]
    got = encoded.collect()
    assert Counter((r["doc_id"], encoding.decode(r["ids"])) for r in got) == Counter(texts)
    # Runs of one character that are long take the library itself too long.
    short = [(i, t) for i, t in texts if len(t) < 50_000]
    want = Counter((i, tuple(encoding.encode_ordinary(t))) for i, t in short)
    assert not want - Counter((r["doc_id"], tuple(r["ids"])) for r in got)
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)
    digests = Counter((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in texts)
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in got) == digests


ADDRESS = re.compile(r"(?<![\w.@+-])[a-z][a-z0-9.]*@[a-z]+(?:\.[a-z]+)+(?![\w@-])")
SECURITY = re.compile(r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w.-])")


def check_hidden(single, hidden):
    """Texts without an at sign and without digits stay as they are; other columns always do; of those with plain e-mail
    addresses or security numbers none keeps one, and an equal value has one pseudonym in all documents."""
    others = [c for c in single.columns if c not in ("text", "n_chars")]
    assert Counter(map(tuple, single.select(*others).collect())) == Counter(map(tuple, hidden.select(*others).collect()))
    new = {r["doc_id"]: r["text"] for r in hidden.collect()}
    names = {}
    for r in single.collect():
        text, hid = r["text"], new[r["doc_id"]]
        if text is None or not re.search("[@0-9]", text):
            assert hid == text
            continue
        for kind in (ADDRESS, SECURITY):
            before, after = kind.findall(text), kind.findall(hid)
            if len(before) == len(after):
                for a, b in zip(before, after):
                    assert names.setdefault(a, b) == b
                    assert a != b or (kind is SECURITY and a[:3] in ("000", "666") or a[0] == "9")



def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and rows.count() > 0
