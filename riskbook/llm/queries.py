"""The operators as queries on the driver tables, with SQL twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.functions.common import let
from riskbook.llm import (
    byte_bpe,
    decontamination,
    mixing,
    neighbours,
    periodic_runs,
    pseudonyms,
    quality_rules,
    resampling,
    sharding,
    simhash,
    token_counts,
    token_files,
    toxicity,
)
from riskbook.llm.common import ship_package
from riskbook.sources.publish import scratch_path

JSON_50K = "byte_bpe_50k.json"
RANKS_50K = "byte_bpe_multi_50k.tiktoken"
TOKEN_LIMIT = 512
END_ID = 2
EVERY_NTH_QUERY, NEAREST = 50, 5
SHARDS = 8
TOXIC_FROM = 0.3
SHINGLE, DISTANCE = 4, 4
POLICY = "v1"
# The setting of the session that holds the key of the pseudonyms, and what stands in where it is unset, as in tests.
KEY_SETTING, KEY = "spark.riskbook.pseudonym.key", "not a secret"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pseudonym_key(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, KEY)


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY_NTH_QUERY == 0, NEAREST)


def op2_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "shards")
    sharding.shuffled_into_shards(docs, path, SHARDS)
    written = sharding.read_shards(spark, path, docs.schema.simpleString())
    return written.select(
        "row.doc_id",
        "size",
        F.crc32(F.coalesce("row.text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    # Rows whose id is null have no remainder and are not held out; they have no label either.
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    model = toxicity.fit(docs, labels, ~held_out)
    return toxicity.scored(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"), SHINGLE, DISTANCE)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = token_counts.token_counts(docs, public_tokenizers.path(JSON_50K))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), pseudonym_key(spark))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return book.select(
        "doc_id",
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        (~quality_rules.passes(F.col("failures"), "base")).alias("base_failed"),
        quality_rules.passes(F.col("failures"), POLICY).alias("kept"),
        "failures",
    )


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the policy costs, of the ledger's bits alone."""
    return quality_rules.ablations(quality_rules.ledger(table(spark, sf_dir, "documents")), POLICY)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path(JSON_50K), end_id=END_ID
    )
    back = token_files.read_token_files(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path(RANKS_50K), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents")
    encoded = byte_bpe.encode(docs, ranks, pattern, give=("n_tokens", "packed", "decoded"))
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _with_repeated_tail(words: Column, id_: Column) -> Column:
    """Words of which one row in ten, chosen by its id, repeats a stretch from some place to its end."""
    hashed = F.crc32(id_.cast("string"))

    def of(x: Column) -> Column:
        begin = F.pmod(x.g, F.size(x.words))
        period = F.lit(1) + F.floor((F.size(x.words) - begin) / (F.lit(3) + F.pmod(x.g, F.lit(8))))
        places = F.struct(x.words.alias("words"), begin.cast("int").alias("begin"), period.cast("int").alias("period"))
        return let(places, repeated)

    def repeated(x: Column) -> Column:
        return F.transform(
            x.words, lambda w, i: F.when(i < x.begin, w).otherwise(F.get(x.words, x.begin + F.pmod(i - x.begin, x.period)))
        )

    def chosen(x: Column) -> Column:
        return F.when((F.pmod(x.h, F.lit(10)) == 0) & (F.size(x.words) > 0), of(x)).otherwise(x.words)

    return let(F.struct(words.alias("words"), hashed.alias("h"), F.floor(hashed / 10).alias("g")), chosen)


def _run_digests(docs: DataFrame) -> DataFrame:
    words = _with_repeated_tail(periodic_runs.words_of(F.col("text")), F.col("doc_id"))
    found = periodic_runs.with_runs(docs.select("doc_id", words.alias("words")))
    # The longest; of equal ones the first, then that of the smallest period.
    places = F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period, r.alias("r")))
    best = F.array_max(places).getField("r")
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best.getField(name).alias(name) for name in ("start", "length", "period")],
        F.floor(best.getField("length") * 1000 / best.getField("period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_digests(table(spark, sf_dir, "documents"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_neighbours,
        op2_mixture,
        op3_sharding,
        op4_toxicity,
        op5_simhash,
        op6_token_counts,
        op7_pseudonyms,
        op8_quality_rules,
        quality_ablations,
        op9_token_files,
        op10_byte_bpe,
        op11_periodic_runs,
        op12_decontamination,
        op13_resampling,
    )
}

_LEDGER_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS gram FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM m)),
hit AS (SELECT r, unnest(range(i, i + 8)) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM hit GROUP BY r),
s AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(len(l) AS BIGINT) AS n_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             CAST(len(regexp_extract_all(t, '\p{Lu}')) AS BIGINT) AS n_capitals
      FROM m LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
                  + 8 * (2 * n_dup_lines > n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT
                  + 32 * (word_chars > 15 * n_words)::INT + 64 * (2 * n_capitals > word_chars)::INT AS BIGINT) AS failures
      FROM s)"""

SQL = {
    "op2_mixture": r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
m AS (SELECT doc_id, source, CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
             -ln((CAST('0x' || md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || t)[1:13] AS BIGINT) + 0.5::DOUBLE)
                 / 4503599627370496.0::DOUBLE)
             / (0.25::DOUBLE + 0.75::DOUBLE * length(regexp_replace(t, '[^\p{L}]', '', 'g')) / greatest(length(t), 1)) AS key
      FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM m GROUP BY source),
w AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
l AS (SELECT *, 2 * source_size AS most, (sum(source_size) OVER () * 1.5::DOUBLE
                 - coalesce(sum(2 * source_size) OVER e, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER e, 0)) AS level
      FROM w WINDOW e AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN most > level * weight
             THEN (max(level) FILTER (WHERE most > level * weight) OVER ()) * weight ELSE CAST(most AS DOUBLE) END AS target FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(floor(target + 0.5) / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
r AS (SELECT m.*, p.source_size, p.target, p.epochs, CAST(floor(p.target + 0.5) AS BIGINT) - p.epochs * p.source_size AS part,
             sum(size) OVER (PARTITION BY m.source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(size) OVER (PARTITION BY m.source, key) AS words, count(*) OVER (PARTITION BY m.source, key) AS n
      FROM m JOIN p ON m.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + CASE WHEN upto <= part AND NOT (upto = part AND words > 0) THEN size
                                 WHEN part > upto - words AND part <= upto THEN floor((part - upto + words) / n)
                                 ELSE 0 END AS BIGINT) AS taken
FROM r
""",
    "op8_quality_rules": _LEDGER_SQL + r"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words
            OR word_chars > 15 * n_words OR 2 * n_capitals > word_chars) AS kept,
       failures
FROM f
""",
    "quality_ablations": _LEDGER_SQL + r""",
rules AS (SELECT unnest(['few_words', 'repeated_words', 'symbols', 'repeated_lines', 'short_words', 'long_words', 'capitals']) AS rule,
                 unnest([1, 2, 4, 8, 16, 32, 64]) AS bit)
SELECT rule, count(*) FILTER (WHERE failures & bit <> 0) AS failing, count(*) FILTER (WHERE failures = bit) AS alone,
       count(*) FILTER (WHERE failures & (127 - bit) = 0) AS kept_without
FROM f, rules GROUP BY rule
""",
    "op12_decontamination": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i
             FROM (SELECT *, least(len(w), 10) AS size FROM b WHERE len(w) > 0))),
dw AS (SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
       FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM bw))),
hit AS (SELECT r, i, dw.size, item_id FROM dw JOIN bw USING (size, win)),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
""",
    # DuckDB has no CRC-32: each distinct feature goes through its table byte by byte.
    "op13_resampling": r"""
WITH RECURSIVE c(n, v, k) AS (
  SELECT CAST(range AS BIGINT), CAST(range AS BIGINT), 0 FROM range(256)
  UNION ALL
  SELECT n, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM c WHERE k < 8),
crc AS (SELECT list(v ORDER BY n) AS t FROM c WHERE k = 8),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS (SELECT r, unnest(w) AS f FROM d UNION ALL
       SELECT r, w[i] || ' ' || w[i + 1] FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM d)),
bf AS (SELECT unnest(w) AS f FROM b UNION ALL
       SELECT w[i] || ' ' || w[i + 1] FROM (SELECT w, unnest(range(1, len(w))) AS i FROM b)),
kinds AS (SELECT f, CAST(xor(list_reduce(
            list_transform(range(0, octet_length(encode(f))),
                           lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT)),
            lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS BIGINT) AS bucket
          FROM (SELECT f FROM df UNION SELECT f FROM bf), crc),
s AS (SELECT bucket, count(*) AS s FROM df JOIN kinds USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN kinds USING (f) GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM df)::DOUBLE AS all_s, (SELECT count(*) FROM bf)::DOUBLE AS all_t),
gain AS (SELECT g.bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000)
                / ((coalesce(s, 0) + 1)::DOUBLE * (all_t + 10000)))) AS BIGINT) AS gain
         FROM (SELECT CAST(range AS BIGINT) AS bucket FROM range(10000)) g LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), n),
m AS (SELECT r, count(*) AS n_features, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
      FROM df JOIN kinds USING (f) JOIN gain USING (bucket) GROUP BY r),
o AS (SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8]
                                                               AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
      FROM d LEFT JOIN m USING (r)),
p AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place, count(*) OVER () AS fit
      FROM o WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * fit // 100 THEN place END AS rank FROM o LEFT JOIN p USING (r)
""",
}
