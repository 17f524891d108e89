"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next.

Every stage but the last returns the columns of its documents, in their order; columns that documents have besides the
ones used here come along. A stage treats nulls, empty and very long texts, ties and empty tables as its operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.llm import byte_bpe, mixing, pseudonyms, quality_rules, simhash
from riskbook.llm.common import ship_package
from riskbook.llm.queries import DISTANCE, POLICY, RANKS_50K, SHINGLE, pseudonym_key
from riskbook.sources.publish import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the policy."""
    ship_package(spark)
    return quality_rules.kept(docs, POLICY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship_package(spark)
    return simhash.one_of_each(docs, SHINGLE, DISTANCE)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms; ``n_chars`` follows the text, since octets have one to three digits."""
    hidden = pseudonyms.pseudonymised(docs, pseudonym_key(spark), count=None)
    if "n_chars" not in docs.columns:
        return hidden
    kind = docs.schema["n_chars"].dataType
    return hidden.withColumn("n_chars", F.length("text").cast(kind))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The id, the number of tokens and the token ids of each document of the mix, and a digest of the bytes that these
    ids decode to."""
    ship_package(spark)
    ranks, give = public_tokenizers.path(RANKS_50K), ("n_tokens", "ids", "decoded")
    encoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, give=give)
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("SimHash near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mix),
    ("byte-level BPE", tokens),
]
# Fingerprints, pseudonyms and tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage-" + name.lower().replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
