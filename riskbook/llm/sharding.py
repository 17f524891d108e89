"""A full random permutation of all rows, cut into shards, by a two-pass external shuffle.

Pass 1 scatters the rows by a seeded hash of their id into buckets that fit in memory; pass 2 shuffles each bucket by
Fisher-Yates and writes it. The buckets one after the other are the permutation; shard k of n holds its k-th n-th, so
the shards' row counts differ by one at most (law ``rows``).

Before pass 1, one scan adds up the bytes of all rows, of which the number of buckets follows, and a second one counts
rows and bytes per bucket, of which the place of each bucket follows: 16 bytes a bucket come to the driver. Rows with
one id share a hash; ids that alone fill half a bucket are found with the bytes of each id in the buckets that are too
large, of which there are as many as the bytes make room for. Their rows are hashed by their whole content too, and
those that still crowd, being copies of one row, are counted and dealt out by a copy number, which all copies share
alike.

The result depends on rows and seed alone, not on how the table is stored or read, so reruns agree.

* null text: 0 bytes; null ids: hashed as one id, told apart by content;
* very long text: a bucket may grow by it;
* repeated rows: each is placed on its own; empty tables: no rows in any shard;
* other columns: written along with the row; they may have any name. Their types must allow grouping (no maps).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskbook.llm.common import stored, utf8_size

BUCKET_BYTES = 32 << 20
# A bucket so many times as large as meant is searched for crowds.
TOO_LARGE = 1.5
# Copies made at a time from one counted row.
COPIES = 10_000
ROWS_OUT = 10_000
# Keys are told apart by their place among so many when they are dealt to buckets.
PARTS = 1 << 40


def _bytes_held(df: DataFrame) -> Column:
    """About the bytes of a row: texts and binaries by their length, other nested columns as printed, 8 for the rest."""
    size = F.lit(8 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size += utf8_size(column)
        elif isinstance(field.dataType, (T.ArrayType, T.StructType)):
            size += utf8_size(column.cast("string"))
    return size


def _bucket(key: Column, buckets: int) -> Column:
    """The bucket of a key: its place among all keys, in equal parts."""
    return F.floor(F.pmod(key, F.lit(PARTS)) * buckets / F.lit(PARTS)).cast("int")


def _per_bucket(rows: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and bytes of each bucket."""
    got = rows.groupBy(_bucket(F.col("key"), buckets).alias("bucket")).agg(F.count("*").alias("n"), F.sum("held").alias("held"))
    found = got.toArrow()
    counts, sizes = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    sizes[found["bucket"].to_numpy()] = found["held"].to_numpy()
    return counts, sizes


def _spread_crowds(rows: DataFrame, large: DataFrame, buckets: int, bucket_bytes: int, seed: int) -> DataFrame:
    """Gives the rows of crowded keys, which lie in the large buckets, keys by their whole content and the number of the
    copy."""
    slim = rows.select("key", "held", _bucket(F.col("key"), buckets).alias("bucket")).join(large, "bucket", "left_semi")
    sums = slim.groupBy("key").agg(F.count("*").alias("n"), F.sum("held").alias("held"))
    crowds = stored(sums.where((F.col("n") > 1) & (2 * F.col("held") > bucket_bytes)).select("key"), "crowds")
    copies = rows.join(crowds, "key", "left_semi").groupBy("row", "size", "held").agg(F.count("*").alias("n"))
    portions = copies.select(
        "row", "size", "held", "n",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))).alias("low"),
    )
    each = portions.repartition("row", "low").select(
        "row", "size", "held", F.explode(F.sequence("low", F.least(F.col("n"), F.col("low") + COPIES) - 1)).alias("copy")
    )
    spread = each.select("row", "size", "held", F.xxhash64(F.lit(seed), "row", "copy").alias("key"))
    return rows.join(crowds, "key", "left_anti").select("row", "size", "held", "key").union(spread)


def shuffled_into_shards(
    df: DataFrame,
    path: str,
    shards: int,
    seed: int = 0,
    text: str = "text",
    id_col: str = "doc_id",
    bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Writes the rows of ``df`` as Parquet under ``path/shard=<k>``: ``row`` is the row of ``df``, ``slot`` its place in
    the shard, counted from 0 without gaps, ``size`` its bytes of text plus one. Files of a shard hold rows in order."""
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        (utf8_size(F.col(f"`{text}`")) + 1).alias("size"),
        F.xxhash64(F.lit(seed), F.col(f"`{id_col}`")).alias("key"),
        _bytes_held(df).alias("held"),
    )
    total = rows.agg(F.sum("held")).first()[0] or 0
    buckets = max(1, -(-int(total) // bucket_bytes))
    counts, sizes = _per_bucket(rows, buckets)
    n_rows = int(counts.sum())
    large = np.flatnonzero((counts > 1) & (sizes > TOO_LARGE * bucket_bytes))
    if len(large):
        spark = df.sparkSession
        table = spark.createDataFrame(pa.table({"bucket": pa.array(large.astype(np.int32))}))
        rows = _spread_crowds(rows, table, buckets, bucket_bytes, seed)
        counts, _ = _per_bucket(rows, buckets)
    before = df.sparkSession.sparkContext.broadcast(np.concatenate([[0], np.cumsum(counts)]))
    # Shard k begins where the k-th of equal shares does.
    begins = np.array([-(-n_rows * k // shards) for k in range(shards + 1)], dtype=np.int64)

    bucket = _bucket(F.col("key"), buckets)
    scattered = rows.drop("held").withColumn("bucket", bucket).withColumn("check", F.xxhash64("row"))
    # One bucket, one task.
    sorted_in = scattered.repartitionById(buckets, "bucket").sortWithinPartitions("key", "check")

    def run(batches):
        table = pa.Table.from_batches([batch for batch in batches if batch.num_rows] or [empty])
        if not table.num_rows:
            return
        number = table["bucket"][0].as_py()
        if table.num_rows != before.value[number + 1] - before.value[number]:
            raise RuntimeError(f"bucket {number} has other rows than were counted: the input changed meanwhile")
        # numpy shuffles by Fisher-Yates.
        order = np.random.default_rng([seed & 0xFFFFFFFF, number]).permutation(table.num_rows)
        place = before.value[number] + np.arange(table.num_rows)
        shard = np.searchsorted(begins, place, side="right") - 1
        picked = table.select(["row", "size"]).take(pa.array(order))
        out = [picked["row"], picked["size"], pa.array(place - begins[shard]), pa.array(shard.astype(np.int32))]
        shuffled = pa.table(out, names=["row", "size", "slot", "shard"])
        yield from shuffled.combine_chunks().to_batches(max_chunksize=ROWS_OUT)

    empty = pa.RecordBatch.from_pylist([], schema=pa.schema([("bucket", pa.int32())]))
    row_type = sorted_in.schema["row"].dataType.simpleString()
    written = sorted_in.mapInArrow(run, f"row {row_type}, size long, slot long, shard int")
    written.write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, row_type: str) -> DataFrame:
    """All rows of all shards; ``row_type`` is the type of ``row``, which an empty folder does not tell."""
    return spark.read.schema(f"row {row_type}, size long, slot long, shard int").parquet(path)
