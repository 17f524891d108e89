"""Token ids of documents as Huffman-coded files.

The files are a folder with two Parquet tables, so that Spark's committers write them to any store and a lost
executor leaves nothing half-written:

* ``blocks``: independent blocks of about ``BLOCK_IDS`` ids, cut between documents. ``part`` and ``block`` number them
  in ascending order of the documents, ``first`` counts the ids of all blocks before; ``ids`` and ``sizes`` name the
  documents and their token counts; ``bits`` holds the codes and ``checkpoints`` the bit offset of every
  ``CHECKPOINT``-th id, from which decoding can start;
* ``codebook``: the code length of each token id; canonical codes follow from the lengths.

Documents are in ascending order of their id, null ids first, equal ids by the hash of their text. Every document ends
with ``end_id``; a null text is an empty one, so it holds only that. A document longer than a block is a block of its
own. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.llm import huffman, pretokens
from riskbook.llm.common import portions, shared_file, stored

BLOCK_IDS = 1 << 20
CHECKPOINT = 256


def _encoded_blocks(df: DataFrame, file, id_col: str, text: str, end_id: int) -> DataFrame:
    """Blocks of ids in order of the documents; ``at`` counts the ids before a block in its partition."""
    id_type = df.schema[id_col].dataType.simpleString()
    # The position spreads repeated rows over partitions; it is read within one job and decides nothing else.
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    rows = df.select(F.col(id_col).alias("key"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order[:2])
    key_type = ordered.limit(0).toArrow().schema.field("key").type

    def run(batches):
        splitter = pretokens.load(file.value)
        vocabulary = max(splitter.vocabulary, end_id + 1)
        end = np.array([end_id], dtype=splitter.width).tobytes()
        width = len(end)
        part, block, at = TaskContext.get().partitionId(), 0, 0
        keys, sizes, held = [], [], []

        def made():
            data = b"".join(held)
            seen = np.bincount(np.frombuffer(data, splitter.width), minlength=vocabulary).astype("<i4").tobytes()
            values = [part, block, at, sum(sizes), keys, sizes, data, seen]
            arrays = [pa.array([value], field.type) for value, field in zip(values, schema)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema), sum(sizes)

        for keys_of, texts in _portions(batches):
            for key, ids in zip(keys_of, splitter.ids(texts)):
                size = len(ids) // width + 1
                if keys and sum(sizes) + size > BLOCK_IDS:
                    batch, count = made()
                    yield batch
                    block, at, keys, sizes, held = block + 1, at + count, [], [], []
                keys.append(key)
                sizes.append(size)
                held += [ids, end]
        if keys:
            yield made()[0]

    fields = [("part", pa.int32()), ("block", pa.int32()), ("at", pa.int64()), ("n_ids", pa.int64())]
    lists = [("ids", pa.list_(key_type)), ("sizes", pa.list_(pa.int64()))]
    schema = pa.schema([*fields, *lists, ("data", pa.binary()), ("seen", pa.binary())])
    return ordered.mapInArrow(
        run,
        f"part int, block int, at long, n_ids long, ids array<{id_type}>, sizes array<long>, data binary, seen binary",
    )


def _portions(batches):
    """Keys and texts of Arrow batches, a bounded amount of text at a time."""
    for batch in batches:
        for start, length in portions(batch.column(1)):
            part = batch.slice(start, length)
            yield part.column(0).to_pylist(), part.column(1)


def _id_counts(blocks: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs; no more rows than the vocabulary has reach the driver or leave a task."""

    def run(batches):
        counts = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            for seen in batch.column(0):
                counts += np.frombuffer(seen.as_py(), "<i4")
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["id", "n"])

    got = blocks.select("seen").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(vocabulary, dtype=np.int64)
    counts[got["id"].to_numpy()] = got["n"].to_numpy()
    return counts


def write_token_files(
    df: DataFrame, path: str, tokenizer_path: str, end_id: int, text: str = "text", id_col: str = "doc_id"
) -> None:
    """Encodes every text and writes the folder described above."""
    spark = df.sparkSession
    file = shared_file(spark, tokenizer_path)
    splitter = pretokens.load(file.value)
    width, vocabulary = splitter.width, max(splitter.vocabulary, end_id + 1)
    blocks = stored(_encoded_blocks(df, file, id_col, text, end_id), "token-ids", "snappy")
    lengths = huffman.code_lengths(_id_counts(blocks, vocabulary))
    codes = huffman.canonical_codes(lengths)
    # One number per partition.
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").toArrow()
    before = dict(zip(totals["part"].to_pylist(), np.cumsum([0, *totals["n"].to_pylist()]).tolist()))
    book = spark.sparkContext.broadcast((lengths, codes, before))

    def run(batches):
        lengths, codes, before = book.value
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["data"], width)
                bits, checkpoints = huffman.encode(ids, lengths, codes, CHECKPOINT)
                made = {k: [row[k]] for k in ("part", "block", "n_ids", "ids", "sizes")}
                made |= {"first": [before[row["part"]] + row["at"]], "checkpoints": [checkpoints.tolist()], "bits": [bits]}
                kinds = {"ids": batch.schema.field("ids").type, "part": pa.int32(), "block": pa.int32()}
                arrays = [pa.array(made[k], kinds.get(k)) for k in names]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["part", "block", "first", "n_ids", "ids", "sizes", "checkpoints", "bits"]
    id_type = df.schema[id_col].dataType.simpleString()
    schema = (
        f"part int, block int, first long, n_ids long, ids array<{id_type}>, sizes array<long>, "
        "checkpoints array<long>, bits binary"
    )
    blocks.drop("seen").mapInArrow(run, schema).write.option("compression", "snappy").parquet(f"{path}/blocks")
    book_rows = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(book_rows, "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document, decoded block by block: its id, ``start`` (ids of all documents before it), ``n_tokens``
    and ``ids``, little-endian unsigned 32-bit integers."""
    blocks = spark.read.parquet(f"{path}/blocks")
    # As long as the vocabulary.
    entries = spark.read.parquet(f"{path}/codebook").toArrow()
    symbols = entries["id"].to_numpy()
    lengths = np.zeros(int(symbols.max(initial=-1)) + 1, dtype=np.uint8)
    lengths[symbols] = entries["bits"].to_numpy()
    book = spark.sparkContext.broadcast(lengths)

    def run(batches):
        table = huffman.decode_table(book.value)
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for row in batch.to_pylist():
                ids = huffman.decode(row["bits"], row["n_ids"], np.array(row["checkpoints"]), CHECKPOINT, table)
                data = ids.astype("<u4").tobytes()
                ends = np.concatenate([[0], np.cumsum(row["sizes"])])
                packed = [data[4 * a : 4 * b] for a, b in zip(ends[:-1], ends[1:])]
                arrays = [pa.array(row["ids"], kind), pa.array(ends[:-1] + row["first"]), pa.array(row["sizes"]), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "start", "n_tokens", "ids"])

    id_type = blocks.schema["ids"].dataType.elementType.simpleString()
    return blocks.drop("part", "block").mapInArrow(run, f"`{id_col}` {id_type}, start long, n_tokens long, ids binary")
