"""Token counts without token ids: each distinct pre-token is merged once and its piece count joined to the documents.

1. Documents are split into pre-tokens block by block (``BLOCK_BYTES`` of text). A block lists its distinct pre-tokens
   once, and for each document the places in that list with their frequencies.
2. The (pre-token, block and place) rows are shuffled and sorted by pre-token. There are at most as many rows for one
   pre-token as there are blocks, however often it occurs. Each run of equal pre-tokens is counted once with the library.
3. The counts go back to their blocks, and join the per-document frequencies there: the sum of frequency times pieces
   is the number of tokens, to which added tokens inside the text (one each) are added.

* null text: counts as the empty text, 0 bytes and 0 tokens;
* very long text: a block of its own, never cut;
* null or repeated ids: every row is counted on its own; rows are matched by block, not by id;
* other columns: not looked at and not returned.
"""

from __future__ import annotations

from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.llm import pretokens
from riskbook.llm.common import shared_file, stored

BLOCK_BYTES = 16 << 20
# A place in a block's list takes these bits of a row's number, the block's number in its partition the next ones.
PLACE_BITS, SEQUENCE_BITS = 26, 16
# Counted rows that are sorted back into blocks at a time.
RETURNED = 1 << 19


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in little space: differences, lowest bytes first, compressed."""
    steps = np.diff(numbers, prepend=0).astype("<i4")
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i4").reshape(-1).astype(np.int64))


class _Block:
    """Documents gathered so far, the places of their pre-tokens and how often each occurs."""

    def __init__(self):
        self.held, self.ids, self.sizes, self.added, self.counts = 0, [], [], [], []
        self.place: dict[str, int] = {}
        self.places, self.times = array("i"), array("i")

    def add(self, key, size: int, words: list[str], specials: int) -> None:
        often, place = Counter(words), self.place
        for word in often:
            if word not in place:
                place[word] = len(place)
        self.places.extend(map(place.__getitem__, often))
        self.times.extend(often.values())
        self.held += size
        self.ids.append(key)
        self.sizes.append(size)
        self.added.append(specials)
        self.counts.append(len(often))

    def columns(self) -> list:
        if len(self.place) >> PLACE_BITS:
            raise RuntimeError(f"a text has more than 2 ** {PLACE_BITS} distinct pre-tokens")
        places, times = np.array(self.places, dtype=np.int64), np.array(self.times, dtype=np.int64)
        # By document and place, which makes the differences small.
        order = np.argsort((np.repeat(np.arange(len(self.ids)), self.counts) << PLACE_BITS) + places)
        return [
            self.ids, self.sizes, self.added, self.counts, _packed(places[order]), _packed(times[order]), list(self.place)
        ]


def _blocks(df: DataFrame, file, id_type: str) -> DataFrame:
    """Blocks of documents: ids, bytes, added tokens, distinct pre-tokens and, per document, places and frequencies."""

    def run(batches):
        splitter = pretokens.load(file.value)
        number, block = TaskContext.get().partitionId() << SEQUENCE_BITS, _Block()
        for batch in batches:
            key_type = batch.column(0).type
            for key, text in zip(batch.column(0).to_pylist(), (t.as_py() for t in batch.column(1))):
                size = len(text.encode()) if text else 0
                if block.ids and block.held + size > BLOCK_BYTES:
                    yield row(number, block, key_type)
                    number, block = number + 1, _Block()
                block.add(key, size, *splitter.of(text or ""))
        if block.ids:
            yield row(number, block, key_type)

    def row(number, block, key_type):
        if number >> SEQUENCE_BITS != TaskContext.get().partitionId():
            raise RuntimeError(f"a partition has more than 2 ** {SEQUENCE_BITS} blocks; read it in smaller ones")
        lists = [pa.list_(key_type), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]
        kinds = [pa.int64(), *lists, pa.binary(), pa.binary(), pa.list_(pa.string())]
        arrays = [pa.array([value], kind) for value, kind in zip([number, *block.columns()], kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["block", "ids", "sizes", "added", "counts", "places", "times", "words"]
    return df.mapInArrow(
        run,
        f"block long, ids array<{id_type}>, sizes array<long>, added array<int>, counts array<int>, places binary, "
        "times binary, words array<string>",
    )


def _counted(words: DataFrame, file) -> DataFrame:
    """Rows (``block``, ``places``, ``pieces``) from rows (word, at) that lie together by word and are sorted by it."""

    def run(batches):
        splitter = pretokens.load(file.value)
        last, last_pieces, held, at, pieces = None, 0, 0, [], []
        for batch in batches:
            column = batch.column(0).dictionary_encode()
            distinct = column.dictionary.to_pylist()
            if not distinct:
                continue
            # A run may go on from the batch before; its word is not merged again.
            skip = int(distinct[0] == last)
            counted = np.concatenate([np.full(skip, last_pieces, dtype=np.int64), splitter.counts(distinct[skip:])])
            last, last_pieces = distinct[-1], int(counted[-1])
            at.append(batch.column(1).to_numpy())
            pieces.append(counted[column.indices.to_numpy()])
            held += batch.num_rows
            if held >= RETURNED:
                yield returned(np.concatenate(at), np.concatenate(pieces))
                held, at, pieces = 0, [], []
        if held:
            yield returned(np.concatenate(at), np.concatenate(pieces))

    def returned(at, pieces):
        order = np.argsort(at)
        at, pieces = at[order], pieces[order]
        starts = np.flatnonzero(np.diff(at >> PLACE_BITS, prepend=-1))
        ends = [*starts[1:], len(at)]
        places = [_packed(at[a:b] & ((1 << PLACE_BITS) - 1)) for a, b in zip(starts, ends)]
        counts = [_packed(pieces[a:b]) for a, b in zip(starts, ends)]
        arrays = [pa.array(at[starts] >> PLACE_BITS), pa.array(places, pa.binary()), pa.array(counts, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["block", "places", "pieces"])

    return words.mapInArrow(run, "block long, places binary, pieces binary")


def _summed(joined: DataFrame, id_col: str, id_type: str) -> DataFrame:
    """One row per document of blocks that hold their pre-tokens' piece counts."""

    def run(batches):
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for row in batch.to_pylist():
                pieces = np.zeros(row["n_words"], dtype=np.int64)
                for part in row["counted"] or ():
                    pieces[_unpacked(part["places"])] = _unpacked(part["pieces"])
                each = pieces[_unpacked(row["places"])] * _unpacked(row["times"])
                upto, ends = np.concatenate([[0], np.cumsum(each)]), np.concatenate([[0], np.cumsum(row["counts"])])
                tokens = upto[ends[1:]] - upto[ends[:-1]] + np.array(row["added"])
                arrays = [pa.array(row["ids"], kind), pa.array(row["sizes"]), pa.array(tokens)]
                yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "n_bytes", "n_tokens"])

    return joined.mapInArrow(run, f"`{id_col}` {id_type}, n_bytes long, n_tokens long")


def token_counts(df: DataFrame, tokenizer_path: str, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``n_bytes`` (UTF-8) and ``n_tokens`` of every row of ``df``, as the library counts without begin, end or added
    special tokens."""
    file = shared_file(df.sparkSession, tokenizer_path)
    id_type = df.schema[id_col].dataType.simpleString()
    blocks = stored(_blocks(df.select(id_col, text), file, id_type), "pretokens")
    words = blocks.select("block", F.posexplode("words").alias("place", "word"))
    at = F.shiftleft("block", PLACE_BITS).bitwiseOR(F.col("place").cast("long"))
    counted = _counted(words.select("word", at.alias("at")).repartition("word").sortWithinPartitions("word"), file)
    by_block = counted.groupBy("block").agg(F.collect_list(F.struct("places", "pieces")).alias("counted"))
    bare = blocks.withColumn("n_words", F.size("words")).drop("words")
    return _summed(bare.join(by_block, "block", "left"), id_col, id_type)
