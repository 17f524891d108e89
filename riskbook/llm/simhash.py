"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked at a few differing bits.

Fingerprints that differ in at most ``d`` bits are cut into ``d // 2 + 1`` segments, so that in one of them they differ
in one bit at most. Each distinct fingerprint is indexed 64 times: once for every bit, by that bit's segment with the
bit left out. Two fingerprints whose segments differ at most there share that key; whatever shares a key is compared
bit by bit. Keys are met in sorted runs, and a run gives back the links of a spanning forest, not all its pairs.

* null text: as the empty text, fingerprint 0;
* empty texts and texts of white space: fingerprint 0, linked like any other;
* fewer words than a shingle: one shingle of all words;
* very long text: hashed whole, shingle by shingle;
* equal texts: one fingerprint, indexed once;
* null ids: get a component, but its id is the smallest id that is not null (null if there is none); repeated ids:
  every row is kept;
* other columns: not looked at by ``components``; ``one_of_each`` keeps all columns of its table, and of rows that agree
  in all of them, one.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import portions, stored
from riskbook.llm.components import connected_components

SEED = 42
BITS = 64
# Runs up to this length are compared all at once, longer ones outwards from what is linked already.
SHORT_RUN = 32
COMPARED_AT_ONCE = 1 << 22
SALTS = 16


def shingle_hashes(text: str | None, size: int) -> list[int]:
    """XXH64 of every shingle, repeats included; words are those between ASCII white space, A to Z in lower case."""
    words = (text or "").encode().lower().split()
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    data = b" ".join(words)
    ends = list(accumulate(map(len, words)))
    hashed = xxhash.xxh64_intdigest
    # The k-th word ends k blanks later than without blanks, and the next one begins a blank later.
    starts = [0, *[end + k for k, end in enumerate(ends[:-size], 1)]]
    stops = [end + k for k, end in enumerate(ends[size - 1 :], size - 1)]
    return [hashed(data[a:b], SEED) for a, b in zip(starts, stops)]


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For consecutive groups of hashes, the bits set in over half of a group; 0 for an empty group.

    Bits are added up eight at a time in the bytes of a word, over stretches of up to 255 hashes.
    """
    out = np.zeros(len(counts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    sizes = counts[full]
    pieces = -(-sizes // 255)
    group = np.repeat(np.arange(len(full)), pieces)
    within = np.arange(len(group)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = (np.cumsum(sizes) - sizes)[group] + 255 * within
    firsts = np.cumsum(pieces) - pieces
    lanes = np.uint64(0x0101010101010101)
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & lanes, cuts)
        totals = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), firsts, axis=0)
        # Byte k of a little-endian word holds bit 8 k + bit.
        for k in range(8):
            out[full] |= (2 * totals[:, k] > sizes).astype(np.uint64) << np.uint64(8 * k + bit)
    return out


def fingerprint(text: Column, size: int) -> Column:
    """The fingerprint of a text as a signed long."""

    @F.arrow_udf("long")
    def make(column: pa.Array) -> pa.Array:
        made = [np.empty(0, dtype=np.uint64)]
        for start, length in portions(column):
            hashes = [np.array(shingle_hashes(t.as_py(), size), dtype=np.uint64) for t in column.slice(start, length)]
            made.append(majority_bits(np.concatenate(hashes), np.array([len(h) for h in hashes])))
        return pa.array(np.concatenate(made).view(np.int64))

    return make(text)


def as_hex(fp: Column) -> Column:
    """Sixteen lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _segments(distance: int) -> list[tuple[int, int]]:
    """First bit and length of each segment; lengths differ by one at most."""
    n = distance // 2 + 1
    ends = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask).cast("long")


def _keys(fp: Column, distance: int) -> Column:
    """The keys of a fingerprint: for each bit its segment without that bit, and which bit it is. A segment that leaves
    no room for the number is hashed with it; what shares a key is compared anyway."""
    keys = []
    for start, length in _segments(distance):
        segment = F.shiftrightunsigned(fp, start).bitwiseAND(_signed((1 << length) - 1))
        for bit in range(length):
            left, number = segment.bitwiseAND(_signed(((1 << length) - 1) ^ (1 << bit))), F.lit(start + bit)
            wide = length + 6 >= BITS
            keys.append(F.xxhash64(left, number) if wide else F.shiftleft(left, 6).bitwiseOR(number.cast("long")))
    return F.array(*keys)


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= distance


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index that links (a, b) among n indices join to each index."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _long_run(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest: what is linked leaves the rest, and only the rest is compared again."""
    children, parents, rest = [], [], fps
    while len(rest):
        root, rest = rest[0], rest[1:]
        front = np.array([root])
        while len(front) and len(rest):
            near = np.zeros(len(rest), dtype=bool)
            step = max(1, COMPARED_AT_ONCE // len(rest))
            for k in range(0, len(front), step):
                near |= _near(front[k : k + step, None], rest[None, :], distance).any(axis=0)
            front, rest = rest[near], rest[~near]
            children.append(front)
            parents.append(np.full(len(front), root))
    none = np.empty(0, dtype=np.uint64)
    return np.concatenate([none, *children]), np.concatenate([none, *parents])


def _links_of(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys, each from a fingerprint to one that stands for its part of the run."""
    starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1)) if len(keys) else np.empty(0, dtype=np.int64)
    sizes = np.diff(np.append(starts, len(keys)))
    children, parents = [], []
    for start, size in zip(starts[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN]):
        child, parent = _long_run(fps[start : start + size], distance)
        children.append(child)
        parents.append(parent)
    short = np.repeat((sizes > 1) & (sizes <= SHORT_RUN), sizes)
    keys, fps = keys[short], fps[short]
    a, b = [], []
    for shift in range(1, min(SHORT_RUN, len(keys))):
        same = np.flatnonzero(keys[shift:] == keys[:-shift])
        if not len(same):
            break
        same = same[_near(fps[same], fps[same + shift], distance)]
        a.append(same)
        b.append(same + shift)
    if a:
        label = _forest(np.concatenate(a), np.concatenate(b), len(fps))
        moved = np.flatnonzero(label != np.arange(len(fps)))
        children.append(fps[moved])
        parents.append(fps[label[moved]])
    none = np.empty(0, dtype=np.uint64)
    return np.concatenate([none, *children]), np.concatenate([none, *parents])


def links(fps: DataFrame, distance: int, fp: str = "fp") -> DataFrame:
    """Links (``a``, ``b``) between distinct fingerprints that have the same components as all pairs within
    ``distance`` bits."""
    keyed = fps.select(F.explode(_keys(F.col(fp), distance)).alias("key"), F.col(fp).alias("fp"))
    together = keyed.repartition("key").sortWithinPartitions("key", "fp")

    def run(batches):
        keys, held = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            held = np.concatenate([held, batch.column(1).to_numpy().view(np.uint64)])
            # The last run may go on in the next batch.
            done = int(np.searchsorted(keys, keys[-1]))
            if done:
                yield batch_of(*_links_of(keys[:done], held[:done], distance))
                keys, held = keys[done:], held[done:]
        yield batch_of(*_links_of(keys, held, distance))

    def batch_of(a, b):
        unique = np.unique(np.column_stack([a, b]).view(np.int64), axis=0) if len(a) else np.empty((0, 2), dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(unique[:, 0]), pa.array(unique[:, 1])], names=["a", "b"])

    return together.mapInArrow(run, "a long, b long")


def _labelled(rows: DataFrame, first: Column, distance: int) -> DataFrame:
    """Every distinct ``fp`` of ``rows`` with its ``first`` and ``label``, one of the fingerprints of its component;
    null, if it is linked to none."""
    distinct = stored(rows.groupBy("fp").agg(first.alias("first")), "fingerprints")
    labels = connected_components(links(distinct, distance)).withColumnRenamed("node", "fp")
    return stored(distinct.join(labels, "fp", "left").select("fp", "first", "label"), "labels")


def _component_ids(labelled: DataFrame) -> DataFrame:
    """``fp`` and ``component_id``, the least ``first`` of its component. A large component is met in several tasks."""
    alone = labelled.where("label is null").select("fp", F.col("first").alias("component_id"))
    linked = labelled.where("label is not null")
    smallest = linked.groupBy("label").agg(F.min("first").alias("component_id"))
    salted = smallest.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")
    return alone.union(linked.withColumn("salt", salt).join(salted, ["label", "salt"]).select("fp", "component_id"))


def components(
    df: DataFrame, size: int, distance: int, text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """One row per row of ``df``: the id, its ``fingerprint`` in hex and ``component_id``, the smallest id that links of
    at most ``distance`` bits reach."""
    rows = stored(df.select(F.col(f"`{id_col}`").alias("id"), fingerprint(F.col(f"`{text}`"), size).alias("fp")), "rows")
    found = _component_ids(_labelled(rows, F.min("id"), distance))
    return rows.join(found, "fp").select(
        F.col("id").alias(id_col), as_hex(F.col("fp")).alias("fingerprint"), "component_id"
    )


def one_of_each(
    df: DataFrame, size: int, distance: int, text: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """One row of each component, with all columns of ``df``: that of the smallest id (null ids last), of equal ids that
    of the smallest fingerprint, then that of the smallest hash of all columns, so that reruns agree.

    Rows are numbered where they are stored. The winner is found on ids, fingerprints, hashes and numbers alone; whole
    rows move once, to meet the numbers of the winners. Columns must have types that can be hashed (no maps).
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    made = df.select(
        F.struct(*columns).alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        fingerprint(F.col(f"`{text}`"), size).alias("fp"),
        F.xxhash64(*columns).alias("check"),
    )
    # The numbers are those of the stored table, whoever wrote it.
    rows = stored(made.withColumn("number", F.monotonically_increasing_id()), "rows")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "fp", "check", "number")
    labelled = _labelled(rows.select("id", "fp", "check", "number"), F.min(place), distance)
    best = labelled.groupBy(F.coalesce("label", "fp").alias("label")).agg(F.min("first").alias("first"))
    return rows.join(best.select("first.number"), "number", "left_semi").select("row.*")
