"""Periodic runs of words: stretches that repeat a block of words several times over, found by block convolution.

A run is a stretch of consecutive words with smallest period ``q`` that holds at least ``TIMES`` periods and ``LEAST``
words and that no neighbouring word extends. At each dyadic scale ``B`` the words are cut into blocks of ``B``. A run
whose period lies in ``[B, 2 B)`` holds a block together with its next occurrence, ``q`` words on. For every block the
sum of squared differences to each place of the following window comes out of an exact integer number-theoretic
transform; where it is zero, the distance is a seed. Seeds of neighbouring blocks at one distance are joined, extended
word by word at both ends, and kept if they reach the length. Words go by numbers, and sums are taken modulo a prime: a
sum that is zero there without being zero makes a seed that the extension throws out, and none is missed. Below
``SMALLEST`` words a block, the differences are formed directly.

Distances within a run already found, at multiples of its period, are not seeds. With them gone, a scale has only as
many extensions as blocks, so the work stays in proportion to the words times the squared logarithm of a text's length.

* null words: no runs; no words, or fewer than ``LEAST``: no runs; very long text: taken whole, alone;
* ties of length: told apart by start and period; repeated rows, ids and other columns: not looked at, each row of
  words has its own runs; empty tables: no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import PORTION

TIMES = 4
LEAST = 6
# Blocks of at least so many words are convolved by transforms.
SMALLEST = 16
# The prime has roots of unity for transforms of up to 2 ** 23 numbers; 3 generates them.
PRIME = 998_244_353
GENERATOR = 3
# Numbers that are transformed at a time, a row of blocks.
AT_ONCE = 1 << 16

SPACES = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


@lru_cache(maxsize=64)
def _roots(size: int, inverse: bool) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a root of unity of order ``size``, and their quotients by the prime, scaled by 2 ** 32."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    root = pow(root, PRIME - 2, PRIME) if inverse else root
    powers = np.ones(max(1, size // 2), dtype=np.uint64)
    done, step = 1, root
    while done < len(powers):
        powers[done : 2 * done] = powers[:done] * np.uint64(step) % np.uint64(PRIME)
        done, step = 2 * done, step * step % PRIME
    return powers, (powers << np.uint64(32)) // np.uint64(PRIME)


def _times_roots(x: np.ndarray, roots: np.ndarray, quotients: np.ndarray) -> np.ndarray:
    """Products modulo the prime, without a division; ``x`` is below 2 ** 32."""
    out = x * roots - ((x * quotients) >> np.uint64(32)) * np.uint64(PRIME)
    return np.minimum(out, out - np.uint64(PRIME))


def _transformed(rows: np.ndarray) -> np.ndarray:
    """The transform of each row, in bit-reversed order."""
    rows = rows.copy()
    n, prime = rows.shape[1], np.uint64(PRIME)
    half = n // 2
    while half:
        parts = rows.reshape(len(rows), -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1]
        total, rest = low + high, low + (prime - high)
        parts[:, :, 0] = np.minimum(total, total - prime)
        parts[:, :, 1] = _times_roots(rest, *_roots(2 * half, False))
        half //= 2
    return rows


def _back(rows: np.ndarray) -> np.ndarray:
    """Rows whose transforms these are, from bit-reversed order."""
    n, prime, half = rows.shape[1], np.uint64(PRIME), 1
    while half < n:
        parts = rows.reshape(len(rows), -1, 2, half)
        low, high = parts[:, :, 0].copy(), _times_roots(parts[:, :, 1], *_roots(2 * half, True))
        total, rest = low + high, low + (prime - high)
        parts[:, :, 0] = np.minimum(total, total - prime)
        parts[:, :, 1] = np.minimum(rest, rest - prime)
        half *= 2
    return rows * np.uint64(pow(n, PRIME - 2, PRIME)) % prime


def zero_differences(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the blocks of ``size`` words, and the distances from ``size`` to below twice that, at which the sum of
    squared differences is zero modulo the prime."""
    prime = np.uint64(PRIME)
    blocks = max(0, (len(codes) - 2 * size) // size + 1)
    # The window behind the last block may end with the text: what is missing differs from everything.
    codes = np.concatenate([codes.astype(np.uint64), np.full(2 * size, codes.max(initial=0) + 1, dtype=np.uint64)])
    squares = np.concatenate([[0], np.cumsum(codes * codes % prime)]).astype(np.uint64)
    at_once = max(1, AT_ONCE // (2 * size))
    starts, distances = [], []
    for low in range(0, blocks, at_once):
        first = np.arange(low, min(blocks, low + at_once)) * size
        block = np.zeros((len(first), 2 * size), dtype=np.uint64)
        # A block turned round makes the product of transforms a correlation.
        block[:, :size] = codes[first[:, None] + np.arange(size)[::-1]]
        window = codes[first[:, None] + np.arange(size, 3 * size)]
        both = _transformed(block) * _transformed(window) % prime
        crossed = _back(both)[:, size - 1 : 2 * size - 1]
        ends = first[:, None] + np.arange(size, 2 * size)
        sums = (squares[first + size] - squares[first])[:, None] + squares[ends + size] - squares[ends]
        row, at = np.nonzero(sums % prime == 2 * crossed % prime)
        starts.append(first[row])
        distances.append(at + size)
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *starts]), np.concatenate([none, *distances])


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]])))
    return edges[::2], edges[1::2]


def _found(begin: np.ndarray, end: np.ndarray, period: int | np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of stretches of equal words at a distance, where they are long enough."""
    length = end - begin + period
    rows = np.column_stack([begin, length, np.broadcast_to(period, begin.shape)])
    return rows[(length >= TIMES * rows[:, 2]) & (length >= LEAST)]


def _not_known(starts: np.ndarray, distances: np.ndarray, size: int, runs: np.ndarray) -> np.ndarray:
    """Which seeds do not lie, block and occurrence, in a run at a multiple of its period."""
    new = np.ones(len(starts), dtype=bool)
    for start, length, period in runs[runs[:, 1] >= 2 * size].tolist():
        low, high = np.searchsorted(starts, [start, start + length])
        inside = starts[low:high] + distances[low:high] + size <= start + length
        new[low:high] &= ~(inside & (distances[low:high] % period == 0))
    return new


def _extended(codes: np.ndarray, begin: np.ndarray, end: np.ndarray, distance: np.ndarray, size: int):
    """The widest stretches of equal words at each distance: less than a block is missing at either end."""
    ends = []
    for at, step in ((begin - 1, -1), (end, 1)):
        places = at[:, None] + step * np.arange(size)
        others = places + distance[:, None]
        inside = (places >= 0) & (others < len(codes))
        same = inside & (codes[np.where(inside, places, 0)] == codes[np.where(inside, others, 0)])
        ends.append(np.cumprod(same, axis=1).sum(axis=1))
    return begin - ends[0], end + ends[1]


def _runs_of_scale(codes: np.ndarray, size: int, known: np.ndarray) -> np.ndarray:
    """Runs with periods from ``size`` to below twice that, and some of known runs once more."""
    starts, distances = zero_differences(codes, size)
    order = np.argsort(starts, kind="stable")
    starts, distances = starts[order], distances[order]
    new = _not_known(starts, distances, size, known)
    starts, distances = starts[new], distances[new]
    if not len(starts):
        return np.empty((0, 3), dtype=np.int64)
    # A run long enough holds two neighbouring blocks at least.
    order = np.lexsort((starts, distances))
    starts, distances = starts[order], distances[order]
    begins = np.concatenate([[True], (np.diff(distances) != 0) | (np.diff(starts) != size)])
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(starts)) - 1
    first, last = first[last > first], last[last > first]
    found = [np.empty((0, 3), dtype=np.int64)]
    at_once = max(1, AT_ONCE // size)
    for low in range(0, len(first), at_once):
        a, b = first[low : low + at_once], last[low : low + at_once]
        distance = distances[a]
        begin, end = _extended(codes, starts[a], starts[b] + size, distance, size)
        # Blocks whose sums are zero only modulo the prime show as words that differ within the chain.
        for k in range(len(a)):
            here = slice(begin[k], end[k])
            same = codes[here] == codes[begin[k] + distance[k] : end[k] + distance[k]]
            if same.all():
                found.append(_found(begin[k : k + 1], end[k : k + 1], int(distance[k])))
            else:
                inner = _stretches(same)
                found.append(_found(inner[0] + begin[k], inner[1] + begin[k], int(distance[k])))
    return np.concatenate(found)


def _smallest_periods(runs: np.ndarray) -> np.ndarray:
    """One row per stretch: a stretch with two periods shows with the smaller one."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    again = np.concatenate([[False], (np.diff(runs[:, 0]) == 0) & (np.diff(runs[:, 1]) == 0)])[: len(runs)]
    return runs[~again]


def runs_of(codes: np.ndarray, longest: int | None = None) -> np.ndarray:
    """Rows (start, length, period) of the runs of a sequence of numbers, by start and period. ``longest`` is the length
    of the longest text in it, if texts are joined by numbers that occur once."""
    most = (len(codes) if longest is None else longest) // TIMES
    found = [np.empty((0, 3), dtype=np.int64)]
    for distance in range(1, min(most, SMALLEST - 1) + 1):
        found.append(_found(*_stretches(codes[:-distance] == codes[distance:]), distance))
    runs, size = _smallest_periods(np.concatenate(found)), SMALLEST
    while size <= most:
        runs = _smallest_periods(np.concatenate([runs, _runs_of_scale(codes, size, runs)]))
        size *= 2
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of_texts(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The owner and (start, length, period) of the runs of several texts, given one after the other. Texts of about one
    length are searched together, so that a long one does not make short ones pass through its scales."""
    sizes = np.diff(offsets)
    scales = np.frexp(np.maximum(sizes, 1))[1]
    owners, rows = [np.empty(0, dtype=np.int64)], [np.empty((0, 3), dtype=np.int64)]
    for scale in np.unique(scales[sizes >= LEAST]):
        chosen = np.flatnonzero((scales == scale) & (sizes >= LEAST))
        # Each text is followed by a number that occurs nowhere else.
        begins = np.cumsum([0, *(sizes[chosen] + 1)])
        joined = np.empty(begins[-1], dtype=np.int64)
        for k, text in enumerate(chosen):
            joined[begins[k] : begins[k + 1] - 1] = codes[offsets[text] : offsets[text + 1]]
        joined[begins[1:] - 1] = codes.max() + 1 + np.arange(len(chosen))
        found = runs_of(joined, int(sizes[chosen].max()))
        text = np.searchsorted(begins, found[:, 0], side="right") - 1
        owners.append(chosen[text])
        rows.append(found - np.column_stack([begins[text], 0 * text, 0 * text]))
    owner, found = np.concatenate(owners), np.concatenate(rows)
    order = np.lexsort((found[:, 2], found[:, 0], owner))
    return owner[order], found[order]


def repeats(sizes: np.ndarray, offsets: np.ndarray, owner: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Which words lie in a run behind its first period."""
    edges = np.zeros(int(sizes.sum()) + 1, dtype=np.int64)
    begin = offsets[owner] + runs[:, 0]
    np.add.at(edges, begin + runs[:, 2], 1)
    np.add.at(edges, begin + runs[:, 1], -1)
    return np.cumsum(edges[:-1]) > 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _portion(lists: pa.ListArray) -> pa.StructArray:
    """Runs and collapsed texts of lists of words without nulls."""
    words = pc.list_flatten(lists)
    sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    owner, runs = runs_of_texts(codes, offsets)
    kept = ~repeats(sizes, offsets, owner, runs)
    ends = np.concatenate([[0], np.cumsum(kept)])[offsets]
    left = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), words.filter(pa.array(kept)))
    counts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sizes)))])
    values = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in range(3)], fields=list(_RUN))
    found = pa.ListArray.from_arrays(pa.array(counts.astype(np.int32)), values)
    return pa.StructArray.from_arrays([found, pc.binary_join(left, " ")], names=["runs", "collapsed"])


def _portions(lists: pa.ListArray):
    """Start and number of lists that hold about ``PORTION`` bytes, one list at least."""
    ends = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values
    sizes = np.concatenate([[0], np.cumsum(pc.binary_length(values).to_numpy().astype(np.int64) + 8)])
    at, start = sizes[ends], 0
    while start < len(lists):
        stop = max(start + 1, int(np.searchsorted(at, at[start] + PORTION, side="right")) - 1)
        yield start, stop - start
        start = stop


def with_runs(df: DataFrame, words: str = "words", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``df`` with two more columns in place of its array of words: ``runs``, an array of (``start``, ``length``,
    ``period``) by start and period, and ``collapsed``, the words joined by one space without those that repeat a run's
    first period."""
    names = [c for c in df.columns if c != words]
    # Numbered, so that names may be any.
    fields = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)]
    rows = df.select(F.struct(F.lit(0).alias("none"), *fields).alias("row"), F.col(f"`{words}`").alias("words"))

    def found(batches):
        for batch in batches:
            column = batch.column(1)
            # A null array has no words; words are never null.
            ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]).astype(np.int32)), pc.list_flatten(column)
            )
            for start, n in _portions(lists):
                made = _portion(lists.slice(start, n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, n), *made.flatten()], names=["row", "runs", "collapsed"]
                )

    schema = (
        f"row {rows.schema['row'].dataType.simpleString()}, "
        "runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
    kept = [F.col("row").getField(f"c{k}").alias(c) for k, c in enumerate(names)]
    return rows.mapInArrow(found, schema).select(*kept, F.col("runs").alias(runs), F.col("collapsed").alias(collapsed))
