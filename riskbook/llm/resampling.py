"""Importance resampling towards a target distribution over hashed word and word-pair features.

A feature is a word, or two neighbouring words joined by a space; its bucket is the CRC-32 of its bytes modulo
``BUCKETS``. Words come out of an Aho-Corasick automaton over a dictionary of distinct words, each bounded by blanks on
both sides; what an automaton emits for a word is its place in tables of its CRC, the CRC of the word with a blank
behind it, and its length. The CRC of a pair follows from the payloads of its words, as the CRC of a concatenation does
from the CRCs and the second length, so no pair is ever spelled out.

The dictionary is grown by each Python worker from the texts it reads, up to ``DICTIONARY`` words; it decides how fast a
word is found, never what is found: stretches the automaton leaves out are cut at blanks and hashed there.

Buckets of a document are stored once, two bytes each; counting and scoring read them. Counts are summed per task
before they are shuffled, ranks come from the counts of distinct scores and an order within each score.

* null text, or one without words: no features, weight 0, not drawn (too few words); very long text: taken whole,
  scanned a bounded portion at a time;
* null ids: hashed as an empty id, last among ties; repeated ids and rows: each row has its own rank; rows that agree
  in all columns of the result share a run of ranks;
* an empty target: all gains follow from the documents alone; empty documents: no rows; other columns: not looked at.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskbook.llm.common import PORTION, portions, stored

BUCKETS = 10_000
SMOOTHING = 10_000
SEED = 7
LEAST_WORDS = 20
SHARE = 25
# Distinct words of a worker's automaton; words beyond are hashed where they stand.
DICTIONARY = 1 << 16
# The automaton is built anew when so many words, and a quarter of what it holds, have come up without being in it.
GROWTH = 2_000
# Copies of one result row made at a time.
COPIES = 10_000

# ASCII bytes that are neither letters nor digits become blanks, upper-case letters lower-case ones.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)
_POLYNOMIAL = 0xEDB88320


def _powers() -> list[np.ndarray]:
    """For k from 0, where each bit of a CRC goes when 2 to the power of k zero bytes follow."""
    bits = [_POLYNOMIAL, *[1 << k for k in range(31)]]
    one = np.array(bits, dtype=np.uint64)
    for _ in range(3):
        one = _through(one, one)
    powers = [one]
    for _ in range(31):
        powers.append(_through(powers[-1], powers[-1]))
    return powers


def _through(matrix: np.ndarray, values: np.ndarray) -> np.ndarray:
    """CRCs after the zero bytes that a matrix stands for."""
    out = np.zeros_like(values)
    for bit in range(32):
        out ^= np.where((values >> np.uint64(bit)) & np.uint64(1), matrix[bit], np.uint64(0))
    return out


_POWERS = _powers()


@lru_cache(maxsize=256)
def _after(length: int) -> np.ndarray:
    """The CRC of each byte value in each of four places, after ``length`` zero bytes."""
    table = np.arange(256, dtype=np.uint64)[None, :] << np.array([[0], [8], [16], [24]], dtype=np.uint64)
    for k in range(length.bit_length()):
        if length >> k & 1:
            table = _through(_POWERS[k], table.ravel()).reshape(4, 256)
    return table.astype(np.uint32)


def joined_crcs(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of concatenations, given those of both parts and the length of the second."""
    out = second.astype(np.uint32).copy()
    kinds, which = np.unique(lengths, return_inverse=True)
    # Nearly all words have one of a few lengths, whose tables are stacked; the rest goes length by length.
    for low in range(0, len(kinds), 64):
        tables = np.stack([_after(int(n)) for n in kinds[low : low + 64]])
        here = np.flatnonzero((which >= low) & (which < low + 64))
        value, row = first[here].astype(np.uint32), which[here] - low
        for place in range(4):
            out[here] ^= tables[row, place, (value >> np.uint32(8 * place)) & np.uint32(255)]
    return out


class Dictionary:
    """Distinct words in an automaton, with the payloads of each."""

    def __init__(self, most: int = DICTIONARY):
        self.most, self.words, self.waiting = most, {}, {}
        self.automaton = None
        self.crcs = self.spaced = self.lengths = np.empty(0, dtype=np.uint32)

    def _grow(self) -> None:
        if len(self.waiting) < max(GROWTH, len(self.words) // 4) and len(self.words) + len(self.waiting) < self.most:
            return
        if not self.waiting or len(self.words) >= self.most:
            self.waiting.clear()
            return
        # A dictionary keeps the order words came in.
        for word in list(self.waiting)[: self.most - len(self.words)]:
            self.words[word] = len(self.words)
        self.waiting.clear()
        words = [w.encode("latin-1") for w in self.words]
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for word, place in self.words.items():
            automaton.add_word(f" {word} ", place)
        automaton.make_automaton()
        self.automaton = automaton
        self.crcs, self.spaced, self.lengths = payloads(words)

    def scan(self, text: str):
        """Starts, CRCs, CRCs with a blank, and lengths of the words of a text that begins and ends with a blank; its
        characters stand for bytes."""
        flat = np.fromiter(
            (x for hit in self.automaton.iter(text) for x in hit) if self.automaton else (), dtype=np.int64
        ).reshape(-1, 2)
        ends, places = flat[:, 0], flat[:, 1]
        lengths = self.lengths[places].astype(np.int64)
        starts = ends - lengths
        # A hit ends at the blank behind its word; between that and the blank before the next one lies what is unknown.
        before = np.concatenate([[0], ends])
        after = np.concatenate([starts - 1, [len(text) - 1]])
        found = [], []
        for low, high in zip(*((x[after > before]).tolist() for x in (before, after))):
            at = low
            for word in text[low:high].split(" "):
                if word:
                    found[0].append(at)
                    found[1].append(word)
                    if len(self.words) < self.most:
                        self.waiting[word] = None
                at += len(word) + 1
        more = payloads([w.encode("latin-1") for w in found[1]])
        parts = [self.crcs[places], more[0]], [self.spaced[places], more[1]], [lengths, more[2].astype(np.int64)]
        all_starts = np.concatenate([starts, np.array(found[0], dtype=np.int64)])
        order = np.argsort(all_starts, kind="stable")
        self._grow()
        return (all_starts[order], *[np.concatenate(p)[order] for p in parts])


def payloads(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC, CRC with a blank behind, and length of each word."""
    return (
        np.array([zlib.crc32(w) for w in words], dtype=np.uint32),
        np.array([zlib.crc32(w + b" ") for w in words], dtype=np.uint32),
        np.array([len(w) for w in words], dtype=np.uint32),
    )


@lru_cache(maxsize=1)
def _dictionary() -> Dictionary:
    """That of this worker; it outlives a task."""
    return Dictionary()


def buckets_of(texts: list[bytes], dictionary: Dictionary) -> list[np.ndarray]:
    """The buckets of each text's features: its words, then its pairs."""
    offsets = np.cumsum([0, *[len(t) + 1 for t in texts]])
    text = (b" " + b" ".join(texts) + b" ").translate(_TO_WORDS)
    found, low = [], 0
    while not found or low < len(text) - 1:
        # Pieces overlap in a blank, so that no word is cut.
        high = text.find(b" ", low + PORTION)
        high = len(text) - 1 if high < 0 else high
        starts, *more = dictionary.scan(text[low : high + 1].decode("latin-1"))
        found.append((starts + low, *more))
        low = high
    starts, crcs, spaced, lengths = (np.concatenate(x) for x in zip(*found))
    first = np.searchsorted(starts, offsets + 1)
    pairs = joined_crcs(spaced[:-1], crcs[1:], lengths[1:]) if len(crcs) else crcs
    words, pairs = (crcs % BUCKETS).astype("<u2"), (pairs % BUCKETS).astype("<u2")
    return [np.concatenate([words[a:b], pairs[a : max(a, b - 1)]]) for a, b in zip(first, first[1:])]


def features(text: Column) -> Column:
    """The buckets of a text's features, two little-endian bytes each."""

    @F.arrow_udf("binary")
    def made(column: pa.Array) -> pa.Array:
        out = []
        for start, n in portions(column):
            texts = pc.fill_null(column.slice(start, n).cast(pa.binary()), b"").to_pylist()
            out += [b.tobytes() for b in buckets_of(texts, _dictionary())]
        return pa.array(out, pa.binary())

    return made(text)


def bucket_counts(rows: DataFrame, buckets: str = "buckets") -> DataFrame:
    """``bucket`` and how many features fall in it."""

    def counted(batches):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer(), dtype="<u2"), minlength=BUCKETS)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    each = rows.select(buckets).mapInArrow(counted, "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of each bucket in thousandths, from two tables of ``bucket_counts``: a number per bucket comes here."""
    spark = documents.sparkSession
    grid = spark.range(BUCKETS).select(F.col("id").alias("bucket"))
    s, t = documents.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    both = grid.join(F.broadcast(s), "bucket", "left").join(F.broadcast(t), "bucket", "left")
    counts = both.select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in "st"])
    totals = counts.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = F.expr(f"((t + 1) * (all_s + {SMOOTHING})) / ((s + 1) * (all_t + {SMOOTHING}))")
    # One row of totals.
    made = counts.join(F.broadcast(totals)).select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))
    found = made.toArrow()
    out = np.zeros(BUCKETS, dtype=np.int64)
    out[found["bucket"].to_numpy()] = found["gain"].to_numpy()
    return out


def weight(buckets: Column, gain: np.ndarray) -> Column:
    """The floored mean gain of the features, 0 for none."""

    @F.arrow_udf("long")
    def mean(column: pa.Array) -> pa.Array:
        out = np.zeros(len(column), dtype=np.int64)
        for i, value in enumerate(column):
            found = np.frombuffer(value.as_buffer(), dtype="<u2")
            out[i] = int(gain[found].sum()) // len(found) if len(found) else 0
        return pa.array(out)

    return mean(buckets)


def gumbel(id_: Column, seed: int) -> Column:
    """Noise of a Gumbel distribution in thousandths, drawn by the id."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(said, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, id_col: str) -> DataFrame:
    """Gives the best rows by ``score`` their rank; rows with fewer than ``LEAST_WORDS`` words are not drawn.

    Scores are whole numbers of a narrow range, so their counts are a small table, over which ranks begin. Rows that
    agree in all columns are counted first and come back with consecutive ranks.
    """
    names = [id_col, "n_features", "weight", "score"]
    groups = stored(rows.groupBy(*names).agg(F.count("*").alias("copies")), "scores")
    # n words have 2 n - 1 features.
    fit = F.col("n_features") >= 2 * LEAST_WORDS - 1
    by_score = groups.where(fit).groupBy("score").agg(F.sum("copies").alias("n"))
    # One row per distinct score.
    down = W.orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, -1)
    ahead = by_score.select(
        "score",
        F.coalesce(F.sum("n").over(down), F.lit(0)).alias("ahead"),
        F.floor(F.sum("n").over(W.partitionBy()) * SHARE / 100).alias("drawn"),
    )
    order = [F.col(id_col).asc_nulls_last(), "n_features", "weight"]
    within = W.partitionBy("score").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    placed = (
        groups.where(fit)
        .join(ahead, "score")
        .withColumn("first", F.col("ahead") + F.coalesce(F.sum("copies").over(within), F.lit(0)))
        .select(*names, "copies", "first", "drawn")
    )
    none = F.lit(None).cast("long")
    unfit = groups.where(~fit).select(*names, "copies", none.alias("first"), none.alias("drawn"))
    lows = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))
    portions_ = placed.union(unfit).select("*", F.explode(lows).alias("low"))
    each = portions_.select("*", F.explode(F.sequence("low", F.least("copies", F.col("low") + COPIES) - 1)).alias("k"))
    rank = F.col("first") + F.col("k") + 1
    return each.select(*names, F.when(rank <= F.col("drawn"), rank).alias("rank"))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    target_text: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn)."""
    rows = stored(
        docs.select(F.col(f"`{id_col}`").alias("id"), features(F.col(f"`{text}`")).alias("buckets")), "features"
    )
    wanted = target.select(features(F.col(f"`{target_text}`")).alias("buckets"))
    gain = gains(bucket_counts(rows), bucket_counts(wanted))
    weighed = rows.select(
        "id", F.floor(F.octet_length("buckets") / 2).alias("n_features"), weight(F.col("buckets"), gain).alias("weight")
    )
    scored = weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed))
    return ranked(scored, "id").withColumnRenamed("id", id_col)
