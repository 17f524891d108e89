"""Benchmark decontamination by winnowing, with column functions and joins only.

What must be found are *windows*: ``WINDOW`` consecutive words of an item, or all words of a shorter item. A window of
``n`` words has ``n // 2`` or so grams of ``n // 2 + 1`` words; the least of their hashes is its fingerprint. A document
keeps the fingerprint of each of its own stretches of ``n`` words. Equal stretches have equal fingerprints, so whatever
shares a window shares a fingerprint, and no shared window is missed.

Fingerprints of documents first meet a bitmap of the benchmark's, which has a fixed number of bits and is broadcast;
only those that pass take the words around them along and are joined with the benchmark by fingerprint and words, so
that a hit is a window that was compared word by word. Joins carry a salt, since a passage may lie in a third of all
documents. Windows that the same items hold are one class; a document meets classes, and items are listed at the end.

* null text: no words; empty text, or one without words: no hits; very long text: taken whole;
* an item without words has no window; items without id count as hits but are not listed; rows that repeat an item id
  are one item with the windows of all of them;
* null and repeated document ids: every row has its own result, equal texts the same one;
* an empty benchmark: no hits; empty documents: no rows; other columns: not looked at.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.functions.common import let
from riskbook.llm.common import stored

WINDOW = 10
# Words are runs of ASCII letters, digits and anything beyond ASCII; upper-case letters count before they are lowered.
SPACER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACER_BEFORE_LOWERING = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Bits of the bitmap, and how many longs of it make a row: at most 32,768 rows of 512 bytes.
BITS = 1 << 27
LONGS_SHIFT = 6
LONGS = 1 << LONGS_SHIFT
SALTS = 8


def words_of(text: Column) -> Column:
    """The words, A to Z in lower case; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, SPACER), "")


def fingerprints(hashes: Column, size: int) -> Column:
    """The fingerprint of every stretch of ``size`` words, in order, given the words' hashes."""
    gram = size // 2 + 1
    grams_in = size - gram + 1

    def places(array: Column, length: int) -> Column:
        return F.when(F.size(array) >= length, F.sequence(F.lit(0), F.size(array) - length)).otherwise(
            F.array().cast("array<int>")
        )

    def grams(h: Column) -> Column:
        return F.transform(places(h, gram), lambda i: F.xxhash64(F.lit(size), *[F.get(h, i + k) for k in range(gram)]))

    def least(g: Column) -> Column:
        if grams_in == 1:
            return g
        return F.transform(places(g, grams_in), lambda i: F.least(*[F.get(g, i + k) for k in range(grams_in)]))

    return let(grams(hashes), least)


def _bit(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(BITS - 1))


def _bitmap(fps: DataFrame) -> DataFrame:
    """The bits of ``fp`` in rows (``part``, ``longs``)."""
    bits = fps.select(_bit(F.col("fp")).alias("bit"))
    one = F.expr("shiftleft(1L, cast(bit & 63 AS int))")
    longs = bits.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(one).alias("long"))
    rows = longs.groupBy(F.shiftright("at", LONGS_SHIFT).alias("part")).agg(
        F.map_from_entries(F.collect_list(F.struct((F.col("at") % LONGS).cast("int"), "long"))).alias("set")
    )
    all_longs = F.transform(
        F.sequence(F.lit(0), F.lit(LONGS - 1)), lambda i: F.coalesce(F.element_at("set", i), F.lit(0).cast("long"))
    )
    return rows.select("part", all_longs.alias("longs"))


def _in_bitmap(rows: DataFrame, bitmap: DataFrame) -> DataFrame:
    """The rows whose ``fp`` may be in the bitmap, which is small whatever it was made of."""
    part = F.shiftright(_bit(F.col("fp")), 6 + LONGS_SHIFT)
    at = F.expr(f"cast((fp & {BITS - 1}) >> 6 AS int) % {LONGS}")
    bit = F.expr("cast(fp & 63 AS int)")
    met = rows.join(F.broadcast(bitmap), part == F.col("part"))
    return met.where(F.getbit(F.get("longs", at), bit) == 1)


def _window(start: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", start + 1, size), " ")


def benchmark_windows(items: DataFrame, text: str = "text", id_col: str = "item_id") -> DataFrame:
    """Distinct ``fp``, ``size``, ``window`` (its words) and ``item`` of a benchmark."""
    words = items.select(F.col(f"`{id_col}`").alias("item"), words_of(F.col(f"`{text}`")).alias("words"))
    sized = words.where(F.size("words") > 0).select("item", "words", F.least(F.size("words"), F.lit(WINDOW)).alias("size"))
    hashes = F.transform("words", lambda w: F.xxhash64(w))

    def by_size(h: Column) -> Column:
        found = F.when(F.col("size") == 1, fingerprints(h, 1))
        for n in range(2, WINDOW + 1):
            found = found.when(F.col("size") == n, fingerprints(h, n))
        return found

    each = sized.select("item", "words", "size", F.posexplode(let(hashes, by_size)).alias("start", "fp"))
    return each.select("fp", "size", _window(F.col("start"), F.col("size")).alias("window"), "item").distinct()


def _classes(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``fp``, ``window`` and their ``class``, and ``class`` with its ``item``: windows of one class have the same items.

    Sets of items are told apart by their size and 128 bits of hashes, so no list of a common window's items is made.
    """

    def marks(seed: int) -> Column:
        return F.bit_xor(F.when(F.col("item").isNotNull(), F.xxhash64(F.lit(seed), "item")).otherwise(0))

    signed = windows.groupBy("fp", "window").agg(
        F.struct(F.count("item").alias("n"), marks(1).alias("a"), marks(2).alias("b")).alias("class")
    )
    one = signed.groupBy("class").agg(F.min(F.struct("fp", "window")).alias("w")).select("class", "w.fp", "w.window")
    members = windows.where(F.col("item").isNotNull()).join(one, ["fp", "window"]).select("class", "item")
    return signed, members


def window_hits(docs: DataFrame, windows: DataFrame, text: str = "text") -> DataFrame:
    """Every place of a document's words that a benchmark window begins at: ``digest`` of the text, ``start``, ``size``,
    and the window's ``fp`` and ``window``. ``windows`` is a stored table of ``benchmark_windows``."""
    # Ten values at most.
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect()) or [WINDOW]
    words = docs.select(text_digest(F.col(f"`{text}`")).alias("digest"), words_of(F.col(f"`{text}`")).alias("words"))

    def all_sizes(h: Column) -> Column:
        return F.array(*[F.struct(F.lit(n).alias("size"), fingerprints(h, n).alias("fps")) for n in sizes])

    hashes = F.transform("words", lambda w: F.xxhash64(w))
    by_size = words.select("digest", "words", F.inline(let(hashes, all_sizes)))
    each = by_size.select("digest", "words", "size", F.posexplode("fps").alias("start", "fp"))
    passing = _in_bitmap(each, _bitmap(windows.select("fp").distinct()))
    candidates = passing.select(
        "digest", "start", "size", "fp", _window(F.col("start"), F.col("size")).alias("window")
    ).withColumn("salt", F.pmod(F.xxhash64("digest", "start"), F.lit(SALTS)).cast("int"))
    wanted = windows.select("fp", "window").distinct()
    salted = wanted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return candidates.join(salted, ["fp", "window", "salt"]).select("digest", "start", "size", "fp", "window")


def text_digest(text: Column) -> Column:
    """SHA-256 of a text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _covered(places: Column) -> Column:
    """How many words lie in the union of stretches (start, size)."""

    def add(state: Column, x: Column) -> Column:
        return let(
            x.start + x.size,
            lambda end: F.struct(
                (state.n + F.greatest(F.lit(0), end - F.greatest(state.end, x.start))).alias("n"),
                F.greatest(state.end, end).alias("end"),
            ),
        )

    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(F.sort_array(places), start, add, lambda done: done.n.cast("long"))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``n_hit`` (words in a window of the benchmark), ``n_items``,
    ``items_sha256`` (the items' ids, sorted as strings and joined by commas) and ``contaminated``."""
    windows = stored(benchmark_windows(benchmark, item_text, item_id), "benchmark-windows")
    classes, members = _classes(windows)
    hits = stored(window_hits(docs, windows, text).distinct(), "window-hits")
    covered = hits.groupBy("digest").agg(_covered(F.collect_set(F.struct("start", "size"))).alias("n_hit"))
    held = hits.select("digest", "fp", "window").distinct().join(classes, ["fp", "window"]).select("digest", "class")
    listed = held.distinct().join(members, "class").select("digest", F.col("item").cast("string").alias("item")).distinct()
    items = listed.groupBy("digest").agg(
        F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items")
    )
    found = stored(
        covered.join(items, "digest", "left").select(
            "digest", "n_hit", F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
            F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        ),
        "contaminated-texts",
    )
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.size(F.array_remove(F.split(content, SPACER_BEFORE_LOWERING), "")).cast("long").alias("n_words"),
        text_digest(content).alias("digest"),
    )
    return rows.join(found, "digest", "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0).cast("long")) > 0).alias("contaminated"),
    )
