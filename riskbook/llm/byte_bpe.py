"""Byte-level BPE with the tiktoken library: a local rank file, cuts of long texts at safe places, raw-byte decoding.

The rank file is read on the driver and broadcast (its size is that of the vocabulary), so executors need no copy.

* null text: encodes like the empty text, to no ids;
* empty text: no ids, decodes to no bytes;
* very long text: cut where no match of the pattern can cross, so the ids are those of the whole text; the regular
  expression never sees more than ``LONG`` characters of a run of white space at once;
* repeated ids or rows: every row is encoded on its own; null ids are kept;
* other columns of the table: not looked at and not returned.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import portions, shared_file

# Texts up to this many characters go to the library whole; the look-ahead of the pattern fails on white space beyond
# some hundred thousand characters.
LONG = 50_000
# The characters of the Unicode property White_Space, as the pattern of the rank files understands \s (fixed values).
_WHITE_SPACE = (
    (0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029),
    (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
SPACE = "".join(f"{chr(a)}-{chr(b)}" for a, b in _WHITE_SPACE)
_LAST_CUT = re.compile(f"(?s).*[^{SPACE}](?=[{SPACE}])")
_NEXT_CUT = re.compile(f"[^{SPACE}](?=[{SPACE}])")
_RUN = re.compile(f"[{SPACE}]*")


# Takes a text as one match.
WHOLE = "(?s).+"


@functools.lru_cache(maxsize=4)
def load(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file with a pattern; with ``WHOLE`` for one piece at a time."""
    merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def safe_parts(text: str, long: int = LONG) -> list[str]:
    """Parts of a text, cut only where white space follows another character.

    No match of the pattern runs from a non-space into a space, and what it matches left of such a place does not
    depend on what follows; so the parts encode to the ids of the whole. A part is longer than ``long`` only if it
    is one run of space followed by one run of other characters.
    """
    parts, at = [], 0
    while len(text) - at > long:
        found = _LAST_CUT.match(text, at, at + long + 1) or _NEXT_CUT.search(text, at + long - 1)
        if not found:
            break
        parts.append(text[at : found.end()])
        at = found.end()
    parts.append(text[at:])
    return parts


def encode_text(
    text: str | None, encoding: tiktoken.Encoding, piece: Callable[[], tiktoken.Encoding], long: int = LONG
) -> list[int]:
    """The ids of a whole text; ``piece`` is asked for the second encoding only where a long run needs it."""
    if not text:
        return []
    if len(text) <= long:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    for part in safe_parts(text, long):
        run = _RUN.match(part).end()
        if run > long:
            # The pattern takes a run of space as one match, all but its last character if another one follows.
            whole = run if run == len(part) else run - 1
            ids += piece().encode_ordinary(part[:whole])
            part = part[whole:]
        ids += encoding.encode_ordinary(part)
    return ids


def _counts(rows: list[np.ndarray], encoding: tiktoken.Encoding) -> pa.Array:
    return pa.array([len(r) for r in rows], pa.int64())


def _lists(rows: list[np.ndarray], encoding: tiktoken.Encoding) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate(rows))


def _packed(rows: list[np.ndarray], encoding: tiktoken.Encoding) -> pa.Array:
    return pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary())


def _decoded(rows: list[np.ndarray], encoding: tiktoken.Encoding) -> pa.Array:
    return pa.array([encoding.decode_bytes(r.tolist()) for r in rows], pa.binary())


# What ``encode`` can return of a text, by name: its type, and its column made from the ids of some texts.
GIVEN = {
    "n_tokens": ("long", _counts),
    "ids": ("array<int>", _lists),
    "packed": ("binary", _packed),
    "decoded": ("binary", _decoded),
}


def encode(
    df: DataFrame,
    rank_path: str,
    pattern: str,
    text: str = "text",
    id_col: str = "doc_id",
    give: tuple[str, ...] = ("n_tokens", "ids"),
) -> DataFrame:
    """One row per row of ``df``: the id and what ``give`` names: ``n_tokens``, the token ids as ``ids``, the same as
    little-endian unsigned 32-bit integers (``packed``), and the bytes these ids decode to (``decoded``). What is asked
    for here is made in the task that has the ids, so that neither ids nor vocabulary go to a second Python worker."""
    ranks = shared_file(df.sparkSession, rank_path)
    made = [GIVEN[name][1] for name in give]

    def piece():
        return load(ranks.value, WHOLE)

    def run(batches):
        encoding = load(ranks.value, pattern)
        for batch in batches:
            for start, length in portions(batch.column(1)):
                texts = batch.column(1).slice(start, length)
                rows = [np.array(encode_text(t.as_py(), encoding, piece), dtype=np.int32) for t in texts]
                arrays = [batch.column(0).slice(start, length), *[column(rows, encoding) for column in made]]
                yield pa.RecordBatch.from_arrays(arrays, names=[id_col, *give])

    id_type = df.schema[id_col].dataType.simpleString()
    columns = ", ".join(f"{name} {GIVEN[name][0]}" for name in give)
    return df.select(id_col, text).mapInArrow(run, f"`{id_col}` {id_type}, {columns}")


def decoded(df: DataFrame, ids: str, rank_path: str, pattern: str) -> Column:
    """The bytes that token ids stand for; null for null. Bytes, since a cut list need not be whole characters."""
    ranks = shared_file(df.sparkSession, rank_path)

    @F.arrow_udf("binary")
    def decode(column: pa.Array) -> pa.Array:
        encoding = load(ranks.value, pattern)
        rows = (None if row.values is None else encoding.decode_bytes(row.values.to_pylist()) for row in column)
        return pa.array(rows, pa.binary())

    return decode(F.col(ids))


def packed(ids: str) -> Column:
    """Token ids as little-endian unsigned 32-bit integers, one binary value per row; null for null."""

    @F.arrow_udf("binary")
    def pack(column: pa.Array) -> pa.Array:
        rows = (None if row.values is None else row.values.to_numpy().astype("<u4").tobytes() for row in column)
        return pa.array(rows, pa.binary())

    return pack(F.col(ids))
