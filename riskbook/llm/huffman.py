"""Canonical Huffman codes of limited length, with table-driven decoding from many places at once."""

from __future__ import annotations

import numpy as np

MOST_BITS = 20


def code_lengths(counts: np.ndarray, most_bits: int = MOST_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most_bits`` for symbols with these counts; 0 for symbols that do not occur.

    Package merge: a symbol is offered once per bit length; of the cheapest 2n - 2 offers, each one that holds a
    symbol adds a bit to its code.
    """
    symbols = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    n = len(symbols)
    if n < 2:
        lengths[symbols] = 1
        return lengths
    if n > 1 << most_bits:
        raise ValueError(f"{n} symbols do not fit codes of {most_bits} bits")
    symbols = symbols[np.argsort(counts[symbols], kind="stable")]
    weights = counts[symbols].astype(np.int64)
    # Per level: which offers, in order of weight, are single symbols (the others are pairs of the level below).
    levels, pairs = [], np.empty(0, dtype=np.int64)
    for _ in range(most_bits):
        offered = np.concatenate([weights, pairs])
        order = np.argsort(offered, kind="stable")
        levels.append(order < n)
        offered = offered[order]
        half = len(offered) // 2 * 2
        pairs = offered[0:half:2] + offered[1:half:2]
    taken = 2 * n - 2
    for single in reversed(levels):
        # The cheapest offers come first, and so do the symbols and the pairs among them.
        chosen = int(single[:taken].sum())
        lengths[symbols[:chosen]] += 1
        taken = 2 * (min(taken, len(single)) - chosen)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol), each the one before plus one, with zeros added where the length grows."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    code, last = 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for symbol in order[np.count_nonzero(lengths == 0) :]:
        size = int(lengths[symbol])
        code <<= size - last
        codes[symbol] = code
        code, last = code + 1, size
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbol and code length for every window of the longest code's bits."""
    bits = max(1, int(lengths.max(initial=0)))
    symbols, sizes = np.zeros(1 << bits, dtype=np.uint32), np.zeros(1 << bits, dtype=np.uint8)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[np.count_nonzero(lengths == 0) :]
    widths = np.left_shift(1, bits - lengths[order].astype(np.int64))
    filled = int(widths.sum())
    symbols[:filled] = np.repeat(order, widths)
    sizes[:filled] = np.repeat(lengths[order], widths)
    return symbols, sizes, bits


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
    """The bits of a block of ids, and the bit offset of each ``every``-th id."""
    sizes = lengths[ids]
    ends = np.cumsum(sizes, dtype=np.int64)
    starts = ends - sizes
    if not len(ids):
        return b"", starts
    # A code at any offset touches two 32-bit words; codes that begin in the same word are joined by one reduction.
    left = codes << (64 - lengths.astype(np.int64)).clip(max=63).astype(np.uint64)
    shifted = left[ids] >> (starts & 31).astype(np.uint64)
    word = starts >> 5
    first = np.flatnonzero(np.diff(word, prepend=-1))
    words = np.zeros(int(ends[-1] >> 5) + 2, dtype=np.uint32)
    words[word[first]] |= np.bitwise_or.reduceat((shifted >> np.uint64(32)).astype(np.uint32), first)
    words[word[first] + 1] |= np.bitwise_or.reduceat(shifted.astype(np.uint32), first)
    return words.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8], starts[::every]


def decode(
    data: bytes, count: int, checkpoints: np.ndarray, every: int, table: tuple[np.ndarray, np.ndarray, int]
) -> np.ndarray:
    """The ids of a block: all stretches between checkpoints advance together, one table look-up per id."""
    symbols, sizes, bits = table
    out = np.zeros((len(checkpoints), every), dtype=np.uint32)
    if not count:
        return out.reshape(-1)
    words = np.frombuffer(data + b"\0" * (16 - len(data) % 4), dtype=">u4").astype(np.uint64)
    windows = (words[:-1] << np.uint64(32)) | words[1:]
    at = np.array(checkpoints, dtype=np.int64)
    full = count // every
    for k in range(every):
        if k == count % every:
            at = at[:full]  # the last stretch is shorter
            if not full:
                break
        window = (windows[at >> 5] >> (64 - bits - (at & 31)).astype(np.uint64)) & np.uint64((1 << bits) - 1)
        out[: len(at), k] = symbols[window]
        at = at + sizes[window]
    return out.reshape(-1)[:count]
