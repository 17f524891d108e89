"""Byte-level pre-tokens of a tokenizer file and their ids, each distinct one merged once.

Only what the files of this kind use is supported: byte-level pre-tokens by the library's own pattern, no normalizer,
no prefix space, added tokens that match their exact text. Anything else raises ``ValueError``.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from riskbook.llm.byte_bpe import SPACE

# The split that byte-level tokenizers make before merging (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# From this code point on, regular expression engines know different versions of Unicode; there the library splits.
AGREED = 0x530
# Pre-tokens kept in memory between calls: short ones, which come again, and no more than this.
CACHED = 900_000
CACHED_LENGTH = 12
PER_CALL = 1_000


def _members(pattern: str) -> str:
    """The characters below ``AGREED`` that a pattern takes, as ranges of a character class."""
    taken = {i for i in range(AGREED) if regex.fullmatch(pattern, chr(i))}
    firsts = sorted(i for i in taken if i - 1 not in taken)
    lasts = sorted(i for i in taken if i + 1 not in taken)
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(firsts, lasts))


def _quick_pattern() -> re.Pattern:
    """``PATTERN`` for texts below ``AGREED``, its commonest case first; no two cases begin alike but the last two and
    the apostrophe."""
    letter, number, space = _members(r"\p{L}"), _members(r"\p{N}"), _members(r"\s")
    return re.compile(
        f" ?[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[^{letter}{number}{space}]+| ?[{number}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


LETTER, NUMBER, SPACE_CHAR, OTHER = range(4)


def _classes() -> np.ndarray:
    """The class of each character below ``AGREED``."""
    kinds = [(LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE_CHAR, r"\s"), (OTHER, ".|\n")]
    return np.array(
        [next(k for k, pattern in kinds if regex.fullmatch(pattern, chr(i))) for i in range(AGREED)], dtype=np.uint8
    )


def _token_starts(data: np.ndarray, texts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of texts begin, all texts at once: ``data`` is their UTF-8, all characters below ``AGREED``,
    ``texts`` where the texts that are not empty begin.

    A pre-token is a run of one class with a blank before it, if there is one. Of a run of white space before something
    else, all but the last character are a pre-token, and the last one too unless it is a blank. An apostrophe that
    begins a run takes the letters of a contraction.
    """
    at = np.flatnonzero((data & 0xC0) != 0x80)
    chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    n = len(chars)
    kind = classes[chars]
    first = np.zeros(n + 1, dtype=bool)
    first[np.searchsorted(at, texts)] = True
    first[n] = True
    space = kind == SPACE_CHAR
    same = np.zeros(n, dtype=bool)
    same[1:] = (kind[1:] == kind[:-1]) & ~first[1:n]
    after_blank = np.zeros(n, dtype=bool)
    after_blank[1:] = (chars[:-1] == 0x20) & ~first[1:n]
    last_space = np.zeros(n, dtype=bool)
    last_space[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
    start = np.where(space, ~same | last_space, ~same & ~after_blank)
    for i in np.flatnonzero((chars == 0x27) & start):
        end = i + 1
        while end < min(n, i + 3) and not first[end]:
            end += 1
        tail = "".join(map(chr, chars[i + 1 : end]))
        size = 2 if tail[:1] in ("s", "t", "m", "d") else 3 if tail in ("re", "ve", "ll") else 0
        if tail and size:
            start[i + 1] = False
            if i + size < n:
                start[i + size] = True
    return at[start]


class Pretokens:
    """Splits texts as the tokenizer file does and gives the ids of pre-tokens."""

    def __init__(self, data: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        said = json.loads(data)
        split = said.get("pre_tokenizer") or {}
        if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError("only byte-level pre-tokens without a prefix space are supported")
        if said.get("normalizer") or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in said["added_tokens"]):
            raise ValueError("normalizers and added tokens that take in their surroundings are not supported")
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self.tokenizer = Tokenizer.from_str(data.decode())
        # Pre-tokens need no second split.
        whole = {**said, "pre_tokenizer": {**split, "use_regex": False}}
        self.merger = Tokenizer.from_str(json.dumps(whole))
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.piece_bytes = np.zeros(self.vocabulary, dtype=np.int64)
        for piece, number in self.tokenizer.get_vocab().items():
            self.piece_bytes[number] = len(piece)
        self.width = "<u2" if self.vocabulary <= 1 << 16 else "<u4"
        self.words = _quick_pattern()
        self.other = re.compile(f"[{chr(AGREED)}-{chr(0x10FFFF)}]")
        # Space and what follows it up to the next space: no pre-token runs from a non-space into a space.
        self.chunks = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
        self.known: dict[str, bytes] = {}
        self.classes = _classes()
        self.needs_care = "|".join([f"[\\x{{{AGREED:x}}}-\\x{{10ffff}}]", *map(re.escape, longest_first)])

    def segments(self, text: str) -> list[str]:
        """Stretches of ordinary text and added tokens, in turn, beginning with ordinary text."""
        return self.cut.split(text) if self.cut else [text]

    def split(self, part: str) -> list[str]:
        """The pre-tokens of ordinary text."""
        if not self.other.search(part):
            return self.words.findall(part)
        words: list[str] = []
        for chunk in self.chunks.findall(part):
            if self.other.search(chunk):
                words += [chunk[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk)]
            else:
                words += self.words.findall(chunk)
        return words

    def of(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and how many added tokens stand between them."""
        parts = self.segments(text)
        if len(parts) == 1:
            return self.split(text), 0
        return [w for part in parts[::2] for w in self.split(part)], len(parts) // 2

    def merged(self, words: list[str]) -> list[bytes]:
        """The ids of each pre-token, packed in ``width``."""
        size = np.dtype(self.width).itemsize
        out: list[bytes] = []
        for i in range(0, len(words), PER_CALL):
            call = words[i : i + PER_CALL]
            ids, ends = self._merged(call)
            data, cuts = ids.astype(self.width).tobytes(), (ends * size).tolist()
            out += [data[a:b] for a, b in zip([0, *cuts], cuts)]
        return out

    def _merged(self, call: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some pre-tokens one after the other, and how many there are up to the end of each."""
        ids = self.merger.encode_batch_fast([call], is_pretokenized=True, add_special_tokens=False)[0].ids
        ids = np.array(ids, dtype=np.int64)
        # A piece stands for as many bytes as its name has characters, so bytes tell which pieces a pre-token has.
        word_bytes = np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in call])
        return ids, np.searchsorted(np.cumsum(self.piece_bytes[ids]), word_bytes) + 1

    def counts(self, words: list[str]) -> np.ndarray:
        """The number of pieces of each pre-token."""
        calls = [words[i : i + PER_CALL] for i in range(0, len(words), PER_CALL)]
        return np.concatenate([np.empty(0, dtype=np.int64), *[np.diff(self._merged(c)[1], prepend=0) for c in calls]])

    def _of_words(self, words: list[str]) -> list[bytes]:
        """The ids of each of distinct pre-tokens."""
        found = list(map(self.known.get, words))
        new = [k for k, ids in enumerate(found) if ids is None]
        named = [words[k] for k in new]
        learnt = self.merged(named)
        for k, ids in zip(new, learnt):
            found[k] = ids
        if len(self.known) < CACHED:
            self.known.update((w, ids) for w, ids in zip(named, learnt) if len(w) <= CACHED_LENGTH)
        return found

    def ids(self, texts: pa.Array) -> list[bytes]:
        """The ids of whole texts, packed in ``width``; none for null.

        Texts whose characters all engines know alike are cut all at once, and only their distinct pre-tokens are
        looked at one by one. Others, and those with added tokens, are split one by one.
        """
        texts = pc.fill_null(texts, "")
        other = pc.match_substring_regex(texts, self.needs_care)
        careful = iter(self._careful(texts.filter(other).to_pylist()))
        quick = iter(self._quick(texts.filter(pc.invert(other))))
        return [next(careful if is_other else quick) for is_other in other.to_pylist()]

    def _careful(self, texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            parts = self.segments(text)
            special = [np.array([self.special[s]], dtype=self.width).tobytes() for s in parts[1::2]]
            split = [self.split(part) for part in parts[::2]]
            distinct = list({word: None for words in split for word in words})
            ids = dict(zip(distinct, self._of_words(distinct)))
            plain = [b"".join(map(ids.__getitem__, words)) for words in split]
            out.append(b"".join(x for pair in zip(plain, [*special, b""]) for x in pair))
        return out

    def _quick(self, texts: pa.Array) -> list[bytes]:
        if not len(texts):
            return []
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        if not len(data):
            return [b""] * len(texts)
        begins = np.append(_token_starts(data, ends[:-1][np.diff(ends) > 0], self.classes), len(data)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(begins) - 1, pa.py_buffer(begins), pa.py_buffer(data.tobytes()))
        coded = words.dictionary_encode()
        entries, codes = self._of_words(coded.dictionary.to_pylist()), coded.indices.to_numpy()
        sizes = np.array([len(e) for e in entries]) // np.dtype(self.width).itemsize
        starts = np.cumsum(sizes) - sizes
        each = sizes[codes]
        upto = np.concatenate([[0], np.cumsum(each)])
        places = np.repeat(starts[codes] - upto[:-1], each) + np.arange(upto[-1])
        ids = np.frombuffer(b"".join(entries), self.width)[places]
        cuts = upto[np.searchsorted(begins, ends)]
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]


@functools.lru_cache(maxsize=2)
def load(data: bytes) -> Pretokens:
    return Pretokens(data)
