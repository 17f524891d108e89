"""Token counts, token files and byte-level BPE against the libraries on whole texts."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskbook.llm import byte_bpe, huffman, pretokens, queries, token_counts, token_files

JSON, RANKS = P.path(queries.JSON_50K), P.path(queries.RANKS_50K)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("whole", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_token_counts(spark, documents, awkward, library):
    special = spark.createDataFrame([(1, "a<|endoftext|><|endoftext|> b <|endoftext", "s")], "doc_id long, text string, s string")
    for df in (documents, awkward, special, awkward.limit(0)):
        want = Counter((r["doc_id"], len((r["text"] or "").encode()), len(ids_of(library, r["text"]))) for r in df.collect())
        assert Counter(map(tuple, token_counts.token_counts(df, JSON).collect())) == want


def test_token_counts_of_several_blocks(documents, library, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK_BYTES", 10_000)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(documents.repartition(3), JSON).collect()}
    assert got == {r["doc_id"]: len(ids_of(library, r["text"])) for r in documents.collect()}


def test_token_counts_query(spark, documents, library):
    got = queries.op6_token_counts(spark, "/root/testdata/sf0.001").collect()
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got) and len(got) == documents.count()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="a 1'.\n\t 　sé́", max_size=60))
def test_pretoken_ids_match_the_library(text):
    splitter = pretokens.load(open(JSON, "rb").read())
    assert np.frombuffer(splitter.ids(pa.array([text], pa.string()))[0], splitter.width).tolist() == ids_of(splitter.tokenizer, text)


def test_every_code_point_is_split_as_by_the_library():
    """Each character between letters, digits, marks and others of its kind."""
    splitter = pretokens.load(open(JSON, "rb").read())
    for code in [*range(0x700), *range(0x2000, 0x2070), *range(0x10000, 0x110000, 4099)]:
        text = "a{0}1{0}!{0}{0}b".format(chr(code))
        said = [text[a:b] for _, (a, b) in splitter.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        assert splitter.split(text) == said, hex(code)


def test_other_kinds_of_tokenizer_are_refused():
    with pytest.raises(ValueError):
        pretokens.Pretokens(open(P.path("word_bpe_49k.json"), "rb").read())


def brute_files(df, library):
    rows = sorted(df.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    out, start = [], 0
    for r in rows:
        ids = [*ids_of(library, r["text"]), 2]
        out.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(spark, df, path):
    token_files.write_token_files(df, path, JSON, end_id=2)
    back = token_files.read_token_files(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc"))


def test_token_files_round_trip(spark, documents, library, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 3_000)
    got = sorted(map(tuple, written(spark, documents.repartition(4), f"{tmp_path}/a").collect()))
    assert got == brute_files(documents, library)


def test_token_files_of_awkward_rows(spark, awkward, library, tmp_path):
    got = [tuple(r) for r in written(spark, awkward, f"{tmp_path}/a").collect()]
    want = brute_files(awkward, library)
    # Rows of one id may stand in any order; starts are gapless either way.
    assert Counter((g[0], g[2], g[3]) for g in got) == Counter((w[0], w[2], w[3]) for w in want)
    upto = 0
    for _, start, size, _ in sorted(got, key=lambda g: g[1]):
        assert start == upto
        upto += size
    ids = [g[0] for g in sorted(got, key=lambda g: g[1])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert written(spark, awkward.limit(0), f"{tmp_path}/b").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=700), st.integers(1, 64))
def test_huffman_round_trip(ids, every):
    ids = np.array(ids, dtype=np.int64)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=45), 7)
    codes = huffman.canonical_codes(lengths)
    data, checkpoints = huffman.encode(ids, lengths, codes, every)
    assert len(data) == (int(lengths[ids].sum()) + 7) // 8
    back = huffman.decode(data, len(ids), checkpoints, every, huffman.decode_table(lengths))
    assert back.tolist() == ids.tolist()


def test_code_lengths_are_the_best_of_their_limit():
    def best(counts, most):
        found = [np.inf]

        def place(k, room, cost, longest):
            if k == len(counts):
                found[0] = min(found[0], cost)
                return
            for size in range(longest, most + 1):
                if room >= 2.0**-size:
                    place(k + 1, room - 2.0**-size, cost + size * counts[k], size)

        counts = sorted(counts, reverse=True)
        place(0, 1.0, 0, 1)
        return found[0]

    random = np.random.default_rng(5)
    for _ in range(60):
        counts = random.integers(1, 500, random.integers(2, 8))
        most = int(np.ceil(np.log2(len(counts)))) + int(random.integers(0, 3))
        lengths = huffman.code_lengths(counts, most)
        assert lengths.max() <= most and (lengths * counts).sum() == best(counts.tolist(), most)
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, dtype=np.int64), 3)


def test_byte_bpe(documents, awkward, encoding):
    for df in (documents, awkward.where("doc_id <> 7 OR doc_id IS NULL"), awkward.limit(0)):
        encoded = byte_bpe.encode(df, RANKS, P.PATTERN)
        got = encoded.select("doc_id", "n_tokens", "ids", byte_bpe.decoded(encoded, "ids", RANKS, P.PATTERN)).collect()
        want = Counter()
        for r in df.collect():
            ids = encoding.encode_ordinary(r["text"] or "")
            want[r["doc_id"], len(ids), tuple(ids), (r["text"] or "").encode()] += 1
        assert Counter((a, b, tuple(c), bytes(d)) for a, b, c, d in got) == want


def test_what_encode_gives(documents, awkward):
    """Packed ids and decoded bytes made along with the ids are those made from the ids afterwards."""
    for df in (documents, awkward.where("doc_id <> 7 OR doc_id IS NULL"), awkward.limit(0)):
        whole = byte_bpe.encode(df, RANKS, P.PATTERN)
        later = whole.select("doc_id", "n_tokens", byte_bpe.packed("ids"), byte_bpe.decoded(whole, "ids", RANKS, P.PATTERN))
        at_once = byte_bpe.encode(df, RANKS, P.PATTERN, give=("n_tokens", "packed", "decoded"))
        assert at_once.columns == ["doc_id", "n_tokens", "packed", "decoded"]
        assert Counter(map(tuple, at_once.collect())) == Counter(map(tuple, later.collect()))


def loaded():
    ranks = open(RANKS, "rb").read()
    return byte_bpe.load(ranks, P.PATTERN), lambda: byte_bpe.load(ranks, byte_bpe.WHOLE)


def test_byte_bpe_of_white_space_the_library_cannot_take(encoding):
    whole, piece = loaded()
    for run in (" ", "\n", "\t ", "　"):
        for text in (run * 400_000, run * 400_000 + "end of it", "begin" + run * 400_000 + "  x" * 30_000):
            ids = byte_bpe.encode_text(text, whole, piece)
            assert encoding.decode_bytes(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab '1!\n\t 　s\x1c\x85", max_size=80), st.integers(1, 12))
def test_parts_encode_as_the_whole(text, long):
    whole, piece = loaded()
    assert "".join(byte_bpe.safe_parts(text, long)) == text
    assert byte_bpe.encode_text(text, whole, piece, long) == whole.encode_ordinary(text)


def test_byte_bpe_query_digests(spark, documents, encoding):
    got = {r["doc_id"]: r for r in queries.op10_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    for r in documents.collect():
        ids = encoding.encode_ordinary(r["text"])
        assert got[r["doc_id"]]["n_tokens"] == len(ids)
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
