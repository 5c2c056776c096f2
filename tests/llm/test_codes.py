"""SentencePiece and token files against the libraries they follow."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rosterline.llm import base, piece_codec, token_files
from rosterline.llm.queries import PIECES, WORDS

SP = sentencepiece.SentencePieceProcessor(model_file=PIECES)
CODEC = piece_codec.PieceCodec(PIECES)
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@settings(max_examples=300, deadline=None)
@example(" \u0655")
@example("  \u0655 \u0655")
@given(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from("the in ▁\n.,<>/0x"), max_size=60))
def test_pieces_equal_the_library(text):
    ids = CODEC.encode(text)
    assert ids == SP.encode(text) + [2]
    assert CODEC.decode(ids) == SP.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(CODEC.pieces[259:20_000]), max_size=12).map("".join))
def test_joined_pieces_equal_the_library(text):
    assert CODEC.encode(text) == SP.encode(text) + [2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 31_999) | st.integers(0, 300), max_size=20))
def test_any_ids_decode_as_the_library(ids):
    assert CODEC.decode(ids) == SP.decode(ids)


def test_blank_runs_and_long_chunks():
    for text in [" " * i + "x" + " " * (i * 3 % 40) for i in range(60)] + ["thethe" * 300, "a" * 5000, "▁" * 77, "</s><0x0A><s>"]:
        assert CODEC.encode(text) == SP.encode(text) + [2]


def piece_digest(text):
    ids = SP.encode(text or "") + [2]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(SP.decode(ids))


def test_piece_digests(docs, rows):
    found = {r[0]: tuple(r[1:]) for r in piece_codec.digests(docs, PIECES).collect()}
    assert found == {i: piece_digest(t) for i, t in zip(rows.doc_id, rows.text)}


def test_piece_edge_cases(awkward, empty):
    found = sorted(map(tuple, piece_codec.digests(awkward, PIECES).collect()), key=repr)
    assert found == sorted(((r.doc_id, *piece_digest(r.text)) for r in awkward.collect()), key=repr)
    assert piece_codec.digests(empty, PIECES).count() == 0


def test_encode_then_decode(docs):
    back = {r.doc_id: r.text for r in piece_codec.decode(piece_codec.encode(docs, PIECES), PIECES).collect()}
    assert back == {r.doc_id: SP.decode(SP.encode(r.text or "")) for r in docs.collect()}


def by_library(rows):
    """(key, start, n, crc) by brute force, keys ascending, nulls first."""
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files(docs, rows):
    found = sorted(map(tuple, token_files.digests(docs, WORDS, 2).collect()))
    assert found == sorted(by_library(list(zip(rows.doc_id.tolist(), rows.text))))


def test_token_file_edge_cases(awkward, empty, tmp_path):
    folder = f"file://{tmp_path}/t"
    found = token_files.digests(awkward, WORDS, 2, folder).collect()
    brute = by_library([(r.doc_id, r.text) for r in awkward.collect()])
    assert sorted((r[0], r[2], r[3]) for r in found if r[0] is not None) == sorted((r[0], r[2], r[3]) for r in brute if r[0] is not None)
    assert sorted((r[2], r[3]) for r in found) == sorted((r[2], r[3]) for r in brute)
    # Starts are contiguous in key order.
    at = 0
    for r in sorted(found, key=lambda r: r[1]):
        assert r[1] == at
        at += r[2]
    keys = [r[0] for r in sorted(found, key=lambda r: r[1])]
    assert keys == [None, None, *sorted(k for k in keys if k is not None)]
    assert token_files.digests(empty, WORDS, 2, f"file://{tmp_path}/e").count() == 0


def test_small_parts_and_missing_keys(spark, docs, tmp_path):
    folder = f"file://{tmp_path}/parts"
    listing = token_files.write(docs, folder, WORDS, 2, rows_per_shard=50, part_bytes=20_000, keys_per_index=30)
    assert listing.count() > 4
    asked = spark.createDataFrame([(0, 0), (199, 0), (5, 1), (10**9, 0), (None, 0)], "doc_id long, occurrence long")
    assert sorted(r.doc_id for r in token_files.look_up(asked, folder).collect()) == [0, 199]
    every = docs.selectExpr("doc_id", "0 AS occurrence")
    assert token_files.read(token_files.look_up(every, folder), folder).count() == docs.count()
    names = {p.name for p in (tmp_path / "parts").iterdir()}
    assert not [n for n in names if n.startswith(".")]


@pytest.mark.parametrize("n", [1, 2, 5, 1000, 20_000])
def test_perfect_hash_is_minimal(n):
    hashes = np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64)
    hashes = np.unique(hashes)
    shift, slots = token_files.build_mph(hashes)
    assert sorted(slots.tolist()) == list(range(len(hashes)))
    d = shift[(hashes % np.uint64(len(shift))).astype(np.int64)]
    assert (token_files._mix(hashes, d) % np.uint64(len(hashes)) == slots.astype(np.uint64)).all()


def test_memo_never_changes_results():
    memo = base.Remembered(lambda x: x * 2, 3)
    assert [memo[i % 7] for i in range(50)] == [2 * (i % 7) for i in range(50)] and len(memo) <= 3


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB'é1 .<|>$\u0301\u017fSt\n-ÀΣ中", max_size=40))
def test_word_ids_equal_the_library(text):
    own = token_files.word_ids(WORDS, 2)
    for t in (text, text + "x<|endoftext|>'s", text.upper()):
        assert own.encode([t])[0] == np.array(own.library.encode(t, add_special_tokens=False).ids, "<u2").tobytes()
