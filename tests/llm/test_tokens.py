"""Encoding, decoding and token files against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import awkward_docs, empty_docs, saved
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ampflow.llm import bpe, simple8b

PATH = public_tokenizers.path(bpe.TOKENIZER)
LIBRARY = Tokenizer.from_file(PATH)
POOL = [*"abZéßΣσİ'’ \t\n\x1c\x85\xa0​½²9٣漢字🙂ﬁéǅ-_.!<|>", "<|endoftext|>", "<|startoftext|>", "'s", "'LL"]


@pytest.fixture(scope="module")
def codec():
    return bpe.ForcedBoundaryBpe(PATH)


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_random_strings_match_the_library(codec):
    rng = random.Random(1)
    own = simple8b.LibraryEncoder(PATH)
    for _ in range(4000):
        text = "".join(rng.choices(POOL, k=rng.randint(0, 14)))
        want = library_ids(text)
        assert codec.encode(text).tolist() == want
        assert codec.decode(want) == LIBRARY.decode(want, skip_special_tokens=False)
        assert np.frombuffer(own.encode(text), np.uint32).tolist() == want


@pytest.mark.parametrize("word", ["a" * 300_000, "=" * 200_000, "é" * 50_000, "internationalisation" * 20_000, "ab" * 30_000 + "!?" * 30_000])
def test_long_words_take_n_log_n(codec, word):
    assert codec.encode(word).tolist() == library_ids(word)
    assert all(len(w) <= 64 for w in codec.words)


def test_heap_and_sweep_merge_alike(codec):
    rng = random.Random(6)
    for _ in range(400):
        units = [codec.file.symbols[b] for b in "".join(rng.choices("etaoinshrdlu=.-", k=rng.randint(1, 39))).encode()]
        units[-1] += codec.file.suffix
        assert codec._merged(tuple(units)) == codec._merged_by_heap(tuple(units))


def test_cuts_are_certain(codec):
    assert len(codec.cut("ab")) >= 1
    for word in ("internationalisation", "thndreereath", "q\x00z", "éèà"):
        ids = [i for fragment in codec.cut(word) for i in codec.fragments[fragment]]
        assert "".join("".join(f) for f in codec.cut(word)).endswith("</w>")
        assert ids == [i for i in codec.encode(word).tolist()] or len(codec.file.words(word)) != 1


def test_digests_of_awkward_rows(spark, tmp_path):
    docs = awkward_docs(spark, "".join(POOL), "The cat's 12 <|endoftext|> mats")
    got = bpe.op10_bpe(spark, saved(spark, tmp_path / "a", documents=docs)).collect()
    want = []
    for r in docs.collect():
        ids = library_ids(r.text or "")
        shown, decoded = " ".join(map(str, ids)), LIBRARY.decode(ids, skip_special_tokens=False)
        want.append((str(r.doc_id), len(ids), hashlib.sha256(shown.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got) == sorted(want)
    assert bpe.op10_bpe(spark, saved(spark, tmp_path / "b", documents=empty_docs(spark))).collect() == []


def test_columns_survive_and_clashes_are_replaced(spark):
    docs = awkward_docs(spark, "some words").withColumnRenamed("lang", "token_ids").withColumnRenamed("source", "decoded")
    encoded = bpe.encode(docs, PATH)
    assert set(encoded.columns) == set(docs.columns)
    back = bpe.decode(encoded, PATH)
    by_text = {r.text: r for r in back.collect()}
    assert by_text["some words"].token_ids == library_ids("some words")
    assert by_text["some words"].decoded == "some</w> words</w>" and by_text[None].token_ids == []


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 1 << 16), st.integers(0, (1 << 64) - 1)), max_size=300))
@settings(max_examples=200, deadline=None)
def test_words_round_trip(values):
    array = np.array(values, dtype=np.uint64)
    words, escapes = simple8b.encode_words(array)
    assert simple8b.decode_words(words, escapes).tolist() == values
    assert len(escapes) == sum(v >= 1 << 60 for v in values)


def test_words_are_packed_densely():
    words, _ = simple8b.encode_words(np.ones(600, dtype=np.uint64))
    assert len(words) == 10
    words, _ = simple8b.encode_words(np.full(40, 30_000, dtype=np.uint64))
    assert len(words) == 10


@pytest.mark.parametrize("block", [1, 50, 1 << 16])
def test_files_hold_every_document_in_order(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(simple8b, "BLOCK_IDS", block)
    docs = awkward_docs(spark, "b b b", "a", "", "zebra 99")
    got = simple8b.op6_simple8b(spark, saved(spark, tmp_path, documents=docs)).collect()
    lengths, at = {}, 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted((r.doc_id for r in docs.collect()), key=lambda i: (i is not None, i or 0))
    for r in docs.collect():
        ids = [*library_ids(r.text or ""), 1]
        lengths.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    for r in got:
        assert (r.n_tokens, r.ids_crc32) in lengths[r.doc_id]


def test_no_documents_give_no_rows(spark, tmp_path):
    assert simple8b.op6_simple8b(spark, saved(spark, tmp_path, documents=empty_docs(spark))).collect() == []
