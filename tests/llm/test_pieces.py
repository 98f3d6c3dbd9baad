"""Encoding and decoding of pieces against the sentencepiece library."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from llm_cases import awkward_docs, empty_docs, saved
from sentencepiece import SentencePieceProcessor

from ampflow.llm import pieces

PATH = public_tokenizers.path(pieces.MODEL)
LIBRARY = SentencePieceProcessor(model_file=PATH)
POOLS = [
    [*"ab "],
    [*"aeinrst ▁"],
    [*" ▁x"],
    [*"the of and ing\n\t.,!<>/s|0123456789  "],
    [*" ▁é́ﬁ中文🙂퟿\U0010ffff\x00\xa0​<s>"],
    [LIBRARY.id_to_piece(i) for i in range(259, 32000)],
]


@pytest.fixture(scope="module")
def table():
    return pieces.PrefixTable(PATH)


def test_random_strings_match_the_library(table):
    rng = random.Random(1)
    for _ in range(12000):
        text = "".join(rng.choices(rng.choice(POOLS), k=rng.randint(0, 30)))
        want = LIBRARY.encode(text)
        assert table.encode(text).tolist() == want
        assert table.decode(want) == LIBRARY.decode(want)


def test_any_ids_decode_like_the_library(table):
    rng = random.Random(2)
    for _ in range(6000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(260), 259, 260, 2]) for _ in range(rng.randint(0, 8))]
        assert table.decode(ids) == LIBRARY.decode(ids), ids


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 100_000, "=" * 100_000, "ab​" * 50_000, "Internationalisierung" * 20_000])
def test_long_words_take_linear_time(table, text):
    assert table.encode(text).tolist() == LIBRARY.encode(text)
    assert max(map(len, table.known)) <= pieces.STRETCH_LENGTH


def test_every_prefix_has_one_last_piece(table):
    text = "▁unbelievableness"
    for end in range(1, len(text) + 1):
        assert table.last_pieces(text)[end] == table.merged(text[:end])[-1]


def test_digests_of_awkward_rows(spark, tmp_path):
    docs = awkward_docs(spark, "".join(POOLS[3]), " lead and trail ", "一二三 🙂", "</s> <s>").withColumnRenamed("lang", "n_tokens")
    got = pieces.op12_pieces(spark, saved(spark, tmp_path / "a", documents=docs)).collect()
    want = []
    for r in docs.collect():
        ids = LIBRARY.encode(r.text or "")
        shown, decoded = ",".join(map(str, ids)), LIBRARY.decode(ids)
        want.append((str(r.doc_id), len(ids), hashlib.sha256(shown.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got) == sorted(want)
    assert pieces.op12_pieces(spark, saved(spark, tmp_path / "b", documents=empty_docs(spark))).collect() == []


def test_columns_survive_and_clashes_are_replaced(spark):
    docs = awkward_docs(spark, "some words").withColumnRenamed("lang", "piece_ids").withColumnRenamed("source", "decoded")
    encoded = pieces.encode(docs, PATH)
    assert set(encoded.columns) == set(docs.columns)
    by_text = {r.text: r for r in pieces.decode(encoded, PATH).collect()}
    assert by_text["some words"].piece_ids == LIBRARY.encode("some words") and by_text["some words"].decoded == "some words"
    assert by_text[None].piece_ids == [] and by_text[None].decoded == ""
    digests = pieces.round_trip_digests(docs.withColumnRenamed("piece_ids", "_text").withColumnRenamed("decoded", "n_tokens"), PATH)
    assert "_text" in digests.columns and digests.where("n_tokens = 2").count() == 1
