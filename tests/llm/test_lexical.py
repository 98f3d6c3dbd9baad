from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import awkward_docs, empty_docs, saved

from ampflow.llm import lexical as L

ITEMS = "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, w, Counter(w)) for i, w in held if w]
    n_docs, length = len(held), sum(len(w) for _, w, _ in held)
    df = Counter(t for _, _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, words, counts in held:
            m = 100 - 25 + (25 * len(words) * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m))
                for t in terms(text)
                if t in counts
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def corpus(n=700, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeéü", k=rng.randint(1, 4))) for _ in range(300)]
    weights = [1 / (i + 1) for i in range(300)]

    def text(n):
        return " ".join(w.upper() if rng.random() < 0.1 else w for w in rng.choices(words, weights, k=n)) + rng.choice(".?!")

    docs = [(i, text(rng.randint(1, 120))) for i in range(n)]
    docs += [(n + i, docs[5][1]) for i in range(40)] + [(5000, " ".join(words) * 3), (None, docs[9][1])]
    items = [(i, text(rng.randint(1, 40))) for i in range(25)] + [(100, docs[5][1]), (101, ""), (102, None), (103, "zzz"), (None, words[0]), (0, words[1])]
    return docs, items


@pytest.mark.parametrize(("block", "shard", "long", "group"), [(32, 1 << 18, 1024, 16 << 20), (4, 900, 40, 700)])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, block, shard, long, group):
    for name, value in (("BLOCK", block), ("SHARD_ENTRIES", shard), ("LONG", long), ("GROUP_BYTES", group), ("ASKED", 90), ("FIRST_ROUND", 3)):
        monkeypatch.setattr(L, name, value)
    docs, items = corpus()
    folder = saved(
        spark, tmp_path, benchmark=spark.createDataFrame(items, ITEMS),
        documents=spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
    )
    got = L.op11_lexical(spark, folder)
    assert got.columns[:4] == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


def test_blocks_are_skipped_and_their_bounds_hold():
    docs, items = corpus()
    vocabulary = {}
    for _, text in items:
        for t in terms(text):
            vocabulary.setdefault(t, len(vocabulary))
    counts = [Counter(vocabulary[t] for t in terms(text) if t in vocabulary) for _, text in docs]
    row = {
        "ids": np.arange(len(docs)).astype("<i8").tobytes(),
        "lengths": np.array([len(terms(t)) for _, t in docs], "<i8").tobytes(),
        "sizes": np.array([len(c) for c in counts], "<i4").tobytes(),
        "terms": np.array([t for c in counts for t in c], "<i4").tobytes(),
        "counts": np.array([n for c in counts for n in c.values()], "<i8").tobytes(),
    }
    holding = np.bincount([t for c in counts for t in c], minlength=len(vocabulary))
    known = L.Statistics(len(docs), sum(len(terms(t)) for _, t in docs), holding)
    queries = []
    for i, (_, text) in enumerate(items):
        own = sorted({vocabulary[t] for t in terms(text)} & set(np.flatnonzero(holding).tolist()))
        queries.append(L.Query(i, i, np.array(own, dtype=np.int64), np.array([known.weight(t) for t in own], dtype=np.int64)))
    block = L.query_blocks(queries)[0]
    shard = L.Shard(row, known, block)
    for term in range(len(block.terms)):
        members, starts = shard.blocks(term)
        summaries = shard.summaries(members, starts, block.coordinates[term])
        for i in block.asking[term]:
            own, weights = block.own[i], block.queries[i].weights
            bounds = summaries[:, np.searchsorted(block.coordinates[term], own)] @ weights
            scores = shard.scores(members, own, weights)
            assert (np.repeat(bounds, np.diff([*starts, len(members)])) >= scores).all()
    assert L.search_shard(shard, block, [L.Best(3) for _ in block.queries]) > 100


def test_awkward_rows_and_extra_columns(spark, tmp_path):
    docs = awkward_docs(spark, "Lorem, IPSUM!", "été ÉTÉ").withColumnRenamed("lang", "rank").withColumnRenamed("source", "score")
    items = spark.createDataFrame([(1, "lorem sit", 2), (2, "ÉTÉ twice", 3), (2, "twice", 4)], "item_id long, text string, doc_id int")
    got = L.op11_lexical(spark, saved(spark, tmp_path / "a", documents=docs, benchmark=items))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert sorted(map(tuple, got.collect()), key=repr) == want
    for name, tables in {"b": (empty_docs(spark), items), "c": (docs, items.limit(0)), "d": (docs.limit(0), items.limit(0))}.items():
        assert L.op11_lexical(spark, saved(spark, tmp_path / name, documents=tables[0], benchmark=tables[1])).collect() == []
