from __future__ import annotations

import random

import numpy as np
import pytest
from llm_cases import awkward_docs, empty_docs, saved

from ampflow.llm import decontaminate as S

BENCH = "item_id long, text string"


def corpus(seed=4):
    rng = random.Random(seed)
    words = ["the", "of", "and", "a", "to"] * 12 + ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(900)]

    def prose(n):
        out = rng.choices(words, k=n)
        return " ".join(w + (". " if rng.random() < 0.1 else "") for w in out).replace("  ", " ")

    items = [prose(rng.randint(15, 90)) for _ in range(30)]
    clean = [prose(rng.randint(5, 600)) for _ in range(60)]
    leaks = []
    for i, item in enumerate(items):
        said = item.split()
        if i % 3 == 1:
            said = [w if rng.random() > 0.12 else rng.choice(words) for w in said]
        if i % 3 == 2:
            said = " ".join(said).upper().replace(" ", " *** ").split(" ")
        leaks.append((i, prose(rng.randint(0, 200)) + " " + " ".join(said) + " " + prose(rng.randint(0, 200))))
    return items, clean, leaks


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_common_words_is_the_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = (rng.choices("abcde", k=rng.randint(1, 30)) for _ in range(2))
        assert S.common_words(S.masks_of(a), len(a), b) == lcs(a, b)


def test_leaks_are_found_and_clean_documents_are_left(spark, tmp_path):
    items, clean, leaks = corpus()
    docs = awkward_docs(spark, *clean, *(t for _, t in leaks))
    bench = spark.createDataFrame([*enumerate(items), (99, None), (98, ""), (97, "...")], BENCH)
    rows = S.op2_decontamination(spark, saved(spark, tmp_path, documents=docs, benchmark=bench)).collect()
    want = {(10 + len(clean) + n, i) for n, (i, _) in enumerate(leaks)}
    got = {(r.doc_id, r.item_id) for r in rows}
    assert got <= want and len(got) >= 0.9 * len(want)
    assert {w for w in want if (w[1]) % 3 != 1} <= got
    for r in rows:
        assert r.common >= S.LEAST_COMMON and (r.common >= S.NEAR_EXACT or r.answer >= S.LEAST_ANSWER)
    kept = S.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    bad = {d for d, _ in got}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in docs.collect() if r.doc_id not in bad)


def test_candidate_recall_against_brute_force():
    items, clean, leaks = corpus(8)
    rng = np.random.default_rng(0)
    weights = np.ones(S.BUCKETS)
    for word in ("the", "of", "and", "a", "to"):
        weights[S.bucket_of(word)] = 0.1
    rows = np.zeros((0, S.BUCKETS))
    for item in items:
        for passage in S.passages(np.array([S.bucket_of(w) for w in S.words_of(item)])):
            vector = np.bincount(passage, weights[passage], minlength=S.BUCKETS)
            rows = np.vstack([rows, vector / np.linalg.norm(vector)])
    _, _, space = np.linalg.svd(rows @ rng.standard_normal((S.BUCKETS, 1)) * 0 + rows, full_matrices=False)
    terms = np.concatenate((weights[:, None] * space.T, np.zeros((1, len(space))))).astype(np.float32)
    matcher = S.Matcher([(i, t, None) for i, t in enumerate(items)], terms)
    found = matcher.candidates([t.lower().split() for _, t in leaks])
    hit = sum(any(c[0] == i for c in own) for (i, _), own in zip(leaks, found, strict=True))
    assert hit >= 0.9 * len(leaks)


def test_decomposition_matches_a_direct_one(spark):
    items, _, _ = corpus(6)
    weights = np.ones(S.BUCKETS)
    rows = S.passage_rows(spark.createDataFrame([(t,) for t in items], "text string"), weights)
    space = S.latent_space(rows, rank=10)
    matrix = np.zeros((rows.count(), S.BUCKETS))
    for i, r in enumerate(rows.collect()):
        matrix[i, r.terms] = r["values"]
    exact = np.linalg.svd(matrix, compute_uv=False)[:10]
    assert np.allclose(np.linalg.norm(space, axis=0), 1)
    assert (np.sort(np.linalg.norm(matrix @ space, axis=0))[::-1] >= 0.9 * exact).all()


def test_answer_column_decides_paraphrases():
    words = [f"w{i}" for i in range(20)]
    text = " ".join(words)
    said = " ".join(["x"] * 4 + words[4:])
    with_answer = S.item_of(1, text, "w0 w1 w2 w3")
    assert with_answer.compare(said.split())[:2] == (0.8, 0.0)
    assert S.item_of(1, text, "w18 w19").compare(said.split())[1] == 1.0


@pytest.mark.parametrize("items", [[], [(1, None)], [(1, "alpha beta gamma delta")]])
def test_empty_tables(spark, tmp_path, items):
    bench = spark.createDataFrame(items, BENCH)
    for name, docs in (("a", empty_docs(spark)), ("b", awkward_docs(spark))):
        assert S.op2_decontamination(spark, saved(spark, tmp_path / name, documents=docs, benchmark=bench)).collect() == []
        assert S.decontaminated(docs, bench).count() == docs.count()


def short_and_long_items(count=4500, seed=11):
    """Items of 4 to 60 words, most of them short, over words of very different frequency; and documents that hold some."""
    rng = np.random.default_rng(seed)
    names = np.array([f"w{i}" for i in range(20000)])
    odds = 1 / np.arange(1, len(names) + 1)
    odds /= odds.sum()

    def prose(n):
        return list(rng.choice(names, n, p=odds))

    items = [prose(int(rng.integers(15, 61)) if i % 10 == 0 else int(rng.integers(4, 15))) for i in range(count)]
    leaks = []
    for i in range(0, count, 15):
        said = list(items[i])
        if i % 2:
            for at in rng.choice(len(said), len(said) // 5, replace=False):
                said[at] = "replaced"
        leaks.append((i, " ".join(prose(200) + said + prose(200))))
    return [" ".join(w) for w in items], leaks


def test_recall_of_short_items_and_of_many(spark):
    items, leaks = short_and_long_items()
    docs = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(leaks)], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), BENCH)
    rows = S.contaminated(docs, bench).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert all(r.common >= S.LEAST_COMMON for r in rows)
    short = [(n, i) for n, (i, _) in enumerate(leaks) if len(items[i].split()) < S.PASSAGE]
    due = [(n, i) for n, i in short if S.item_of(i, items[i], None).compare(leaks[n][1].split())[0] >= S.LEAST_COMMON]
    assert len(due) > 0.8 * len(short) and got >= set(due)
    whole = {(n, i) for n, (i, _) in enumerate(leaks) if not i % 2}
    assert whole <= got


def test_anchors_lose_no_match():
    rng = random.Random(2)
    words = [f"v{i}" for i in range(40)]
    items = [rng.choices(words, k=rng.randint(1, S.PASSAGE - 1)) for _ in range(60)]
    weights = np.array([rng.random() for _ in range(S.BUCKETS)])
    terms = np.concatenate((np.random.default_rng(1).normal(size=(S.BUCKETS, 4)), np.zeros((1, 4)))).astype(np.float32)
    matcher = S.Matcher([(i, " ".join(t), None) for i, t in enumerate(items)], terms, weights)
    texts = [rng.choices(words, k=rng.randint(1, 150)) for _ in range(40)]
    for number, item in enumerate(items):
        texts.append(rng.choices(words, k=number) + [w for w in item if rng.random() < 0.9] + rng.choices(words, k=9))
    for text, found in zip(texts, matcher.found([" ".join(t) for t in texts]), strict=True):
        held = {m[0] for m in found}
        for item in matcher.items:
            common, answer, _ = item.compare(text)
            if common >= S.NEAR_EXACT or (common >= S.LEAST_COMMON and answer >= S.LEAST_ANSWER):
                assert item.number in held


def test_words_are_hashed_where_they_are_split():
    rng = random.Random(9)
    pool = [*"abZéΣİ'\"_-.,«»“…¿ \t\n\x0b\x1c\x85\xa0 　🙂½"]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(3000)] + [None, "", "x" * 3000, " - "]
    buckets, sizes = S.word_buckets(texts)
    assert sizes.tolist() == [len(S.words_of(t or "")) for t in texts]
    ends = np.cumsum(sizes)
    seen = {}
    for text, end, size in zip(texts, ends, sizes, strict=True):
        for word, bucket in zip(S.words_of(text or ""), buckets[end - size : end].tolist(), strict=True):
            assert seen.setdefault(word, bucket) == bucket
    assert len(set(seen.values())) > 0.75 * min(len(seen), S.BUCKETS * (1 - np.exp(-len(seen) / S.BUCKETS)))


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    texts = ["alpha beta  gamma", "w" * 70 + " delta " * 40, "", "…omega… " * 9]
    whole = S.word_buckets(texts)
    monkeypatch.setattr(S, "PIECE_BYTES", 11)
    assert all((a == b).all() for a, b in zip(whole, S.word_buckets(texts), strict=True))
    monkeypatch.setattr(S, "ROWS", 2)
    rng = np.random.default_rng(0)
    terms = np.concatenate((rng.normal(size=(S.BUCKETS, 8)), np.zeros((1, 8)))).astype(np.float32)
    said = " ".join(f"v{i}" for i in range(150))
    matcher = S.Matcher([(1, " ".join(f"v{i}" for i in range(40, 110)), None)], terms)
    close = matcher.close(*S.word_buckets([said, "none of it", said]))
    monkeypatch.setattr(S, "ROWS", 1024)
    again = matcher.close(*S.word_buckets([said, "none of it", said]))
    assert [[c[:2] for c in t] for t in close] == [[c[:2] for c in t] for t in again] and close[0] and not close[1]


def test_items_of_several_passes_over_the_documents(spark, monkeypatch):
    items, _, leaks = corpus(12)
    monkeypatch.setattr(S, "BLOCK_ITEMS", 4)
    monkeypatch.setattr(S, "PASS_BLOCKS", 3)
    docs = awkward_docs(spark, *(t for _, t in leaks))
    bench = spark.createDataFrame([*enumerate(items), (5, items[5])], BENCH)
    got = {(r.doc_id, r.item_id) for r in S.contaminated(docs, bench).collect()}
    assert {(10 + n, i) for n, (i, _) in enumerate(leaks) if i % 3 != 1} <= got
    bad = {d for d, _ in got}
    kept = S.decontaminated(docs, bench)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in docs.collect() if r.doc_id not in bad)
