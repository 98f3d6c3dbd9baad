from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from llm_cases import awkward_docs, empty_docs, saved

from ampflow.llm import toxicity as S
from ampflow.llm.tokens import Remembered

LABELS = "doc_id long, quality int, toxic int"
BAD = ["scum", "idiotic", "idiots", "vile"]


def sample(count, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    texts, labels = [], []
    for i in range(count):
        sentences = [" ".join(rng.choices(words, k=rng.randint(3, 12))) for _ in range(rng.randint(1, 12))]
        label = int(i % 4 == 0)
        if label:
            at = rng.randrange(len(sentences))
            sentences[at] += " " + " ".join(rng.choices(BAD, k=rng.randint(1, 2)))
        texts.append(". ".join(sentences) + ".")
        labels.append(label)
    return texts, labels


@pytest.fixture(scope="module")
def model():
    return S.fit(*sample(800, 1))


def test_held_out_accuracy(model):
    texts, labels = sample(1200, 1)
    known = model.token_weights()
    scores = np.array([model.score(t, known) for t in texts[800:]])
    assert ((scores >= S.THRESHOLD) == np.array(labels[800:], dtype=bool)).mean() > 0.97


def test_noisy_or_of_the_sentences(model):
    known = model.token_weights()
    text = "abc def. scum here! quiet words\nidiots"
    parts = [1 / (1 + np.exp(-s)) for s in model.sentence_scores(text, known)]
    assert len(parts) == 2  # sentences without telling features cannot offend
    assert model.score(text, known) == pytest.approx(1 - np.prod([1 - p for p in parts]), abs=1e-9)


def test_offending_sentences_are_located(model):
    text = "All is well. You scum and idiots! Bye."
    spans = model.offending(text, model.token_weights())
    assert [text[s["start"] : s["end"]].strip() for s in spans] == ["You scum and idiots!"]


def test_long_harmless_texts_stay_harmless(model):
    rng = random.Random(9)
    text = ". ".join(" ".join(rng.choices(["abc", "def", "ghij"], k=6)) for _ in range(3000))
    assert model.score(text, model.token_weights()) < S.THRESHOLD


def test_query(spark, tmp_path):
    texts, labels = sample(600, 1)
    docs = awkward_docs(spark, *texts, "you scum " * 4000).withColumnRenamed("lang", "score")
    marked = [(10 + i, 1, y) for i, y in enumerate(labels)]
    stored = spark.createDataFrame([*marked, (None, 1, 1), (12, None, None), (10, 0, 1)], LABELS)
    rows = S.op8_toxicity(spark, saved(spark, tmp_path, documents=docs, labels=stored)).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    for r in rows:
        shown = "" if r.doc_id is None else str(r.doc_id)
        assert r.doc_id is None or r.held_out == (zlib.crc32(shown.encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    assert by_id[1].score == by_id[2].score == 0
    assert by_id[10 + len(texts)].predicted == 1
    held = [(by_id[10 + i].predicted, y) for i, y in enumerate(labels) if by_id[10 + i].held_out]
    assert np.mean([p == y for p, y in held]) > 0.95


def test_held_out_labels_are_not_learned_from(spark, tmp_path):
    texts, labels = sample(300, 1)
    docs = awkward_docs(spark, *texts)
    flipped = [(10 + i, 1, 1 - y if zlib.crc32(str(10 + i).encode()) % 3 == 1 else y) for i, y in enumerate(labels)]
    true = [(10 + i, 1, y) for i, y in enumerate(labels)]
    got = []
    for name, rows in (("a", flipped), ("b", true)):
        folder = saved(spark, tmp_path / name, documents=docs, labels=spark.createDataFrame(rows, LABELS))
        got.append(sorted((str(r.doc_id), r.score) for r in S.op8_toxicity(spark, folder).collect()))
    assert got[0] == got[1]


def test_without_labels_or_documents(spark, tmp_path):
    none = spark.createDataFrame([], LABELS)
    rows = S.op8_toxicity(spark, saved(spark, tmp_path / "a", documents=awkward_docs(spark, "scum"), labels=none)).collect()
    assert {r.score for r in rows} == {0.0}
    assert S.op8_toxicity(spark, saved(spark, tmp_path / "b", documents=empty_docs(spark), labels=none)).collect() == []
    assert S.Model({}, None).score("scum", Remembered(lambda t: 1.0)) == 0


def test_sample_of_repeated_ids_is_always_the_same(spark, monkeypatch):
    rows = [(i % 40, f"text {i} of {'many ' * (i % 7)}words") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(40)], "doc_id long, toxic int")
    samples = []
    for parts in (1, 7):
        docs = spark.createDataFrame(rows[:: 1 if parts == 1 else -1], "doc_id long, text string").repartition(parts)
        samples.append([tuple(r) for r in S.labelled_sample(docs, labels).collect()])
    assert samples[0] == samples[1] and len(samples[0]) == 40
    monkeypatch.setattr(S, "SAMPLE_CHARS", 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few = [tuple(r) for r in S.labelled_sample(docs, labels).collect()]
    assert few == samples[0][: len(few)] and sum(len(t) for t, _ in few) <= 300 < sum(len(t) for t, _ in samples[0][: len(few) + 1])
