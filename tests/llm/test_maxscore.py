from __future__ import annotations

import math
import random

import pytest
from llm_cases import saved

from ampflow.llm import maxscore as S

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k=10):
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    asked = {}
    for i, v in usable:
        if i % 100 == 0:
            asked[i] = min(asked.get(i, v), v)
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in usable if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def as_float32(spark, rows):
    return spark.createDataFrame(rows, VECTORS)


@pytest.mark.parametrize("spread", [1.0, 0.02])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, spread):
    monkeypatch.setattr(S, "SHARD_ROWS", 37)
    monkeypatch.setattr(S, "BLOCK_ROWS", 3)
    monkeypatch.setattr(S, "BLOCKS_AT_ONCE", 2)
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0, spread) for _ in range(8)], None) for i in range(1, 1200)]
    rows += [(2000 + i, rows[5][1], 1) for i in range(15)]  # ties
    rows += [(0, None, 1), (None, [1.0] * 8, 1), (100_000, [None] + [0.1] * 7, 0), (100_100, [float("nan")] * 8, 0)]
    rows += [(100_200, [float("inf")] * 8, 0), (100_300, [], 0), (7, rows[6][1], 0)]
    stored = as_float32(spark, rows)
    got = S.op3_maxscore(spark, saved(spark, tmp_path, embeddings=stored.repartition(3))).collect()
    want = brute([tuple(r) for r in stored.collect()])
    # Rows with one id and score are alike, whichever comes first.
    assert sorted(tuple(r) for r in got) == want


def test_fewer_than_k_and_empty(spark, tmp_path):
    rows = as_float32(spark, [(0, [1.0, -1.0], 0), (1, [0.5, 0.5], 0), (2, [-2.0, 1.0], 0)])
    got = sorted(tuple(r) for r in S.op3_maxscore(spark, saved(spark, tmp_path / "a", embeddings=rows)).collect())
    assert got == [(0, 1, 1, 0), (0, 2, 2, -3072 * 1024)]
    assert S.op3_maxscore(spark, saved(spark, tmp_path / "b", embeddings=rows.limit(0))).collect() == []


def test_non_essential_terms_are_skipped():
    import numpy as np

    terms = np.array([[9, 0, 8, -1], [1, 2, 0, 1]])
    shard = S.Shard(np.arange(4), terms)
    scores, ids = shard.best(np.array([10, 1]), own=-1, floor=50)
    assert dict(zip(ids.tolist(), scores.tolist(), strict=True)) == {0: 91, 2: 80}


def test_large_components_and_invalid_rows_of_a_query(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], None) for i in range(1, 250)]
    rows += [(1000 + i, [rng.uniform(-9e5, 9e5) for _ in range(8)], None) for i in range(120)]
    rows += [(5000, [None] + [0.1] * 7, 0), (5000, [0.3] * 8, 0), (5100, [-math.inf] * 8, 0), (5100, [0.4] * 8, 0)]
    stored = as_float32(spark, rows)
    got = S.op3_maxscore(spark, saved(spark, tmp_path, embeddings=stored)).collect()
    assert sorted(tuple(r) for r in got) == brute([tuple(r) for r in stored.collect()])
    assert {5000, 5100} <= {r.query_id for r in got} and any(r.score > 1 << 60 for r in got)
