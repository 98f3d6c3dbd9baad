from __future__ import annotations

import random

import pytest
import xxhash
from llm_cases import awkward_docs, empty_docs, saved

from ampflow.llm import simhash as S
from ampflow.llm.components import connected_components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_roots(values, max_bits=4):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


@pytest.mark.parametrize("text", ["", "one", "ONE two\x0bthree", "a b c d", "Ä b  c d e f a b c d", "w " * 500, "x\x1cy é z q r s t"])
def test_fingerprint_is_that_of_plain_counting(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


def test_segments_leave_one_bit_at_most():
    bounds = S.segments(4)
    assert len(bounds) == 3 and bounds[0][0] == 0 and bounds[-1][1] == 64
    assert len(S.variant_masks(4)) == 64


def test_every_near_pair_is_linked_where_it_is_first_found(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << i for i in rng.sample(range(64), k)) for b in base for k in (0, 1, 2, 3, 4, 5, 6)]
    values = sorted(set(base + near + [0, 1, (1 << 64) - 1, 1 << 63]))
    prints = spark.createDataFrame([(S.signed(v),) for v in values], "fp long")
    links = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in S.near_links(prints).collect()]
    want = {frozenset((a, b)) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4}
    assert {frozenset(x) for x in links} == want and len(links) == len(want)


def test_dense_groups_keep_their_components(spark, monkeypatch):
    monkeypatch.setattr(S, "DENSE", 4)
    monkeypatch.setattr(S, "CHUNK", 8)
    rng = random.Random(2)
    center = rng.getrandbits(64)
    values = {center ^ sum(1 << i for i in rng.sample(range(64), rng.choice([1, 2, 3, 7, 9]))) for _ in range(120)}
    prints = spark.createDataFrame([(S.signed(v),) for v in values], "fp long")
    roots = connected_components(S.near_links(prints)).collect()
    got = {}
    for r in roots:
        got.setdefault(r.root, set()).add(r.node)
    want = {}
    for v, r in brute_roots(values).items():
        want.setdefault(r, set()).add(S.signed(v))
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    long = [" ".join(rng.choices(words, k=300)) for _ in range(4)]
    edited = [t.replace(" ", "  ", 1).upper() for t in long] + [t + " tail" for t in long]
    docs = awkward_docs(spark, *long, *edited, "short", "Short", "other")
    got = S.op4_simhash(spark, saved(spark, tmp_path, documents=docs)).collect()
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    roots = brute_roots({p for _, p in prints})
    least = {}
    for i, p in prints:
        known = [x for x in (least.get(roots[p]), i) if x is not None]
        least[roots[p]] = min(known) if known else None
    want = sorted((str(i), f"{p:016x}", str(least[roots[p]])) for i, p in prints)
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_chains_and_empty_tables(spark, tmp_path):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (7, 3), (7, 3)], "a long, b long")
    assert {(r.node, r.root) for r in connected_components(links).collect()} == {(i, 0) for i in range(61)}
    assert connected_components(links.limit(0)).collect() == []
    assert S.op4_simhash(spark, saved(spark, tmp_path, documents=empty_docs(spark))).collect() == []


def test_one_row_of_each_group_stays(spark):
    docs = awkward_docs(spark, "alpha beta", "ALPHA  beta", "gamma").withColumnRenamed("source", "_row")
    kept = S.deduplicated(docs)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    assert len([t for t in texts if not (t or "").split()]) == 1
    assert sorted(t.lower() for t in texts if t and "alpha" in t.lower()) in (["alpha beta"], ["alpha  beta"])
    assert "gamma" in texts and texts.count("twice the same") == 1


def test_kept_rows_do_not_depend_on_how_a_scan_is_split(spark, tmp_path):
    """An executor that comes or goes between the steps changes how later scans of the input are split."""
    docs = spark.createDataFrame([(i, f"text number {i // 2} of some words {i // 2}") for i in range(120)], "doc_id long, text string")
    docs.repartition(16).write.parquet(f"{tmp_path}/docs")
    name, counts = "spark.sql.leafNodeDefaultParallelism", []
    try:
        for later in ("3", "9"):
            spark.conf.set(name, "4")
            kept = S.deduplicated(spark.read.parquet(f"{tmp_path}/docs"))
            spark.conf.set(name, later)
            counts.append((kept.count(), kept.select("text").distinct().count()))
    finally:
        spark.conf.unset(name)
    assert counts == [(60, 60)] * 2
