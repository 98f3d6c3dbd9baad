from __future__ import annotations

import struct
import zlib

import pytest
import xxhash
from llm_cases import awkward_docs, empty_docs, saved
from pyspark.sql import functions as F

from ampflow.llm import sharding as S

MASK = (1 << 64) - 1


def spark_hash(*longs: int) -> int:
    seed = 42
    for value in longs:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", value), seed & MASK)
    return seed - (1 << 64) if seed >> 63 else seed


def place(number: int, total: int, seed: int) -> int:
    """The permutation in plain Python."""
    a, b = S.halves(total)
    while True:
        left, right = divmod(number, b)
        for i in range(S.ROUNDS):
            if i % 2 == 0:
                left = (left + spark_hash(seed * S.ROUNDS + i, right) % a) % a
            else:
                right = (right + spark_hash(seed * S.ROUNDS + i, left) % b) % b
        number = left * b + right
        if number < total:
            return number


@pytest.mark.parametrize("total", [1, 2, 3, 7, 10, 97, 100, 1000, 4097])
def test_places_are_a_permutation_and_computable(spark, total):
    got = [r[0] for r in spark.range(total).orderBy("id").select(S.place_of(F.col("id"), total)).collect()]
    assert sorted(got) == list(range(total))
    assert got[:50] == [place(n, total, S.SEED) for n in range(min(total, 50))]


@pytest.mark.parametrize("total", [0, 1, 2, 5, 99, 10**6, 10**11 + 7])
def test_few_values_lie_outside(total):
    a, b = S.halves(total)
    assert a * b >= total and a * b - total < max(a, 2)


def check_law(rows, total, shards):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert sum(map(len, by_shard.values())) == total
    for slots in by_shard.values():
        assert sorted(slots) == list(range(len(slots)))
    sizes = [len(by_shard.get(i, [])) for i in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_query_on_awkward_rows(spark, tmp_path):
    docs = awkward_docs(spark, "x", "ü", "x")
    rows = S.op9_feistel_shards(spark, saved(spark, tmp_path, documents=docs)).collect()
    check_law(rows, docs.count(), 40)
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    got = sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows)
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in docs.collect())
    assert got == want


def test_result_does_not_depend_on_the_partitions(spark):
    rows = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("size"))
    one = S.feistel_shards(rows.coalesce(1), ["doc_id"], 6).orderBy("doc_id").collect()
    many = S.feistel_shards(rows.orderBy(F.rand(3)).repartition(9), ["doc_id"], 6).orderBy("doc_id").collect()
    assert one == many


def test_one_id_for_a_third_of_the_rows(spark):
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("doc_id"))
    check_law(S.feistel_shards(rows, ["doc_id"], 40).collect(), 900, 40)


def test_clashing_columns_and_empty_table(spark, tmp_path):
    rows = spark.range(5).select("id", F.lit("old").alias("shard"), F.lit(1).alias("_part"), F.lit(2).alias("_AT"))
    got = S.feistel_shards(rows, ["id"], 2)
    assert {"_part", "_AT"} <= set(got.columns)
    check_law(got.collect(), 5, 2)
    assert S.op9_feistel_shards(spark, saved(spark, tmp_path, documents=empty_docs(spark))).collect() == []


def test_main_path_runs_no_python(spark, tmp_path):
    plan = S.op9_feistel_shards(spark, saved(spark, tmp_path, documents=awkward_docs(spark)))
    assert not any(word in plan._jdf.queryExecution().toString() for word in ("Python", "Arrow", "Pandas"))
