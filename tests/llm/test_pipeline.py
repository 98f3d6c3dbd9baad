from __future__ import annotations

import random

import corpus_pipeline as P
import public_tokenizers
from llm_cases import awkward_docs, empty_docs, saved
from tokenizers import Tokenizer

import __spark_entry__ as entry

LABELS = "doc_id long, quality int, toxic int"
BENCH = "item_id long, text string"


def planted(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(700)]

    def prose(n):
        return " ".join(rng.choices(words, k=n)) + "."

    clean = [prose(rng.randint(150, 300)) for _ in range(120)]
    toxic = [prose(60) + " you scum vermin. " + prose(60) for _ in range(40)]
    copies = [clean[0], clean[0].upper(), clean[1] + " "]
    item = prose(40)
    leaks = [prose(80) + " " + item + " " + prose(80)]
    texts = clean + toxic + copies + leaks
    docs = awkward_docs(spark, *texts)
    labels = [(10 + i, 1, int(120 <= i < 160)) for i in range(len(texts))]
    return docs, spark.createDataFrame(labels, LABELS), spark.createDataFrame([(1, item)], BENCH), texts


def test_every_stage_does_its_part(spark, tmp_path):
    docs, labels, bench, texts = planted(spark)
    folder = saved(spark, tmp_path, documents=docs, labels=labels, benchmark=bench)
    sizes, current = [], spark.read.parquet(f"{folder}/documents.parquet")
    for i, (_, stage) in enumerate(P.STAGES):
        current = stage(spark, current, folder)
        if i < 3:
            assert current.columns == docs.columns
        current.write.parquet(f"{tmp_path}/stage{i}")
        current = spark.read.parquet(f"{tmp_path}/stage{i}")
        sizes.append(current.count())
    kept = {r.doc_id: r for r in current.collect()}
    ids = {10 + i for i in range(len(texts))}
    gone = ids - kept.keys()
    assert {10 + i for i in range(120, 160)} <= gone  # toxic
    assert 10 + 163 in gone  # the leak
    assert len({10, 130 + 40, 131 + 40} & kept.keys()) == 1 and len({11, 132 + 40} & kept.keys()) == 1
    assert {10 + i for i in range(2, 120)} <= kept.keys()
    assert sizes[0] == docs.count() - 40 and sizes[2] == sizes[3]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i in (12, 40, 99):
        assert kept[i].token_ids == library.encode(texts[i - 10], add_special_tokens=False).ids
        assert kept[i].n_tokens == len(kept[i].token_ids)


def test_run_equals_the_stages_and_takes_empty_tables(spark, tmp_path):
    docs, labels, bench, _ = planted(spark)
    folder = saved(spark, tmp_path / "a", documents=docs, labels=labels, benchmark=bench)
    rows = entry.queries()["pipeline"](spark, folder)
    assert rows.count() == rows.select("doc_id").distinct().count()
    empty = saved(spark, tmp_path / "b", documents=empty_docs(spark), labels=labels.limit(0), benchmark=bench.limit(0))
    assert P.run(spark, empty).collect() == []


def test_extra_columns_with_clashing_names(spark, tmp_path):
    docs, labels, bench, _ = planted(spark)
    docs = docs.withColumnRenamed("lang", "_row").withColumnRenamed("source", "score").withColumnRenamed("n_chars", "place")
    folder = saved(spark, tmp_path, documents=docs, labels=labels, benchmark=bench)
    assert {"_row", "score", "place"} <= set(P.run(spark, folder).columns)


def test_queries_are_registered():
    names = list(entry.queries())
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
