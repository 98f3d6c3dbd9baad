"""The corpus pipeline: toxic documents go, near-duplicates go, benchmark leaks go, the rest is encoded.

Every stage works on all that its predecessor kept. All but the last return the columns of ``documents``; the last adds
``token_ids``, ``n_tokens`` and the digest of the decoded text in place of the text. Stages are written to the shared
folder and read again, so a lost executor costs one stage at most.

Null and empty texts score 0, are near-duplicates of each other (fingerprint zero), hold no benchmark item, and have no
tokens. Extra columns are carried along; those named like a column that the last stage adds are replaced.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ampflow.llm.bpe import TOKENIZER, encode_and_check
from ampflow.llm.common import read_table, written
from ampflow.llm.decontaminate import decontaminated
from ampflow.llm.simhash import deduplicated
from ampflow.llm.toxicity import harmless, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labels does not reject."""
    return harmless(docs, toxicity_model(spark, sf_dir, docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by the contract of the SimHash operator."""
    return deduplicated(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number, and the digest of what they decode to."""
    return encode_and_check(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("bpe", tokenize),
]

#: Not expressible in SQL: a trained classifier, hashed fingerprints, a decomposition and a tokenizer. Tested against
#: brute-force versions of the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
