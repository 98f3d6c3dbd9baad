"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, trained from document labels.

A sentence is a bag of word features: the word and its first four and five letters, so that inflected forms share
what they have in common. Its score is a logistic function of the feature weights. A document is toxic if any of its
sentences is: its probability is one minus the product of the sentences' probabilities of being harmless. Features
that toxic documents do not hold more often than others weigh nothing, and a sentence without telling features cannot
offend, so a long text is not suspect for its length. Only
documents have labels; the gradient of the noisy-or hands each document's label to the sentences that explain it.
With the trained weights, sentences are scored alone, which locates the offending ones.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS`` of each label, ``SAMPLE_CHARS`` characters),
taken by a hash of the id; everything is scored. Ids, sources and languages are never features.

Corner cases: null and empty texts have no sentence and the score 0. Texts are scored whole. Repeated rows get the same
score. Without toxic or without harmless labels in the sample no weights can be learned and every score is 0. Null
labels are no labels; of several labels of one id the largest counts. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from ampflow.llm.common import chunks, map_arrow, read_table
from ampflow.llm.tokens import Remembered

SAMPLE_ROWS = {1: 3000, 0: 6000}
SAMPLE_CHARS = 32_000_000
LONGEST_SAMPLED = 200_000
#: Standard deviations by which toxic documents must hold a feature more often than harmless ones.
LEAST_EXCESS = 5.0
STEPS = 40
RATE = 0.1
START_BIAS = -9.0
#: Weight of the prior that draws the weights to where they start.
PULL = 1e-4
THRESHOLD = 0.7
HELD_OUT = 1

TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]+")
SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
#: Value that stands for a sentence end among word weights.
BREAK = 1e9


def word_features(word: str) -> list[str]:
    out = [f"={word}"]
    out += [f"{n}{word[:n]}" for n in (4, 5) if len(word) >= n]
    return out


@dataclass
class Model:
    """Feature weights, those near zero left out, and the bias of a sentence."""

    weights: dict[str, float]
    bias: float | None

    def token_weights(self) -> Remembered:
        def weight(token: str) -> float:
            if not token[0].isalpha():
                return BREAK
            return sum(self.weights.get(f, 0.0) for f in word_features(token))

        return Remembered(weight)

    def sentence_scores(self, text: str, known: Remembered) -> np.ndarray:
        """Logits of the sentences of a text that have telling features; the others cannot offend."""
        values = np.array([known[t] for t in TOKEN.findall(text.lower())])
        if not len(values) or self.bias is None:
            return np.empty(0)
        breaks = values == BREAK
        sums = np.bincount(np.cumsum(breaks)[~breaks], values[~breaks])
        return sums[sums > 0] + self.bias

    def score(self, text: str, known: Remembered) -> float:
        return float(-np.expm1(-np.logaddexp(0, self.sentence_scores(text, known)).sum()))

    def offending(self, text: str, known: Remembered) -> list[dict]:
        """Sentences that are likelier toxic than not: code-point spans and scores."""
        out = []
        for found in SENTENCE.finditer(text):
            score = self.score(found.group(), known)
            if score >= 0.5:
                out.append({"start": found.start(), "end": found.end(), "score": score})
        return out


def _instances(texts: list[str], places: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature and sentence number of every feature occurrence, and the document of every sentence that has any."""

    def located(token: str) -> tuple[int, ...] | None:
        if not token[0].isalpha():
            return None
        return tuple(places[f] for f in word_features(token) if f in places)

    known = Remembered(located)
    features: list[int] = []
    sizes: list[int] = []
    owners: list[int] = []
    for doc, text in enumerate(texts):
        before = len(features)
        for found in [known[t] for t in [*TOKEN.findall(text.lower()), "."]]:
            if found is not None:
                features += found
            elif len(features) > before:
                sizes.append(len(features) - before)
                owners.append(doc)
                before = len(features)
    sentences = np.repeat(np.arange(len(sizes)), sizes)
    return np.array(features, dtype=np.int32), sentences.astype(np.int32), np.array(owners, dtype=np.int32)


def telling_features(texts: list[str], y: np.ndarray) -> dict[str, float]:
    """Features that toxic documents hold more often than chance explains, with their log odds ratio."""

    def held(text: str) -> set[str]:
        return {f for t in set(TOKEN.findall(text.lower())) if t[0].isalpha() for f in word_features(t)}

    toxic: Counter[str] = Counter()
    for text in (t for t, label in zip(texts, y.tolist(), strict=True) if label):
        toxic.update(held(text))
    # One document tells nothing; most features occur in one, so the rest are few enough to count in the others.
    seen = Counter({f: n for f, n in toxic.items() if n > 1})
    for text in (t for t, label in zip(texts, y.tolist(), strict=True) if not label):
        seen.update(held(text) & seen.keys())
    share, positives = y.mean(), int(y.sum())
    out = {}
    for feature, total in sorted(seen.items()):
        among = toxic[feature]
        if (among - total * share) / np.sqrt(total * share * (1 - share)) >= LEAST_EXCESS:
            odds = (among + 0.5) / (positives + 1) / ((total - among + 0.5) / (len(y) - positives + 1))
            out[feature] = float(np.log(odds))
    return out


def fit(texts: list[str], labels: list[int]) -> Model:
    """Maximum likelihood of the document labels under the noisy-or, by gradient steps of adaptive size.

    Weights are never negative, so harmless words cannot hide an offence in a long sentence; they start at half the
    log odds ratio and are drawn to it, as otherwise the first word to explain a document leaves none of it to the others.
    """
    y = np.array(labels, dtype=bool)
    if not y.any() or y.all():
        return Model({}, None)
    start = telling_features(texts, y)
    names = list(start)
    features, sentences, owners = _instances(texts, {f: i for i, f in enumerate(names)})
    prior = 0.5 * np.array([*start.values()])
    state = np.concatenate((prior, [START_BIAS]))  # the weights, then the bias
    mean, square = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, STEPS + 1):
        logits = np.bincount(sentences, state[features], minlength=len(owners)) + state[-1]
        chance = 1 / (1 + np.exp(-np.clip(logits, -50, 50)))
        harmless = np.bincount(owners, np.logaddexp(0, logits), minlength=len(y))
        toxic = np.maximum(-np.expm1(-harmless), 1e-12)
        pull = np.where(y, -np.exp(-harmless) / toxic, 1.0)
        slope = pull[owners] * chance
        grown = np.bincount(features, slope[sentences], minlength=len(names))
        gradient = np.concatenate((grown, [slope.sum()])) / len(y)
        gradient[:-1] += PULL * (state[:-1] - prior)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        state = state - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        state[:-1] = np.maximum(state[:-1], 0)
    kept = {n: float(w) for n, w in zip(names, state[:-1], strict=True) if w > 0}
    return Model(kept, float(state[-1]))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(text, toxic)`` of the bounded sample: the first labelled ids by hash, up to so many rows and characters.

    Of several texts with one id the one with the least hash is taken. Lengths decide first, without the texts; the texts
    that are taken are fetched by a second scan.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("_id"))
    marked = marked.agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
    order = F.xxhash64("_id", F.lit(0))
    chosen = None
    for value, rows in SAMPLE_ROWS.items():
        some = marked.where(F.col("_toxic") == value).orderBy(order).limit(rows)
        chosen = some if chosen is None else chosen.union(some)
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.xxhash64("text").alias("_hash")).where(
        F.length("_text").between(1, LONGEST_SAMPLED)
    )
    # At most the rows of SAMPLE_ROWS: a few hundred kilobytes whatever the size of the tables.
    sizes = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_toxic")
    sizes = sizes.agg(F.min(F.struct("_hash", F.length("_text").alias("_size"))).alias("_one"))
    ranked = sizes.select("_id", "_toxic", "_one.*", order.alias("_order"))
    running = F.sum("_size").over(Window.orderBy("_order").rowsBetween(Window.unboundedPreceding, 0))
    kept = ranked.withColumn("_sum", running).where(F.col("_sum") <= SAMPLE_CHARS).drop("_sum", "_size")
    found = texts.join(F.broadcast(kept), ["_id", "_hash"]).dropDuplicates(["_id"])
    return found.orderBy("_order").select(F.col("_text").alias("text"), F.col("_toxic").alias("toxic"))


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of a bounded sample of the labelled documents."""
    rows = labelled_sample(docs, labels).toArrow()
    return fit(rows.column("text").to_pylist(), rows.column("toxic").to_pylist())


SPANS = ArrayType(
    StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("score", DoubleType())])
)


def score_documents(docs: DataFrame, model: Model, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``offending``, the spans of the sentences likelier toxic than not.

    Columns of these names are replaced.
    """
    docs = docs.drop("score", "predicted", "offending")
    place = docs.columns.index(text_column)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.token_weights()
        for batch in chunks(batches, place):
            texts = [t or "" for t in batch.column(place).to_pylist()]
            scores = [model.score(t, known) for t in texts]
            spans = [model.offending(t, known) if s >= 0.5 else [] for t, s in zip(texts, scores, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= threshold) for s in scores], pa.int32()),
                    pa.array(spans, span_type),
                ],
                names=[*batch.schema.names, "score", "predicted", "offending"],
            )

    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    added = [StructField("score", DoubleType()), StructField("predicted", IntegerType()), StructField("offending", SPANS)]
    return map_arrow(docs, worker, StructType([*docs.schema.fields, *added]))


def harmless(docs: DataFrame, model: Model, text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score at least ``threshold``; columns as they are."""
    place = docs.columns.index(text_column)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.token_weights()
        for batch in chunks(batches, place):
            scores = [model.score(t or "", known) for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return map_arrow(docs, worker, docs.schema)


def remainder(id_column: str = "doc_id"):
    """crc32 of the id as text, modulo 3."""
    return F.crc32(F.encode(F.col(id_column).cast("string"), "UTF-8")) % 3


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> Model:
    """The model of the labels that are not held out."""
    labels = read_table(spark, sf_dir, "labels").where(remainder() != HELD_OUT)
    return trained(docs, labels)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score; labels of one third of the ids are never learned from."""
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = toxicity_model(spark, sf_dir, docs)
    scored = score_documents(docs, model)
    return scored.select(
        "doc_id", (remainder() == HELD_OUT).alias("held_out"), "score", "predicted", F.size("offending").alias("n_offending")
    )
