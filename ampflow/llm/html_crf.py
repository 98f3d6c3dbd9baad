"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page.

Each block is main text or not. Its features are the elements open around it, their class, id and role names, and
properties of its text; the chain adds weights for the two labels of neighbouring blocks. Weights maximise the
likelihood of the labels of training pages (forward-backward), the labels of a page are the best sequence (Viterbi).

The model is trained on a bounded number of labelled pages. Every page of the table is extracted whole.

Corner cases: null and empty pages, and pages without main text, give the empty text. Cut-off or wrongly nested markup
is read as far as it goes. Character references are decoded, unknown ones stay. Repeated rows stay. An empty table
gives no rows. Columns of the input with the names of the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ampflow.llm.common import chunks, map_arrow, read_table
from ampflow.llm.html_blocks import described
from ampflow.llm.html_training import labelled_pages

LABELS = 2
STEPS = 150
RATE = 0.1
DECAY = 1e-4
SEPARATOR = "\n\n"


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis=axis)) + top.squeeze(axis)


@dataclass
class ChainField:
    """Weights of the labels by feature, and of the pairs of neighbouring labels."""

    features: dict[str, tuple[float, ...]]
    pairs: tuple[tuple[float, ...], ...]

    def labels(self, sequence: list[list[str]]) -> list[int]:
        """The best label sequence of a page's blocks."""
        if not sequence:
            return []
        own = self.features
        (a00, a01), (a10, a11) = self.pairs
        back, at0, at1 = [], 0.0, 0.0
        for i, names in enumerate(sequence):
            score0 = score1 = 0.0
            for name in names:
                weights = own.get(name)
                if weights:
                    score0 += weights[0]
                    score1 += weights[1]
            if i == 0:
                at0, at1 = score0, score1
                continue
            from0, from1 = (0 if at0 + a00 >= at1 + a10 else 1), (0 if at0 + a01 >= at1 + a11 else 1)
            at0, at1 = max(at0 + a00, at1 + a10) + score0, max(at0 + a01, at1 + a11) + score1
            back.append((from0, from1))
        best = [0 if at0 >= at1 else 1]
        for step in reversed(back):
            best.append(step[best[-1]])
        return best[::-1]

    def extract(self, page: str) -> str:
        found = described(page, self.features)
        labels = self.labels([b.features for b in found])
        return SEPARATOR.join(b.text for b, label in zip(found, labels, strict=True) if label)


def train(pages: list[str]) -> ChainField:
    """Maximum likelihood weights of labelled pages, by gradient steps of adaptive size over all pages at once."""
    sequences = [s for s in (described(p) for p in pages) if s]
    names = sorted({f for s in sequences for b in s for f in b.features})
    number = {f: i for i, f in enumerate(names)}
    longest = max(map(len, sequences))
    shape = (len(sequences), longest)
    inside, labels = np.zeros(shape, dtype=bool), np.zeros(shape, dtype=np.int64)
    rows, columns = [], []
    for i, sequence in enumerate(sequences):
        for j, block in enumerate(sequence):
            inside[i, j], labels[i, j] = True, block.part == "main"
            rows += [i * longest + j] * len(block.features)
            columns += [number[f] for f in block.features]
    rows_, columns_ = np.array(rows), np.array(columns)
    observed = np.zeros((len(names), LABELS))
    np.add.at(observed, (columns_, labels.reshape(-1)[rows_]), 1)
    both = inside[:, 1:] & inside[:, :-1]
    seen_pairs = np.zeros((LABELS, LABELS))
    np.add.at(seen_pairs, (labels[:, :-1][both], labels[:, 1:][both]), 1)
    weights, pairs = np.zeros((len(names), LABELS)), np.zeros((LABELS, LABELS))
    state = [weights, pairs]
    means, squares = [np.zeros_like(s) for s in state], [np.zeros_like(s) for s in state]
    for step in range(1, STEPS + 1):
        weights, pairs = state
        own = np.stack([np.bincount(rows_, weights[columns_, y], minlength=inside.size) for y in range(LABELS)], axis=-1)
        own = own.reshape(*shape, LABELS)
        forward, backward = np.zeros((*shape, LABELS)), np.zeros((*shape, LABELS))
        forward[:, 0] = own[:, 0]
        for j in range(1, longest):
            moved = _log_sum(forward[:, j - 1, :, None] + pairs, 1) + own[:, j]
            forward[:, j] = np.where(inside[:, j, None], moved, forward[:, j - 1])
        for j in range(longest - 2, -1, -1):
            moved = _log_sum(pairs + (own[:, j + 1] + backward[:, j + 1])[:, None, :], 2)
            backward[:, j] = np.where(inside[:, j + 1, None], moved, 0)
        whole = _log_sum(forward[:, -1], 1)
        chance = np.exp(forward + backward - whole[:, None, None]) * inside[..., None]
        joint = forward[:, :-1, :, None] + pairs + (own[:, 1:] + backward[:, 1:])[:, :, None, :] - whole[:, None, None, None]
        expected_pairs = np.exp(joint[both]).sum(axis=0)
        flat = chance.reshape(-1, LABELS)
        expected = np.stack([np.bincount(columns_, flat[rows_, y], minlength=len(names)) for y in range(LABELS)], axis=-1)
        slopes = [(expected - observed) / len(sequences) + DECAY * weights, (expected_pairs - seen_pairs) / len(sequences) + DECAY * pairs]
        for i, slope in enumerate(slopes):
            means[i] = 0.9 * means[i] + 0.1 * slope
            squares[i] = 0.99 * squares[i] + 0.01 * slope**2
            state[i] = state[i] - RATE * (means[i] / (1 - 0.9**step)) / (np.sqrt(squares[i] / (1 - 0.99**step)) + 1e-8)
    weights, pairs = state
    return ChainField({n: tuple(w) for n, w in zip(names, weights.tolist(), strict=True)}, tuple(map(tuple, pairs.tolist())))


def extract_main_text(pages: DataFrame, model: ChainField, html_column: str = "html") -> DataFrame:
    """``pages`` with ``text``, the main text of each page, and ``n_chars``."""
    pages = pages.drop("text", "n_chars")
    place = pages.columns.index(html_column)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, place, 4 << 20):
            texts = [model.extract(p) if p else "" for p in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*batch.schema.names, "text", "n_chars"],
            )

    added = [StructField("text", StringType()), StructField("n_chars", LongType())]
    return map_arrow(pages, worker, StructType([*pages.schema.fields, *added]))


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = read_table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return extract_main_text(pages, train(labelled_pages())).select("page_id", "url", "text", "n_chars")
