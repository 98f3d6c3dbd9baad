"""BPE encoding and decoding with forced boundaries.

A merge makes a vocabulary token, so two neighbouring bytes that stand side by side inside no vocabulary token can
never end up in one token: between them is a certain cut. Every word is cut at these pairs, the fragments are merged
independently and the ids concatenated. Fragments repeat far more than texts do and are kept per worker.

Decoding joins the token strings by spaces, which is what a file without a decoder asks for.

Corner cases: null and empty texts have no tokens, decode to the empty text, and hash as such. Texts of any length are
encoded whole. Repeated rows stay. Lone surrogates cannot occur in Spark strings. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ampflow.llm.common import chunks, free_name, map_arrow, read_table, worker_cache
from ampflow.llm.tokens import Remembered, TokenizerFile

TOKENIZER = "word_bpe_49k.json"
#: Words that a worker remembers, some 60 MB, and fragments besides.
WORDS = 250_000
FRAGMENTS = 30_000
#: Rank of a pair that no merge has.
NEVER = 1 << 60
#: Units from which on the pairs of a fragment wait in a heap.
HEAPED = 40


class ForcedBoundaryBpe:
    """Encoder and decoder for one tokenizer file."""

    def __init__(self, path: str):
        self.file = TokenizerFile(path)
        self.ranks = {pair: rank for rank, pair in enumerate(self.file.merges)}
        self.inside = self._pairs_inside_tokens()
        self.fragments = Remembered(self._merged, FRAGMENTS)
        self.words = Remembered(self._encoded_word, WORDS)

    def _units(self, token: str) -> list[str]:
        """Base symbols of a token or word; the last of a word carries the word-end suffix."""
        suffix = self.file.suffix
        if len(token) > len(suffix) and token.endswith(suffix):
            body = token[: -len(suffix)]
            return [*body[:-1], body[-1] + suffix]
        return list(token)

    def _pairs_inside_tokens(self) -> set[tuple[str, str]]:
        pairs: set[tuple[str, str]] = set()
        for token in self.file.vocabulary:
            units = self._units(token)
            pairs.update(zip(units, units[1:], strict=False))
        return pairs

    def _merged(self, fragment: tuple[str, ...]) -> tuple[int, ...]:
        """Ids of a fragment: the best ranked pair, leftmost first, is merged until none is left."""
        if len(fragment) >= HEAPED:
            return self._merged_by_heap(fragment)
        units, rank = list(fragment), self.ranks.get
        ranks = [rank(pair, NEVER) for pair in zip(units, units[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            units[at : at + 2] = [units[at] + units[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank((units[at], units[at + 1]), NEVER)
            if at:
                ranks[at - 1] = rank((units[at - 1], units[at]), NEVER)
        return tuple([self.file.vocabulary[u] for u in units])

    def _merged_by_heap(self, fragment: tuple[str, ...]) -> tuple[int, ...]:
        """The same in n log n: units are linked, and pairs that a merge has ended are passed over when popped."""
        units: list[str | None] = list(fragment)
        after, before = list(range(1, len(units) + 1)), list(range(-1, len(units) - 1))
        waiting: list[tuple[int, int, str, str]] = []

        def offer(left: int) -> None:
            rank = self.ranks.get((units[left], units[after[left]]))
            if rank is not None:
                heapq.heappush(waiting, (rank, left, units[left], units[after[left]]))

        for i in range(len(units) - 1):
            offer(i)
        while waiting:
            _, left, a, b = heapq.heappop(waiting)
            right = after[left]
            if units[left] != a or right == len(units) or units[right] != b:
                continue
            units[left], units[right] = a + b, None
            after[left] = after[right]
            if after[left] < len(units):
                before[after[left]] = left
                offer(left)
            if before[left] >= 0:
                offer(before[left])
        return tuple([self.file.vocabulary[u] for u in units if u is not None])

    def cut(self, word: str) -> list[tuple[str, ...]]:
        """Fragments of a word between certain cuts."""
        symbols = self.file.symbols
        units = [symbols[b] for b in word.encode("utf-8", "surrogatepass")]
        units[-1] += self.file.suffix
        out, start, inside = [], 0, self.inside
        for i in range(1, len(units)):
            if (units[i - 1], units[i]) not in inside:
                out.append(tuple(units[start:i]))
                start = i
        return [*out, tuple(units[start:])]

    def _encoded_word(self, word: str) -> bytes:
        ids = [i for fragment in self.cut(word) for i in self.fragments[fragment]]
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        known, words = self.words, self.file.words
        if self.file.special_pattern.search(text) is None:
            return np.frombuffer(b"".join([known[w] for w in words(text)]), dtype="<u4")
        out = []
        for special, part in self.file.parts(text):
            if special:
                out.append(np.array([self.file.special[part]], dtype="<u4").tobytes())
            else:
                out += [known[w] for w in words(part)]
        return np.frombuffer(b"".join(out), dtype="<u4")

    def decode(self, ids) -> str:
        tokens = self.file.tokens
        return " ".join([tokens[i] for i in ids])


def codec(path: str) -> ForcedBoundaryBpe:
    """The worker's encoder for a file, built once and kept for later tasks."""
    return worker_cache(f"bpe:{path}", lambda: ForcedBoundaryBpe(path))


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.concatenate(rows).astype(np.int32) if rows else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode(docs: DataFrame, path: str, text_column: str = "text", name: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of every text as an array; a column of that name is replaced."""
    docs = docs.drop(name)
    place = docs.columns.index(text_column)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in chunks(batches, place):
            ids = [bpe.encode(t or "") for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(ids)], names=[*batch.schema.names, name])

    return map_arrow(docs, worker, StructType([*docs.schema.fields, StructField(name, ArrayType(IntegerType()))]))


def decode(encoded: DataFrame, path: str, ids_column: str = "token_ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the decoded text of every id array; null arrays decode to null."""
    encoded = encoded.drop(name)
    place = encoded.columns.index(ids_column)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in chunks(batches, place):
            texts = [None if ids is None else bpe.decode(ids) for ids in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, name]
            )

    return map_arrow(encoded, worker, StructType([*encoded.schema.fields, StructField(name, StringType())]))


def encode_and_check(docs: DataFrame, path: str, text_column: str = "text") -> DataFrame:
    """``docs`` with ``token_ids``, ``n_tokens`` and ``decoded_sha256`` in place of the text.

    One worker encodes and decodes, so the ids travel once. Columns of these names are replaced.
    """
    docs = docs.drop("token_ids", "n_tokens", "decoded_sha256")
    place = docs.columns.index(text_column)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in chunks(batches, place, 2 << 20):
            ids = [bpe.encode(t or "") for t in batch.column(place).to_pylist()]
            digests = [hashlib.sha256(bpe.decode(i.tolist()).encode()).hexdigest() for i in ids]
            added = [_lists(ids), pa.array([len(i) for i in ids], pa.int64()), pa.array(digests, pa.string())]
            others = [c for i, c in enumerate(batch.columns) if i != place]
            yield pa.RecordBatch.from_arrays([*others, *added], names=schema.names)

    added = [
        StructField("token_ids", ArrayType(IntegerType())),
        StructField("n_tokens", LongType()),
        StructField("decoded_sha256", StringType()),
    ]
    schema = StructType([*(f for f in docs.schema.fields if f.name != text_column), *added])
    return map_arrow(docs, worker, schema)


def round_trip_digests(docs: DataFrame, path: str, text_column: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of encoding and decoding it.

    Encoder and decoder run in one pass over the texts, so neither ids nor decoded texts travel.
    """
    (text,) = free_name(docs, "_text")
    kept = docs.drop("n_tokens", "ids_sha256", "decoded_sha256").withColumn(text, F.col(f"`{text_column}`"))
    kept = kept.drop(text_column)
    place = kept.columns.index(text)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in chunks(batches, place):
            counts, shown, decoded = [], [], []
            for t in batch.column(place).to_pylist():
                ids = bpe.encode(t or "").tolist()
                counts.append(len(ids))
                shown.append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
            others = [c for i, c in enumerate(batch.columns) if i != place]
            names = [c for i, c in enumerate(batch.schema.names) if i != place]
            yield pa.RecordBatch.from_arrays(
                [*others, pa.array(counts, pa.int64()), pa.array(shown, pa.string()), pa.array(decoded, pa.string())],
                names=[*names, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    fields = [f for f in kept.schema.fields if f.name != text]
    added = [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]
    return map_arrow(kept, worker, StructType(fields + added))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return round_trip_digests(docs, public_tokenizers.path(TOKENIZER))
