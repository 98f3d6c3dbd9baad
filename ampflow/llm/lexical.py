"""Ranked lexical search, exact, over posting lists that are cut into geometric blocks.

Documents are read once: only terms that an item asks for are kept, packed into shards of bounded size with what the
weights need. A shard is searched term by term. The posting list of a term is clustered by the similarity of its
documents (inner products of random projections of their weighted vectors with evenly spaced documents of the list), and
every cluster is a block with a summary: the largest impact of its documents in each coordinate that an item with the
term asks for. The product of an item and a summary bounds the score of every document of the block, so a block is skipped
only if that bound is below the item's k-th best score so far, or not above zero; the documents of all other blocks are
scored in full. Documents with more than ``LONG`` asked terms would spoil a summary; each is a block of its own, whose
summary is the document.

A first round over one shard in ``FIRST_ROUND`` finds scores that the k-th best cannot fall below. They start the second
round, over all shards, so that a task returns few rows. Projections and rounds decide what is skipped early, never the
result.

Items are the stated query set. A group of items with at most about ``GROUP_BYTES`` of text is broadcast and takes one
pass over the documents; inside a task a group is worked off in blocks of about ``ASKED`` terms.

Corner cases: null and empty texts hold no term, as documents and as items. Every row of items asks for itself, those with
one or no id too; every row of documents stands for itself, and of equal scores one without an id comes last. Very long
texts are read whole. Repeated rows tie and all compete. An item that no document answers, an empty corpus and an empty
set of items give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ampflow.llm.common import chunks, map_arrow, read_table, written

TOP_K = 20
#: Entries (documents times their asked terms) and documents of a shard.
SHARD_ENTRIES = 1 << 18
SHARD_DOCS = 1 << 13
#: Documents of a block, on average.
BLOCK = 32
LONG = 1024
SKETCH = 32
SEED = 11
FIRST_ROUND = 16
GROUP_BYTES = 16 << 20
#: Terms that the items of one block ask for, with repeats between items.
ASKED = 1 << 16
#: The id that stands for none: as of a tie the last.
NO_ID = (1 << 63) - 1

SHARDS = "part long, ids binary, lengths binary, sizes binary, terms binary, counts binary"
FOUND = "query int, item_id long, doc_id long, score long"

#: Bytes of a text as terms see them: A-Z in lower case, other ASCII signs than letters and digits as a space.
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8."""
    return text.translate(TERM_BYTES).split()


def packed(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``docs`` ``(id, text)`` with at least one term, as shards of their lengths and their counts of asked terms."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        part, ids, lengths, sizes, terms, counts = TaskContext.get().partitionId() << 32, [], [], [], [], []

        def shard() -> pa.RecordBatch:
            columns = [np.array(ids, "<i8"), np.array(lengths, "<i8"), np.array(sizes, "<i4"), np.array(terms, "<i4"), np.array(counts, "<i8")]
            names = ["part", "ids", "lengths", "sizes", "terms", "counts"]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), *[pa.array([c.tobytes()], pa.binary()) for c in columns]], names=names
            )

        for batch in chunks(batches, 1):
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = terms_of(text or b"")
                if not words:
                    continue
                own = {known[w]: n for w, n in Counter(words).items() if w in known}
                if ids and (len(ids) >= SHARD_DOCS or len(terms) + len(own) > SHARD_ENTRIES):
                    yield shard()
                    part, ids, lengths, sizes, terms, counts = part + 1, [], [], [], [], []
                ids.append(NO_ID if number is None else number)
                lengths.append(len(words))
                sizes.append(len(own))
                terms += own
                counts += own.values()
        if ids:
            yield shard()

    return map_arrow(docs.select(F.col("id").cast("long"), F.col("text").cast("binary")), worker, SHARDS)


def _column(row: dict, name: str, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(row[name], dtype=kind)


@dataclass
class Statistics:
    """Documents with a term, their terms with repeats, and the documents that hold each asked term."""

    documents: int
    length: int
    holding: np.ndarray

    def weight(self, term: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * int(self.holding[term]) + 1)))

    def impacts(self, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The share of a term in a document's score, before its weight."""
        normal = 100 - 25 + (25 * lengths * self.documents) // self.length
        return (1_000_000_000 * counts) // (1000 * counts + 12 * normal)


def statistics(shards: DataFrame, asked: int) -> Statistics:
    """Counts over all documents; every task adds up its own first."""

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(asked + 2, dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                lengths = _column(row, "lengths")
                sums[:asked] += np.bincount(_column(row, "terms", "<i4"), minlength=asked)
                sums[asked:] += (len(lengths), int(lengths.sum()))
        own = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"term": own.astype(np.int32), "n": sums[own]})

    # One row per asked term: bounded by the group of items.
    rows = map_arrow(shards, worker, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(asked + 2, dtype=np.int64)
    sums[rows.column("term").to_numpy()] = rows.column("n").to_numpy()
    return Statistics(int(sums[asked]), int(sums[asked + 1]), sums[:asked])


@dataclass
class Query:
    """An item: ascending terms and what one unit of impact in them scores."""

    number: int
    item_id: int | None
    terms: np.ndarray
    weights: np.ndarray


@dataclass
class Best:
    """The best documents of one item so far."""

    k: int
    floor: int = 1
    scores: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int64))

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.floor
        if good.any():
            scores, ids = np.concatenate((self.scores, scores[good])), np.concatenate((self.ids, ids[good]))
            order = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[order], ids[order]
            if len(order) == self.k:
                self.floor = max(self.floor, int(self.scores[-1]))


class QueryBlock:
    """Some items, with the items and the coordinates that belong to each of their terms."""

    def __init__(self, queries: list[Query]):
        self.queries = queries
        self.terms = np.unique(np.concatenate([q.terms for q in queries]))
        self.own = [np.searchsorted(self.terms, q.terms) for q in queries]
        self.asking: list[list[int]] = [[] for _ in self.terms]
        for i, own in enumerate(self.own):
            for term in own.tolist():
                self.asking[term].append(i)
        self.coordinates = [np.unique(np.concatenate([self.own[i] for i in asking])) for asking in self.asking]
        weights = np.zeros(len(self.terms), dtype=np.int64)
        for own, query in zip(self.own, queries, strict=True):
            np.maximum.at(weights, own, query.weights)
        self.order = np.argsort(-weights, kind="stable")
        self.weights = weights


def query_blocks(queries: list[Query]) -> list[QueryBlock]:
    out, held, asked = [], [], 0
    for query in queries:
        if held and asked + len(query.terms) > ASKED:
            out.append(QueryBlock(held))
            held, asked = [], 0
        if len(query.terms):
            held.append(query)
            asked += len(query.terms)
    return [*out, QueryBlock(held)] if held else out


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start .. start + size`` of every span, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Shard:
    """The documents of a shard in the terms of a block of items."""

    def __init__(self, row: dict, known: Statistics, block: QueryBlock):
        self.ids, lengths, sizes = _column(row, "ids"), _column(row, "lengths"), _column(row, "sizes", "<i4")
        terms, counts = _column(row, "terms", "<i4"), _column(row, "counts")
        docs = np.repeat(np.arange(len(sizes)), sizes)
        places = np.minimum(np.searchsorted(block.terms, terms), len(block.terms) - 1)
        kept = np.flatnonzero(block.terms[places] == terms)
        docs, places = docs[kept], places[kept]
        impacts = known.impacts(counts[kept], lengths[docs])
        self.width = len(block.terms)
        keys = docs * self.width + places
        order = np.argsort(keys)
        self.keys, self.terms, self.impacts = keys[order], places[order], impacts[order]
        self.sizes = np.bincount(docs, minlength=len(sizes))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.long = np.flatnonzero(self.sizes > LONG)
        listed = np.flatnonzero(self.sizes[docs[order]] <= LONG)
        by_term = listed[np.argsort(self.terms[listed], kind="stable")]
        self.postings = docs[order][by_term]
        self.list_ends = np.cumsum(np.bincount(self.terms[listed], minlength=self.width))
        self.sketches = self._sketches(block)
        self.place = np.full(self.width, -1, dtype=np.int64)

    def _sketches(self, block: QueryBlock) -> np.ndarray:
        """Projections of the documents' weighted unit vectors."""
        axes = np.random.default_rng(SEED).standard_normal((self.width, SKETCH)).astype(np.float32)
        values = (self.impacts * block.weights[self.terms]).astype(np.float32)
        out = np.zeros((len(self.sizes), SKETCH), dtype=np.float32)
        full = np.flatnonzero(self.sizes)
        if len(full):
            out[full] = np.add.reduceat(values[:, None] * axes[self.terms], self.starts[full], axis=0)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """``(documents, starts)``: the posting list of a term in blocks of similar documents."""
        docs = self.postings[self.list_ends[term - 1] if term else 0 : self.list_ends[term]]
        if len(docs) <= BLOCK:
            return docs, np.zeros(min(1, len(docs)), dtype=np.int64)
        centres = self.sketches[docs[:: BLOCK]]
        nearest = np.argmax(self.sketches[docs] @ centres.T, axis=1)
        order = np.argsort(nearest, kind="stable")
        nearest = nearest[order]
        return docs[order], np.flatnonzero(np.concatenate(([True], nearest[1:] != nearest[:-1])))

    def summaries(self, docs: np.ndarray, starts: np.ndarray, coordinates: np.ndarray) -> np.ndarray:
        """The largest impact of every block in every coordinate."""
        out = np.zeros((len(starts), len(coordinates)), dtype=np.int64)
        self.place[coordinates] = np.arange(len(coordinates))
        sizes = self.sizes[docs]
        entries = _spans(self.starts[docs], sizes)
        block = np.repeat(np.repeat(np.arange(len(starts)), np.diff([*starts, len(docs)])), sizes)
        places = self.place[self.terms[entries]]
        inside = np.flatnonzero(places >= 0)
        np.maximum.at(out.reshape(-1), block[inside] * len(coordinates) + places[inside], self.impacts[entries[inside]])
        self.place[coordinates] = -1
        return out

    def scores(self, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Full scores of documents for one item."""
        if not len(self.keys):
            return np.zeros(len(docs), dtype=np.int64)
        keys = docs[:, None] * self.width + terms[None, :]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.impacts[at], 0) @ weights


def search_shard(shard: Shard, block: QueryBlock, best: list[Best]) -> int:
    """Adds the documents of a shard to the best of every item; returns how many blocks were skipped."""
    skipped = 0
    seen = np.zeros((len(block.queries), len(shard.ids)), dtype=bool)
    for i, query in enumerate(block.queries):
        if len(shard.long):
            best[i].add(shard.scores(shard.long, block.own[i], query.weights), shard.ids[shard.long])
    for term in block.order.tolist():
        docs, starts = shard.blocks(term)
        if not len(docs):
            continue
        coordinates = block.coordinates[term]
        summaries = shard.summaries(docs, starts, coordinates)
        sizes = np.diff([*starts, len(docs)])
        for i in block.asking[term]:
            own, weights = block.own[i], block.queries[i].weights
            bounds = summaries[:, np.searchsorted(coordinates, own)] @ weights
            visited = bounds >= best[i].floor
            skipped += len(starts) - int(visited.sum())
            if not visited.any():
                continue
            found = docs[np.repeat(visited, sizes)]
            found = found[~seen[i, found]]
            seen[i, found] = True
            best[i].add(shard.scores(found, own, weights), shard.ids[found])
    return skipped


def _searched(shards: DataFrame, asked, known: Statistics, k: int) -> DataFrame:
    """The best ``k`` documents of every task for each item, none below the item's floor."""

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, floors = asked.value
        blocks = query_blocks(queries)
        best = [[Best(k, floors.get(q.number, 1)) for q in b.queries] for b in blocks]
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                for block, own in zip(blocks, best, strict=True):
                    search_shard(Shard(row, known, block), block, own)
        for block, own in zip(blocks, best, strict=True):
            for query, found in zip(block.queries, own, strict=True):
                if len(found.ids):
                    n = len(found.ids)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([query.number] * n, pa.int32()),
                            pa.array([query.item_id] * n, pa.int64()),
                            pa.array(found.ids, mask=found.ids == NO_ID),
                            pa.array(found.scores),
                        ],
                        names=["query", "item_id", "doc_id", "score"],
                    )

    return map_arrow(shards, worker, FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_group(docs: DataFrame, items: list[tuple[int | None, str | None]], k: int) -> DataFrame:
    """``(query, item_id, rank, doc_id, score)`` for a group of items that fits into every task."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    counted = []
    for number, (item_id, text) in enumerate(items):
        words = Counter(terms_of((text or "").encode("utf-8", "surrogatepass")))
        counted.append((number, item_id, {vocabulary.setdefault(w, len(vocabulary)): n for w, n in words.items()}))
    shards = written(packed(docs, vocabulary), "shards")
    known = statistics(shards, len(vocabulary))
    weights = [known.weight(t) for t in range(len(vocabulary))]
    queries = []
    for number, item_id, own in counted:
        terms = np.array(sorted(t for t in own if weights[t] > 0 and known.holding[t]), dtype=np.int64)
        queries.append(Query(number, item_id, terms, np.array([weights[t] * own[t] for t in terms.tolist()], dtype=np.int64)))
    context = spark.sparkContext
    some = shards.where(F.pmod(F.xxhash64("part"), F.lit(FIRST_ROUND)) == 0)
    first = _ranked(_searched(some, context.broadcast((queries, {})), known, k), k).where(F.col("rank") == k)
    # At most one row per item of the group.
    floors = {r.query: r.score for r in first.select("query", "score").collect()}
    return _ranked(_searched(shards, context.broadcast((queries, floors)), known, k), k)


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = TOP_K, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of every item with a score above zero."""
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))
    asked = items.select(F.col(f"`{item_column}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    asked = written(asked.withColumn("place", F.monotonically_increasing_id()), "items")
    total = asked.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    groups = -(-total // GROUP_BYTES)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for group in range(groups):
        chosen = asked.where(F.pmod(F.xxhash64("place"), F.lit(groups)) == group).orderBy("item_id", "place")
        rows = [tuple(r) for r in chosen.select("item_id", "text").collect()]
        if rows:
            out = out.union(search_group(source, rows, k).select("item_id", "rank", "doc_id", "score"))
    return out


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that answer each benchmark item best."""
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH words AS (
    SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), asked AS (
    SELECT item, item_id, term, count(*) AS asked
    FROM (
        SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ) GROUP BY ALL
), total AS (
    SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM words WHERE len(terms) > 0
), held AS (
    SELECT doc, term, count(*) AS tf
    FROM (SELECT doc, unnest(terms) AS term FROM words) WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weight AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * max(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM held, total GROUP BY term
), scored AS (
    SELECT item, item_id, doc_id, doc, CAST(sum(asked * w * ((1000000000 * tf)
        // (1000 * tf + 12 * (75 + (25 * len(terms) * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked JOIN held USING (term) JOIN weight USING (term) JOIN words USING (doc), total
    GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS place
    FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 20
"""
