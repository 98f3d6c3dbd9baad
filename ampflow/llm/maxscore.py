"""Exact top-k search by integer inner product with MaxScore pruning.

Each component is a term: its postings are the rows of a shard whose component has the sign of the query's, and its
bound is the largest contribution any row of the shard can make. Terms are taken by falling bound. Terms whose bounds
together stay below the k-th best score so far are non-essential: a row that is in no essential posting list cannot
enter. Essential postings are traversed, and the rows found are probed in the other terms as long as their score plus
the bounds of the terms left is competitive. Nothing is approximate: a row is left out only if its best possible
score is strictly below the k-th best.

Candidates are packed into shards of bounded size, queries into blocks of bounded size. Every block visits every
shard: a few blocks of at most ``BLOCK_ROWS`` vectors are broadcast at a time and joined by block number, the shards
stay where they are, and only the best rows of each task are shuffled and merged.

Components are kept as doubles, which hold them exactly. A query and a shard whose scores may pass ``LARGEST`` are
computed in Python's integers, the others in longs.

Corner cases: a vector that is null, holds null or non-finite components, or has a null id takes no part. Shorter
vectors count as padded with zeros. An empty vector scores zero. Of several rows with one query id the least vector
that takes part asks; as candidates, repeated rows stay separate. A score among the best that no long can hold ends
the query with an error, as in ``OP3_SQL``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ampflow.llm.common import map_arrow, read_table, written

TOP_K = 10
SCALE = 1024
QUERY_STEP = 100
SHARD_ROWS = 4096
BLOCK_ROWS = 1024
#: Blocks that are broadcast together.
BLOCKS_AT_ONCE = 4
#: Scores that may reach this are not computed in longs.
LARGEST = 1 << 62
#: Terms probed between two prunings.
STEP = 8

PACKED = "part long, rows int, width int, ids binary, terms binary"


def integer_vectors(ids: pa.Array, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and ``floor(SCALE * x)`` as rows of equal width, without the vectors that take no part."""
    usable = ids.is_valid().to_numpy(zero_copy_only=False) & vectors.is_valid().to_numpy(zero_copy_only=False)
    keep = np.flatnonzero(usable)
    ids, vectors = ids.take(pa.array(keep)), vectors.take(pa.array(keep))
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False) * SCALE
    width = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), width))
    inside = np.arange(width)[None, :] < lengths[:, None]
    out[inside] = np.floor(values)
    good = np.isfinite(out).all(axis=1)
    return ids.to_numpy()[good].astype(np.int64), out[good]


def takes_part(embedding: Column) -> Column:
    """Whether no component is null or non-finite; NaN counts as larger than any number."""
    finite = F.forall(embedding, lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) < float("inf"), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def narrow(values: np.ndarray) -> np.ndarray:
    """As longs; what is cut here meets zeros only, or the scores would not stay below ``LARGEST``."""
    return np.clip(values, -float(LARGEST), float(LARGEST)).astype(np.int64)


def exact(values: np.ndarray) -> np.ndarray:
    """As Python's integers."""
    return np.array([int(v) for v in values.ravel()], dtype=object).reshape(values.shape)


def packed(vectors: DataFrame, rows: int) -> DataFrame:
    """Vectors ``(vec_id, embedding)`` as blocks of up to ``rows`` vectors, stored term by term."""

    def block(part: int, ids: list, terms: list) -> pa.RecordBatch:
        width = max(t.shape[1] for t in terms)
        wide = np.concatenate([np.pad(t, ((0, 0), (0, width - t.shape[1]))) for t in terms])
        return pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part], pa.int64()),
                "rows": pa.array([len(wide)], pa.int32()),
                "width": pa.array([width], pa.int32()),
                "ids": pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                "terms": pa.array([np.ascontiguousarray(wide.T).tobytes()], pa.binary()),
            }
        )

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, terms, held = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                own, values = integer_vectors(batch.column(0).slice(at, rows), batch.column(1).slice(at, rows))
                if held and held + len(own) > rows:
                    yield block(part, ids, terms)
                    part, ids, terms, held = part + 1, [], [], 0
                if len(own):
                    ids.append(own)
                    terms.append(values)
                    held += len(own)
        if held:
            yield block(part, ids, terms)

    return map_arrow(vectors.select(F.col("vec_id").cast("long"), "embedding"), worker, PACKED)


class Shard:
    """Candidates with their postings (as bit maps by sign) and the extreme values of each term."""

    def __init__(self, ids: np.ndarray, terms: np.ndarray):
        self.ids, self.terms = ids, terms
        self.high, self.low = terms.max(axis=1, initial=0), terms.min(axis=1, initial=0)
        self.positive, self.negative = terms > 0, terms < 0

    def best(self, query: np.ndarray, own: int, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the rows that may reach ``floor`` (all rows without one), other than the query's own."""
        bounds = np.maximum(query * self.high, query * self.low)
        order = np.argsort(-bounds, kind="stable")
        left = np.concatenate((np.cumsum(bounds[order][::-1])[::-1], [0]))
        found = np.flatnonzero(self.ids != own)
        if floor is not None and floor > 0:
            essential = int(np.argmax(left < floor))
            hit = np.zeros(len(self.ids), dtype=bool)
            for term in order[:essential]:
                hit |= self.positive[term] if query[term] > 0 else self.negative[term]
            found = found[hit[found]]
        scores = np.zeros(len(found), dtype=np.int64)
        for at in range(0, len(order), STEP):
            if not len(found):
                break
            terms = order[at : at + STEP]
            scores = scores + query[terms] @ self.terms[np.ix_(terms, found)]
            if floor is not None:
                alive = scores + left[min(at + STEP, len(order))] >= floor
                if not alive.all():
                    found, scores = found[alive], scores[alive]
        return scores, self.ids[found]


def merged(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if scores.dtype == object:
        order = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)
    else:
        order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _unpacked(row: dict, name: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{name}ids"], dtype=np.int64)
    terms = np.frombuffer(row[f"{name}terms"], dtype=np.float64)
    return ids, terms.reshape(row[f"{name}width"], len(ids))


def top_of_task(k: int):
    """Worker: the best ``k`` rows for each query over all shards of a task; scores found early prune later shards."""

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                ids, terms = _unpacked(row, "")
                own, queries = _unpacked(row, "q_")
                width = max(terms.shape[0], queries.shape[0])
                terms = np.pad(terms, ((0, width - terms.shape[0]), (0, 0)))
                queries = np.pad(queries, ((0, width - queries.shape[0]), (0, 0)))
                asked = narrow(queries)
                for start, end in ((0, 256), (256, len(ids))):
                    if start >= len(ids):
                        continue
                    part = terms[:, start:end]
                    shard, wide = Shard(ids[start:end], narrow(part)), None
                    reach = np.abs(part).max(axis=1, initial=0) @ np.abs(queries)
                    for i, name in enumerate(own.tolist()):
                        held = kept.get(name)
                        floor = int(held[0][-1]) if held is not None and len(held[0]) == k else None
                        if reach[i] < LARGEST:
                            scores, found = shard.best(asked[:, i], name, floor)
                        else:
                            wide = wide or Shard(ids[start:end], exact(part))
                            scores, found = wide.best(exact(queries[:, i]), name, floor)
                        if held is not None:
                            scores, found = np.concatenate((held[0], scores)), np.concatenate((held[1], found))
                        kept[name] = merged(scores, found, k)
        for name, (scores, found) in kept.items():
            yield pa.RecordBatch.from_pydict(
                {"query_id": np.full(len(found), name, dtype=np.int64), "vec_id": found, "score": pa.array(scores.tolist(), pa.int64())}
            )

    return worker


def maxscore_search(queries: DataFrame, candidates: DataFrame, k: int = TOP_K) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best candidates of every query, ties to the smaller id."""
    asked = queries.where(F.col("vec_id").isNotNull() & takes_part(F.col("embedding"))).groupBy("vec_id").agg(
        F.min("embedding").alias("embedding")
    )
    asked = written(asked, "queries")
    count = asked.count()
    blocks = written(packed(asked.repartition(-(-count // BLOCK_ROWS) or 1), BLOCK_ROWS), "query-blocks")
    shards = written(packed(candidates, SHARD_ROWS), "shards")
    renamed = blocks.select(*[F.col(c).alias(f"q_{c}") for c in blocks.columns])
    found = shards.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    parts = sorted(part for (part,) in blocks.select("part").collect())
    for at in range(0, len(parts), BLOCKS_AT_ONCE):
        visiting = parts[at : at + BLOCKS_AT_ONCE]
        # At most BLOCKS_AT_ONCE rows of at most BLOCK_ROWS vectors: the size does not grow with the data.
        block = F.broadcast(renamed.where(F.col("q_part").isin(visiting)))
        visited = shards.withColumn("q_part", F.explode(F.array(*[F.lit(p).cast("long") for p in visiting])))
        pairs = visited.join(block, "q_part")
        found = found.union(map_arrow(pairs, top_of_task(k), "query_id long, vec_id long, score long"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def op3_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 100 against all others."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return maxscore_search(vectors.where(F.col("vec_id") % QUERY_STEP == 0), vectors)


OP3_SQL = """
WITH v AS (
    SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""
