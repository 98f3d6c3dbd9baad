"""SimHash near-duplicates: fingerprints of word shingles, found by deletion-variant signatures.

A fingerprint has 64 bits; bit ``i`` is set if it is set in over half of the XXH64 hashes of the text's shingles. Two
fingerprints within 4 bits are cut into 3 segments: one of them differs by one bit at most, so the two share that
segment with one position left out. Every fingerprint is indexed under all its one-wildcard segment variants (64, one
per bit); fingerprints that share a variant are compared in full.

Copies collapse first: only distinct fingerprints are indexed. A variant that many fingerprints share is split into
chunks of bounded size, all pairs of chunks are compared in tasks of their own, and each task returns a spanning
forest of its links instead of all pairs, which keeps every component whole.

Corner cases: null and empty texts have no words and the fingerprint zero, linked like any other. Texts with fewer
words than a shingle are one shingle. Repeated rows share their fingerprint. An empty table gives no rows. Rows with a
null id take part; a component that holds nothing else has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampflow.llm.common import chunks, free_name, map_arrow, read_table, written
from ampflow.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints that share a segment variant are joined pair by pair up to this number, beyond it in chunks.
DENSE = 128
CHUNK = 1024


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of a whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].astype("<u8", copy=False)
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.flatnonzero(2 * counts > len(hashes))
    return int(sum(1 << int(i) for i in bits))


def fingerprints(docs: DataFrame, id_column: str, text_column: str, shingle: int = SHINGLE) -> DataFrame:
    """``(id, fp)`` of every row; ``fp`` is the fingerprint as a signed long."""

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            prints = [fingerprint(t, shingle) if t else 0 for t in batch.column(1).to_pylist()]
            values = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["id", "fp"])

    source = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))
    return map_arrow(source, worker, "id long, fp long")


def segments(max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """``(first bit, end)`` of the fewest segments one of which differs by at most one bit."""
    count = max_bits // 2 + 1
    cuts = [64 * i // count for i in range(count + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def variant_masks(max_bits: int = MAX_BITS) -> list[int]:
    """For each of the 64 bits its segment without that bit, as signed masks."""
    return [signed(((1 << end) - (1 << start)) & ~(1 << bit)) for start, end in segments(max_bits) for bit in range(start, end)]


def segment_masks(max_bits: int = MAX_BITS) -> list[int]:
    return [signed((1 << end) - (1 << start)) for start, end in segments(max_bits)]


def _exploded(masks: list[int]):
    return F.posexplode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("place", "mask")


def signatures(prints: DataFrame, max_bits: int) -> DataFrame:
    """``(place, value, fp)``: all one-wildcard variants of the distinct fingerprints, by the bit left out."""
    return prints.select("fp", _exploded(variant_masks(max_bits))).select(
        "place", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp"
    )


def first_shared(differing, place, max_bits: int):
    """Whether ``place`` is the lowest variant that two fingerprints share, given the bits in which they differ.

    They share the variants of a segment in which they differ in one bit (the variant without it) or none (all).
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    found, earlier = F.lit(False), F.lit(True)
    for (start, end), mask in zip(segments(max_bits), segment_masks(max_bits), strict=True):
        own = differing.bitwiseAND(F.lit(mask).cast("long"))
        here = (place >= start) & (place < end) & ((own == bit) | ((own == 0) & (place == start)))
        found = found | (earlier & here)
        earlier = earlier & (F.bit_count(own) >= 2)
    return found


def dense_keys(prints: DataFrame, max_bits: int) -> DataFrame:
    """The variants ``(place, value)`` that may hold over ``DENSE`` fingerprints.

    A variant joins two segment values; with over ``DENSE`` fingerprints one value has over half of them. So counts of
    whole segment values, three rows for each fingerprint, find all such keys.
    """
    bounds = segments(max_bits)
    values = prints.select("fp", _exploded(segment_masks(max_bits))).select(
        F.col("place").alias("segment"), F.col("fp").bitwiseAND(F.col("mask")).alias("value")
    )
    dense = values.groupBy("segment", "value").count().where(F.col("count") > DENSE // 2)
    of_segment = F.array(*[F.lit(i) for i, (a, b) in enumerate(bounds) for _ in range(a, b)])
    masks = variant_masks(max_bits)
    place = F.posexplode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("place", "mask")
    variants = dense.select("segment", "value", place).where(F.col("segment") == of_segment[F.col("place")])
    return variants.select("place", F.col("value").bitwiseAND(F.col("mask")).alias("value")).distinct()


def _forest(values: np.ndarray, chunk: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(a, b)`` that connect what pairs within ``max_bits`` connect: within one chunk, or between two."""
    n = len(values)
    left, right = [], []
    within = chunk.min() == chunk.max()
    for at in range(0, n, 256):
        block = values[at : at + 256]
        near = np.bitwise_count(block[:, None] ^ values[None, :]) <= max_bits
        if not within:
            near &= chunk[at : at + 256, None] != chunk[None, :]
        i, j = np.nonzero(near)
        keep = i + at < j
        left.append(i[keep] + at)
        right.append(j[keep])
    i, j = np.concatenate(left), np.concatenate(right)
    labels = np.arange(n)
    while True:
        before = labels.copy()
        np.minimum.at(labels, j, labels[i])
        np.minimum.at(labels, i, labels[j])
        labels = labels[labels]
        if (labels == before).all():
            break
    moved = np.flatnonzero(labels != np.arange(n))
    return values[moved].view(np.int64), values[labels[moved]].view(np.int64)


def dense_links(rows: DataFrame, max_bits: int) -> DataFrame:
    """Links among fingerprints ``(place, value, fp)`` of large groups, in tasks of two chunks."""

    def group(table: pa.Table) -> pa.Table:
        values = table.column("fp").to_numpy().view(np.uint64)
        a, b = _forest(values, table.column("chunk").to_numpy(), max_bits)
        return pa.table({"a": a, "b": b})

    key = ["place", "value"]
    sizes = rows.groupBy(*key).agg(F.ceil(F.count("*") / CHUNK).cast("long").alias("parts"))
    placed = rows.join(sizes, key).withColumn("chunk", F.pmod(F.xxhash64("fp", *key), F.col("parts")))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    paired = paired.select(
        *key, "fp", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")
    )
    return paired.groupBy(*key, "low", "high").applyInArrow(group, "a long, b long")


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints whose components are those of all pairs within ``max_bits``."""
    key = ["place", "value"]
    keyed = signatures(prints, max_bits)
    dense = written(dense_keys(prints, max_bits), "dense-keys")
    sparse = keyed.join(dense, key, "left_anti")
    pairs = sparse.select(*key, F.col("fp").alias("a")).join(sparse.select(*key, F.col("fp").alias("b")), key)
    differing = F.col("a").bitwiseXOR(F.col("b"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(differing) <= max_bits)
    # A pair shares up to 64 variants; it is a link where it is found first.
    links = pairs.where(near & first_shared(differing, F.col("place"), max_bits)).select("a", "b")
    if dense.isEmpty():
        return links
    return links.union(dense_links(keyed.join(dense, key, "left_semi"), max_bits))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """``(id, fp, component_id)`` of every row; ``component_id`` is the smallest id reachable over near links."""
    stored = written(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    prints = written(stored.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    roots = connected_components(near_links(prints.select("fp"), max_bits))
    members = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = members.groupBy("root").agg(F.min("first").alias("component_id"))
    return stored.join(members.join(least, "root").select("fp", "component_id"), "fp")


def deduplicated(docs: DataFrame, text_column: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: its first in the order of the input files.

    Numbers depend on how a scan is split, so the numbered rows are written once and read by all steps.
    """
    (row,) = free_name(docs, "_row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(numbered, row, text_column, shingle, max_bits)
    first = found.where(F.col("id") == F.col("component_id")).select(F.col("id").alias(row))
    return numbered.join(first, row, "left_semi").drop(row)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
