"""Token-id files in Simple-8b: as many ids per 64-bit word as their widths allow.

The four high bits of a word select how many values of how many bits fill the other sixty (``LAYOUTS``). A value that
needs over sixty bits is an escape: its word has selector 0 and the place of the value in the block's escape table.
Words are found greedily, the most values first, and packed and unpacked by selector with array operations.

A file is a table of blocks in ascending document order; a block holds whole documents, about ``BLOCK_IDS`` ids, and
carries what decoding needs: document ids and lengths, words, escapes, and the number of ids of the file before it.
So every block decodes alone, and one number per file gives every document its place in the whole.

Corner cases: null and empty texts hold the end id alone. Texts of any length are encoded whole, so a block can be as
large as the longest document. Documents with one id stay in the order of their texts' hashes. Rows without an id come
first, with a null id. An empty table gives no files and no rows.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ampflow.llm.common import chunks, map_arrow, read_table, scratch_path, worker_cache
from ampflow.llm.tokens import UNCOMMON, Remembered, TokenizerFile

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
BLOCK_IDS = 1 << 16
#: Words that a worker remembers, some 90 MB.
WORDS = 400_000
#: Fixed values: (values, bits) by selector from 2; selector 0 is an escape, 1 is not used.
LAYOUTS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
FIRST_SELECTOR = 2
PAYLOAD = (1 << 60) - 1

FILES = "part int, block int, ids_before long, n_ids long, doc_ids binary, lengths binary, words binary, escapes binary"


def _widest(widths: np.ndarray, count: int, made: dict[int, np.ndarray]) -> np.ndarray:
    """Largest width among ``count`` values from each place on; beyond the end counts as too wide."""
    if count in made:
        return made[count]
    half = count - count // 2
    near = _widest(widths, half, made)
    far = np.full(len(near), 255, dtype=np.uint8)
    shift = count - half
    far[: max(0, len(near) - shift)] = near[shift:]
    made[count] = np.maximum(near, far)
    return made[count]


def encode_words(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(words, escapes)`` of unsigned 64-bit values."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    widths = np.zeros(n, dtype=np.uint8)
    for bits in sorted({b for _, b in LAYOUTS}, reverse=True):
        widths[values < np.uint64(1 << bits)] = bits
    escape = values > np.uint64(PAYLOAD)
    steps, choice = np.ones(n, dtype=np.uint8), np.full(n, len(LAYOUTS) - 1, dtype=np.uint8)
    packable = np.where(escape, np.uint8(61), widths)
    made = {1: packable}
    for i in range(len(LAYOUTS) - 2, -1, -1):
        count, bits = LAYOUTS[i]
        fits = _widest(packable, count, made) <= bits
        steps[fits], choice[fits] = count, i
    starts, at, jump = [], 0, steps.tolist()
    while at < n:
        starts.append(at)
        at += jump[at]
    first = np.array(starts, dtype=np.int64)
    words = np.empty(len(first), dtype=np.uint64)
    chosen = choice[first]
    for i, (count, bits) in enumerate(LAYOUTS):
        where = np.flatnonzero(chosen == i)
        if not len(where):
            continue
        shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
        group = values[first[where][:, None] + np.arange(count)[None, :]] & np.uint64(PAYLOAD)
        words[where] = np.bitwise_or.reduce(group << shifts, axis=1) | np.uint64((i + FIRST_SELECTOR) << 60)
    places = np.flatnonzero(escape[first])
    words[places] = np.arange(len(places), dtype=np.uint64)
    return words, values[first[places]]


def decode_words(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The values again."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([1, 0, *[c for c, _ in LAYOUTS]], dtype=np.int64)[selectors]
    starts = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), dtype=np.uint64)
    for i, (count, bits) in enumerate(LAYOUTS):
        where = np.flatnonzero(selectors == i + FIRST_SELECTOR)
        if len(where):
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            group = (words[where][:, None] >> shifts) & np.uint64((1 << bits) - 1)
            out[starts[where][:, None] + np.arange(count)[None, :]] = group
    where = np.flatnonzero(selectors == 0)
    out[starts[where]] = escapes[(words[where] & np.uint64(PAYLOAD)).astype(np.int64)]
    return out


class LibraryEncoder:
    """Whole texts through the tokenizers library.

    Words of common texts go to the library's model one by one, and are remembered; a text with special strings or
    uncommon characters goes through the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.file = TokenizerFile(path)
        self.library = Tokenizer.from_file(path)
        model, symbols = self.library.model, self.file.symbols

        def encoded(word: str) -> bytes:
            shown = word if word.isascii() else "".join([symbols[b] for b in word.encode()])
            return array("I", [t.id for t in model.tokenize(shown)]).tobytes()

        self.known = Remembered(encoded, WORDS)

    def encode(self, text: str) -> bytes:
        """Ids of a text as unsigned 32-bit integers."""
        if UNCOMMON.search(text) or self.file.special_pattern.search(text):
            return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        known = self.known
        return b"".join([known[w] for w in self.file.words(text)])


def write_token_files(docs: DataFrame, tokenizer: str, path: str, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encodes ``docs`` in ascending id order into Simple-8b files under ``path``.

    Texts are shuffled before they are encoded: that way the order is found from the scan alone. A running id splits
    rows of one document id over partitions.
    """
    end = np.array([END_ID], dtype="<u4").tobytes()

    def block(part: int, number: int, before: int, ids: list, parts: list[bytes]) -> pa.RecordBatch:
        lengths = np.array([len(p) // 4 for p in parts], dtype=np.int64)
        words, escapes = encode_words(np.frombuffer(b"".join(parts), dtype="<u4").astype(np.uint64))
        doc_ids = pa.array(ids, pa.int64())
        known = np.packbits(doc_ids.is_valid().to_numpy(zero_copy_only=False))
        stored = doc_ids.fill_null(0).to_numpy().tobytes() + known.tobytes()
        row = [part, number, before, int(lengths.sum()), stored, lengths.tobytes(), words.tobytes(), escapes.tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row, [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4], strict=True)],
            names=["part", "block", "ids_before", "n_ids", "doc_ids", "lengths", "words", "escapes"],
        )

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(f"library:{tokenizer}", lambda: LibraryEncoder(tokenizer))
        part, number, before = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        parts: list[bytes] = []
        held = 0
        for batch in chunks(batches, 1, 2 << 20):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc)
                parts.append(encoder.encode(text or "") + end)
                held += len(parts[-1]) // 4
                if held >= BLOCK_IDS:
                    yield block(part, number, before, ids, parts)
                    number, before, ids, parts, held = number + 1, before + held, [], [], 0
        if parts:
            yield block(part, number, before, ids, parts)

    spark = docs.sparkSession
    source = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))
    source = source.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = source.repartitionByRange(width, "id", "tie", "row").sortWithinPartitions("id", "tie", "row")
    encoded = map_arrow(ordered.select("id", "text"), worker, FILES)
    encoded.write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, decoded from the files."""

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], dtype=np.int64)
                ids = decode_words(np.frombuffer(row["words"], np.uint64), np.frombuffer(row["escapes"], np.uint64))
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(lengths)
                spans = zip((4 * (ends - lengths)).tolist(), (4 * ends).tolist(), strict=True)
                known = np.unpackbits(np.frombuffer(row["doc_ids"], np.uint8, offset=8 * len(lengths)), count=len(lengths))
                docs = pa.array(np.frombuffer(row["doc_ids"], np.int64, len(lengths)), mask=known == 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lengths), row["part"], dtype=np.int32)),
                        docs,
                        pa.array(row["ids_before"] + ends - lengths),
                        pa.array(lengths),
                        pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()),
                    ],
                    names=["part", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    files = spark.read.schema(FILES).parquet(path)
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort: their number is a setting, not a matter of the data.
    offsets = F.broadcast(sizes.select("part", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("before")))
    columns = ["part", "n_ids", "ids_before", "doc_ids", "lengths", "words", "escapes"]
    decoded = map_arrow(files.select(*columns), worker, "part int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return decoded.join(offsets, "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def op6_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written to token files and read back."""
    path = scratch_path(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), path)
    return read_token_files(spark, path)
