"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items are cut into overlapping passages of words. Terms are weighted by TF-IDF, with document
counts over the whole corpus. A distributed randomised singular value decomposition of the benchmark's passages gives
the latent space; every document passage is projected into it and compared with the benchmark's passages by cosine.
Passages that are close enough are candidates. An item shorter than a passage fills too little of one, so stretches
that hold enough of its rarest words are candidates as well, and no match of it can lack those. All are checked in full: the longest common subsequence of words
within a stretch hardly longer than the item must hold most of the item; below a near-exact share, which is where
paraphrases are, so must the item's answer (its ``answer`` column, or else its last sentence).

Terms are hashed into a fixed number of buckets, so the counts, the latent space and a block of items all have a
bounded size whatever the corpus is; they are broadcast. Words are hashed from the bytes of their texts by array
operations, for the counts and again for the search; only texts with a candidate are split into words. Documents are
read where they lie and never shuffled. Items are the stated query set: one pass over the documents holds up to
``PASS_BLOCKS`` blocks of about ``BLOCK_ITEMS``.

The decomposition is fitted on the passages of all items: tasks add up their own, so only sums of bounded size move.

Corner cases: null and empty texts match nothing and are kept. Items without words match nothing. Texts are searched
whole. Repeated documents are reported each; repeated items likewise. An empty corpus or benchmark finds nothing.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampflow.llm.common import chunks, map_arrow, read_table, worker_cache, written

BITS = 13
BUCKETS = 1 << BITS
#: The hash of words: a polynomial in ``BASE`` modulo 2^32, mixed by ``MIXER``.
BASE, MIXER = 0x9E3779B1, 0x2C1B3C6D
#: Bytes of text that are hashed at a time; a longer word is hashed whole.
PIECE_BYTES = 1 << 20
NEXT_SPACE = re.compile(rb"\s")
HALF = 16
PASSAGE = 2 * HALF
RANK = 256
OVERSAMPLED = 8
POWER_STEPS = 2
SEED = 5
#: Items whose passages one task adds up, about.
FIT_ITEMS = 1 << 16
BLOCK_ITEMS = 1024
#: Cosine from which a passage is a candidate.
CLOSE = 0.55
#: Share of an item's words in the common subsequence: for a match with its answer, and for one without.
LEAST_COMMON = 0.7
NEAR_EXACT = 0.9
LEAST_ANSWER = 0.6
#: A stretch of a document that is compared may be so much longer than the item.
STRETCH = 1.3
#: A short item's candidate stretch holds two of its rarest words, and one more for so many words that it must hold.
WORDS_PER_ANCHOR = 8
EDGES = ".,;:!?\"'()[]{}<>|*#$%&~`^+=/\\-_…«»“”‘’¡¿"
PARTS = 4
#: Rows of half passages that are projected at a time.
ROWS = 1024
#: Blocks of items that one pass over the documents holds, and bytes of text in a block, about.
PASS_BLOCKS = 16
BLOCK_BYTES = 4 << 20

PAIRS = "doc_id long, item_id long, cosine double, common double, answer double, first_word long"


def words_of(text: str) -> list[str]:
    """Words in lower case without signs at their edges; signs alone are no words."""
    return [w for w in (t.strip(EDGES) for t in text.lower().split()) if w]


def _byte_classes() -> np.ndarray:
    """0 for white space, 1 for signs that are no part of a word at its edges, 2 for all else."""
    out = np.full(256, 2, dtype=np.uint8)
    out[[ord(c) for c in EDGES if c.isascii()]] = 1
    out[[c for c in range(128) if chr(c).isspace()]] = 0
    return out


CLASSES = _byte_classes()
#: Characters beyond ASCII that end words or stand at their edges; they are read as a space or a quotation mark.
UNUSUAL = re.compile("[" + "".join(c for c in EDGES if not c.isascii()) + "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse, modulo 2^32; kept by a worker and made longer when needed."""
    held = worker_cache("word-powers", dict)
    if len(held.get("up", ())) < size:
        size = max(size, PIECE_BYTES + 1)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 32))):
            steps = np.full(size, base, dtype=np.uint32)
            steps[0] = 1
            held[name] = np.cumprod(steps, dtype=np.uint32)
    return held["up"], held["down"]


def _piece_buckets(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(first bytes, buckets)`` of the words among some bytes: a polynomial hash from running sums."""
    classes = CLASSES[raw]
    core = np.flatnonzero(classes == 2)
    if not len(core):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint16)
    token = np.cumsum(classes == 0, dtype=np.int32)[core]
    new = np.flatnonzero(token[1:] != token[:-1])
    starts = core[np.concatenate(([0], new + 1))]
    ends = core[np.concatenate((new, [len(core) - 1]))] + 1
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint32)
    np.cumsum((raw + np.uint32(1)) * up[: len(raw)], dtype=np.uint32, out=sums[1:])
    hashed = (sums[ends] - sums[starts]) * down[starts]
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(MIXER)
    return starts, (hashed >> np.uint32(32 - BITS)).astype(np.uint16)


def word_buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words of the texts one after the other, and the number of words of each text."""
    shown = []
    for text in texts:
        text = (text or "").lower()
        if not text.isascii() and UNUSUAL.search(text):
            text = UNUSUAL.sub(lambda found: " " if found.group().isspace() else '"', text)
        shown.append(text.encode("utf-8", "surrogatepass"))
    raw = b" ".join(shown)
    begins = np.cumsum([0] + [len(s) + 1 for s in shown[:-1]]) if shown else np.empty(0, dtype=np.int64)
    places, buckets, at = [], [], 0
    while at < len(raw):
        # A long text is taken in pieces that end with a word.
        space = NEXT_SPACE.search(raw, at + PIECE_BYTES) if len(raw) - at > PIECE_BYTES else None
        end = space.start() if space else len(raw)
        starts, own = _piece_buckets(np.frombuffer(raw, dtype=np.uint8, count=end - at, offset=at))
        places.append(np.searchsorted(begins, starts + at, "right") - 1)
        buckets.append(own)
        at = end
    if not buckets:
        return np.empty(0, dtype=np.uint16), np.zeros(len(shown), dtype=np.int64)
    return np.concatenate(buckets), np.bincount(np.concatenate(places), minlength=len(shown))


def bucket_of(word: str) -> int:
    """Bucket of a lower-case word, -1 for signs alone."""
    buckets, _ = word_buckets([word])
    return int(buckets[0]) if len(buckets) else -1


def document_counts(docs: DataFrame, text_column: str) -> tuple[np.ndarray, int]:
    """In how many documents each bucket occurs, and the number of documents. Counts of a task are summed there."""

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in chunks(batches, 0, PIECE_BYTES):
            buckets, sizes = word_buckets(batch.column(0).to_pylist())
            total += len(sizes)
            ends = np.cumsum(sizes)
            for at in range(0, len(sizes), 128):
                own = sizes[at : at + 128]
                start = ends[at] - sizes[at]
                held = np.zeros((len(own), BUCKETS), dtype=bool)
                held[np.repeat(np.arange(len(own)), own), buckets[start : start + own.sum()]] = True
                counts += held.sum(axis=0)
        yield pa.RecordBatch.from_pydict(
            {"bucket": np.arange(-1, BUCKETS, dtype=np.int32), "documents": np.concatenate(([total], counts))}
        )

    partial = map_arrow(docs.select(F.col(f"`{text_column}`").alias("text")), worker, "bucket int, documents long")
    # One row per bucket: a fixed number.
    rows = partial.groupBy("bucket").agg(F.sum("documents").alias("documents")).toArrow()
    counts = np.zeros(BUCKETS + 1, dtype=np.int64)
    counts[rows.column("bucket").to_numpy() + 1] = rows.column("documents").to_numpy()
    return counts[1:], int(counts[0])


def passages(buckets: np.ndarray) -> list[np.ndarray]:
    """Overlapping passages of a text's buckets."""
    last = max(1, math.ceil(len(buckets) / HALF) - 1)
    return [buckets[i * HALF : i * HALF + PASSAGE] for i in range(last)] if len(buckets) else []


def passage_rows(items: DataFrame, weights: np.ndarray) -> DataFrame:
    """``(terms, values)``: unit TF-IDF vectors of the passages of ``items``."""

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, values = [], []
            for text in batch.column(0).to_pylist():
                for passage in passages(word_buckets([text])[0]):
                    own, counts = np.unique(passage, return_counts=True)
                    vector = counts * weights[own]
                    terms.append(own.tolist())
                    values.append((vector / max(np.linalg.norm(vector), 1e-12)).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64()))], names=["terms", "values"]
            )

    return map_arrow(items.select("text"), worker, "terms array<int>, values array<double>")


def _batch_rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for terms, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        yield np.array(terms, dtype=np.int64), np.array(values)


def _normal_product(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """``A'A basis`` for the passage matrix ``A``: each task multiplies its rows, sums of equal buckets are added up."""
    held, size = rows.sparkSession.sparkContext.broadcast(basis), 512
    width = basis.shape[1]

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, out, used = held.value, np.zeros((BUCKETS, width)), np.zeros(BUCKETS, dtype=bool)
        for batch in batches:
            for terms, values in _batch_rows(batch):
                out[terms] += values[:, None] * (values @ q[terms])
                used[terms] = True
        for at in range(0, BUCKETS, size):
            own = np.flatnonzero(used[at : at + size])
            if len(own):
                row = [[at // size], [own.astype(np.int64).tobytes()], [out[at + own].tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    def added(table: pa.Table) -> pa.Table:
        total = np.zeros((size, width))
        for own, sums in zip(table.column("own").to_pylist(), table.column("sums").to_pylist(), strict=True):
            total[np.frombuffer(own, dtype=np.int64)] += np.frombuffer(sums, dtype=np.float64).reshape(-1, width)
        used = np.flatnonzero(total.any(axis=1))
        row = [[table.column("block")[0].as_py()], [used.astype(np.int64).tobytes()], [total[used].tobytes()]]
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    schema = pa.schema([("block", pa.int32()), ("own", pa.binary()), ("sums", pa.binary())])
    kind = "block int, own binary, sums binary"
    # One row per block of buckets: a fixed number, together at most the size of the basis.
    blocks = map_arrow(rows, worker, kind).groupBy("block").applyInArrow(added, kind).toArrow()
    held.destroy()
    out = np.zeros_like(basis)
    for row in blocks.to_pylist():
        sums = np.frombuffer(row["sums"], dtype=np.float64).reshape(-1, width)
        out[row["block"] * size + np.frombuffer(row["own"], dtype=np.int64)] = sums
    return out


def _gram(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """``(A basis)'(A basis)``."""
    held, width = rows.sparkSession.sparkContext.broadcast(basis), basis.shape[1]

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((width, width))
        for batch in batches:
            for terms, values in _batch_rows(batch):
                projected = values @ held.value[terms]
                out += np.outer(projected, projected)
        yield pa.RecordBatch.from_pydict({"sums": [out.tobytes()]}, schema=pa.schema([("sums", pa.binary())]))

    parts = map_arrow(rows, worker, "sums binary").toArrow().column("sums").to_pylist()
    held.destroy()
    return sum((np.frombuffer(p, dtype=np.float64).reshape(width, width) for p in parts), np.zeros((width, width)))


def latent_space(rows: DataFrame, rank: int = RANK) -> np.ndarray:
    """The leading right singular vectors of the passage matrix, by a randomised range finder with power steps."""
    basis = np.random.default_rng(SEED).standard_normal((BUCKETS, rank + OVERSAMPLED))
    for _ in range(POWER_STEPS):
        basis, _ = np.linalg.qr(_normal_product(rows, basis))
    strengths, turned = np.linalg.eigh(_gram(rows, basis))
    leading = np.argsort(-strengths)[:rank]
    return basis @ turned[:, leading[strengths[leading] > 1e-9]]


def common_words(item: dict[str, int], size: int, words: list[str]) -> int:
    """Length of the longest common subsequence of an item, given as bit masks by word, and ``words``."""
    row = full = (1 << size) - 1
    for word in words:
        mask = item.get(word)
        if mask:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def masks_of(words: list[str]) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, word in enumerate(words):
        out[word] = out.get(word, 0) | 1 << i
    return out


def stretch_of(size: int) -> int:
    """Words of a document that are compared with an item of ``size`` words."""
    return math.ceil(STRETCH * size) + 2


@dataclass
class Item:
    """One benchmark item, ready to be compared."""

    number: int
    words: list[str]
    masks: dict[str, int]
    answer: list[str]
    answer_masks: dict[str, int]

    def compare(self, region: list[str]) -> tuple[float, float, int]:
        """Shares of the item and of its answer in the best stretch of a region, and where that starts."""
        size = len(self.words)
        length = stretch_of(size)
        if common_words(self.masks, size, region) < LEAST_COMMON * size:
            return 0.0, 0.0, 0
        step = max(1, size // 8)
        best, at = -1, 0
        for start in range(0, max(1, len(region) - length + step), step):
            found = common_words(self.masks, size, region[start : start + length])
            if found > best:
                best, at = found, start
        stretch = region[at : at + length]
        answer = common_words(self.answer_masks, len(self.answer), stretch) / max(1, len(self.answer))
        return best / size, answer, at


def item_of(number: int | None, text: str | None, answer: str | None) -> Item:
    words = words_of(text or "")
    own = words_of(answer or "")
    if not own:
        sentences = [s for s in map(words_of, re.split(r"[.!?\n]+", text or "")) if s]
        own = sentences[-1] if sentences else []
    return Item(-1 if number is None else number, words, masks_of(words), own, masks_of(own))


class Anchors:
    """Where texts may hold short items, without loss.

    A match holds ``k`` of an item's ``m`` words within its stretch, so at least ``r`` of any ``m - k + r`` of them. The
    rarest are taken; a place is a candidate if ``r`` words of the text within a stretch fall into their buckets.
    """

    def __init__(self, items: list[Item], weights: np.ndarray):
        self.items, lengths, needs, owners, buckets = [], [], [], [], []
        for number, item in enumerate(items):
            size = len(item.words)
            if 0 < size < PASSAGE:
                least = math.ceil(LEAST_COMMON * size - 1e-9)
                need = min(least, 2 + least // WORDS_PER_ANCHOR)
                all_words = word_buckets([" ".join(item.words)])[0].tolist()
                rarest = sorted(all_words, key=lambda b: -weights[b])[: size - least + need]
                own = set(rarest)
                owners += [len(self.items)] * len(own)
                buckets += own
                self.items.append(number)
                lengths.append(stretch_of(size))
                needs.append(need)
        order = np.argsort(np.array(buckets, dtype=np.int64), kind="stable")
        self.owners = np.array(owners, dtype=np.int32)[order]
        self.counts = np.bincount(np.array(buckets, dtype=np.int64), minlength=BUCKETS + 1)
        self.starts = np.concatenate(([0], np.cumsum(self.counts)[:-1]))
        self.lengths, self.needs = np.array(lengths, dtype=np.int64), np.array(needs, dtype=np.int64)

    def places(self, buckets: np.ndarray, owners: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(item, first half, last half)`` as rows of ``buckets``, whose texts are ``owners``."""
        step, more = 2048, -(-int(self.lengths.max()) // HALF)  # a stretch that begins in a step ends in it or in ``more``
        for at in range(0, len(buckets), step):
            rows = slice(at, at + step + more)
            for item, first, last in self._places(buckets[rows], owners[rows]):
                yield item, at + first, at + last

    def _places(self, buckets: np.ndarray, owners: np.ndarray) -> Iterator[tuple[int, int, int]]:
        flat = buckets.reshape(-1)
        hits = np.flatnonzero(self.counts[flat])
        each = self.counts[flat[hits]]
        ends = np.cumsum(each)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - each, each)
        items = self.owners[np.repeat(self.starts[flat[hits]], each) + within]
        order = np.argsort(items, kind="stable")
        items, places = items[order], np.repeat(hits, each)[order]
        texts = owners[places // HALF]
        last = np.arange(len(items)) + self.needs[items] - 1
        going = np.flatnonzero(last < len(items))
        last = last[going]
        near = (items[last] == items[going]) & (texts[last] == texts[going])
        near &= places[last] - places[going] < self.lengths[items[going]]
        found = going[near]
        own, at = items[found], places[found]
        halves = np.unique(np.stack((own, (at - self.lengths[own] + 1) // HALF, at // HALF), axis=1), axis=0)
        for item, first, end in halves.tolist():
            yield self.items[item], first, end


class Matcher:
    """Compares documents with a block of items ``(item_id, text, answer)`` in the space of the term vectors."""

    def __init__(self, rows: list[tuple], terms: np.ndarray, weights: np.ndarray | None = None):
        terms = np.ascontiguousarray(terms)
        self.items, self.terms = [item_of(*r) for r in rows], terms
        vectors, owners = [np.empty((0, terms.shape[1]), dtype=np.float32)], []
        for i, item in enumerate(self.items):
            for passage in passages(word_buckets([" ".join(item.words)])[0]):
                vector = terms[passage].sum(axis=0)
                vectors.append(vector[None, :] / max(np.linalg.norm(vector), 1e-9))
                owners.append(i)
        self.passages, self.owners = np.concatenate(vectors).astype(np.float32), np.array(owners, dtype=np.int64)
        self.first_passages = np.searchsorted(self.owners, np.arange(len(self.items)))
        self.anchors = Anchors(self.items, np.ones(BUCKETS) if weights is None else weights)

    def candidates(self, tokens: list[list[str]]) -> list[list[tuple[int, int, float]]]:
        """For each text the ``(item, half passage, cosine)`` of its passages close to one of the item, or by anchors."""
        return self.close(*word_buckets([" ".join(t) for t in tokens]))

    def _passages(self, halves: np.ndarray, goes_on: np.ndarray, at: int, end: int) -> np.ndarray:
        """Projected passages that begin at the half passages ``at .. end``."""
        rows = halves[at : end + 1]
        sums = np.take(self.terms, rows[:, 0], axis=0, mode="clip")
        one = np.empty_like(sums)
        for column in range(1, HALF):
            np.take(self.terms, rows[:, column], axis=0, out=one, mode="clip")
            sums += one
        out = sums[: end - at]
        after = np.flatnonzero(goes_on[at:end])
        out[after] += sums[after + 1]
        return out

    def close(self, buckets: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int, float]]]:
        """As ``candidates``, for texts given by the buckets of their words."""
        out: list[list[tuple[int, int, float]]] = [[] for _ in sizes]
        each = -(-sizes // HALF)
        if not each.sum():
            return out
        owners = np.repeat(np.arange(len(sizes)), each)
        begins = (np.cumsum(each) - each) * HALF
        halves = np.full(len(owners) * HALF, BUCKETS, dtype=np.int32)
        halves[np.arange(len(buckets)) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)] = buckets
        halves = halves.reshape(-1, HALF)
        goes_on = np.concatenate((owners[1:] == owners[:-1], [False]))
        first = np.concatenate(([True], ~goes_on[:-1]))
        firsts = np.flatnonzero(first)
        usable = goes_on | first  # the end of a longer text is part of the passage before
        for at in range(0, len(halves), ROWS):
            rows = at + np.flatnonzero(usable[at : at + ROWS])
            block = self._passages(halves, goes_on, at, min(at + ROWS, len(halves)))[rows - at]
            lengths = np.maximum(np.linalg.norm(block, axis=1), 1e-9)
            products = block @ self.passages.T
            close = np.flatnonzero(products.max(axis=1) >= CLOSE * lengths)
            i, j = np.nonzero(products[close] >= (CLOSE * lengths[close])[:, None])
            i = close[i]
            near, items = rows[i], self.owners[j].tolist()
            starts = (near - firsts[np.searchsorted(firsts, near, "right") - 1]).tolist()
            cosines = (products[i, j] / lengths[i]).tolist()
            for text, item, start, cosine in zip(owners[near].tolist(), items, starts, cosines, strict=True):
                out[text].append((item, start, cosine))
        if self.anchors.items:
            begins = firsts[np.searchsorted(firsts, np.arange(len(halves)), "right") - 1]
            for item, start, end in self.anchors.places(halves, owners):
                begin = int(begins[end])
                start = max(start, begin)
                block = self._passages(halves, goes_on, start, end + 1)
                cosines = block @ self.passages[self.first_passages[item]] / np.maximum(np.linalg.norm(block, axis=1), 1e-9)
                for row, cosine in enumerate(cosines.tolist(), start):
                    out[owners[row]].append((item, row - begin, cosine))
        return out

    def matches(self, text_tokens: list[str], close: list[tuple[int, int, float]]) -> list[tuple[int, float, float, float, int]]:
        """``(item, cosine, common, answer, first word)`` of the items that a text holds, each once."""
        words = [w for w in (t.strip(EDGES) for t in text_tokens) if w]
        by_item: dict[int, list[tuple[int, float]]] = {}
        for item, half, cosine in close:
            by_item.setdefault(item, []).append((half, cosine))
        out = []
        for number, places in by_item.items():
            item, best = self.items[number], None
            size = len(item.words)
            regions: list[list] = []
            for half, cosine in sorted(places):
                start, end = max(0, half * HALF - size), half * HALF + PASSAGE + size
                if regions and start <= regions[-1][0] + size:
                    regions[-1][1], regions[-1][2] = end, max(regions[-1][2], cosine)
                else:
                    regions.append([start, end, cosine])
            for start, end, cosine in regions:
                common, answer, at = item.compare(words[start:end])
                if common >= NEAR_EXACT or (common >= LEAST_COMMON and answer >= LEAST_ANSWER):
                    if best is None or common > best[2]:
                        best = (item.number, cosine, common, answer, start + at)
            if best:
                out.append(best)
        return out

    def found(self, texts: list[str | None]) -> list[list[tuple[int, float, float, float, int]]]:
        return found_by([self], texts)


def found_by(matchers: list[Matcher], texts: list[str | None]) -> list[list[tuple[int, float, float, float, int]]]:
    """The matches of each text with the items of all matchers. Only texts with a candidate are split into words."""
    buckets, sizes = word_buckets(texts)
    out: list[list] = [[] for _ in texts]
    for matcher in matchers:
        for i, close in enumerate(matcher.close(buckets, sizes)):
            if close:
                out[i] += matcher.matches(texts[i].lower().split(), close)
    return out


def item_passes(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> Iterator[tuple]:
    """What a pass over the documents needs: blocks of items ``(item_id, text, answer)``, the term vectors, the weights."""
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None)
    items = benchmark.select(F.col("item_id").cast("long"), "text", answer.cast("string").alias("answer"))
    items = written(items.withColumn("place", F.monotonically_increasing_id()), "items")
    count, size = items.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    if not count:
        return
    documents, total = document_counts(docs, text_column)
    weights = np.log((1 + total) / (1 + documents)) + 1
    parts = max(PARTS, -(-count // FIT_ITEMS))
    rows = written(passage_rows(items.select("text").repartition(parts), weights), "passages")
    space = latent_space(rows)
    if not space.shape[1]:
        return
    terms = np.concatenate((weights[:, None] * space, np.zeros((1, space.shape[1])))).astype(np.float32)
    number = max(-(-count // BLOCK_ITEMS), -(-(size or 0) // BLOCK_BYTES))
    for at in range(0, number, PASS_BLOCKS):
        blocks = []
        for block in range(at, min(at + PASS_BLOCKS, number)):
            chosen = items.where(F.pmod(F.xxhash64("place"), F.lit(number)) == block).orderBy("item_id", "place")
            blocks.append([tuple(r) for r in chosen.select("item_id", "text", "answer").collect()])
        yield blocks, terms, weights


def _matchers(held: tuple) -> list[Matcher]:
    blocks, terms, weights = held
    return [Matcher(block, terms, weights) for block in blocks if block]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each document and item that it holds: cosine, shares of item and answer, first word."""
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    out = spark.createDataFrame([], PAIRS)
    for one in item_passes(docs, benchmark, text_column):
        held = spark.sparkContext.broadcast(one)

        def worker(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            schema = pa.schema(
                [("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64())]
                + [("common", pa.float64()), ("answer", pa.float64()), ("first_word", pa.int64())]
            )
            matchers = _matchers(held.value)
            for batch in chunks(batches, 1, PIECE_BYTES):
                found = found_by(matchers, batch.column(1).to_pylist())
                rows = [(doc, *m) for doc, ms in zip(batch.column(0).to_pylist(), found, strict=True) for m in ms]
                columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        out = out.union(map_arrow(source, worker, PAIRS))
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item. Each pass but the last is written, so a task has one worker."""
    spark, place = docs.sparkSession, docs.columns.index(text_column)
    kept, passes = docs, 0
    for one in item_passes(docs, benchmark, text_column):
        held = spark.sparkContext.broadcast(one)
        kept, passes = written(kept, "kept") if passes else kept, passes + 1

        def worker(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            matchers = _matchers(held.value)
            for batch in chunks(batches, place, PIECE_BYTES):
                found = found_by(matchers, batch.column(place).to_pylist())
                yield batch.filter(pa.array([not f for f in found], pa.bool_()))

        kept = map_arrow(kept, worker, docs.schema)
    return kept


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items."""
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
