"""SentencePiece (BPE) encoding and decoding over a table of prefixes.

Every prefix of a text has one encoding, hence one last piece. A piece is the last one of a prefix exactly if it ends there
and the last piece of the prefix before it stays apart from it, that is, if merging the two pieces' characters alone would
leave these two. So an automaton over all pieces reports what ends at each place, a test of two neighbours picks the one
piece that fits, and the ids are read from the end of the table backwards. The time is linear in the text, however long a
word is.

The test of two neighbours undoes their merges, the latest first. Whatever stood side by side at the border until then must
not have had a merge that came earlier. This needs merges that rank after the merges they are built from. Pieces for which
that does not hold (``late``; here two runs of spaces without a rank of their own) make their stretch of text be merged
directly, by a heap.

Stretches that no piece can cross are encoded apart: no piece holds a space sign after another sign, none
another sign after a letter (letters are what no sign follows in any piece), and none a character that is no piece. Those characters become the pieces of their bytes. Short stretches are remembered.

Corner cases: null and empty texts have no ids, decode to the empty text and hash as such. Texts of any length are encoded
whole. Repeated rows stay. An empty table gives no rows. Ids decode as the library decodes them: control pieces vanish, the
unknown piece is shown, bytes that are no UTF-8 become U+FFFD one by one.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ampflow.llm.common import chunks, free_name, map_arrow, read_table, worker_cache

MODEL = "piece_bpe_32k.model"
#: The sign for a space, and how the unknown piece is shown.
SPACE = "▁"
UNKNOWN = " ⁇ "
#: Stretches that a worker remembers, and their greatest length; pairs of neighbours that it remembers. Some 120 MB.
STRETCHES = 200_000
STRETCH_LENGTH = 48
PAIRS = 1 << 20


class PieceFile:
    """Pieces of a model file: the text, the rank (best first) and the kind of each."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        probe = " a  Åﬁ\t b "
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError(f"{path} normalises texts in a way that is not covered")
        size = model.get_piece_size()
        self.texts = [model.id_to_piece(i) for i in range(size)]
        self.control = [i for i in range(size) if model.is_control(i)]
        self.unknown = model.unk_id()
        self.bytes = {int(self.texts[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        if len(self.bytes) != 256 or any(model.is_unused(i) for i in range(size)):
            raise ValueError(f"{path} has no byte pieces, or unused ones")
        special = {*self.control, self.unknown, *self.bytes.values()}
        self.ids = {self.texts[i]: i for i in range(size) if i not in special}
        self.ranks = {i: -model.get_score(i) for i in self.ids.values()}
        if any(a != SPACE and b == SPACE for text in self.ids for a, b in zip(text, text[1:], strict=False)):
            raise ValueError(f"{path} has pieces that go on after a word")


class PrefixTable:
    """Encoder and decoder for one model file."""

    def __init__(self, path: str):
        self.file = PieceFile(path)
        self.lengths = [len(t) for t in self.file.texts]
        self.parts: dict[int, tuple[int, int]] = {}
        self.late: set[int] = set()
        self.automaton = ahocorasick.Automaton()
        for text, number in self.file.ids.items():
            if self._learn(text, number):
                self.automaton.add_word(text, (len(text), number))
        self.automaton.make_automaton()
        alone = "".join(re.escape(t) for t in self.file.ids if len(t) == 1)
        self.spans = re.compile(f"[{alone}]+|[^{alone}]+")
        self.characters = {t for t in self.file.ids if len(t) == 1}
        self.stretches = re.compile(self._stretch_pattern())
        self.late_texts = re.compile("|".join(re.escape(self.file.texts[i]) for i in self.late) or "(?!)")
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.shown = [str(i) for i in range(len(self.file.texts))]
        self.plain = [t.replace(SPACE, " ").encode() for t in self.file.texts]
        for number in self.file.control:
            self.plain[number] = b""
        self.plain[self.file.unknown] = UNKNOWN.encode()
        for value, number in self.file.bytes.items():
            self.plain[number] = bytes([value])
        self.byte_ids = set(self.file.bytes.values())
        self.silent = {*self.file.control, self.file.unknown}

    def _stretch_pattern(self) -> str:
        """Stretches that no piece crosses: it never holds a space sign after another sign, nor a sign after a letter."""
        breaks = "".join(c for c in "\n\t" if c not in self.characters)
        ends = f"{SPACE}++" + (f"|[{breaks}]++" if breaks else "")
        signs = {c for text in self.file.ids for c in text if re.fullmatch(r"[\W\d_]", c)}
        while more := {a for text in self.file.ids for a, b in zip(text, text[1:], strict=False) if b in signs and a not in signs}:
            signs |= more  # what a sign may follow is no letter here
        odd = "".join(sorted(re.escape(c) for c in signs if re.fullmatch(r"[^\W\d_]", c)))
        sign = rf"(?:[\d_{odd}]|[^\w{SPACE}{breaks}])"
        return rf"{SPACE}*+{sign}*+[^\W\d_{odd}]++|{SPACE}*+{sign}++|{ends}"

    def _learn(self, text: str, number: int) -> bool:
        """Notes from which two pieces a piece is merged last; False if merging its characters gives something else."""
        if len(text) == 1:
            return True
        merges: list[tuple[int, int, int]] = []
        if self.merged(text, merges) != [number]:
            return False
        _, left, right = merges[-1]
        self.parts[number] = (left, right)
        rank = self.file.ranks
        self.late.update(p for p in (left, right) if len(self.file.texts[p]) > 1 and rank[p] >= rank[number])
        return True

    def merged(self, text: str, merges: list[tuple[int, int, int]] | None = None) -> list[int]:
        """Ids of characters merged pair by pair, the best rank first and of equal ranks the leftmost."""
        ids, ranks, texts = self.file.ids, self.file.ranks, self.file.texts
        held: list[int | None] = [ids[c] for c in text]
        after, before = list(range(1, len(held) + 1)), list(range(-1, len(held) - 1))
        waiting: list[tuple[float, int, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            whole = ids.get(texts[held[left]] + texts[held[right]])
            if whole is not None:
                heapq.heappush(waiting, (ranks[whole], left, right, held[left], held[right]))

        for i in range(len(held) - 1):
            offer(i, i + 1)
        while waiting:
            _, left, right, a, b = heapq.heappop(waiting)
            if held[left] != a or held[right] != b or after[left] != right:
                continue
            held[left], held[right] = ids[texts[a] + texts[b]], None
            if merges is not None:
                merges.append((held[left], a, b))
            after[left] = after[right]
            if after[left] < len(held):
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return [h for h in held if h is not None]

    def apart(self, left: int, right: int) -> bool:
        """Whether two neighbouring pieces stay two: no merge across their border came before those that made them."""
        ids, ranks, texts, parts = self.file.ids, self.file.ranks, self.file.texts, self.parts
        until, tie_joins = float("inf"), True
        while True:
            joined = ids.get(texts[left] + texts[right])
            if joined is not None and (ranks[joined] < until or (tie_joins and ranks[joined] == until)):
                return False
            made = ranks[left] if left in parts else -1.0, ranks[right] if right in parts else -1.0
            if made == (-1.0, -1.0):
                return True
            # Of equal ranks the left merge came first, so the right one is undone first; a tie with it joins the border.
            tie_joins = made[1] >= made[0]
            if tie_joins:
                until, right = made[1], parts[right][0]
            else:
                until, left = made[0], parts[left][1]

    def last_pieces(self, text: str) -> list[int]:
        """For every prefix of a text of known characters its last piece; -1 for the empty prefix."""
        last, size, pairs = [-1] * (len(text) + 1), len(self.lengths), self.pairs
        for end, (length, number) in self.automaton.iter(text):
            if last[end + 1] >= 0:
                continue
            left = last[end + 1 - length]
            if left >= 0:
                key = left * size + number
                fits = pairs.get(key)
                if fits is None:
                    fits = self.apart(left, number)
                    if len(pairs) < PAIRS:
                        pairs[key] = fits
                if not fits:
                    continue
            elif length <= end:
                continue
            last[end + 1] = number
        return last

    def _known_span(self, text: str) -> list[int]:
        if self.late_texts.search(text):
            return self.merged(text)
        last, lengths, out, at = self.last_pieces(text), self.lengths, [], len(text)
        while at:
            out.append(last[at])
            at -= lengths[last[at]]
        return out[::-1]

    def _stretch(self, text: str) -> bytes:
        """Ids of a stretch as unsigned 32-bit integers."""
        out: list[int] = []
        for span in self.spans.findall(text):
            if span[0] in self.characters:
                out += self._known_span(span)
            else:
                out += [self.file.bytes[b] for b in span.encode("utf-8", "surrogatepass")]
        return array("I", out).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if not text:
            return np.empty(0, dtype=np.uint32)
        known, out = self.known, []
        for stretch in self.stretches.findall(SPACE + text.replace(" ", SPACE)):
            ids = known.get(stretch)
            if ids is None:
                ids = self._stretch(stretch)
                if len(stretch) <= STRETCH_LENGTH and len(known) < STRETCHES:
                    known[stretch] = ids
            out.append(ids)
        return np.frombuffer(b"".join(out), dtype=np.uint32)

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the space that encoding puts first."""
        plain = self.plain
        start = next((i for i, number in enumerate(ids) if plain[number]), len(ids))
        if start == len(ids):
            return ""
        ids = ids[start:]
        raw = b"".join([plain[i] for i in ids])
        if ids[0] not in self.byte_ids and ids[0] not in self.silent and raw[:1] == b" ":
            raw = raw[1:]
        try:
            if not self.silent.intersection(ids):
                return raw.decode()
        except UnicodeDecodeError:
            pass
        return self._decode_piecewise(ids)

    def _decode_piecewise(self, ids: list[int]) -> str:
        """Runs of byte pieces are decoded apart from their neighbours; each byte that is no UTF-8 is one U+FFFD."""
        out, run = [], bytearray()

        def flush() -> None:
            while run:
                for size in range(1, 5):
                    try:
                        out.append(bytes(run[:size]).decode())
                        del run[:size]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    del run[:1]

        for number in ids:
            if number in self.byte_ids:
                run += self.plain[number]
                continue
            flush()
            text = self.plain[number].decode()
            if not out and number not in self.silent and text[:1] == " ":
                text = text[1:]
            out.append(text)
        flush()
        return "".join(out)


def codec(path: str) -> PrefixTable:
    """The worker's encoder for a file, built once and kept for later tasks."""
    return worker_cache(f"pieces:{path}", lambda: PrefixTable(path))


def _added(docs: DataFrame, path: str, place: int, make: Callable, added: list[StructField], drop: bool) -> DataFrame:
    """``docs`` with the columns that ``make`` finds from the codec and the values at ``place``, and without these if asked."""

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = codec(path)
        for batch in chunks(batches, place, 2 << 20):
            made = make(table, batch.column(place).to_pylist())
            others = [(n, c) for i, (n, c) in enumerate(zip(batch.schema.names, batch.columns, strict=True)) if not drop or i != place]
            yield pa.RecordBatch.from_arrays([*[c for _, c in others], *made], names=[*[n for n, _ in others], *names])

    fields = [f for i, f in enumerate(docs.schema.fields) if not drop or i != place]
    names = [f.name for f in added]
    return map_arrow(docs, worker, StructType([*fields, *added]))


def _id_lists(table: PrefixTable, texts: list[str | None]) -> list[pa.Array]:
    rows = [table.encode(t or "") for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.concatenate(rows).astype(np.int32) if rows else np.empty(0, dtype=np.int32)
    return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]


def _decoded(table: PrefixTable, rows: list[list[int] | None]) -> list[pa.Array]:
    return [pa.array([None if ids is None else table.decode(ids) for ids in rows], pa.string())]


def _digests(table: PrefixTable, texts: list[str | None]) -> list[pa.Array]:
    counts, shown, decoded = [], [], []
    for text in texts:
        ids = table.encode(text or "").tolist()
        counts.append(len(ids))
        shown.append(hashlib.sha256(",".join([table.shown[i] for i in ids]).encode()).hexdigest())
        decoded.append(hashlib.sha256(table.decode(ids).encode("utf-8", "surrogatepass")).hexdigest())
    return [pa.array(counts, pa.int64()), pa.array(shown, pa.string()), pa.array(decoded, pa.string())]


def encode(docs: DataFrame, path: str, text_column: str = "text", name: str = "piece_ids") -> DataFrame:
    """``docs`` with the ids of every text as an array; a column of that name is replaced."""
    docs = docs.drop(name)
    added = [StructField(name, ArrayType(IntegerType()))]
    return _added(docs, path, docs.columns.index(text_column), _id_lists, added, drop=False)


def decode(encoded: DataFrame, path: str, ids_column: str = "piece_ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the decoded text of every id array; null arrays decode to null."""
    encoded = encoded.drop(name)
    return _added(encoded, path, encoded.columns.index(ids_column), _decoded, [StructField(name, StringType())], drop=False)


def round_trip_digests(docs: DataFrame, path: str, text_column: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; such columns are replaced.

    Encoder and decoder run in one pass over the texts, so neither ids nor decoded texts travel.
    """
    (text,) = free_name(docs, "_text")
    kept = docs.withColumn(text, F.col(f"`{text_column}`")).drop("n_tokens", "ids_sha256", "decoded_sha256", text_column)
    names = (("n_tokens", LongType()), ("ids_sha256", StringType()), ("decoded_sha256", StringType()))
    return _added(kept, path, kept.columns.index(text), _digests, [StructField(n, t) for n, t in names], drop=True)


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return round_trip_digests(docs, public_tokenizers.path(MODEL))
