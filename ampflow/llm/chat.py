"""Chat formatting by columnar byte assembly.

A conversation becomes its turns in order, each between an opening and a closing mark of its role. Control strings
that occur in a text are made harmless by one backslash after their first character; as sequences that already have
backslashes there get one more, taking one away gives the text back exactly.

Turns are assembled in batches: the lengths of all headers, contents and closers give cumulative offsets, each source
byte gets its place in the output, and everything is scattered into one preallocated Arrow buffer. The loss mask is
the list of byte spans of the assistant texts.

A conversation is written in pieces of about ``PIECE_BYTES``, so one with very many turns never has to fit in memory,
and it is read back piece by piece. Turns of one conversation have to follow each other, as its hash does; rows are
sorted and streamed.

Corner cases: null texts are empty; a null role is the empty role. Turns with equal numbers are ordered by role and
text; null turn numbers come first; repeated rows are separate turns. Rows with a null ``conv_id`` form one
conversation. An empty table gives no conversations but those added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampflow.llm.common import chunks, map_arrow, read_table

PIECE_BYTES = 1 << 20
#: Marks of the known roles, and of any other role, whose name stands between NAME marks.
MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
OTHER = ("[TURN] ", " [/TURN]")
NAME = ("[ROLE]", "[/ROLE]")
CONTROLS = r"([\[<])(\\*)(/?(?:SYS|INST|TURN|ROLE)\]|/?s>)"
ESCAPED = r"([\[<])\\(\\*)(/?(?:SYS|INST|TURN|ROLE)\]|/?s>)"
LEARNED = "assistant"
#: The conversation that the query adds, a user's and an assistant's turn.
ADDED_ID, ADDED_TEXT = -1, "</s>[INST] ok [/INST]"

PIECES = "conv_id long, piece int, turns int, formatted string, loss_starts array<int>, loss_lengths array<int>"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def escaped(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, CONTROLS, r"\1\\\2\3")


def unescaped(text: str) -> str:
    return re.sub(ESCAPED, r"\1\2\3", text)


def scattered(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], total: int) -> np.ndarray:
    """One buffer of ``total`` bytes from sources ``(bytes, lengths, places)`` whose segments lie one after another."""
    out = np.empty(total, dtype=np.uint8)
    for data, lengths, places in parts:
        starts = np.cumsum(lengths) - lengths
        out[np.repeat(places - starts, lengths) + np.arange(len(data))] = data
    return out


def _bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data and lengths of a string array without nulls."""
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int32)[array.offset : array.offset + len(array) + 1]
    if not len(offsets) or array.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(array), np.int64)
    data = np.frombuffer(array.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, np.diff(offsets).astype(np.int64)


def _marks(roles: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Headers and closers of the rows, and which rows are learned."""
    distinct = roles.dictionary_encode()
    names = distinct.dictionary.to_pylist()
    safe = escaped(pa.array(names, pa.string())).to_pylist()
    pairs = [MARKS.get(n, (NAME[0] + s + NAME[1] + OTHER[0], OTHER[1])) for n, s in zip(names, safe, strict=True)]
    heads = pa.array([h for h, _ in pairs], pa.string()).take(distinct.indices)
    tails = pa.array([t for _, t in pairs], pa.string()).take(distinct.indices)
    learned = np.array([n == LEARNED for n in names], dtype=bool)[distinct.indices.to_numpy()]
    return heads, tails, learned


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Formatted bytes of all rows, the end of each row, and start, length and learned flag of each content."""
    heads, tails, learned = _marks(roles)
    (head, head_n), (body, body_n), (tail, tail_n) = _bytes(heads), _bytes(escaped(texts)), _bytes(tails)
    ends = np.cumsum(head_n + body_n + tail_n)
    starts = ends - head_n - body_n - tail_n
    contents = starts + head_n
    total = int(ends[-1]) if len(ends) else 0
    out = scattered([(head, head_n, starts), (body, body_n, contents), (tail, tail_n, contents + body_n)], total)
    return out, ends, contents, body_n, learned


def format_conversations(turns: DataFrame) -> DataFrame:
    """Pieces of formatted conversations from ``(conv_id, turn, role, text)``.

    A piece has the formatted text, the number of its turns, and the byte spans under the loss mask within it.
    """

    def cut(conv: np.ndarray, known: np.ndarray, ends: np.ndarray, last: tuple | None) -> Iterator[tuple[int, int, int]]:
        """``(first row, end, piece number)``: rows of one conversation, about PIECE_BYTES; goes on from ``last``."""
        start, number = 0, 0
        if last is not None and len(conv) and (conv[0], known[0]) == last[:2]:
            number = last[2] + 1
        for i in range(1, len(conv) + 1):
            other = i < len(conv) and (conv[i] != conv[i - 1] or known[i] != known[i - 1])
            base = ends[start - 1] if start else 0
            if i == len(conv) or other or ends[i - 1] - base >= PIECE_BYTES:
                yield start, i, number
                start, number = i, 0 if other else number + 1

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in chunks(batches, 2, 2 << 20):
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            conv = ids.fill_null(0).to_numpy()
            out, ends, contents, lengths, learned = assemble(batch.column(1), batch.column(2))
            pieces = list(cut(conv, known, ends, last))
            first = np.array([a for a, _, _ in pieces])
            stop = np.array([b for _, b, _ in pieces])
            bounds = np.concatenate(([0], ends[stop - 1])).astype(np.int32)
            formatted = pa.StringArray.from_buffers(len(pieces), pa.py_buffer(bounds), pa.py_buffer(out))
            own = np.repeat(bounds[:-1], stop - first)
            masked = np.cumsum(learned)
            upto = np.concatenate(([0], masked[stop - 1])).astype(np.int32)
            spans = [pa.array(v[learned].astype(np.int32)) for v in (contents - own, lengths)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(conv[first], mask=~known[first]),
                    pa.array([n for _, _, n in pieces], pa.int32()),
                    pa.array((stop - first).astype(np.int32)),
                    formatted,
                    *[pa.ListArray.from_arrays(pa.array(upto), s) for s in spans],
                ],
                names=["conv_id", "piece", "turns", "formatted", "loss_starts", "loss_lengths"],
            )
            last = (conv[-1], known[-1], pieces[-1][2])

    source = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("turn").alias("turn"),
    )
    ordered = source.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_arrow(ordered.select("conv_id", "role", "text"), worker, PIECES)


def parsed(formatted: str) -> Iterator[tuple[str, str]]:
    """``(role, text)`` of the turns of a formatted piece."""
    openers = {mark[0]: (role, mark[1]) for role, mark in MARKS.items()}
    at = 0
    while at < len(formatted):
        if formatted.startswith(NAME[0], at):
            end = formatted.index(NAME[1] + OTHER[0], at)
            role, closer = unescaped(formatted[at + len(NAME[0]) : end]), OTHER[1]
            start = end + len(NAME[1] + OTHER[0])
        else:
            opener = next(o for o in openers if formatted.startswith(o, at))
            (role, closer), start = openers[opener], at + len(opener)
        end = formatted.index(closer, start)
        yield role, unescaped(formatted[start:end])
        at = end + len(closer)


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of every conversation from its pieces, which have to follow each other as they were made."""

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> dict:
            return {
                "conv_id": conv,
                "n_turns": n_turns,
                "turns_sha256": turns.hexdigest(),
                "loss_chars": loss_chars,
                "loss_sha256": loss.hexdigest(),
                "formatted_chars": chars,
            }

        started, conv, n_turns, turns, loss_chars, loss, chars = False, None, 0, None, 0, None, 0
        for batch in batches:
            done = []
            for piece in batch.to_pylist():
                if not started or piece["piece"] == 0:
                    if started:
                        done.append(row())
                    started, conv, n_turns, loss_chars, chars = True, piece["conv_id"], 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, text in parsed(piece["formatted"]):
                    n_turns += 1
                    turns.update(f"{role}\n{text}\n".encode())
                raw = piece["formatted"].encode()
                chars += len(piece["formatted"])
                for start, length in zip(piece["loss_starts"], piece["loss_lengths"], strict=True):
                    text = unescaped(raw[start : start + length].decode())
                    loss_chars += len(text)
                    loss.update(text.encode())
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if started:
            yield pa.RecordBatch.from_pylist([row()], schema=schema)

    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )
    return map_arrow(pieces, worker, DIGESTS)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts are control strings."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(ADDED_ID).cast("long").alias("conv_id"),
        F.col("id").cast("int").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ADDED_TEXT).alias("text"),
    )
    return read_back(format_conversations(turns.unionByName(added)))
