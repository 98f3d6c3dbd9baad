"""Repair of conversation structure by lightest derivations.

A conversation is a row of turns; a repaired one reads ``(s?(ua)+)?`` in the initials of its roles. What is derived is
``Prefix(i, state)``: the first ``i`` rows can be edited so that the pattern is in ``state``. It follows from a prefix and
an edit that may be made there, ``Edit(i, kind)``, an axiom that weighs the cost of the edit:

    Prefix(i, s), Edit(i, keep | rerole)  |-  Prefix(i + 1, the state after the role)
    Prefix(i, s), Edit(i, delete)         |-  Prefix(i + 1, s)
    Prefix(i, s), Edit(i, insert)         |-  Prefix(i, the state after the role put in)
    Prefix(n, a state that may end)       |-  Goal

Weights are pairs (cost, audit) in their natural order; a deduction adds the costs and appends the edit's initial to the
prefix's audit. That never weighs less than a premise, and a lighter premise never gives a heavier conclusion: two audits
of one prefix and one cost differ at some place, as neither can go on from the other without an insertion that costs. So
items are popped from an agenda in the order of their weights, are final when popped, and Goal ends the work (Knuth 1977).

Long conversations are cut. For a stretch of rows the agenda runs from every state, which gives a span: the lightest
weight from each state to each. Spans are joined pairwise, and again over the partitions that hold a conversation, so no
task holds a whole one but its audit.

Rows are sorted by conversation and turn in ranges, so a conversation with a third of all rows is spread over tasks.
Texts do not take part in that, only their digests; they follow each other once, in the order of their conversation, for
the digest of what was repaired, which is sequential.

Corner cases: rows of one turn go by their digests of role and text; nulls come first. Repeated rows are duplicates of
each other. Rows without a conversation id form one conversation. A conversation without rows after the damage has
zeros and an empty audit. Very long texts are read whole. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ampflow.llm.common import chunks, map_arrow, read_table, written

#: White space; what the damage is; the costs; the pattern ``(s?(ua)+)?`` as states 0 (start), 1 (after s),
#: 2 (after u) and 3 (after a).
BLANKS = " \t\n\x0b\x0c\r"
STOPS = ".!?"
DROPPED, EMPTIED, UNSTOPPED, REPEATED, USER = range(5)
DAMAGES = 20
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: Rows that one agenda works on.
STRETCH = 48

Weight = tuple[int, str]
#: Lightest weights by the states before and after.
Span = dict[tuple[int, int], Weight]

CHUNKS = (
    "conv_id long, part long, rows long, blank long, duplicate long, truncated long, illegal long, turns long,"
    " first_turn long, last_turn long, first_role string, last_role string, span string"
)
REPAIRED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def axioms(rows: list[tuple[str, str]]) -> dict[tuple, int]:
    """``Edit`` items with their costs, for rows ``(initial, fault)``; fault is B, D, T or empty."""
    out = {}
    for i, (_, fault) in enumerate(rows):
        if fault not in ("B", "D"):
            cut = TRUNCATED if fault == "T" else 0
            out["edit", i, "K"], out["edit", i, "R"] = cut, REROLE + cut
        out["edit", i, "D"] = DELETE
    for i in range(len(rows) + 1):
        out["edit", i, "I"] = INSERT
    return out


def concluded(rows: list[tuple[str, str]], prefix: tuple, edit: tuple) -> tuple | None:
    """The prefix that follows from a prefix and an edit of its next row."""
    _, i, state = prefix
    kind = edit[2]
    if kind == "D":
        return "prefix", i + 1, state
    if kind == "I":
        return "prefix", i, AFTER[state, WANTED[state]]
    letter = rows[i][0] if kind == "K" else WANTED[state]
    after = AFTER.get((state, letter))
    return None if after is None else ("prefix", i + 1, after)


def lightest(rows: list[tuple[str, str]], start: int = 0, goal: bool = True) -> dict[tuple, Weight]:
    """Final weights of the items, from ``Prefix(0, start)``; the work ends with Goal if that is asked for."""
    edits = axioms(rows)
    agenda: list[tuple[int, str, tuple]] = [(cost, "", item) for item, cost in edits.items()]
    agenda.append((0, "", ("prefix", 0, start)))
    heapq.heapify(agenda)
    final: dict[tuple, Weight] = {}
    at: list[list[tuple]] = [[] for _ in range(len(rows) + 1)]  # final prefixes and edits by their row
    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = cost, audit
        if item == ("goal",):
            break
        here = at[item[1]]
        for other in here:
            if (other[0] == "prefix") == (item[0] == "prefix"):
                continue
            prefix, edit = (item, other) if item[0] == "prefix" else (other, item)
            then = concluded(rows, prefix, edit)
            if then is not None and then not in final:
                (a, before), (b, _) = final[prefix], final[edit]
                heapq.heappush(agenda, (a + b, before + edit[2], then))
        here.append(item)
        if goal and item[0] == "prefix" and item[1] == len(rows) and item[2] in ENDS:
            heapq.heappush(agenda, (cost, audit, ("goal",)))
    return final


def joined(first: Span, second: Span) -> Span:
    """The span of two neighbouring stretches."""
    out: Span = {}
    for (start, middle), (cost, audit) in first.items():
        for (left, end), (more, then) in second.items():
            if left == middle:
                weight = cost + more, audit + then
                if (start, end) not in out or weight < out[start, end]:
                    out[start, end] = weight
    return out


def span_of(rows: list[tuple[str, str]]) -> Span:
    """Lightest weights of all rows from each state to each."""
    if len(rows) > STRETCH:
        half = len(rows) // 2
        return joined(span_of(rows[:half]), span_of(rows[half:]))
    out: Span = {}
    for start in WANTED:
        final = lightest(rows, start, goal=False)
        out |= {(start, end): final["prefix", len(rows), end] for end in WANTED if ("prefix", len(rows), end) in final}
    return out


def repair(rows: list[tuple[str, str]]) -> Weight:
    """Cost and audit of the cheapest repair of rows ``(initial, fault)``."""
    if len(rows) <= STRETCH:
        return lightest(rows)["goal",]
    span = span_of(rows)
    return min(span[0, end] for end in ENDS if (0, end) in span)


def _packed_span(span: Span) -> str:
    return ";".join(f"{start}{end}{cost}:{audit}" for (start, end), (cost, audit) in span.items())


def _unpacked_span(packed: str) -> Span:
    out = {}
    for part in packed.split(";"):
        head, audit = part.split(":")
        out[int(head[0]), int(head[1])] = int(head[2:]), audit
    return out


def damaged(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)`` after the damage; rows that it drops have no copy."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    code = F.pmod(F.crc32(F.concat(shown[0], F.lit(":"), shown[1])), F.lit(DAMAGES))
    text = F.when(code == EMPTIED, "").when(code == UNSTOPPED, F.translate(shown[3], STOPS, "")).otherwise(shown[3])
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(code == USER, "user").otherwise(shown[2]).alias("role"),
        text.alias("text"),
        F.when(code == DROPPED, 0).when(code == REPEATED, 2).otherwise(1).alias("copies"),
    )


def _digest() -> Column:
    return F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)


def marked(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, digest, initial, fault, copies)`` of damaged rows, without their texts.

    Rows alike in conversation, turn, role and text are one row with their number of copies; ``fault`` is that of the
    first copy, the others are duplicates.
    """
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    own = F.when(end == "", "B").when(~end.isin(*STOPS), "T").otherwise("")
    narrow = rows.select("conv_id", "turn", _digest().alias("digest"), F.left("role", F.lit(1)).alias("initial"), own.alias("own"), "copies")
    alike = narrow.groupBy("conv_id", "turn", "digest", "initial", "own").agg(F.sum("copies").alias("copies"))
    alike = written(alike, "turns")
    here = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = alike.where("copies > 0").groupBy("conv_id", "digest").agg(F.min(here).alias("first"))
    seen = alike.alias("a").join(
        first.alias("f"), F.col("a.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("a.digest") == F.col("f.digest")), "left"
    )
    earlier = ~F.col("first.turn").eqNullSafe(F.col("a.turn"))
    fault = F.when(F.col("own") == "B", "B").when(earlier, "D").otherwise(F.col("own"))
    return seen.select("a.conv_id", "a.turn", "a.digest", "initial", fault.alias("fault"), "copies")


@dataclass
class Chunk:
    """The rows of a conversation within a partition."""

    conv_id: int | None
    rows: list[tuple[str, str]] = field(default_factory=list)
    faults: dict[str, int] = field(default_factory=lambda: {"B": 0, "D": 0, "T": 0, "": 0})
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None

    def add(self, turn: int | None, initial: str, fault: str, copies: int) -> None:
        for copy in range(copies):
            own = fault if copy == 0 or fault == "B" else "D"
            if self.rows and self.rows[-1][0] + initial not in LEGAL:
                self.illegal += 1
            self.rows.append((initial, own))
            self.faults[own] += 1
        if copies and turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def row(self, part: int) -> tuple:
        counts = self.faults["B"], self.faults["D"], self.faults["T"], self.illegal, self.turns
        ends = (self.rows[0][0], self.rows[-1][0]) if self.rows else (None, None)
        span = _packed_span(span_of(self.rows)) if self.rows else None
        return self.conv_id, part, len(self.rows), *counts, self.first_turn, self.last_turn, *ends, span


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow_schema(spec: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in spec.split(","))])


def spans(marked_rows: DataFrame) -> DataFrame:
    """Chunks of conversations: one row for each conversation and range partition that holds some of it."""
    width = int(marked_rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "digest"]
    schema = _arrow_schema(CHUNKS)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, done = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for conv_id, turn, initial, fault, copies in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if chunk is None or chunk.conv_id != conv_id:
                    if chunk is not None:
                        done.append(chunk.row(part))
                    chunk = Chunk(conv_id)
                chunk.add(turn, initial, fault, copies)
            yield _batch(done, schema)
            done = []
        if chunk is not None:
            yield _batch([chunk.row(part)], schema)

    ordered = marked_rows.repartitionByRange(width, *order).sortWithinPartitions(*order)
    return map_arrow(ordered.select("conv_id", "turn", "initial", "fault", "copies"), worker, CHUNKS)


def repairs(marked_rows: DataFrame) -> DataFrame:
    """Counts of faults, cost and audit of every conversation."""
    names = [part.split()[0] for part in CHUNKS.split(",")]
    schema = _arrow_schema(REPAIRED)

    def finished(held: list[dict]) -> tuple:
        total = {c: sum(h[c] for h in held) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
        full = [h for h in held if h["rows"]]
        dated = [h for h in full if h["first_turn"] is not None]
        for before, after in zip(full, full[1:], strict=False):
            total["illegal"] += before["last_role"] + after["first_role"] not in LEGAL
        for before, after in zip(dated, dated[1:], strict=False):
            total["turns"] -= before["last_turn"] == after["first_turn"]
        gaps = dated[-1]["last_turn"] - dated[0]["first_turn"] + 1 - total["turns"] if dated else 0
        cost, audit = 0, ""
        if full:
            found = [_unpacked_span(h["span"]) for h in full]
            while len(found) > 1:
                found = [joined(*found[i : i + 2]) if i + 1 < len(found) else found[i] for i in range(0, len(found), 2)]
            cost, audit = min(found[0][0, end] for end in ENDS if (0, end) in found[0])
        return held[0]["conv_id"], gaps, total["blank"], total["duplicate"], total["truncated"], total["illegal"], cost, audit

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if held and held[0]["conv_id"] != row["conv_id"]:
                    done.append(finished(held))
                    held = []
                held.append(row)
            yield _batch(done, schema)
        if held:
            yield _batch([finished(held)], schema)

    # At most one row of a conversation for each range partition.
    gathered = spans(marked_rows).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return map_arrow(gathered.select(*names), worker, REPAIRED)


class _Edits:
    """The repaired turns of one conversation while its rows arrive."""

    def __init__(self, conv_id: int | None, audit: str):
        self.conv_id, self.audit, self.at, self.state = conv_id, audit, 0, 0

    def _put(self, role: str, text: str) -> tuple[str, str]:
        self.state = AFTER[self.state, role[:1]]
        return role, text

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._put(ROLES[WANTED[self.state]], "")

    def of(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """What stands in place of the next row, and before it."""
        yield from self.inserted()
        kind = self.audit[self.at]
        self.at += 1
        if kind != "D":
            yield self._put(ROLES[WANTED[self.state]] if kind == "R" else role, text)


def _in_order(found: DataFrame, rows: DataFrame) -> DataFrame:
    """``(conv_id, audit, role, text, copies)``: in each partition whole conversations, the audit before the rows."""
    none = F.lit(None)
    heads = found.select(
        "conv_id", F.lit(0).alias("kind"), none.cast("long").alias("turn"), F.lit("").alias("digest"),
        "audit", none.cast("string").alias("role"), none.cast("string").alias("text"), F.lit(0).alias("copies"),
    )
    tails = rows.where("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), "turn", _digest().alias("digest"),
        none.cast("string").alias("audit"), "role", "text", "copies",
    )
    ordered = heads.union(tails).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "digest")
    return ordered.select("conv_id", "audit", "role", "text", "copies")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, bool, list[tuple[str, str]]]]]:
    """For each slice of the batches ``(conv_id, whether it begins here, repaired turns)`` in order."""
    edits = None
    for batch in chunks(batches, 3):
        out = []
        for conv_id, audit, role, text, copies in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if audit is not None:
                if edits is not None:
                    out.append((edits.conv_id, False, list(edits.inserted())))
                edits = _Edits(conv_id, audit)
                out.append((conv_id, True, []))
            for _ in range(copies):
                out.append((conv_id, False, list(edits.of(role, text))))
        yield out
    if edits is not None:
        yield [(edits.conv_id, False, list(edits.inserted()))]


def repaired_turns(found: DataFrame, rows: DataFrame) -> DataFrame:
    """``(conv_id, place, role, text)``: the turns of repaired conversations, numbered from 0."""
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for part in _edited(batches):
            out = []
            for conv_id, begins, turns in part:
                place = 0 if begins else place
                for role, text in turns:
                    out.append((conv_id, place, role, text))
                    place += 1
            yield _batch(out, schema)

    return map_arrow(_in_order(found, rows), worker, "conv_id long, place long, role string, text string")


def repaired_digests(found: DataFrame, rows: DataFrame) -> DataFrame:
    """``(conv_id, repaired_sha256)``: the digests of repaired conversations, whose turns only pass through a task."""
    spec = "conv_id long, repaired_sha256 string"
    schema = _arrow_schema(spec)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, empty = None, None, True
        for part in _edited(batches):
            done = []
            for conv_id, begins, turns in part:
                if begins:
                    if digest is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest, empty = conv_id, hashlib.sha256(), True
                for role, text in turns:
                    digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                    empty = False
            yield _batch(done, schema)
        if digest is not None:
            yield _batch([(current, digest.hexdigest())], schema)

    return map_arrow(_in_order(found, rows), worker, spec)


def repaired_conversations(turns: DataFrame) -> DataFrame:
    """Faults, cheapest repair and digest of the repaired turns, for every conversation of ``(conv_id, turn, role, text)``."""
    rows = damaged(turns)
    found = written(repairs(marked(rows)), "repairs")
    digests = repaired_digests(found, rows)
    own = digests.withColumnRenamed("conv_id", "own")
    return found.join(own, found.conv_id.eqNullSafe(F.col("own"))).drop("own")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged by rule and repaired."""
    return repaired_conversations(read_table(spark, sf_dir, "conversations")).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )
