"""One contract for JSON records, whether they come as lines, as outer arrays or in a stream.

A record is good if it is valid UTF-8, parses, repeats no key, is an object, and stands in the array if the file should
hold one. Everything else is kept as text with
the name of its file, so that every record of an input file comes out once, good or bad. A field of a wrong type does
not make a record bad; it is NULL.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, DataFrameReader
from pyspark.sql import functions as F

from ampflow.session import shared_dir

# The splitting helper travels with its tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*+"?|[\[\]{},]', re.S)
VALUE, FILE, PLACED = "value", "_source_file", "_placed"


def elements(content: bytes) -> Iterator[tuple[bytes, bool]]:
    """Elements of an outer array as raw text, and whether they stand in it.

    A cut-off array gives its elements up to the cut, the last as far as it goes. What follows the array, and content
    that is no array, comes out as one piece outside.
    """
    content = content.removeprefix(b"\xef\xbb\xbf").strip()
    if not content.startswith(b"["):
        if content:
            yield content, False
        return
    depth, start, met = 0, 1, False
    for token in TOKEN.finditer(content):
        sign = token.group()
        if sign in (b"[", b"{"):
            depth += 1
        elif sign in (b"]", b"}"):
            depth -= 1
        if (sign == b"," and depth == 1) or depth == 0:
            piece = content[start : token.start()].strip()
            if piece or sign == b"," or met:
                yield piece, True
            start, met = token.end(), sign == b","
            if depth == 0:
                break
    rest = content[start:].strip()
    if rest or (depth and met):
        yield rest, depth > 0


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content, file in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            found = list(elements(content.as_py() or b""))
            for at in range(0, len(found), 1000):
                part = found[at : at + 1000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([piece for piece, _ in part], pa.binary()),
                        pa.array([placed for _, placed in part], pa.bool_()),
                        pa.array([file] * len(part), pa.string()),
                    ],
                    names=[VALUE, PLACED, FILE],
                )


def array_records(files: DataFrame) -> DataFrame:
    """Elements ``(value, _placed, _source_file)`` of whole files ``(value, _source_file)``, a file at a time."""
    raw = files.select(F.col(VALUE).cast("binary").alias(VALUE), FILE)
    split = raw.mapInArrow(_split, f"{VALUE} binary, {PLACED} boolean, {FILE} string")
    return split.select(F.col(VALUE).cast("string").alias(VALUE), PLACED, FILE)


# --- one array file in many tasks --------------------------------------------------------------------------------------
#
# Spark splits a text file at any line separator. Read with the comma as separator, a file comes in blocks that begin and end
# at commas, whatever stands in them. What a comma means depends on what came before its block: whether a string is open and
# how deep the brackets are. So a first pass sums up every block as a function of that (a string is open or not; brackets
# only add up), the sums of a file are composed in the order of its blocks, and a second pass splits every block knowing how
# it begins. An element that crosses blocks leaves one fragment in each, and these few are put together in order.

#: How files are read that are compressed, whose blocks cannot be split at commas.
COMPRESSED = r"\.(gz|bz2|zst|zstd|lz4|snappy|deflate|xz)$"
BLOCK = f"path string, {FILE} string, block long, length long, size long"
SUMMARY = "path string, block long, bytes long, size long, array boolean, depths array<int>, leasts array<int>, opens array<boolean>"
ENTRY = "path string, block long, ended boolean, open boolean, depth int, last boolean, trailing boolean"
WHOLE, HEAD, TAIL, MIDDLE = range(4)
_STRING_END = re.compile(rb'(?:[^"\\]|\\.)*+("?)', re.S)
_SIGN = re.compile(rb'"(?:[^"\\]|\\.)*+("?)|[\[\]{},]', re.S)
_BOM = b"\xef\xbb\xbf"


def _opening(content: bytes) -> int:
    """The place after the bracket that opens the array of a file, 0 if it holds none."""
    start = len(content) - len(content.removeprefix(_BOM).lstrip())
    return start + 1 if content[start : start + 1] == b"[" else 0


class _Sum:
    """What a stretch does to the depth of brackets, if a string is open before it or not."""

    def __init__(self, open_string: bool):
        self.open, self.depth, self.least = open_string, 0, 0

    def feed(self, content: bytes, at: int = 0) -> None:
        if self.open:
            found = _STRING_END.match(content, at)
            if not found.group(1):
                return
            at, self.open = found.end(), False
        for token in _SIGN.finditer(content, at):
            sign = content[token.start()]
            if sign == 0x22:
                self.open = not token.group(1)
            elif sign in b"[{":
                self.depth += 1
            elif sign in b"]}":
                self.depth -= 1
                self.least = min(self.least, self.depth)


class _Splitter:
    """Splits a block that begins inside the array."""

    def __init__(self, open_string: bool, depth: int):
        self.open, self.depth, self.ended, self.met = open_string, depth, False, False
        self.held: list[bytes] = []

    def feed(self, content: bytes, at: int = 0) -> Iterator[tuple[bytes, bool]]:
        """``(element, whether a comma ends it)``; what is left is held."""
        start = at
        if self.ended:
            self.held.append(content[at:])
            return
        if self.open:
            found = _STRING_END.match(content, at)
            at, self.open = found.end(), not found.group(1)
            if self.open:
                self.held.append(content[start:])
                return
        for token in _SIGN.finditer(content, at):
            sign = content[token.start()]
            if sign == 0x22:
                self.open = not token.group(1)
                continue
            if sign in b"[{":
                self.depth += 1
            elif sign in b"]}":
                self.depth -= 1
            if (sign == 0x2C and self.depth == 1) or self.depth == 0:
                self.held.append(content[start : token.start()])
                yield b"".join(self.held), sign == 0x2C
                self.held, start, self.ended = [], token.end(), self.depth == 0
                if self.ended:
                    break
        self.held.append(content[start:])

    def rest(self) -> bytes:
        return b"".join(self.held)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[list[bytes]]]]:
    """Each block with the pieces between its commas, some at a time."""

    def runs() -> Iterator[tuple[tuple, pa.RecordBatch]]:
        for batch in batches:
            if batch.num_rows:
                # Rows of a block follow each other; only where a run ends are its path and number looked at.
                columns = batch.column("path"), batch.column("block")
                ends = sorted({end for c in columns for end in pc.run_end_encode(c).run_ends.to_pylist()})
                for at, end in zip([0, *ends], ends):
                    yield tuple(c[at].as_py() for c in columns), batch.slice(at, end - at)

    for _, parts in groupby(runs(), key=lambda run: run[0]):
        first = next(parts)[1]
        info = {n: first.column(n)[0].as_py() for n in first.schema.names if n != VALUE}

        def pieces(first=first, parts=parts) -> Iterator[list[bytes]]:
            yield first.column(VALUE).to_pylist()
            for _, batch in parts:
                yield batch.column(VALUE).to_pylist()

        yield info, pieces()


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for info, parts in _blocks(batches):
        sums, size, array, at = [_Sum(False), _Sum(True)], 0, True, 0
        for number, pieces in enumerate(parts):
            content = b",".join(pieces) + b","
            size += len(content)
            if number == 0 and info["block"] == 0:
                at = _opening(content)
                array = at > 0
            for one in sums:
                one.feed(content, at)
            at = 0
        yield pa.RecordBatch.from_pydict(
            {
                "path": [info["path"]],
                "block": pa.array([info["block"]], pa.int64()),
                "bytes": pa.array([size], pa.int64()),
                "size": pa.array([info["size"]], pa.int64()),
                "array": [array],
                "depths": pa.array([[s.depth for s in sums]], pa.list_(pa.int32())),
                "leasts": pa.array([[s.least for s in sums]], pa.list_(pa.int32())),
                "opens": pa.array([[s.open for s in sums]], pa.list_(pa.bool_())),
            }
        )


def _ends_with_comma(size: int, read: int) -> bool:
    """Whether a file of ``size`` bytes ends with a comma, if its pieces with a comma each have ``read`` bytes.

    The reader drops a comma at the end and a byte order mark.
    """
    return size - read in (0, len(_BOM))


def _entries(table: pa.Table) -> pa.Table:
    """How each block of a file begins: the sums of the blocks before it, composed in order."""
    rows = sorted(table.to_pylist(), key=lambda r: r["block"])
    read = sum(r["bytes"] for r in rows)
    out, ended, is_open, depth = [], not rows[0]["array"], False, 1
    for number, row in enumerate(rows):
        last = number + 1 == len(rows)
        out.append((row["path"], row["block"], ended, is_open, depth, last, last and _ends_with_comma(row["size"], read)))
        entry = int(is_open)
        ended = ended or depth + row["leasts"][entry] <= 0
        is_open, depth = row["opens"][entry], depth + row["depths"][entry]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.bool_(), pa.bool_()]
    names = ["path", "block", "ended", "open", "depth", "last", "trailing"]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def _block_elements(info: dict, parts: Iterator[list[bytes]]) -> Iterator[tuple[bytes, bool, int, bool]]:
    """``(text, whether it stands in the array, kind, flag)`` of the elements and fragments of a block.

    The flag of a head tells whether a comma ends its element, that of a tail whether a comma began it.
    """
    alone = info["ended"] is None
    begins = info["block"] == 0
    splitter, outside, size, at = None, [], 0, 0
    if not (begins or info["ended"]):
        splitter = _Splitter(info["open"], info["depth"])
    headless = splitter is not None
    last = alone or info["last"]

    def found(content: bytes, at: int) -> Iterator[tuple[bytes, bool, int, bool]]:
        nonlocal headless
        for text, comma in splitter.feed(content, at):
            if headless:
                headless = False
                yield text, True, HEAD, comma
            else:
                text = text.strip()
                if text or comma or splitter.met:
                    yield text, True, WHOLE, False
            splitter.met = comma

    for number, pieces in enumerate(parts):
        content = b",".join(pieces)
        size += len(content) + 1
        if number == 0 and begins:
            at = _opening(content)
            if at:
                splitter = _Splitter(False, 1)
            else:
                content = content.removeprefix(_BOM)
        if number:
            content = b"," + content
        if splitter is None:
            outside.append(content)
        else:
            yield from found(content, at)
        at = 0
    if not last or (_ends_with_comma(info["size"], size) if alone else info["trailing"]):
        if splitter is None:
            outside.append(b",")
        else:
            yield from found(b",", 0)
    if splitter is None:
        text = b"".join(outside).strip()
        if text:
            yield text, False, WHOLE, False
        return
    rest = splitter.rest()
    if splitter.ended or (last and not headless):
        rest = rest.strip()
        if rest or (splitter.met and not splitter.ended):
            yield rest, not splitter.ended, WHOLE, False
    elif headless:
        yield rest, True, MIDDLE, False
    else:
        yield rest, True, TAIL, splitter.met


_PARTS = f"{VALUE} binary, {PLACED} boolean, path string, {FILE} string, block long, kind int, flag boolean"


def _split_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in _PARTS.split(", ")]
    kinds = [pa.binary(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_()]
    for info, parts in _blocks(batches):
        held: list[tuple] = []
        at = (info["path"], info[FILE], info["block"])
        for text, placed, kind, flag in _block_elements(info, parts):
            held.append((text, placed, *at, kind, flag))
            if len(held) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements from their fragments, which come by file, block and kind; one element is held at a time."""
    pending: list[bytes] | None = None
    file, path, met = None, None, False

    def element(comma: bool) -> list[bytes]:
        text = b"".join(pending or []).strip()
        return [text] if text or comma or met else []

    def batch_of(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
        texts, files = [r[0] for r in rows], [r[1] for r in rows]
        columns = [pa.array(texts, pa.binary()), pa.array([True] * len(rows), pa.bool_()), pa.array(files, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=[VALUE, PLACED, FILE])

    for batch in batches:
        out: list[tuple[bytes, str]] = []
        for row in batch.to_pylist():
            if row["path"] != path:
                if pending is not None:
                    out += [(text, file) for text in element(False)]
                pending, met = None, False
            path, file = row["path"], row[FILE]
            if row["kind"] == TAIL:
                pending, met = [row[VALUE]], row["flag"]
            else:
                pending = [*(pending or []), row[VALUE]]
                if row["kind"] == HEAD:
                    out += [(text, file) for text in element(row["flag"])]
                    pending = None
        yield batch_of(out)
    if pending is not None:
        yield batch_of([(text, file) for text in element(False)])


def split_array_records(reader: DataFrameReader, path: str) -> DataFrame:
    """As :func:`array_records` for files at ``path``, each read by as many tasks as it has blocks.

    The files are read twice, here: once to sum up their blocks and once to split them into a table in the shared folder.
    What stands outside the array is one piece for each block.
    """
    meta = F.col("_metadata")
    raw = reader.option("lineSep", ",").text(path).select(
        F.col(VALUE).cast("binary").alias(VALUE),
        meta.file_path.alias("path"),
        meta.file_name.alias(FILE),
        meta.file_block_start.alias("block"),
        meta.file_block_length.alias("length"),
        meta.file_size.alias("size"),
    )
    raw = raw.where(~F.col(FILE).rlike(COMPRESSED))
    several = raw.where("length < size").select(VALUE, "path", "block", "size")
    entries = several.mapInArrow(_summaries, SUMMARY).groupBy("path").applyInArrow(_entries, ENTRY)
    # One row for each block of a large file: some fifty bytes for, as a rule, 128 MB of input.
    met = raw.drop("length").join(F.broadcast(entries), ["path", "block"], "left")
    # Whole elements and fragments go on apart, and readers part good from bad: the split is done once and kept for them.
    spark = raw.sparkSession
    kept = f"{shared_dir(spark)}/ampflow/{spark.sparkContext.applicationId}/work/elements-{uuid.uuid4().hex}"
    split = met.mapInArrow(_split_blocks, _PARTS)
    split.write.parquet(kept)
    parts = spark.read.schema(split.schema).parquet(kept)
    fragments = parts.where(F.col("kind") != WHOLE).repartition("path").sortWithinPartitions("path", "block", "kind")
    joined = fragments.mapInArrow(_put_together, f"{VALUE} binary, {PLACED} boolean, {FILE} string")
    return parts.where(F.col("kind") == WHOLE).select(VALUE, PLACED, FILE).unionByName(joined)


def read_records(reader, path: str, outer_array: bool) -> DataFrame:
    """Raw records ``(value, _placed, _source_file)`` by a batch or streaming reader; blank lines are no records.

    ``_placed`` is false for what stands outside the array that a file should hold. In a batch a file of any size is split
    by many tasks, unless it is compressed; in a stream a file is split by one.
    """
    source = F.col("_metadata.file_name").alias(FILE)
    if outer_array:
        whole = reader.option("wholetext", True).text(path).select(VALUE, source)
        if not isinstance(reader, DataFrameReader):
            return array_records(whole)
        split = split_array_records(reader.option("wholetext", False), path)
        return array_records(whole.where(F.col(FILE).rlike(COMPRESSED))).unionByName(
            split.select(F.col(VALUE).cast("string").alias(VALUE), PLACED, FILE)
        )
    return reader.text(path).select(VALUE, F.lit(True).alias(PLACED), source).where(F.trim(VALUE) != "")


def parsed(value: str = VALUE) -> Column:
    """The record as VARIANT, NULL if it is bad."""
    whole = F.col(PLACED) & F.is_valid_utf8(value) & F.ltrim(value).startswith("{")
    return F.when(whole, F.try_parse_json(value))


def bad_text(value: str = VALUE) -> Column:
    """The text of a bad record with invalid bytes replaced, NULL for a good one."""
    return F.when(parsed(value).isNull(), F.make_valid_utf8(value))


def typed(records: DataFrame, schema: str, corrupt: str) -> DataFrame:
    """Good records as typed columns, bad ones in ``corrupt``; other columns stay."""
    fields = F.from_json(F.when(parsed().isNotNull(), F.col(VALUE)), schema)
    others = [c for c in records.columns if c not in (VALUE, PLACED)]
    return records.select(fields.alias("_fields"), bad_text().alias(corrupt), *others).select("_fields.*", corrupt, *others)
