"""Elements of an array in JSON files, read by byte ranges: a file of any size is as many tasks as it has ranges.

A file is one object; the elements of one of its arrays are wanted. Spark's text reader, told that lines end at
``}``, deals a file out in ranges, of any store and without a line in it. Where elements begin can't be seen in a range
alone: that depends on the brackets, and on being in a string, before it. These form an associative scan:

1. A range is summarised for both cases, that it begins in a string or outside: how the depth of brackets changes,
   and whether strings flip. The summaries, a row a range, are added up by file.
2. Each range, its beginning known, is cut after every ``}`` that ends an element (depth 2) or lies outside of arrays. What
   lies between two cuts is an element; only a range's first and last pieces go on in others and are put together, a few rows.

Which array an element is in is told by the last key at depth 1, in its range or an earlier one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..cluster import saved

#: Ranges whose beginnings are sent to all tasks, 16 bytes each; they are as large as spark.sql.files.maxPartitionBytes.
MOST_RANGES = 1 << 23
#: Bytes of rows that a task hands back at a time.
VOLUME = 4 << 20

OPEN, CLOSE, QUOTE, SLASH = np.zeros(256, bool), np.zeros(256, bool), 0x22, 0x5C
OPEN[list(b"[{")] = CLOSE[list(b"]}")] = True
TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*"|[\[\]{}:]|[^\s,\[\]{}:"]+', re.DOTALL)
NEXT = re.compile(rb"\s*,\s*(?=\{)")
AFTER = b"text after the object"

SUMMARY = "block long, file string, start long, size long, octets long, fragments long, flips boolean, outside long, inside long"
PIECE = "block long, kind string, seq long, depth int, wanted boolean, text string"
FOUND = "file string, block long, text string, wanted boolean, fault string"


def structure(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether strings flipped, an odd number of times, up to and with each byte; 1 or -1 at brackets of either kind, in strings too)."""
    quote = data == QUOTE
    at = np.flatnonzero(data == SLASH)
    if len(at):
        new = np.append(True, np.diff(at) > 1)
        first, last = at[new], at[np.append(new[1:], True)]
        escaped = last[(last - first) % 2 == 0] + 1  # after an odd number of backslashes
        quote[escaped[escaped < len(data)]] = False
    return np.cumsum(quote) % 2 == 1, OPEN[data].astype(np.int8) - CLOSE[data].astype(np.int8)


def fragments(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(block, file, start, size, octets, text): pieces of files up to each ``}``, by range in their order; bytes that aren't UTF-8 become U+FFFD."""
    rows = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(paths)
    meta = F.col("_metadata")
    file, start = meta.file_path, meta.file_block_start
    return rows.select(
        F.xxhash64(file, start).alias("block"), file.alias("file"), start.alias("start"), meta.file_size.alias("size"), (F.octet_length("value") + 1).cast("long").alias("octets"),
        F.concat(F.make_valid_utf8("value"), F.lit("}")).alias("text"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(first row, end row, block, bytes) of a batch's runs of rows of one block."""
    blocks = batch.column("block").to_numpy()
    if not len(blocks):
        return
    text = batch.column("text")
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2], np.uint8)
    edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield a, b, int(blocks[a]), data[offsets[a] : offsets[b]]


def summaries(rows: DataFrame) -> DataFrame:
    """A row of SUMMARY for every range; ``outside`` and ``inside`` are the changes of depth if it begins outside of or in a string."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict | None = None
        for batch in batches:
            octets = batch.column("octets").to_numpy()
            for a, b, block, data in _runs(batch):
                if known is None or known["block"] != block:
                    if known:
                        yield pa.RecordBatch.from_pylist([known], schema=_SUMMARY)
                    known = {"block": block, **{c: batch.column(c)[a].as_py() for c in ("file", "start", "size")}, "octets": 0, "fragments": 0, "flips": False, "outside": 0, "inside": 0}
                flipped, step = structure(data)
                one, two = int(step[~flipped].sum()), int(step[flipped].sum())
                if known["flips"]:
                    one, two = two, one
                known["outside"] += one
                known["inside"] += two
                known["flips"] ^= bool(flipped[-1])
                known["octets"] += int(octets[a:b].sum())
                known["fragments"] += b - a
        if known:
            yield pa.RecordBatch.from_pylist([known], schema=_SUMMARY)

    return rows.mapInArrow(summed, SUMMARY)


_SUMMARY = pa.schema([("block", pa.int64()), ("file", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("octets", pa.int64()), ("fragments", pa.int64()), ("flips", pa.bool_()), ("outside", pa.int64()), ("inside", pa.int64())])
_PIECE = pa.schema([("block", pa.int64()), ("kind", pa.string()), ("seq", pa.int64()), ("depth", pa.int32()), ("wanted", pa.bool_()), ("text", pa.string())])
_FOUND = pa.schema([("file", pa.string()), ("block", pa.int64()), ("text", pa.string()), ("wanted", pa.bool_()), ("fault", pa.string())])


def _before(value: Column, by: str = "file", order: str = "start") -> Column:
    """Sum of the values of a file's earlier ranges."""
    return F.coalesce(F.sum(value).over(Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def beginnings(found: DataFrame) -> DataFrame:
    """Summaries with what is known before each range: ``in_string``, ``depth``; and ``open_end``: the file doesn't end with a ``}`` and its last range has one too many."""
    rows = found.withColumn("in_string", _before(F.col("flips").cast("int")) % 2 == 1)
    change = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    whole, later = Window.partitionBy("file"), Window.partitionBy("file").orderBy(F.desc("start"))
    ends = (F.sum("octets").over(whole) == F.col("size") + 1) & (F.row_number().over(later) == 1)
    return rows.withColumns({"depth": _before(change), "open_end": ends})


@dataclass
class Known:
    """Beginnings of ranges, by rising ``block``."""

    block: np.ndarray
    in_string: np.ndarray
    depth: np.ndarray
    last: np.ndarray  # fragments of a range whose last one has a bracket too many, else -1

    def of(self, block: int) -> tuple[bool, int, int]:
        k = int(np.searchsorted(self.block, block))
        return bool(self.in_string[k]), int(self.depth[k]), int(self.last[k])


def _known(rows: DataFrame) -> Known:
    last = F.when(F.col("open_end"), F.col("fragments")).otherwise(-1)
    found = rows.select("block", "in_string", F.col("depth").cast("int").alias("depth"), last.alias("last")).toArrow().sort_by("block")
    return Known(*(found.column(c).to_numpy(zero_copy_only=False) if c == "in_string" else found.column(c).to_numpy() for c in ("block", "in_string", "depth", "last")))


def parsed(text: bytes, depth: int, field: str) -> tuple[bytes | None, bool | None, str | None]:
    """(element that the piece ends with, whether what follows at depth 2 is wanted, or None if the piece leaves that as it was, fault)."""
    key = begin = wanted = None
    for m in TOKEN.finditer(text):
        token = m[0]
        if depth == 0 and (token != b"{" or wanted is not None):
            return None, wanted, AFTER.decode() if wanted is not None else "not an object"
        if token in (b"{", b"["):
            if depth == 0:
                wanted = False
            elif depth == 1:
                wanted = token == b"[" and key == field
            depth += 1
            begin = m.start() if depth == 3 else begin
        elif token in (b"}", b"]"):
            depth -= 1
            wanted = False if depth <= 1 else wanted
        elif depth == 1 and token[:1] == b'"':
            try:
                key = json.loads(token, strict=False)
            except ValueError:
                key = None
    return text[begin:] if depth == 2 and begin is not None else None, wanted, None


def pieces(rows: DataFrame, known, field: str) -> DataFrame:
    """Rows of PIECE: elements (e) that lie in one range, with their number among those whose array is or isn't known there; first (h),
    last (t) or only piece (m) of a range; and at its end whether what follows is wanted (l), where the range tells."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        volume, block, left = 0, None, b""
        inside, depth, last, rows_seen, cuts, wanted, at_cut = False, 0, -1, 0, 0, None, 0
        numbers = {None: 0, True: 0}

        def flushed() -> pa.RecordBatch:
            nonlocal out, volume
            made, out, volume = out, [], 0
            columns = zip(*made, strict=True) if made else ((),) * 6
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE, strict=True)], schema=_PIECE)

        def add(kind: str, seq: int, level: int, want: bool | None, text: bytes) -> None:
            nonlocal volume
            out.append((block, kind, seq, level, want, text.decode("utf-8", "replace")))
            volume += len(text) + 60

        def closed() -> None:
            if block is not None:
                add("t" if cuts else "m", 0, at_cut, None, left)
                if wanted is not None:
                    add("l", 0, 0, wanted, b"")

        for batch in batches:
            for a, b, own, data in _runs(batch):
                if own != block:
                    closed()
                    block, left, rows_seen, cuts, wanted, numbers = own, b"", 0, 0, None, {None: 0, True: 0}
                    inside, depth, last = known.value.of(own)
                rows_seen += b - a
                if rows_seen == last:
                    data = data[:-1]
                flipped, step = structure(data)
                flipped = flipped ^ inside
                level = depth + np.cumsum(np.where(flipped, 0, step), dtype=np.int64)
                held, begin = data.tobytes(), 0
                at = np.flatnonzero((data == 0x7D) & ~flipped & (level <= 2))
                for p, deep in zip(at.tolist(), level[at].tolist(), strict=True):
                    text, begin = left + held[begin : p + 1], p + 1
                    left = b""
                    if not cuts:
                        add("h", 0, 0, None, text)
                    elif at_cut == 0:
                        add("f", 0, 0, None, AFTER)
                    elif at_cut == 2 and (m := NEXT.match(text)):
                        if wanted is not False:
                            add("e", numbers[wanted], 0, wanted, text[m.end() :])
                            numbers[wanted] += 1
                    else:
                        element, told, fault = parsed(text, at_cut, field)
                        wanted = wanted if told is None else told
                        if fault:
                            add("f", 0, 0, None, fault.encode())
                        elif element is not None and wanted is not False:
                            add("e", numbers[wanted], 0, wanted, element)
                            numbers[wanted] += 1
                    cuts, at_cut = cuts + 1, deep
                    if volume > VOLUME:
                        yield flushed()
                left += held[begin:]
                if len(data):
                    inside, depth = bool(flipped[-1]), int(level[-1])
        closed()
        yield flushed()

    return rows.select("block", "text").mapInArrow(cut, PIECE)


def joined(parts: DataFrame, blocks: DataFrame, field: str) -> DataFrame:
    """Rows of FOUND for what lies over the edges of ranges: the element that ends first in its range, if any; and faults."""
    order = F.struct("start", F.when(F.col("kind") == "t", 1).otherwise(0).alias("k"))
    ends = parts.filter("kind IN ('h', 'm', 't')").join(blocks.select("block", "file", "start"), "block")
    group = F.sum(F.when(F.col("kind") == "t", 1).otherwise(0)).over(Window.partitionBy("file").orderBy(order))
    rows = ends.withColumn("group", group).groupBy("file", "group").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), "text"))), lambda x: x.text), "").alias("text"),
        F.coalesce(F.max(F.when(F.col("kind") == "t", F.col("depth"))), F.lit(0)).alias("depth"), F.max(F.when(F.col("kind") == "h", F.col("block"))).alias("block"),
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                text = r["text"].encode()
                if r["block"] is None:  # the file's end
                    fault = None if r["depth"] == 0 and not text.strip() and r["group"] else "cut off" if r["depth"] else AFTER.decode() if r["group"] else "not an object"
                    out.append({"file": r["file"], "block": None, "text": None, "wanted": None, "fault": fault})
                else:
                    element, wanted, fault = parsed(text, r["depth"], field) if r["depth"] or not r["group"] else (None, None, AFTER.decode())
                    out.append({"file": r["file"], "block": r["block"], "text": None if element is None else element.decode(), "wanted": wanted, "fault": fault})
            yield pa.RecordBatch.from_pylist(out, schema=_FOUND)

    return rows.mapInArrow(read, FOUND)


def elements(spark: SparkSession, paths: list[str], field: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """((file, pos, c): the objects of the array ``field`` of every file, parsed by ``schema``; (file, broken): files that can't be parsed, whose elements are left out).

    ``pos`` counts from 0 in each file. Other keys are passed over, control characters may stand in strings, and elements that aren't
    objects don't count. A file without the array, and one of no bytes, gives no rows. Broken are files that aren't one object,
    are cut off, or hold an element that can't be parsed. Of a compressed file, one range, a missing last bracket goes unnoticed.
    """
    rows = fragments(spark, paths)
    blocks = saved(beginnings(saved(summaries(rows))))
    if (many := blocks.count()) > MOST_RANGES:
        raise ValueError(f"{many} ranges: raise spark.sql.files.maxPartitionBytes, so that there are {MOST_RANGES} at most")
    options = {"allowUnquotedControlChars": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    element = F.from_json("text", f"{schema}, _broken string", options)
    torn = F.col("c").isNull() | F.col("c._broken").isNotNull()

    def with_values(df: DataFrame) -> DataFrame:
        return df.withColumn("c", element).withColumn("torn", torn)

    # an element is parsed once; its text is kept only where it is a piece or can't be parsed
    parts = with_values(pieces(rows, spark.sparkContext.broadcast(_known(blocks)), field))
    is_element = F.col("kind") == "e"
    parts = saved(parts.select("block", "kind", "seq", "depth", "wanted", F.when(~is_element | F.col("torn"), F.col("text")).alias("text"), F.when(is_element, F.col("c")).alias("c"), (is_element & F.col("torn")).alias("torn")))
    edge = saved(with_values(joined(parts, blocks, field)))
    counts = parts.groupBy("block").agg(
        F.count_if((F.col("kind") == "e") & F.col("wanted").isNull()).alias("told_before"), F.count_if((F.col("kind") == "e") & F.col("wanted")).alias("told"),
        F.max(F.when(F.col("kind") == "l", F.col("wanted"))).alias("last"),
    )
    heads = edge.filter("block IS NOT NULL").select("block", F.col("wanted").alias("head"), F.col("text").isNotNull().alias("has_head"))
    by_file = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    table = blocks.select("block", "file", "start").join(counts, "block", "left").join(heads, "block", "left")
    table = table.withColumn("here", F.coalesce("head", F.last(F.coalesce("last", "head"), True).over(by_file), F.lit(False)))
    table = table.withColumn("headed", (F.coalesce("has_head", F.lit(False)) & F.col("here")).cast("int"))
    early = F.when(F.col("here"), F.coalesce("told_before", F.lit(0))).otherwise(0)
    table = saved(table.withColumn("early", early).withColumn("first", _before(F.col("headed") + F.col("early") + F.coalesce("told", F.lit(0)))))
    placed = F.col("first") + F.col("headed") + F.col("seq") + F.when(F.col("wanted"), F.col("early")).otherwise(0)
    inner = parts.filter("kind = 'e'").join(table, "block").filter("wanted OR here").select("file", placed.alias("pos"), "c", "torn", "text")
    outer = edge.filter("text IS NOT NULL").join(table.drop("file"), "block").filter("headed = 1").select("file", F.col("first").alias("pos"), "c", "torn", "text")
    found = inner.union(outer)
    faults = edge.filter("fault IS NOT NULL").select("file", F.col("fault").alias("broken")).union(parts.filter("kind = 'f'").join(blocks, "block").select("file", F.col("text").alias("broken")))
    broken = saved(faults.union(found.filter("torn").select("file", F.left("text", F.lit(200)))).groupBy("file").agg(F.min("broken").alias("broken")))
    whole = found if broken.isEmpty() else found.join(broken.select("file"), "file", "left_anti")
    return whole.select("file", "pos", F.col("c").dropFields("_broken").alias("c")), broken
