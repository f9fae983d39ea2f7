"""Repeated runs of lines across all documents, by a suffix array over line ids.

Lines that hold a word are the symbols; a document's sequence of them is a text, and the suffix at
every line takes part. Distributed prefix doubling ranks suffixes by their first 1, 2, 4, ... lines:
in a round, the ranks of a suffix and of the one half a prefix further on make the new rank, and
suffixes whose prefix occurs once leave for good. Suffixes of one rank are an interval of the
suffix array whose longest common prefix is at least the round's length; its rank is written as the
interval's first place in the corpus, so a suffix stands in a later copy if its rank isn't its own place.

A run qualifies if it has ``MIN_WORDS`` words. Every line of a qualifying run lies in the shortest
qualifying run that begins, or the one that ends, at some line of it, so a maximal repeated run is
the union of such short ones; those are looked up from the ranks of two overlapping prefixes. That
bounds the rounds by the lines of a short run, however long the repeats are.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import saved
from .text import trimmed

#: Fewest words of a run whose later copies go.
MIN_WORDS = 50

LINES = "doc binary, place int, id binary, spans array<int>"


def worded(text: str | None) -> tuple[list[str], list[int], list[int]]:
    """(all lines, numbers of those with a word, words of these)."""
    lines = (text or "").split("\n")
    counts = [len(x.encode().split()) for x in lines]
    at = [k for k, n in enumerate(counts) if n]
    return lines, at, [counts[k] for k in at]


def shortest(counts: list[int], least: int) -> list[list[int]]:
    """For each line, the lengths of shortest runs of at least ``least`` words that begin at it, or begin at it and are shortest for their end."""
    n = len(counts)
    spans: list[set[int]] = [set() for _ in range(n)]
    end = total = 0
    for start in range(n):
        while end < n and total < least:
            total += counts[end]
            end += 1
        if total >= least:
            spans[start].add(end - start)
        total -= counts[start]
    start = n - 1
    total = 0
    for end in range(n - 1, -1, -1):
        while start >= 0 and total < least:
            total += counts[start]
            start -= 1
        if total >= least:
            spans[start + 1].add(end - start)
        total -= counts[end]
    return [sorted(s) for s in spans]


def document_key(doc_id: int | None, text_hash: int) -> bytes:
    """Bytes that sort as ids do, nulls first; rows that share an id but not the text differ."""
    known = doc_id is not None
    return struct.pack(">BQQ", known, (doc_id if known else 0) + (1 << 63), text_hash + (1 << 63))


def _keyed(docs: DataFrame) -> DataFrame:
    """Id, hash of the text and text; rows that share id and text once. Only rows with a repeated id are moved for that."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("h"), "text")
    twice = saved(rows.groupBy("id").count().filter("count > 1").select(F.col("id").alias("twice")))
    if twice.isEmpty():
        return rows
    again = F.col("id").eqNullSafe(F.col("twice"))
    return rows.join(twice, again, "left_anti").union(rows.join(twice, again, "left_semi").dropDuplicates(["id", "h"]))


def sequences(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """One row a line with a word: document, place, 128-bit id of the line, lengths of short runs that begin there."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            volume = 0
            for doc_id, h, text in zip(*(batch.column(c) for c in ("id", "h", "text")), strict=True):
                lines, at, counts = worded(text.as_py())
                key = document_key(doc_id.as_py(), h.as_py())
                out[0].extend([key] * len(at))
                out[1].extend(range(len(at)))
                out[2].extend(hashlib.blake2b(lines[k].encode(), digest_size=16).digest() for k in at)
                out[3].extend(shortest(counts, least))
                volume += len(at)
                if volume > 50_000:
                    yield _lines(out)
                    out, volume = ([], [], [], []), 0
            yield _lines(out)

    return _keyed(docs).mapInArrow(trimmed(rows), LINES)


def _lines(out: tuple[list, list, list, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary()), pa.array(out[3], pa.list_(pa.int32()))], names=["doc", "place", "id", "spans"])


def _place() -> Column:
    """A suffix's place in the corpus, as bytes that sort by document and line."""
    return F.concat("doc", F.unhex(F.lpad(F.hex(F.col("place")), 8, "0")))


def _ranked(rows: DataFrame, by: list[str], *also: str) -> DataFrame:
    """Suffixes whose ``by`` occurs more than once, with the first place of its group as rank."""
    groups = rows.groupBy(*by).agg(F.min("at").alias("rank"), F.count("*").alias("many")).filter("many > 1")
    # written, so that the join below stands on plain tables and adaptive execution can split a frequent group
    return rows.join(saved(groups.select(*by, "rank")), by).select("doc", "place", "at", "rank", *also)


def copies(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """(doc, start, length, first) of short repeated runs that aren't the first of their kind; doc as by ``document_key``."""
    rows = sequences(docs, least).withColumn("at", _place())
    rounds = [saved(_ranked(rows, ["id"], "spans"))]
    runs = saved(rounds[0].filter(F.size("spans") > 0).select("doc", F.col("place").alias("start"), "at", F.explode("spans").alias("length")))
    longest = runs.agg(F.max("length")).first()[0] or 0
    last = rounds[0].select("doc", "place", "at", "rank")
    step = 1
    while 2 * step <= longest:
        further = last.select("doc", (F.col("place") - step).alias("place"), F.col("rank").alias("next"))
        last = saved(_ranked(last.join(further, ["doc", "place"]).withColumnRenamed("rank", "left"), ["left", "next"]))
        if last.isEmpty():
            break
        rounds.append(last)
        step *= 2
    found = None
    for k, ranks in enumerate(rounds):
        own = runs.filter((F.col("length") >= 1 << k) & (F.col("length") < 1 << (k + 1)))
        head = ranks.select("doc", F.col("place").alias("start"), F.col("rank").alias("head"))
        tail = ranks.select("doc", F.col("place").alias("end"), F.col("rank").alias("tail"))
        whole = own.join(head, ["doc", "start"])
        whole = whole.withColumn("tail", F.col("head")) if not k else whole.withColumn("end", F.col("start") + F.col("length") - (1 << k)).join(tail, ["doc", "end"])
        runs_by = ["head", "tail", "length"]
        first = whole.groupBy(*runs_by).agg(F.min("at").alias("first"), F.count("*").alias("many")).filter("many > 1")
        later = whole.join(saved(first.drop("many")), runs_by).filter("at <> first").select("doc", "start", "length", "first")
        found = later if found is None else found.union(later)
    return found


def dedup(docs: DataFrame, least: int = MIN_WORDS, note: str = "removed") -> DataFrame:
    """The columns of documents with new ``text``, and ``note``: numbers of the lines that went (from 0).

    Of every run of lines with at least ``least`` words (lines without a word don't count and never
    go) that occurs more than once in the corpus, the first in order of doc_id (null first) and line
    stays, and lines of all later ones go, also within a document. Rows that share id and text are
    one document here and get the same answer, so a repeated row isn't a later copy of itself. A null
    text stays null. A column of the table that is named as ``note`` is replaced, all others but ``text`` are
    left as they are. An empty table gives no rows.
    """
    spans = copies(docs, least).groupBy("doc").agg(F.collect_set(F.struct("start", "length")).alias("gone"))
    names = [c for c in docs.columns if c != note]
    spare = "_" * (2 + max(map(len, [*names, note])))  # longer than any column of the table
    known = F.col("doc_id").isNotNull()
    flip = lambda c: F.unhex(F.lpad(F.hex(c.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))), 16, "0"))
    key = F.concat(F.when(known, F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00"))), flip(F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))), flip(F.xxhash64("text")))
    joined = docs.withColumn(spare, key).join(spans.select(F.col("doc").alias(spare), F.col("gone").alias(spare + "_")), spare, "left").drop(spare)
    schema = T.StructType([*docs.select(*names).schema.fields, T.StructField(note, T.ArrayType(T.IntegerType()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = [], []
            for text, gone in zip(batch.column("text"), batch.column(spare + "_"), strict=True):
                text, gone = text.as_py(), gone.as_py()
                if gone:
                    lines, at, _ = worded(text)
                    out = {at[k] for g in gone for k in range(g["start"], g["start"] + g["length"])}
                    text = "\n".join(x for k, x in enumerate(lines) if k not in out)
                    removed.append(sorted(out))
                else:
                    removed.append([])
                texts.append(text)
            columns = [pa.array(texts, batch.column(c).type) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.list_(pa.int32()))], names=[*names, note])

    return joined.mapInArrow(trimmed(rows), schema)
