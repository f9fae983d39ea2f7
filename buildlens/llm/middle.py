"""Fill-in-middle: documents cut at unit ends into prefix, middle and suffix, written in an order that a model reads left to right.

A pandas UDF over Arrow batches does the work: ``finditer`` of the regex library collects the end of
every unit of a text (a line, as given) in a compact array of integers, so a cut after k units is one
look-up and a piece is one slice between two of them. The cuts and the form come from the SHA-256 of
a seed and the document's id, so a document is cut alike wherever and however often it is read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import trimmed

#: A line with its end, or the last one without.
LINE = r"[^\n]*\n|[^\n]+"
#: What stands before prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")

CUT = "n long, form string, prefix_chars long, middle_chars long, output string"


def unit_ends(text: str, units: regex.Pattern) -> array:
    """End of every unit in code points, after a leading 0."""
    return array("q", chain((0,), (m.end() for m in units.finditer(text))))


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from the hash of seed and id; a null id counts as empty."""
    found = hashlib.sha256(f"{seed}:{'' if doc_id is None else int(doc_id)}".encode()).digest()
    return tuple(int.from_bytes(found[k : k + 4], "big") for k in (0, 4, 8, 12))


def checked(markers: tuple[str, str, str]) -> tuple[str, str, str]:
    """The markers, if none can come about where a marker and a piece of text meet; else the text couldn't be told from the output."""
    if len(set(markers)) < 3 or not all(markers):
        raise ValueError("markers must be three different strings")
    for a in markers:
        for b in markers:
            if a != b and a in b or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)) + (a != b))):
                raise ValueError(f"markers {a!r} and {b!r} overlap")
    return markers


def cut(text: str, doc_id: int | None, units: regex.Pattern, seed: int, rate: int, spm: int, markers: tuple[str, str, str]) -> tuple[int, str, int | None, int | None, str]:
    """A row of CUT for this text."""
    ends = unit_ends(text, units)
    n = len(ends) - 1
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or h3 % 100 >= rate or any(m in text for m in markers):
        return n, "plain", None, None, text
    low, high = sorted((ends[h1 % (n + 1)], ends[h2 % (n + 1)]))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    p, s, m = markers
    if h4 % 100 < spm:
        return n, "spm", low, high - low, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", low, high - low, f"{p}{prefix}{s}{suffix}{m}{middle}"


def joined(output: str, form: str, markers: tuple[str, str, str] = MARKERS) -> str:
    """The text that an output of this form was made from."""
    if form == "plain":
        return output
    first, second = (1, 0) if form == "spm" else (0, 1)
    if not output.startswith(markers[first]):
        raise ValueError(f"not an output of the form {form}")
    one, found, rest = output[len(markers[first]) :].partition(markers[second])
    two, also, middle = rest.partition(markers[2])
    if not (found and also):
        raise ValueError(f"not an output of the form {form}")
    return one + middle + two if form == "psm" else two + middle + one


def transform(docs: DataFrame, unit: str = LINE, seed: int = 7, rate: int = 100, spm: int = 50, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of documents.

    unit: pattern of a unit whose matches, left to right, make up the whole text; text after the last
    match belongs to the suffix. rate: percent of documents that are cut; spm: percent of these that put
    the suffix first. A null text counts as empty. An empty text, one that holds a marker, and one that
    isn't drawn stay as they are (form plain, lengths null). Repeated rows and null ids give a row
    each; rows aren't moved, so an empty table gives none, and other columns aren't read.
    """
    checked(markers)

    @F.pandas_udf(CUT)
    def parts(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        units = regex.compile(unit)
        for ids, texts in frames:
            made = [cut(text or "", None if missing else doc_id, units, seed, rate, spm, markers) for doc_id, missing, text in zip(ids, ids.isna(), texts, strict=True)]
            n, form, low, middle, output = zip(*made, strict=True) if made else ((),) * 5
            yield pd.DataFrame({"n": n, "form": form, "prefix_chars": pd.array(low, "Int64"), "middle_chars": pd.array(middle, "Int64"), "output": output})

    # ids as text, so that an integer of a column with nulls stays exact
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), parts(F.col("doc_id").cast("long").cast("string"), F.col("text")).alias("cut"))
    return found.select("doc_id", "cut.*")


def restored(output: str | Column, form: str | Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text rebuilt from an output and its form; an output that isn't of this form is an error."""
    checked(markers)

    @F.pandas_udf("string")
    def back(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([None if o is None or f is None else joined(o, f, markers) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return back(output, form)


def digests(cuts: DataFrame, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """Rows of ``transform`` with SHA-256 digests of the output and of the text rebuilt from it, in place of the output itself."""
    checked(markers)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, back = [], []
            for output, form in zip(batch.column("output"), batch.column("form"), strict=True):
                output, form = output.as_py(), form.as_py()
                given.append(hashlib.sha256(output.encode()).hexdigest())
                back.append(hashlib.sha256(joined(output, form, markers).encode()).hexdigest())
            kept = [c for c in batch.schema.names if c != "output"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(given, pa.string()), pa.array(back, pa.string())], names=[*kept, "output_sha256", "restored_sha256"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cuts.schema if f.name != "output")
    return cuts.mapInArrow(trimmed(rows), f"{schema}, output_sha256 string, restored_sha256 string")
