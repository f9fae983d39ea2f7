"""Recursive expansion of archives: each level's archives are unpacked by the methods that their names and first bytes allow.

zip, tar (plain, gzip, bzip2, xz), gzip, bzip2 and xz are unpacked here; other methods need programs of their
own and are reported as failed. Members of ``a`` have paths below ``a_dir``.
"""

from __future__ import annotations

import bz2
import gzip
import io
import lzma
import posixpath
import tarfile
import zipfile
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import saved
from ..functions import archives, magic

#: Smaller files are no archives: an empty zip has so many bytes.
LEAST_BYTES = 22
#: Levels of archives within archives, against ones that hold themselves.
LEVELS = 32
FILES = "path string, content binary"
MADE = "archive string, path string, content binary, method string, error string"

TAR = {"tar_gz": "r:gz", "tar_bz2": "r:bz2", "tar_xz": "r:xz", "tar_lzma": "r:xz", "tar_plain": "r:"}
PLAIN = {"gzip_plain": (gzip.open, ".gz"), "bzip2_plain": (bz2.open, ".bz2"), "xz_plain": (lzma.open, ".xz")}


def members(method: str, name: str, content: bytes) -> Iterator[tuple[str, bytes]]:
    """(path, bytes) of an archive's files by one method; fails if the content isn't of this kind. Paths stay inside the archive's folder."""
    data = io.BytesIO(content)
    if method == "zip":
        with zipfile.ZipFile(data) as z:
            found = [(i.filename, i) for i in z.infolist() if not i.is_dir()]
            for path, info in found:
                yield inside(path), z.read(info)
    elif method in TAR:
        with tarfile.open(fileobj=data, mode=TAR[method]) as t:
            for info in t:
                if info.isfile():
                    yield inside(info.name), t.extractfile(info).read()
    elif method in PLAIN:
        opened, ending = PLAIN[method]
        with opened(data) as f:
            yield name.removesuffix(ending), f.read()
    else:
        raise ValueError(f"{method} needs a program of its own")


def inside(path: str) -> str:
    """The path without a root and steps upwards."""
    return "/".join(c for c in posixpath.normpath("/" + path).split("/") if c)


def expand(found: DataFrame) -> DataFrame:
    """Rows ``MADE`` of archives (path, content, methods): a row a member, or one row with the error where every method failed."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(made: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*made, strict=True))
            kinds = [pa.string(), pa.string(), pa.binary(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["archive", "path", "content", "method", "error"])

        for batch in batches:
            for path, content, methods in zip(*(batch.column(c) for c in ("path", "content", "methods")), strict=True):
                path, content, errors = path.as_py(), content.as_py(), []
                for method in methods.as_py():
                    try:
                        # all of an archive is read before its members count
                        got = list(members(method, path.rsplit("/", 1)[-1], content))
                    except Exception as wrong:  # noqa: BLE001  any kind of damage
                        errors.append(f"{method}: {wrong}")
                        continue
                    for name, data in got:
                        yield batch_of([(path, f"{path}_dir/{name}", data, method, None)])
                    if not got:
                        yield batch_of([(path, None, None, method, None)])
                    break
                else:
                    yield batch_of([(path, None, None, None, "; ".join(errors) or "no method")])

    return found.select("path", "content", "methods").mapInArrow(rows, MADE)


def unpack(files: DataFrame, every: bool = False, skip: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(files, log) after all archives among ``files`` (path, content), and those within them, are unpacked.

    files: (path, content) of the given files and all members. log: (path, event, detail), event unpacked
    (detail: the method), failed (the errors of all methods), too_small, skipped for a path that matches
    ``skip``, or too_deep for an archive within ``LEVELS`` others. Jars stay packed unless ``every``. Each level is written before the next.
    """
    level = saved(files.select("path", "content"))
    all_files, logs = [level], []
    for _ in range(LEVELS):
        words = magic.magic(F.substring("content", 1, magic.HEADER))
        kind = archives.kind(F.col("path"), every)
        left_out = F.col("path").rlike(skip) if skip else F.lit(False)
        judged = level.withColumns({"words": words, "kind": kind, "size": F.octet_length("content"), "left_out": left_out})
        packed = judged.filter((F.col("kind") == "archive") | ((F.col("kind") == "check") & (archives.methods_by_magic(F.col("words")) != "")))
        logs.append(packed.filter("left_out").select("path", F.lit("skipped").alias("event"), F.lit("").alias("detail")))
        logs.append(packed.filter(~F.col("left_out") & (F.col("size") < LEAST_BYTES)).select("path", F.lit("too_small").alias("event"), F.col("size").cast("string").alias("detail")))
        work = packed.filter(~F.col("left_out") & (F.col("size") >= LEAST_BYTES)).withColumn("methods", archives.plan(F.col("path"), F.col("words")))
        made = saved(expand(work))
        if made.isEmpty():
            break
        logs.append(made.filter("method IS NOT NULL").groupBy(F.col("archive").alias("path")).agg(F.lit("unpacked").alias("event"), F.min("method").alias("detail")))
        logs.append(made.filter("error IS NOT NULL").select(F.col("archive").alias("path"), F.lit("failed").alias("event"), F.col("error").alias("detail")))
        level = made.filter("path IS NOT NULL").select("path", "content")
        all_files.append(level)
    else:  # what is still packed is told
        deep = level.filter(archives.kind(F.col("path"), every) == "archive")
        logs.append(deep.select("path", F.lit("too_deep").alias("event"), F.lit(f"beyond {LEVELS} levels").alias("detail")))
    return reduce(DataFrame.union, all_files), reduce(DataFrame.union, logs)
