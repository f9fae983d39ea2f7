"""Files of a folder: their digests, kinds and signatures."""

from __future__ import annotations

import hashlib
import os
import time
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import opened, qualified, saved
from ..functions import archives, magic
from ..plans.signatures import parent_chain

#: Path of files that an unpacker works on.
WORKING = "/.queue."


def projects(spark: SparkSession, folder: str, inside: str | None = None) -> list[str]:
    """Names of the folders in this one, sorted; with ``inside`` only those that hold a folder of this name."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in system.listStatus(root) if s.isDirectory())
    return [n for n in names if inside is None or system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/{inside}"))]


def walk(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, content) of all files below the folder but those an unpacker works on; content is read only where it is used."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    root = folder.rstrip("/")
    path = F.regexp_replace("path", r"^[a-z]+:/+(?=[^/])", "/")
    rows = rows.select(path.alias("path"), "length", "content").filter(~F.col("path").contains(WORKING))
    return rows.withColumn("path", F.substring("path", F.length(F.lit(root)) + 2, 1 << 20))


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


# Seconds that a digest may take, in all cases and for each 100 MB.
SECONDS, SECONDS_100_MB = 120, 60
#: Bytes read at a time, and files that are a task of their own.
CHUNK, LARGE = 8 << 20, 1 << 30

DIGEST = "path string, length long, hash string, error string"


def budget(length: int) -> float:
    """Seconds for the digest of a file of this length."""
    return (length >> 20) // 100 * SECONDS_100_MB + SECONDS


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of all files below the folder, relative to it, ones of no bytes too; links aren't followed.

    Folders are listed level by level, each by a task, so that no task or driver holds all names. The store is one that pyarrow's file systems reach.
    """
    root = qualified(spark, folder)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(root)
        for batch in batches:
            for at in batch.column("path").to_pylist():
                found = store.get_file_info(pyarrow.fs.FileSelector(f"{base}/{at}".rstrip("/")))
                if isinstance(store, pyarrow.fs.LocalFileSystem):
                    found = [f for f in found if not os.path.islink(f.path)]
                names = [f"{at}/{f.base_name}".lstrip("/") for f in found]
                folders = [f.type == pyarrow.fs.FileType.Directory for f in found]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([f.size or 0 for f in found], pa.int64()), pa.array(folders, pa.bool_())], names=["path", "length", "folder"])

    level, levels = spark.createDataFrame([("",)], "path string"), []
    while True:
        found = saved(level.repartition(spark.sparkContext.defaultParallelism).mapInArrow(rows, "path string, length long, folder boolean"))
        levels.append(found.filter("NOT folder").select("path", "length"))
        level = found.filter("folder").select("path")
        if level.isEmpty():
            return reduce(DataFrame.union, levels)


def hashed(listed: DataFrame, root: str, algorithm: str = "sha256", seconds: Callable[[int], float] = budget) -> DataFrame:
    """Rows of DIGEST for files (path, length) below ``root``.

    A file is read in chunks with a running digest, whatever its length. Without a digest ``error`` tells why: TIMEOUT where it took
    longer than its length allows (seen between chunks), FAILED where it can't be read to its end, EMPTY_HASH where the algorithm gave nothing.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(root)
        for batch in batches:
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                digest, error, until = hashlib.new(algorithm), None, time.monotonic() + seconds(length)
                try:
                    with store.open_input_stream(f"{base}/{path}", compression=None) as file:
                        while part := file.read(CHUNK):
                            digest.update(part)
                            if time.monotonic() > until:
                                error = "TIMEOUT"
                                break
                except (OSError, pa.ArrowException):
                    error = "FAILED"
                error = error or (None if (text := digest.hexdigest()) else "EMPTY_HASH")
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([length]), pa.array([None if error else text], pa.string()), pa.array([error], pa.string())], names=["path", "length", "hash", "error"])

    return listed.select("path", "length").mapInArrow(rows, DIGEST)


def digests(spark: SparkSession, folder: str, algorithm: str = "sha256", seconds: Callable[[int], float] = budget) -> DataFrame:
    """Rows of DIGEST for all files below the folder but those an unpacker works on; large files are tasks of their own."""
    root = qualified(spark, folder)
    listed = saved(listing(spark, folder).filter(~F.concat(F.lit("/"), "path").contains(WORKING)))
    sizes = listed.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count_if(F.col("length") >= LARGE).alias("large")).first()
    small = listed.filter(F.col("length") < LARGE).repartition(max(1, sizes["bytes"] // LARGE, spark.sparkContext.defaultParallelism))
    large = listed.filter(F.col("length") >= LARGE).repartition(max(1, sizes["large"]))
    return hashed(small, root, algorithm, seconds).union(hashed(large, root, algorithm, seconds))


def signatures(files: DataFrame, project: str, side: str, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(path, hash, archive, parents_hash, parents_chain, error) of files below a project's ``side`` (src or bin), see ``walk`` and ``digests``.

    Paths are virtual: without the suffix _dir of unpacked archives. archive is 1 if such a folder lies
    beside the file. Files of ``digests`` have their hash and error; of others ``digest`` makes the hash, and error is EMPTY_HASH where it gives nothing.
    """
    told = files.select("path", "error") if "error" in files.columns else None
    hashed = files.select("path", F.coalesce(F.col("hash") if told is not None else digest(F.col("content")), F.lit("")).alias("hash"))
    folders = hashed.select(F.explode(F.expr("transform(sequence(1, greatest(size(split(path, '/')) - 1, 1)), k -> array_join(slice(split(path, '/'), 1, k), '/'))")).alias("around"))
    unpacked = folders.filter(F.col("around").endswith("_dir")).select(F.regexp_replace("around", "_dir$", "").alias("path")).distinct().withColumn("unpacked", F.lit(1))
    chains = parent_chain(hashed)
    rows = chains.join(unpacked, "path", "left")
    rows = rows.withColumn("error", F.lit(None).cast("string")) if told is None else rows.join(told.filter("error IS NOT NULL"), "path", "left")
    return rows.select(
        F.concat(F.lit(f"{project}/{side}/"), "virtual_path").alias("path"), "hash", F.coalesce("unpacked", F.lit(0)).alias("archive"), "parents_hash", "parents_chain",
        F.when(F.col("hash") == "", F.coalesce("error", F.lit("EMPTY_HASH"))).alias("error"),
    )


def binaries(files: DataFrame) -> DataFrame:
    """(type, path) of binary files: BINARY_EXT by extension, ELF, PE32 or MSDOS by their first bytes where the name doesn't tell."""
    triage = archives.triage(F.col("path"))
    header = F.substring("content", 1, magic.HEADER)
    kind = F.when(triage == "BINARY_EXT", "BINARY_EXT").when(triage == "MAGIC", magic.executable(magic.magic(header)))
    return files.select(kind.alias("type"), "path").filter("type IS NOT NULL")


def extensions(files: DataFrame) -> DataFrame:
    """(ext, files) by the profiler's extensions."""
    from ..functions.paths import shell_extension

    return files.groupBy(shell_extension(F.col("path")).alias("ext")).agg(F.count("*").alias("files"))


def languages_present(files: DataFrame, endings: dict[str, tuple[str, ...]]) -> DataFrame:
    """One row: for each language whether a file ends with one of its endings (as written)."""
    return languages_by(files, endings)


def languages_by(files: DataFrame, endings: dict[str, tuple[str, ...]], *by: str) -> DataFrame:
    """A row for each group, say a project: for each language whether one of the group's files ends with one of its endings."""
    return files.groupBy(*by).agg(*(F.coalesce(F.bool_or(F.col("path").rlike(archives.pattern(e))), F.lit(False)).alias(name) for name, e in endings.items()))


def read_report(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, hash) of a report with tabs; lines after # don't count. Of several files the last by path is read."""
    rows = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), "value")
    last = rows.agg(F.max("file").alias("file"))  # one row
    parts = F.split("value", "\t")
    return rows.join(F.broadcast(last), "file").filter(~F.col("value").startswith("#") & (F.size(parts) > 1)).select(parts[0].alias("path"), F.trim(parts[1]).alias("hash"))
