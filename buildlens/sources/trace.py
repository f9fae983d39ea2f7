"""Readers of build traces and file signatures (JSON)."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..cluster import saved
from ..functions.paths import basename, normpath
from .ranges import elements

COMMAND = "id bigint, command array<string>, dependencies string, output string, modified string"
#: The array of a trace, for readers of whole small files.
COMMANDS = f"component_commands array<struct<{COMMAND}>>"
SIGNATURE = "path string, hash string, archive int, parents_hash string, parents_chain array<string>"
ENTRY = "struct<path:string,hash:string>"


def broken_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, broken) of trace files that can't be parsed, and why or where."""
    return elements(spark, paths, "component_commands", COMMAND)[1]


def _whole(found: DataFrame, broken: DataFrame, what: str, strict: bool) -> DataFrame:
    if strict and (first := broken.orderBy("file").first()):
        raise PySparkException(f"unreadable {what}: {first.file}: {first.broken}")
    return found


def stripped(s: Column) -> Column:
    """Without white space at either end."""
    return F.trim(s, F.lit(" \t\n\r\x0b\x0c"))


def entries(raw: Column) -> Column:
    """Files of a dependency field: an object path to hash, a list of {path, hash}, or a list of paths; blanks are null."""
    mapped = F.transform(F.map_entries(F.from_json(raw, "map<string,string>")), lambda e: F.struct(e.key.alias("path"), e.value.alias("hash")))
    listed = F.transform(
        F.from_json(raw, "array<string>"),
        lambda e: F.when(e.startswith("{"), F.from_json(e, ENTRY)).otherwise(F.struct(e.alias("path"), F.lit(None).cast("string").alias("hash"))),
    )
    found = F.when(F.ltrim(raw).startswith("{"), mapped).when(F.ltrim(raw).startswith("["), listed)
    known = lambda c: F.when(stripped(c) != "", stripped(c))
    return F.transform(found, lambda e: F.struct(known(e.path).alias("path"), known(e.hash).alias("hash")))


def read_commands(spark: SparkSession, paths: list[str], strict: bool = True) -> DataFrame:
    """(cmd_idx, file, id, command, dependencies, output, modified): commands of all files, by file name, then path, and place in it.

    Files are read by ranges, see ``ranges``. One that can't be parsed is an error with its name; unless ``strict`` it is left out, see ``broken_files``.
    """
    rows = _whole(*elements(spark, paths, "component_commands", COMMAND), "trace", strict)
    sizes = rows.groupBy("file").agg(F.count("*").alias("n"))
    return rows.join(placed(sizes), "file").select((F.col("before") + F.col("pos")).alias("cmd_idx"), "file", "c.*")


def placed(sizes: DataFrame) -> DataFrame:
    """(file, before): the sum of n of files before each one, by name and path. No task has more than a range of files; sums of ranges meet on the driver."""
    ranges = sizes.withColumn("name", basename(F.col("file"))).repartitionByRange("name", "file").withColumn("part", F.spark_partition_id())
    ranges = saved(ranges)
    before, start = [], 0
    for r in ranges.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # a row a partition
        before.append((r.part, start))
        start += r.n
    starts = F.create_map(*(F.lit(x) for pair in before for x in pair)) if before else F.create_map(F.lit(0), F.lit(0))
    within = Window.partitionBy("part").orderBy("name", "file")
    return ranges.select("file", (F.try_element_at(starts, F.col("part")) + F.sum("n").over(within) - F.col("n")).alias("before"))


def edges(commands: DataFrame, column: str) -> DataFrame:
    """(cmd_idx, pos, path, path_norm, hash) of a file field of all commands."""
    by = [c for c in ("project",) if c in commands.columns]
    rows = commands.select(*by, "cmd_idx", F.posexplode(entries(F.col(column))).alias("pos", "f"))
    return rows.select(*by, "cmd_idx", "pos", F.col("f.path").alias("path"), normpath(F.col("f.path")).alias("path_norm"), F.col("f.hash").alias("hash"))


def read_signatures(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(ord, file, path, path_norm, hash, archive, parents_hash, chain) of all signature files in their order; a blank hash is null. A file that can't be parsed is an error."""
    rows = _whole(*elements(spark, paths, "signatures", SIGNATURE), "signatures", True)
    sizes = rows.groupBy("file").agg(F.count("*").alias("n"))
    rows = rows.join(placed(sizes), "file").select((F.col("before") + F.col("pos")).alias("ord"), "file", "c.*")
    bare = stripped(F.col("hash"))
    return rows.select("ord", "file", "path", normpath(F.col("path")).alias("path_norm"), F.when(bare != "", bare).alias("hash"), "archive", "parents_hash", F.col("parents_chain").alias("chain"))


def shipped_sets(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Distinct hashes and distinct normalised paths of a distribution's signatures, blanks left out; both empty where no file is given."""
    rows = read_signatures(spark, paths) if paths else spark.createDataFrame([], "hash string, path_norm string, path string")
    return rows.select("hash").filter("hash IS NOT NULL").distinct(), rows.filter(stripped(F.col("path")) != "").select("path_norm").distinct()
