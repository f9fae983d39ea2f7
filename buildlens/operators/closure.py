"""Graph operators over the commands of a build: a frontier loop on tables of commands and keys."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import saved, shared_folder
from ..functions.text import packed


def scope(df: DataFrame) -> list[str]:
    """The columns that keep projects apart: of a table with several projects ``project``, else none."""
    return [c for c in ("project",) if c in df.columns]


def by_hash_or_path(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that match ``right``, in their project, by hash or by path: two equi semi-joins, as one join with OR would be a nested loop."""
    by = scope(left)
    h = left.join(right.select(*by, "hash").filter("hash IS NOT NULL").distinct(), [*by, "hash"], "left_semi")
    p = left.join(right.select(*by, "path_norm").filter("path_norm IS NOT NULL").distinct(), [*by, "path_norm"], "left_semi")
    return h.unionByName(p)


def command_keys(edges: DataFrame) -> DataFrame:
    """(cmd_idx, key): hashes and normalised paths of the edges, as keys that can't meet each other."""
    keys = F.array(F.concat(F.lit("h"), "hash"), F.concat(F.lit("p"), "path_norm"))
    return edges.select(*scope(edges), "cmd_idx", F.explode(keys).alias("key")).filter("key IS NOT NULL").distinct()


def packed_keys(edges: DataFrame) -> DataFrame:
    """(cmd_idx, key): as ``command_keys``, repeated ones too, in bytes: hashes of hex digits take half of their length."""
    key = F.explode(F.array(packed(F.col("hash")), F.concat(F.lit(bytearray(b"p")), F.col("path_norm").cast("binary"))))
    return edges.select(*scope(edges), "cmd_idx", key.alias("key")).filter("key IS NOT NULL")


def good_commands(dep: DataFrame, out: DataFrame, bin_: DataFrame) -> DataFrame:
    """cmd_idx of commands that lead to the distribution: those with an output in it, and producers of their inputs, to the fixpoint.

    Keys that nobody writes lead nowhere, so reads are joined with the writers of their keys once, and only what meets
    is written: the command that reads (null: the distribution) and the one that writes, or, where several
    commands write a key, the key, so that there are never pairs of its readers and writers. A round scans this table.
    """
    spark, by = dep.sparkSession, scope(dep)
    made = packed_keys(out)
    writers = made.groupBy(*by, "key").agg(F.min("cmd_idx").alias("maker"), F.max("cmd_idx").alias("last"))
    reads = packed_keys(dep.filter("cmd_idx IS NOT NULL")).union(packed_keys(bin_.withColumn("cmd_idx", F.lit(None).cast("long"))))
    single = F.col("maker") == F.col("last")
    links = saved(reads.join(writers, [*by, "key"]).select(*by, "cmd_idx", F.when(single, F.col("maker")).alias("maker"), F.when(~single, F.col("key")).alias("key")).filter("maker IS NULL OR cmd_idx IS NULL OR cmd_idx <> maker"))
    shared = links.filter("key IS NOT NULL").select(*by, "key")
    several = None if shared.isEmpty() else saved(made.join(shared.distinct(), [*by, "key"], "left_semi").distinct())

    def makers(used: DataFrame) -> DataFrame:
        found = used.filter("maker IS NOT NULL").select(*by, F.col("maker").alias("cmd_idx"))
        if several is not None:
            keys = used.filter("key IS NOT NULL").select(*by, "key").distinct()
            found = found.union(several.join(keys, [*by, "key"], "left_semi").select(*by, "cmd_idx"))
        return found.distinct()

    folder = f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    frontier = makers(links.filter("cmd_idx IS NULL"))
    kind = frontier.schema
    turn = 0
    while True:
        frontier.write.parquet(f"{folder}/round={turn}")
        new = spark.read.schema(kind).parquet(f"{folder}/round={turn}")
        good = spark.read.schema(kind).parquet(*(f"{folder}/round={k}" for k in range(turn + 1)))
        if new.isEmpty():
            return good
        frontier = makers(links.join(new, [*by, "cmd_idx"], "left_semi")).join(good, [*by, "cmd_idx"], "left_anti")
        turn += 1
