"""Signatures of unpacked files: the archives that a file came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parent_chain(files: DataFrame) -> DataFrame:
    """(path, hash, virtual_path, parents_hash, parents_chain) of files below one folder.

    An archive ``a`` is unpacked to the folder ``a_dir``. The chain has the hashes of the archives
    around a file, nearest first; one without a file or hash is left out. parents_hash is the first,
    or "0". Chains are made once a folder, however many files it has. The virtual path has no _dir.
    """
    at = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    rows = files.select("path", "hash", at.alias("folder"))
    folders = rows.filter("folder <> ''").select("folder").distinct()
    parts = F.split("folder", "/")
    above = folders.select("folder", F.explode(F.sequence(F.lit(1), F.size(parts))).alias("depth")).withColumn("around", F.array_join(F.slice(parts, 1, F.col("depth")), "/"))
    above = above.filter(F.col("around").endswith("_dir")).select("folder", "depth", F.regexp_replace("around", "_dir$", "").alias("archive"))
    archives = files.filter("hash <> ''").groupBy(F.col("path").alias("archive")).agg(F.min("hash").alias("parent"))
    found = above.join(archives, "archive").groupBy("folder").agg(F.array_sort(F.collect_list(F.struct((-F.col("depth")).alias("near"), "parent"))).alias("c"))
    chain = F.coalesce("c.parent", F.array().cast("array<string>"))
    out = rows.join(found, "folder", "left").withColumn("parents_chain", chain)
    return out.select("path", "hash", F.replace("path", F.lit("_dir/"), F.lit("/")).alias("virtual_path"), F.coalesce(F.get("parents_chain", F.lit(0)), F.lit("0")).alias("parents_hash"), "parents_chain")
