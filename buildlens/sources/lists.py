"""Readers of text lists: binaries found by the profiler, and the dictionary of tools by role."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.paths import without_dir
from .trace import stripped

# Kinds of binaries that a list may name.
KINDS = ("ELF", "PE32", "MSDOS", "BINARY_EXT")


def _projects(project: Column | None) -> list[Column]:
    return [] if project is None else [project.alias("project")]


def read_binary_list(spark: SparkSession, paths: list[str], project: Column | None = None) -> DataFrame:
    """(type, path) of all lists, and ``project`` if it is given as a column of the file's metadata: the first word and the rest of a line, blanks in it kept; lines of other types are left out."""
    line = spark.read.text(paths).select(*_projects(project), F.regexp_extract("value", r"^\s*(\S+)\s+(.*?)\s*$", 1).alias("type"), F.regexp_extract("value", r"^\s*(\S+)\s+(.*?)\s*$", 2).alias("path"))
    return line.filter(F.col("type").isin(*KINDS) & (F.col("path") != ""))


def read_tools(spark: SparkSession, path: str) -> DataFrame:
    """(role, tool) of a tool dictionary: a YAML mapping of lists below the key ``utilities``, block or inline; comments don't count.

    The file is a small configuration, whose lines are parsed in their order by the driver.
    """
    text = spark.read.text(path, wholetext=True).first()
    rows, role = [], None
    for line in (text.value if text else "").splitlines():
        bare = re.sub(r"(^|\s)#.*$", "", line).rstrip()
        if head := re.match(r"^\s*([A-Za-z_]+):\s*(?:\[(.*)\])?$", bare):
            role = None if head[1] == "utilities" else head[1]
            rows += [(role, tool.strip().strip("'\"")) for tool in (head[2] or "").split(",") if role and tool.strip()]
        elif role and (item := re.match(r"^\s*-\s+(.+)$", bare)):
            rows.append((role, item[1].strip().strip("'\"")))
    return spark.createDataFrame(rows, "role string, tool string").distinct()


def read_rules(spark: SparkSession, path: str) -> rules.Rules:
    """Rules of a JSON file, a small configuration: an object of lists that take the place of the defaults', or of objects with ``add`` and ``remove``; see ``rules.of``. An empty file gives the defaults."""
    text = spark.read.text(path, wholetext=True).first()
    return rules.parsed(text.value if text else "")


def read_path_hashes(spark: SparkSession, paths: list[str], project: Column | None = None) -> DataFrame:
    """(path, hash) of a distribution's file list: a JSON list, or an object with the list under ``signatures`` or else ``files``; rows without either are left out.

    Of a path that occurs again, also with slashes before it, the last hash counts. With ``project``, a column of the file's metadata, paths are kept apart by it.
    """
    by = [] if project is None else ["project"]
    entry = "array<struct<path:string,hash:string>>"
    options = {"allowUnquotedControlChars": "true"}
    text = F.make_valid_utf8("value")
    rows = spark.read.text(paths, wholetext=True).select(*_projects(project), F.col("_metadata.file_path").alias("file"), F.ltrim(text).alias("text"))
    whole = F.from_json("text", f"struct<signatures:{entry},files:{entry}>", options)
    listed = F.when(F.col("text").startswith("["), F.from_json("text", entry, options)).otherwise(F.coalesce(whole.signatures, whole.files))
    found = rows.select(*by, "file", F.posexplode(listed).alias("pos", "e")).select(*by, "file", "pos", stripped(F.col("e.path")).alias("path"), stripped(F.col("e.hash")).alias("hash"))
    found = found.filter("path <> '' AND hash <> ''")
    both = found.select(*by, F.explode(F.array_distinct(F.array("path", F.ltrim("path", F.lit("/"))))).alias("path"), "hash", F.struct("file", "pos").alias("at"))
    return both.groupBy(*by, "path").agg(F.max_by("hash", "at").alias("hash"))


def binary_entries(listed: DataFrame, hashes: DataFrame, project: str | None = None) -> DataFrame:
    """(path, hash) of listed binaries whose hash is known, for pass 4.

    ``listed``: (type, path) relative to the project; ``hashes``: see ``read_path_hashes``. The first of four
    ways to write the path that has a hash counts: below the project without the suffix _dir of unpacked
    archives, below the project, as it is, without slashes before it. A path that is listed twice gives two rows. Without a name the project is a column of both tables.
    """
    by = [] if project else ["project"]
    below = F.concat(F.lit(project) if project else F.col("project"), F.lit("/"), "path")
    ways = F.array(without_dir(below), below, F.col("path"), F.ltrim("path", F.lit("/")))
    tried = listed.select(*by, "path").distinct().select(*by, "path", F.posexplode(ways).alias("prio", "way"))
    known = tried.join(hashes.select(*by, F.col("path").alias("way"), "hash"), [*by, "way"]).groupBy(*by, "path").agg(F.min_by("hash", "prio").alias("hash"))
    return listed.join(known, [*by, "path"]).select(*by, without_dir(below).alias("path"), "hash")
