"""Searches over a build's commands: by tool, by package, by file; samples and counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import basename, stem
from ..functions.text import shown_command
from ..operators.matching import holding
from ..sources.trace import entries, stripped

#: Stands for a command without words.
NO_COMMAND = "__no_command__"
#: Outputs, inputs and words that a match shows.
SHOWN_OUTPUTS, SHOWN_INPUTS, SHOWN_WORDS = 5, 3, 6
SECTIONS = ("output", "dependencies", "modified")


def tool_of(argv: Column) -> Column:
    """Name of the program; null without words."""
    return basename(F.try_element_at(argv, F.lit(1)))


def is_tool(tool: Column, terms: list[str]) -> Column:
    """Whether the tool is one of the terms, or one of them stands in its lower-case name."""
    return F.coalesce(F.lit(False) | tool.isin(*terms) | reduce(Column.__or__, (F.lower(tool).contains(t) for t in terms), F.lit(False)), F.lit(False))


def tool_matches(commands: DataFrame, terms: list[str]) -> DataFrame:
    """(cmd_idx, file, tool, command, outputs, inputs) of commands of these tools, see ``is_tool``; only the first words and files."""
    paths = lambda c: F.coalesce(F.filter(F.transform(entries(F.col(c)), lambda e: e.path), lambda p: p.isNotNull()), F.array().cast("array<string>"))
    tool = tool_of(F.col("command"))
    return commands.filter(is_tool(tool, terms)).select(
        "cmd_idx", basename(F.col("file")).alias("file"), tool.alias("tool"), F.slice("command", 1, SHOWN_WORDS).alias("command"),
        F.slice(paths("output"), 1, SHOWN_OUTPUTS).alias("outputs"), F.slice(paths("dependencies"), 1, SHOWN_INPUTS).alias("inputs"),
    )


def tool_counts(cmd: DataFrame) -> DataFrame:
    """(tool, commands); commands without a tool under ``NO_COMMAND``."""
    return cmd.groupBy(F.coalesce("tool", F.lit(NO_COMMAND)).alias("tool")).agg(F.count("*").alias("commands"))


def tool_totals(cmd: DataFrame) -> DataFrame:
    """One row: commands, those without words, distinct tools (no words count as one)."""
    return tool_counts(cmd).agg(
        F.coalesce(F.sum("commands"), F.lit(0)).alias("commands"), F.coalesce(F.sum(F.when(F.col("tool") == NO_COMMAND, F.col("commands"))), F.lit(0)).alias("no_command"),
        F.count("*").alias("tools"),
    )


def tool_samples(cmd: DataFrame, n: int = 5, tools: list[str] | None = None) -> DataFrame:
    """The first ``n`` commands of each tool (or of these tools), by cmd_idx."""
    named = cmd.withColumn("tool", F.coalesce("tool", F.lit(NO_COMMAND)))
    named = named if tools is None else named.filter(F.col("tool").isin(*tools))
    by = Window.partitionBy("tool").orderBy("cmd_idx")
    return named.withColumn("k", F.row_number().over(by)).filter(F.col("k") <= n).drop("k")


def package_matches(cmd: DataFrame, dep: DataFrame, out: DataFrame, patterns: list[str]) -> DataFrame:
    """(package, role, tool, cmd_idx, path, hash): inputs and outputs whose path holds a pattern, whatever the case; a row for each pattern, of which there may be many."""
    both = dep.select(F.lit("INPUT").alias("role"), "cmd_idx", "path", "hash").unionByName(out.select(F.lit("OUTPUT").alias("role"), "cmd_idx", "path", "hash"))
    found = holding(both, "path", patterns, "package")
    return found.join(cmd.select("cmd_idx", "tool"), "cmd_idx", "left").select("package", "role", "tool", "cmd_idx", "path", "hash")


def package_roles(matches: DataFrame) -> DataFrame:
    """(package, role, tool, path, matches): how often each file was met."""
    return matches.groupBy("package", "role", "tool", "path").agg(F.count("*").alias("matches"))


# Likely classes by how a file was met.
LIKELY = {"written": "external_prebuilt or untraced_from_src", "read": "external_prebuilt", "both": "external_built or compiled_from_src"}


def likely_origin(matches: DataFrame, *by: str) -> DataFrame:
    """(by, likely, matches): the classes of pass 4 that are likely for a file that was read and written, only written, or only read."""
    has = lambda r: F.bool_or(F.col("role") == r)
    likely = F.when(has("OUTPUT") & has("INPUT"), LIKELY["both"]).when(has("OUTPUT"), LIKELY["written"]).otherwise(LIKELY["read"])
    return matches.groupBy(*by).agg(likely.alias("likely"), F.count("*").alias("matches"))


def find_file(commands: DataFrame, hash_: str | None = None, name: str | None = None) -> DataFrame:
    """(cmd_idx, id, tool, shown, section, path, hash, pre_hash) of files with this hash, now or before a change, or with a like name.

    Names are alike without regard to case and the endings of Python sources and byte code.
    """
    kind = "struct<path:string,hash:string,pre_hash:string>"
    found = []
    for section in SECTIONS:
        raw = F.col(section)
        mapped = F.transform(F.map_entries(F.from_json(raw, "map<string,string>")), lambda e: F.struct(e.key.alias("path"), e.value.alias("hash"), F.lit(None).cast("string").alias("pre_hash")))
        listed = F.transform(F.filter(F.from_json(raw, "array<string>"), lambda e: e.startswith("{")), lambda e: F.from_json(e, kind))
        files = F.when(F.ltrim(raw).startswith("{"), mapped).when(F.ltrim(raw).startswith("["), listed)
        found.append(commands.select("cmd_idx", "id", "command", F.lit(section).alias("section"), F.explode(files).alias("f")))
    rows = reduce(DataFrame.unionByName, found)
    clean = lambda c: stripped(F.coalesce(F.col(c), F.lit("")))
    rows = rows.select(
        "cmd_idx", "id", F.coalesce(tool_of(F.col("command")), F.lit("?")).alias("tool"), shown_command(F.coalesce("command", F.array().cast("array<string>"))).alias("shown"),
        "section", F.coalesce("f.path", F.lit("")).alias("path"), clean("f.hash").alias("hash"), clean("f.pre_hash").alias("pre_hash"),
    )
    hit = F.lit(False)
    if hash_:
        hit = hit | (F.col("hash") == hash_) | (F.col("pre_hash") == hash_)
    if name:
        hit = hit | (stem(F.col("path")) == stem(F.lit(name)))
    return rows.filter(hit)


def by_command(matches: DataFrame) -> DataFrame:
    """(cmd_idx, tool, shown, files): matches of one command together, by section and path."""
    return matches.groupBy("cmd_idx", "tool", "shown").agg(F.array_sort(F.collect_list(F.struct("section", "path", "hash"))).alias("files"))


def similar_files(wanted: DataFrame, shipped: DataFrame) -> DataFrame:
    """(name, path, hash): shipped files whose names are like the wanted ones, see ``find_file``."""
    names = wanted.select("name", stem(F.col("name")).alias("stem")).distinct()
    return shipped.select("path", "hash", stem(F.col("path")).alias("stem")).join(names, "stem").select("name", "path", "hash")
