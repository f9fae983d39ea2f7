"""Provenance passes over sources, commands and the distribution, as joins and CASE columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import saved
from ..functions import paths as P
from ..functions.rules import COMPILERS, INTERPRETERS, LINKERS, Roles, Rules  # noqa: F401  names of tools for those who read passes
from ..functions.text import packed
from ..operators.closure import by_hash_or_path, good_commands, scope

def roles_of(tools: DataFrame) -> Roles:
    """Roles from a dictionary (role, tool), a small configuration; a tool may have several."""
    rows = sorted((r.role, r.tool) for r in tools.select("role", "tool").distinct().collect())
    return Roles(*(tuple(t for r, t in rows if r == role) for role in ("compilers", "linkers", "interpreters")))


@dataclass
class Build:
    """src, bin: (ord, path, path_norm, hash, chain); cmd: (cmd_idx, tool, argv); dep, out: (cmd_idx, pos, path, path_norm, hash).

    With a column ``project`` in all of them they hold many projects: every pass then runs over all at once,
    results have the column too, and nothing of one project meets another's files or commands. ``rules`` say what a file
    is by its path; ``roles``, where given, stand for those of the rules.
    """

    src: DataFrame
    bin: DataFrame
    cmd: DataFrame
    dep: DataFrame
    out: DataFrame
    roles: Roles | None = None
    rules: Rules = Rules()

    def __post_init__(self) -> None:
        self.roles = self.roles or self.rules.roles

    @property
    def by(self) -> list[str]:
        """What keeps projects apart, see ``scope``."""
        return scope(self.cmd)


def with_tool(tools: tuple[str, ...], cmd: DataFrame) -> DataFrame:
    """cmd_idx of commands of these tools."""
    return cmd.filter(F.col("tool").isin(*tools) if tools else F.lit(False)).select(*scope(cmd), "cmd_idx")


def makers(b: Build) -> DataFrame:
    """cmd_idx of compilers and linkers; of all commands where the dictionary names neither."""
    return with_tool(b.roles.makers, b.cmd) if b.roles.makers else b.cmd.select(*b.by, "cmd_idx")


def pool(b: Build) -> DataFrame:
    """Distinct hashes of the trace."""
    return b.dep.select(*b.by, "hash").union(b.out.select(*b.by, "hash")).filter("hash IS NOT NULL").distinct()


def traced_keys(b: Build) -> DataFrame:
    """``pool`` as bytes, half as many for hex digits."""
    hashes = b.dep.select(*b.by, "hash").union(b.out.select(*b.by, "hash"))
    return hashes.select(*b.by, F.explode(F.array(packed(F.col("hash")))).alias("key")).filter("key IS NOT NULL").distinct()


def pass1(b: Build) -> DataFrame:
    """(ord, path, hash, parent_hash, category) of source files: direct, parent, untraced_in_distrib or redundant.

    The keys of sources and their archives are written first: where they are few, Spark broadcasts them and shuffles no other key of the trace.
    """
    by, rows = b.by, b.src.filter(b.rules.is_source(F.col("path"))).withColumn("key", packed(F.col("hash")))
    asked = rows.select(*by, F.explode(F.array_append(F.coalesce("chain", F.array().cast("array<string>")), F.col("hash"))).alias("link"))
    asked = saved(asked.select(*by, packed(F.col("link")).alias("key")).filter("key IS NOT NULL").distinct())
    traced = traced_keys(b).join(asked, [*by, "key"], "left_semi").withColumn("direct", F.lit(True))
    first = (
        rows.select(*by, "ord", F.posexplode("chain").alias("pos", "link")).withColumn("key", packed(F.col("link"))).join(traced.select(*by, "key"), [*by, "key"])
        .groupBy(*by, "ord").agg(F.min_by("link", "pos").alias("parent_hash"))
    )
    shipped = b.bin.select(*by, "hash").filter("hash IS NOT NULL").distinct().withColumn("shipped", F.lit(True))
    found = rows.join(traced, [*by, "key"], "left").join(first, [*by, "ord"], "left").join(shipped, [*by, "hash"], "left")
    category = F.when(F.col("direct"), "direct").when(F.col("parent_hash").isNotNull(), "parent").when(F.col("shipped"), "untraced_in_distrib").otherwise("redundant")
    return found.select(*by, "ord", "path", "path_norm", "hash", F.when(F.col("direct").isNull(), F.col("parent_hash")).alias("parent_hash"), category.alias("category"))


def good(b: Build) -> DataFrame:
    """cmd_idx of good commands; without compilers those with an output in the distribution."""
    return good_commands(b.dep, b.out, b.bin) if b.roles.compilers else by_hash_or_path(b.out, b.bin).select(*b.by, "cmd_idx").distinct()


def compiler_inputs(b: Build, good_: DataFrame) -> DataFrame:
    """Distinct keys, hashes and paths alike, of what good compiler and linker commands read.

    The commands are written first: where they are few, Spark broadcasts them and shuffles only what they read.
    """
    cmds = saved(with_tool(b.roles.makers, b.cmd).join(good_, [*b.by, "cmd_idx"], "left_semi"))
    deps = b.dep.join(cmds, [*b.by, "cmd_idx"], "left_semi")
    return deps.select(*b.by, F.explode(F.array("hash", "path_norm")).alias("key")).filter("key IS NOT NULL").distinct()


def pass2(b: Build, first: DataFrame, good_: DataFrame) -> DataFrame:
    """Rows of pass 1 after the compiler check: compiled sources that no good command read become not_compiled; without compilers none does."""
    keys = compiler_inputs(b, good_).withColumn("read", F.lit(True))
    checked = (
        first.join(keys.withColumnRenamed("key", "hash").withColumnRenamed("read", "by_hash"), [*b.by, "hash"], "left")
        .join(keys.withColumnRenamed("key", "path_norm").withColumnRenamed("read", "by_path"), [*b.by, "path_norm"], "left")
    )
    unread = F.lit(bool(b.roles.compilers)) & F.col("category").isin("direct", "parent") & b.rules.is_compiled(F.col("path")) & F.col("by_hash").isNull() & F.col("by_path").isNull()
    return checked.select(*b.by, "ord", "path", "path_norm", "hash", "parent_hash", F.when(unread, F.col("category")).alias("source"), F.when(unread, "not_compiled").otherwise(F.col("category")).alias("category"))


def interpreter_files(b: Build, edges: DataFrame) -> DataFrame:
    """First (cmd_idx, pos) for each interpreted file that interpreter commands read or wrote, by hash or else path."""
    rows = edges.join(with_tool(b.roles.interpreters, b.cmd), [*b.by, "cmd_idx"], "left_semi").filter(b.rules.is_interpreted(F.col("path")))
    by = Window.partitionBy(*b.by, F.coalesce("hash", "path_norm")).orderBy("cmd_idx", "pos")
    return rows.withColumn("k", F.row_number().over(by)).filter("k = 1").drop("k")


def pass3(b: Build, good_: DataFrame) -> DataFrame:
    """(ord, path, hash, category) of interpreted files: copied, compiled_unused, compiled_used, executed or not_used, the first that holds."""
    reads, writes = interpreter_files(b, b.dep), interpreter_files(b, b.out)
    led = reads.join(good_.withColumn("good", F.lit(True)), [*b.by, "cmd_idx"], "left")
    rows = b.src.filter(b.rules.is_interpreted(F.col("path")) & F.lit(bool(b.roles.interpreters)))

    def flag(table: DataFrame, key: str, label: str, *value: F.Column) -> None:
        nonlocal rows
        keyed = table.filter(F.col(key).isNotNull()).groupBy(*b.by, key).agg(*(value or (F.lit(True).alias(label),)))
        rows = rows.join(keyed, [*b.by, key], "left")

    flag(b.bin, "hash", "bin_hash")
    flag(b.bin, "path_norm", "bin_path")
    flag(writes, "hash", "out_hash")
    flag(writes, "path_norm", "out_path")
    flag(led, "hash", "", F.lit(True).alias("in_hash"), F.max(F.coalesce("good", F.lit(False))).alias("good_hash"))
    flag(led, "path_norm", "", F.lit(True).alias("in_path"), F.max(F.coalesce("good", F.lit(False))).alias("good_path"))
    leads = F.when(F.col("in_hash"), F.col("good_hash")).otherwise(F.col("good_path"))
    category = (
        F.when(F.col("bin_hash") | F.col("bin_path"), "copied").when(F.col("out_hash") | F.col("out_path"), "compiled_unused").when(leads, "compiled_used")
        .when(b.rules.is_python(F.col("path")) & (F.col("in_hash") | F.col("in_path")), "executed").otherwise("not_used")
    )
    return rows.select(*b.by, "ord", "path", "hash", category.alias("category"))


def executed_commands(b: Build, third: DataFrame) -> DataFrame:
    """(ord, path, hash, commands) of executed files: the distinct commands, in their order, that read them.

    Of each file that interpreters read only the first command counts. A file with a hash is looked up
    by it alone, so one that was met by its path only has no commands. ``cmd`` needs argv.
    """
    by = b.by
    reads = interpreter_files(b, b.dep).join(b.cmd.select(*by, "cmd_idx", F.array_join("argv", " ").alias("line")), [*by, "cmd_idx"])
    rows = third.filter("category = 'executed'").select(*by, "ord", "path", "hash", F.when(F.col("hash").isNull(), P.normpath(F.col("path"))).alias("path_norm"))
    by_hash = rows.join(reads.select(*by, "hash", "cmd_idx", "line"), [*by, "hash"]).select(*by, "ord", "cmd_idx", "line")
    by_path = rows.filter("hash IS NULL").join(reads.select(*by, "path_norm", "cmd_idx", "line"), [*by, "path_norm"]).select(*by, "ord", "cmd_idx", "line")
    lines = by_hash.union(by_path).filter("line <> ''").groupBy(*by, "ord").agg(F.array_sort(F.collect_set(F.struct("cmd_idx", "line"))).alias("c"))
    commands = F.coalesce(F.array_distinct("c.line"), F.array().cast("array<string>"))
    return rows.join(lines, [*by, "ord"], "left").select(*by, "ord", "path", "hash", commands.alias("commands"))


def pass3_outputs(b: Build, good_: DataFrame, third: DataFrame) -> DataFrame:
    """(path, hash, category) of interpreted files that interpreter commands wrote and pass 3 has not recorded by path as compiled.

    The first of a path counts; one without a path doesn't. compiled_used if it is in the distribution
    by hash or path, or if its first reader, by hash or else by path, is a good command; else compiled_unused.
    """
    reads, writes = interpreter_files(b, b.dep), interpreter_files(b, b.out)
    by = b.by
    recorded = third.filter("category IN ('compiled_used', 'compiled_unused')").select(*by, P.normpath(F.col("path")).alias("path_norm")).distinct()
    first = writes.filter("path_norm IS NOT NULL").groupBy(*by, "path_norm").agg(F.min_by(F.struct("path", "hash"), F.struct("cmd_idx", "pos")).alias("f"))
    rows = first.join(recorded, [*by, "path_norm"], "left_anti").select(*by, "path_norm", "f.*")
    led = reads.join(good_.withColumn("good", F.lit(True)), [*by, "cmd_idx"], "left").withColumn("good", F.coalesce("good", F.lit(False)))
    for key in ("hash", "path_norm"):
        rows = rows.join(led.filter(F.col(key).isNotNull()).groupBy(*by, key).agg(F.max("good").alias(f"good_{key}")), [*by, key], "left")
        rows = rows.join(b.bin.select(*by, key).filter(F.col(key).isNotNull()).distinct().withColumn(f"bin_{key}", F.lit(True)), [*by, key], "left")
    used = F.coalesce("bin_hash", "bin_path_norm", "good_hash", "good_path_norm", F.lit(False))
    return rows.select(*by, "path", "hash", F.when(used, "compiled_used").otherwise("compiled_unused").alias("category"))


def external_dependencies(b: Build) -> DataFrame:
    """(bin_path, bin_hash, dep_path, dep_hash) of suspicious inputs of the compiler commands that made distribution files: not system, source, resource, allowed, or made by the build."""
    by = b.by
    made = b.out.join(b.bin.select(*by, F.col("path").alias("bin_path"), "hash"), [*by, "hash"]).select(*by, "cmd_idx", "bin_path", F.col("hash").alias("bin_hash")).join(makers(b), [*by, "cmd_idx"], "left_semi")
    p = F.col("path")
    deps = b.dep.filter(F.col("hash").isNotNull() & ~b.rules.is_system(p) & ~b.rules.is_resource(p) & ~b.rules.is_allowed(p))
    deps = deps.join(b.src.select(*by, "hash").distinct(), [*by, "hash"], "left_anti").join(b.out.select(*by, "hash").filter("hash IS NOT NULL").distinct(), [*by, "hash"], "left_anti")
    return made.join(deps.select(*by, "cmd_idx", F.col("path").alias("dep_path"), F.col("hash").alias("dep_hash")), [*by, "cmd_idx"]).select(*by, "bin_path", "bin_hash", "dep_path", "dep_hash").distinct()


def with_aliases(deps: DataFrame, *by: str) -> DataFrame:
    """(by, dep_path, dep_hash, aliases): inputs with those that are versions of one shared library in a folder as one row.

    Such a row, from two inputs on, has the library's path without version, the hash of the shortest path and all paths, sorted. Other inputs stay as they are.
    """
    path = F.col("dep_path")
    library = F.coalesce(path.rlike(r"\.so(\.\d+)*$"), F.lit(False))
    order = F.struct(F.length("dep_path").alias("n"), "dep_path", "dep_hash")
    groups = deps.filter(library).groupBy(*by, P.so_base(path).alias("base")).agg(F.min(order).alias("first"), F.count("*").alias("many"), F.array_sort(F.collect_set("dep_path")).alias("all"))
    several = F.col("many") > 1
    merged = groups.select(*by, F.when(several, F.col("base")).otherwise(F.col("first.dep_path")).alias("dep_path"), F.col("first.dep_hash").alias("dep_hash"), F.when(several, F.col("all")).alias("aliases"))
    return deps.filter(~library).select(*by, "dep_path", "dep_hash", F.lit(None).cast("array<string>").alias("aliases")).union(merged)


def merged_aliases(deps: DataFrame) -> DataFrame:
    """External dependencies with versions of one shared library as one row, aliases joined by commas; see ``with_aliases``."""
    return with_aliases(deps, *scope(deps), "bin_path", "bin_hash").withColumn("aliases", F.array_join("aliases", ","))


def summary(category_rows: DataFrame) -> DataFrame:
    """Files and percent by category, of all rows; of many projects see ``summaries.rollup``."""
    counts = category_rows.groupBy("category").agg(F.count("*").alias("files"))
    total = category_rows.agg(F.count("*").alias("total"))  # one row
    return counts.join(F.broadcast(total)).select("category", "files", F.round(100.0 * F.col("files") / F.col("total"), 4).alias("percent"))


def shipped_by_path_or_hash(b: Build) -> DataFrame:
    return by_hash_or_path(b.out, b.bin).distinct()
