"""Where packages came from: an index of packages that commands wrote, and the origin of files inside packages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import saved
from ..functions.paths import basename
from ..operators.closure import scope
from .passes import Build

# Readable commands of package tools.
READABLE = {
    "apt": "apt download", "apt-get": "apt-get install", "dpkg": "dpkg -i", "pip": "pip install", "pip2": "pip install", "pip3": "pip install", "pip3.5": "pip install", "pip3.6": "pip install",
    "pip3.7": "pip install", "pip3.8": "pip install", "pip3.9": "pip install", "pip3.10": "pip install", "pip3.11": "pip install", "npm": "npm install", "yarn": "yarn add",
}


def package_index(b: Build) -> DataFrame:
    """(container, package_type, source, command, cmd_idx, pos): deb, rpm and whl files that commands wrote, the first of a name.

    The source is the command's first input of the same name whatever its case, else its first input
    whose path holds the name up to the first underscore, else the file itself. The packages' first commands are
    written, so that where they are few Spark broadcasts them and places the inputs of these commands only.
    """
    name = F.lower(basename(F.col("path")))
    kind = F.when(name.rlike(r"\.(deb|rpm)$"), "deb").when(name.endswith(".whl"), "pip")
    by = b.by
    made = b.out.filter(kind.isNotNull()).select(*by, "cmd_idx", "pos", "path", basename(F.col("path")).alias("container"), kind.alias("package_type"))
    first = saved(made.join(b.cmd.filter("tool IS NOT NULL").select(*by, "cmd_idx", "tool"), [*by, "cmd_idx"]).groupBy(*by, "container").agg(
        F.min_by(F.struct("cmd_idx", "pos", "path", "package_type", "tool"), F.struct("cmd_idx", "pos")).alias("f")).select(*by, "container", "f.*"))
    deps = b.dep.filter("path IS NOT NULL").join(first.select(*by, "cmd_idx").distinct(), [*by, "cmd_idx"], "left_semi").select(*by, "cmd_idx", F.col("pos").alias("dep_pos"), F.col("path").alias("dep_path"))
    lower = F.lower("container")
    rank = F.when(F.lower(basename(F.col("dep_path"))) == lower, 0).when(F.contains(F.lower("dep_path"), F.substring_index(lower, "_", 1)), 1)
    source = (
        first.select(*by, "cmd_idx", "container").join(deps, [*by, "cmd_idx"]).withColumn("rank", rank).filter("rank IS NOT NULL")
        .groupBy(*by, "container").agg(F.min_by("dep_path", F.struct("rank", "dep_pos")).alias("source"))
    )
    command = F.coalesce(*(F.when(F.col("tool").isin(*(t for t, x in READABLE.items() if x == text)), text) for text in dict.fromkeys(READABLE.values())), F.col("tool"))
    rows = first.join(source, [*by, "container"], "left")
    return rows.select(*by, "container", "package_type", F.coalesce("source", "path").alias("source"), command.alias("command"), "cmd_idx", "pos")


def content_with_origin(content: DataFrame, index: DataFrame) -> DataFrame:
    """Rows of package content with (source, command) of their package: by its name, for pip else by the first wheel whose name holds it.

    Names are looked up inside wheels' names by the first three characters of every tail of these, so
    the lookup is a join on keys. Without a package the source is empty and the command its type.
    """
    by, facts = scope(content), F.struct("source", "command")
    exact = content.join(index.select(*by, "container", facts.alias("exact")), [*by, "container"], "left")
    low = F.lower("container")
    wanted = content.filter("package_type = 'pip'").select(*by, F.lower("container").alias("low")).filter("low <> ''").distinct().withColumn("gram", F.left("low", F.lit(3)))
    tails = (
        index.filter("package_type = 'pip'").select(*by, low.alias("wheel"), "cmd_idx", "pos", facts.alias("facts"))
        .select("*", F.explode(F.sequence(F.lit(1), F.length("wheel"))).alias("at")).select(*by, "cmd_idx", "pos", "facts", F.substr("wheel", "at").alias("tail"))
        .select("*", F.explode(F.array(*(F.left("tail", F.lit(k)) for k in (1, 2, 3)))).alias("gram")).distinct()
    )
    inside = wanted.join(tails, [*by, "gram"]).filter(F.col("tail").startswith(F.col("low"))).groupBy(*by, "low").agg(F.min_by("facts", F.struct("cmd_idx", "pos")).alias("inside"))
    rows = exact.withColumn("low", F.when(F.col("package_type") == "pip", low)).join(inside, [*by, "low"], "left").withColumn("from", F.coalesce("exact", "inside"))
    return rows.select(*by, "path", "hash", "package_type", "container", F.coalesce("from.source", F.lit("")).alias("source"), F.coalesce("from.command", "package_type").alias("command"))
