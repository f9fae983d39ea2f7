"""Builds in SQL: their tables and passes as views, and table functions over these."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .cluster import saved
from .plans import binaries, packages, passes
from .plans.passes import Build

#: Table functions: parameter, rows, and the view they come from.
FUNCTIONS = {
    "files_of_class": ("wanted STRING", "path STRING, hash STRING", "SELECT path, hash FROM {classes} WHERE category = wanted"),
    "inputs_of": ("number BIGINT", "pos INT, path STRING, hash STRING", "SELECT pos, path, hash FROM {inputs} WHERE cmd_idx = number"),
    "outputs_of": ("number BIGINT", "pos INT, path STRING, hash STRING", "SELECT pos, path, hash FROM {outputs} WHERE cmd_idx = number"),
    "commands_that_read": ("file STRING", "cmd_idx BIGINT, tool STRING", "SELECT DISTINCT c.cmd_idx, c.tool FROM {commands} c JOIN {inputs} f ON f.cmd_idx = c.cmd_idx WHERE f.path = file"),
    "commands_that_made": ("file STRING", "cmd_idx BIGINT, tool STRING", "SELECT DISTINCT c.cmd_idx, c.tool FROM {commands} c JOIN {outputs} f ON f.cmd_idx = c.cmd_idx WHERE f.path = file"),
}


def tables(b: Build) -> dict[str, DataFrame]:
    """The build's tables and the results of passes 1 to 4 by name. The closure and the scan are made once; passes are computed when they are asked for."""
    good = passes.good(b)
    third = passes.pass3(b, good)
    scanned = binaries.scan(b)
    fourth = saved(binaries.pass4(b, scanned=scanned))
    second = passes.pass2(b, passes.pass1(b), good)
    columns = [*b.by, "path", "hash", "category"]
    return {
        "sources": b.src, "binaries": b.bin, "commands": b.cmd, "inputs": b.dep, "outputs": b.out, "good_commands": good, "pass1": passes.pass1(b), "pass2": second, "pass3": third,
        "pass3_outputs": passes.pass3_outputs(b, good, third), "pass4": fourth, "classes": second.select(columns).union(third.select(columns)).union(fourth.select(columns)),
        "rules": b.cmd.sparkSession.createDataFrame(b.rules.rows(), "rule string, value string"), "external_dependencies": passes.external_dependencies(b), "suspicious_inputs": binaries.suspicious_inputs(b, fourth, scanned), "trusted_java": binaries.trusted_java(b, fourth, scanned),
        "filtered_dependencies": binaries.filtered_dependencies(b, fourth), "external_inputs": binaries.external_inputs(b, fourth, scanned), "package_index": packages.package_index(b),
    }


def register(spark: SparkSession, b: Build, prefix: str = "") -> list[str]:
    """Makes the build's tables and passes temporary views, and ``FUNCTIONS`` temporary table functions, named with the prefix; returns their names.

    Functions are for builds of one project, and aren't made for builds of many; views of these have the column ``project``.
    """
    found, names = tables(b), []
    views = {name: f"{prefix}{name}" for name in found}
    for name, df in found.items():
        df.createOrReplaceTempView(views[name])
        names.append(views[name])
    for name, (parameter, rows, text) in FUNCTIONS.items() if not b.by else ():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameter}) RETURNS TABLE({rows}) RETURN {text.format(**views)}")
        names.append(f"{prefix}{name}")
    return names
