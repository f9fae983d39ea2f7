"""Command line: ``python -m buildlens COMMAND ...``. Exit code 1 if any project fails.

Folders below the base: unpacked/PROJECT/{src,bin}, builds/PROJECT/*.json (traces), results/PROJECT/{sources,ext,reports}.
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sinks, sql
from .cluster import clear_saved
from .functions.paths import basename
from .functions.rules import Rules
from .operators import unpack
from .plans import binaries, hotspots, packages, passes, summaries, tools
from .sources import files, lists, trace
from .sources import hotspots as service


def _build(src: DataFrame, bin_: DataFrame, commands: DataFrame, by: list[str], dictionary: str | None, rules: str | None) -> passes.Build:
    """A build whose tables are written once, and its commands parsed once, whatever reads them. ``dictionary``: file of tools, before the roles in the file ``rules``."""
    spark = commands.sparkSession
    roles = passes.roles_of(lists.read_tools(spark, dictionary)) if dictionary else None
    saved, commands = trace.saved, trace.saved(commands)
    bin_ = bin_.select(*by, "path", trace.normpath(F.col("path")).alias("path_norm"), "hash").withColumn("ord", F.monotonically_increasing_id())
    cmd = commands.select(*by, "cmd_idx", tools.tool_of(F.col("command")).alias("tool"), F.col("command").alias("argv"))
    return passes.Build(saved(src), saved(bin_), cmd, saved(trace.edges(commands, "dependencies")), saved(trace.edges(commands, "output")), roles, lists.read_rules(spark, rules) if rules else Rules())


def load(spark: SparkSession, base: str, project: str, dictionary: str | None, rules: str | None = None) -> passes.Build:
    """A project's sources, binaries and traces as a build."""
    results = f"{base}/results/{project}"
    src = trace.read_signatures(spark, [f"{results}/sources/{project}_src.json"])
    known = lists.read_path_hashes(spark, [f"{results}/sources/{project}_bin.json"])
    entries = lists.binary_entries(lists.read_binary_list(spark, [f"{results}/ext/binaries_in_bin.txt"]), known, project)
    return _build(src, entries, trace.read_commands(spark, [f"{base}/builds/{project}"], strict=False), [], dictionary, rules)


def load_all(spark: SparkSession, base: str, dictionary: str | None, only: list[str] | None = None, rules: str | None = None) -> passes.Build:
    """All projects' sources, binaries and traces as one build with a project column; ``only`` some of them. A trace that can't be parsed is left out."""
    def project(folder: str, file: F.Column) -> F.Column:
        return F.regexp_extract(file, rf"/{folder}/([^/]+)/", 1)

    def chosen(df: DataFrame) -> DataFrame:
        return df.filter(F.col("project").isin(only)) if only else df

    results, at = f"{base}/results/*", project("results", F.col("_metadata.file_path"))
    src = trace.read_signatures(spark, [f"{results}/sources/*_src.json"]).withColumn("project", project("results", F.col("file")))
    src = src.filter(F.col("file").endswith(F.concat(F.lit("/"), "project", F.lit("_src.json"))))  # not earlier versions
    hashes = lists.read_path_hashes(spark, [f"{results}/sources/*_bin.json"], F.when(F.col("_metadata.file_path").endswith(F.concat(F.lit("/"), at, F.lit("_bin.json"))), at)).filter("project IS NOT NULL")
    entries = lists.binary_entries(lists.read_binary_list(spark, [f"{results}/ext/binaries_in_bin.txt"], at), hashes)
    commands = trace.read_commands(spark, [f"{base}/builds/*"], strict=False).withColumn("project", project("builds", F.col("file")))
    return _build(chosen(src), chosen(entries), chosen(commands), ["project"], dictionary, rules)


def classified(b: passes.Build, trust_java: bool) -> tuple[DataFrame, DataFrame, DataFrame, dict[str, int]]:
    """Passes 1 to 4: (classes, commands of executed files, content of packages, files by class); by project where the build has several.

    Files are counted while the classes are written.
    """
    by, good = b.by, passes.good(b)
    second = summaries.with_redundant(passes.pass2(b, passes.pass1(b), good))
    third = trace.saved(passes.pass3(b, good))
    written = passes.pass3_outputs(b, good, third)
    executed = passes.executed_commands(b, third).select(*by, "path", "hash", F.to_json("commands").alias("commands"))
    scanned = binaries.scan(b)
    fourth = trace.saved(binaries.pass4(b, binaries.apt_containers(b), scanned=scanned))
    content = trace.saved(binaries.all_package_content(fourth, packages.package_index(b)))
    rest = fourth.filter("category <> 'apt_package_content'").join(content.select(*by, "path", "hash").distinct(), [*by, "path", "hash"], "left_anti")
    if trust_java:
        trusted = binaries.trusted_java(b, fourth, scanned).filter("category = 'compiled_from_src'").select(*by, "ord", F.lit("compiled_from_src").alias("trusted"))
        rest = rest.join(trusted, [*by, "ord"], "left").withColumn("category", F.coalesce("trusted", "category"))
    columns = [*by, "path", "hash", "category"]
    classes = second.select(columns).union(third.select(columns)).union(written.select(columns)).union(rest.select(columns))
    rows, seen = summaries.observed(classes.union(content.select(*by, "path", "hash", F.lit("external_package_content"))))
    return trace.saved(rows), executed, content, seen.get


def together(spark: SparkSession, base: str, only: list[str] | None, dictionary: str | None, trust_java: bool, rules: str | None = None) -> None:
    """Passes 1 to 4 of all projects in one plan: below ``together`` classes and package content as JSON lines by project, and sums by project, section and class."""
    classes, executed, content, _ = classified(load_all(spark, base, dictionary, only, rules), trust_java)
    commands = executed.withColumn("category", F.lit("executed"))
    sinks.write_categories(classes.join(commands, ["project", "category", "path", "hash"], "left"), f"{base}/together/classes")
    content.write.mode("overwrite").partitionBy("project").json(f"{base}/together/package_content")
    summaries.rollup(classes).write.mode("overwrite").json(f"{base}/together/summary")


def analyze(spark: SparkSession, base: str, project: str, dictionary: str | None, by_disk: bool, keep: bool, trust_java: bool, rules: str | None = None) -> None:
    """Passes 1 to 4, and 5 with ``by_disk``: every class as JSON and text, packages and a summary in a run's folder."""
    began = time.monotonic()
    b = load(spark, base, project, dictionary, rules)
    folder = sinks.run_folder(spark, f"{base}/results/{project}/reports", keep)
    classes, executed, content, counts = classified(b, trust_java)
    reports = {}
    for category in sorted(c for c, n in counts.items() if n and c != "rows"):
        own = classes.filter(F.col("category") == category).drop("category")
        sinks.write_category_json(own.join(executed, ["path", "hash"], "left") if category == "executed" else own, f"{folder}/{project}_{category}.json", category)
        reports[f"{project}_{category}.txt"] = (sinks.write_tsv(own, f"{folder}/{project}_{category}.txt", category), f"files of the class {category}")
    sinks.write_packages(summaries.packages(content), f"{folder}/external_package_content.json")
    sinks.write_package_tsv(content, f"{folder}/external_package_content.txt")
    if by_disk:
        sinks.write_by_disk(classes.filter("category <> 'external_package_content'"), f"{folder}/by_disk")
    lines = sinks.summary_lines(project, *summaries.summary_of(counts), time.strftime("%H:%M:%S", time.gmtime(time.monotonic() - began)))
    sinks.write_summary(spark, f"{folder}/summary.txt", lines)
    sinks.copy_reports(spark, reports, f"{folder}/summary")
    print("\n".join(lines))


def sign(spark: SparkSession, base: str, project: str) -> None:
    for side in ("src", "bin"):
        found = files.signatures(trace.saved(files.digests(spark, f"{base}/unpacked/{project}/{side}")), project, side)
        sinks.write_signatures(found, sinks.versioned(spark, f"{base}/results/{project}/sources/{project}_{side}.json"), f"{project}/{side}")


def profile(spark: SparkSession, base: str, project: str, rewrite: bool) -> None:
    for side in ("src", "bin"):
        target = f"{base}/results/{project}/ext/extensions_{side}.json"
        if rewrite or not sinks.exists(spark, target):
            found = files.walk(spark, f"{base}/unpacked/{project}/{side}")
            sinks.write_extensions(files.extensions(found), target, project, side, f"unpacked/{project}/{side}")
            below = files.binaries(found).withColumn("path", F.concat(F.lit(f"{side}/"), "path"))
            sinks.write_binaries(below, f"{base}/results/{project}/ext/binaries_in_{side}.txt")


def expand(spark: SparkSession, base: str, project: str, every: bool, skip: str | None) -> None:
    """Unpacked files and a log as tables beside the project's folder: files of a cluster's store aren't overwritten one by one."""
    made, log = unpack.unpack(files.walk(spark, f"{base}/src/{project}").select("path", "content"), every, skip)
    made.write.mode("overwrite").parquet(f"{base}/unpacked/{project}/files.parquet")
    log.write.mode("overwrite").json(f"{base}/unpacked/{project}/log.json")


def show(df: DataFrame, most: int = 200) -> None:
    for r in df.limit(most).collect():
        print("\t".join("" if x is None else str(x) for x in r))


def arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="buildlens", description="Provenance of software builds.")
    commands = top.add_subparsers(dest="command", required=True)

    def add(name: str, text: str) -> argparse.ArgumentParser:
        own = commands.add_parser(name, help=text)
        own.add_argument("base", help="folder with unpacked, builds and results")
        own.add_argument("-p", "--project", action="append", help="a project, again for more; default: all")
        return own

    own = add("analyze", "passes and reports")
    own.add_argument("-t", "--tools", help="dictionary of tools (YAML)")
    own.add_argument("-r", "--rules", help="rules of paths and tools (JSON)")
    own.add_argument("-d", "--by-disk", action="store_true")
    own.add_argument("-k", "--keep", action="store_true", help="keep earlier runs")
    own.add_argument("--parts", action="store_true", help="reports as folders of parts, written by many tasks")
    own.add_argument("--together", action="store_true", help="all projects in one plan, results as folders")
    own.add_argument("--trust-java", action=argparse.BooleanOptionalAction, default=True)
    add("sign", "signatures of unpacked files")
    add("profile", "extensions and binaries").add_argument("--no-rewrite", action="store_true")
    own = add("unpack", "recursive expansion of archives")
    own.add_argument("-a", "--all", action="store_true", help="jars too")
    own.add_argument("-s", "--skip", help="pattern of paths that stay packed")
    own = add("search", "commands by tool and files by package")
    own.add_argument("--tools", nargs="*", default=["apt", "pip", "npm", "wget", "curl"])
    own.add_argument("--packages", nargs="*", default=[])
    own = add("sample", "first commands of each tool")
    own.add_argument("--tools", nargs="*")
    own.add_argument("-n", type=int, default=5)
    own.add_argument("--tools-only", action="store_true")
    own = add("sql", "a query over a project's tables and passes, which are views")
    own.add_argument("-q", "--query", required=True)
    own.add_argument("-r", "--rules", help="rules of paths and tools (JSON)")
    own = add("trace", "commands that met a file")
    own.add_argument("-f", "--file")
    own.add_argument("--hash")
    own = add("hotspots", "spreadsheet of hotspots")
    own.add_argument("--url", required=True)
    own.add_argument("--out", required=True, help="folder on this machine")
    return top


def run(spark: SparkSession, a: argparse.Namespace, project: str) -> None:
    if a.command == "analyze":
        analyze(spark, a.base, project, a.tools, a.by_disk, a.keep, a.trust_java, a.rules)
    elif a.command == "sign":
        sign(spark, a.base, project)
    elif a.command == "profile":
        profile(spark, a.base, project, not a.no_rewrite)
    elif a.command == "unpack":
        expand(spark, a.base, project, a.all, a.skip)
    elif a.command == "sql":
        sql.register(spark, load(spark, a.base, project, None, a.rules))
        show(spark.sql(a.query))
    elif a.command == "hotspots":
        sinks.write_xlsx(hotspots.report(service.read_service(spark, a.url, project), project), f"{a.out}/{project}.xlsx")
    else:
        commands = trace.read_commands(spark, [f"{a.base}/builds/{project}"], strict=False)
        if a.command == "trace":
            show(tools.by_command(tools.find_file(commands, a.hash, a.file and a.file.rsplit("/", 1)[-1])))
            return
        cmd = commands.select("cmd_idx", tools.tool_of(F.col("command")).alias("tool"), F.col("command").alias("argv"))
        if a.command == "sample":
            show(tools.tool_totals(cmd))
            show(tools.tool_counts(cmd).orderBy(F.desc("commands"), "tool") if a.tools_only else tools.tool_samples(cmd, a.n, a.tools).orderBy("tool", "cmd_idx"))
            return
        if a.tools:
            show(tools.tool_matches(commands, a.tools))
        if a.packages:
            found = tools.package_matches(cmd, trace.edges(commands, "dependencies"), trace.edges(commands, "output"), a.packages)
            show(tools.package_roles(found))
            show(tools.likely_origin(found.withColumn("name", basename(F.col("path"))), "package", "name"))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = arguments().parse_args(argv)
    own = spark is None
    spark = spark or SparkSession.builder.appName(f"buildlens {a.command}").getOrCreate()
    roots = {"unpack": "src", "sign": "unpacked", "profile": "unpacked", "hotspots": "results", "analyze": "results"}
    if a.command == "analyze" and a.together:
        together(spark, a.base, a.project, a.tools, a.trust_java, a.rules)
        return 0
    if a.command == "analyze":
        spark.conf.set(sinks.PARTS, str(a.parts).lower())
    failed = []
    for project in a.project or files.projects(spark, f"{a.base}/{roots.get(a.command, 'builds')}"):
        try:
            run(spark, a, project)
        except Exception as wrong:  # noqa: BLE001  the other projects still run
            print(f"{project}: {wrong}", file=sys.stderr)
            failed.append(project)
        if own:  # a session that is given may still read its tables
            clear_saved(spark)
    return int(bool(failed))


if __name__ == "__main__":
    sys.exit(main())
