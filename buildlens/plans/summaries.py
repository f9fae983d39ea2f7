"""Totals over the classes of all passes, and packages with their files."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from ..operators.closure import scope

# Classes of the passes that the totals add up.
SOURCES = ("direct", "parent", "redundant")
INTERPRETED = ("executed", "compiled_used", "compiled_unused", "copied", "not_used")
BINARIES = ("compiled_from_src", "binaries_from_src", "untraced_from_src", "external_built", "external_prebuilt", "untraced_external", "system_binaries", "external_package_content")
SPARE = ("redundant", "compiled_unused", "not_used")
SECTIONS = {"source": SOURCES, "interpreted": INTERPRETED, "binaries": BINARIES}
#: Classes that no section has.
OTHERS = ("not_compiled", "untraced_in_distrib", "apt_package_content")


def with_redundant(second: DataFrame) -> DataFrame:
    """Rows of pass 2 by class, where a row that is not compiled is also redundant: (path, hash, category)."""
    rows = second.select(*scope(second), "path", "hash", "category")
    return rows.union(rows.filter("category = 'not_compiled'").withColumn("category", F.lit("redundant")))


def totals(rows: DataFrame) -> DataFrame:
    """One row of counts over (category) rows of all passes.

    total_source adds direct, parent and redundant files (not compiled ones are among these),
    total_interpreted the five classes of pass 3, total_all both; redundant_all are redundant, compiled
    but unused and unused files, used_all the rest; total_binaries adds the classes of pass 4.
    """
    one = lambda *names: F.count_if(F.col("category").isin(*names))
    sums = rows.agg(one(*SOURCES).alias("total_source"), one(*INTERPRETED).alias("total_interpreted"), one(*SPARE).alias("redundant_all"), one(*BINARIES).alias("total_binaries"))
    everything = F.col("total_source") + F.col("total_interpreted")
    return sums.select("total_source", "total_interpreted", everything.alias("total_all"), "redundant_all", (everything - F.col("redundant_all")).alias("used_all"), "total_binaries")


def shares(rows: DataFrame) -> DataFrame:
    """(section, category, files, percent) of the classes in each section that occur; percent of the section's total, one digit."""
    groups = (("source", SOURCES), ("interpreted", INTERPRETED), ("binaries", BINARIES))
    sections = F.array(*(F.when(F.col("category").isin(*names), s) for s, names in groups))
    known = rows.select("category", F.explode(F.array_compact(sections)).alias("section")).groupBy("section", "category").agg(F.count("*").alias("files"))
    sums = known.groupBy("section").agg(F.sum("files").alias("total"))  # three rows at most
    return known.join(F.broadcast(sums), "section").select("section", "category", "files", F.round(100.0 * F.col("files") / F.col("total"), 1).alias("percent"))


def observed(rows: DataFrame, name: str = "classes") -> tuple[DataFrame, Observation]:
    """The rows, and the number of each class (and ``rows``, all of them) that is known once they are written: it costs no job of its own."""
    seen = Observation(name)
    classes = [c for names in (*SECTIONS.values(), OTHERS) for c in names]
    return rows.observe(seen, F.count("*").alias("rows"), *(F.count_if(F.col("category") == c).alias(c) for c in dict.fromkeys(classes))), seen


def summary_of(counts: dict[str, int]) -> tuple[list[Row], Row]:
    """Rows of ``shares`` and the row of ``totals`` from the numbers of the classes, see ``observed``; a few numbers on the driver, no job."""
    found = []
    for section, names in SECTIONS.items():
        whole = sum(counts.get(c, 0) for c in names)
        found += [Row(section=section, category=c, files=counts[c], percent=float(Decimal(repr(100.0 * counts[c] / whole)).quantize(Decimal("0.1"), ROUND_HALF_UP))) for c in names if counts.get(c)]
    add = lambda names: sum(counts.get(c, 0) for c in names)
    source, interpreted, spare = add(SOURCES), add(INTERPRETED), add(SPARE)
    return found, Row(total_source=source, total_interpreted=interpreted, total_all=source + interpreted, redundant_all=spare, used_all=source + interpreted - spare, total_binaries=add(BINARIES))


def rollup(rows: DataFrame) -> DataFrame:
    """(project, section, category, files, percent) over (project, category) rows of all passes, with sums: a null category is a project's section, a null section a project, a null project all.

    percent is that of the next larger sum, four digits.
    """
    section = F.array_compact(F.array(*(F.when(F.col("category").isin(*names), s) for s, names in (("source", SOURCES), ("interpreted", INTERPRETED), ("binaries", BINARIES)))))
    known = rows.select("project", F.coalesce(F.try_element_at(section, F.lit(1)), F.lit("other")).alias("section"), "category")
    sums = known.rollup("project", "section", "category").agg(F.count("*").alias("files"), F.grouping_id().alias("level"))
    above = sums.select(F.col("project").alias("p"), F.col("section").alias("s"), F.col("files").alias("whole"), F.col("level").alias("l")).filter("l > 0")  # a few rows a project
    parent = F.when(F.col("level") == 0, 1).when(F.col("level") == 1, 3).otherwise(7)
    same = (F.col("l") == parent) & F.col("p").eqNullSafe(F.when(F.col("level") < 3, F.col("project"))) & F.col("s").eqNullSafe(F.when(F.col("level") < 1, F.col("section")))
    return sums.join(above, same, "left").select("project", "section", "category", "files", F.round(100.0 * F.col("files") / F.col("whole"), 4).alias("percent"))


def packages(content: DataFrame) -> DataFrame:
    """(package_type, container, source, command, files_count, files) of package content (path, hash, package_type, container, source, command), a row a package.

    Source and command are those of the first file by path and hash; files are sorted.
    """
    first = F.struct("path", "hash")
    return content.groupBy("package_type", "container").agg(
        F.min_by("source", first).alias("source"), F.min_by(F.coalesce("command", "package_type"), first).alias("command"), F.count("*").alias("files_count"),
        F.array_sort(F.collect_list(first)).alias("files"),
    )


def package_count(content: DataFrame) -> DataFrame:
    """One row: files and distinct packages."""
    return content.agg(F.count("*").alias("total_files"), F.count_distinct(F.coalesce("package_type", F.lit("")), F.coalesce("container", F.lit(""))).alias("total_packages"))
