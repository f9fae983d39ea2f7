"""Tables of runs by project: merged with new results, with the rules for the states that a new result resets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import saved
from ..versioned import VersionedTable

RUN = (
    "project_name string, project_key string, server_url string, source_path string, languages_analyzed array<string>, languages_excluded array<string>, status string, "
    "analyzed_at timestamp, dashboard_url string, depth_exclusion string, error_message string, hotspots_status string, hotspots_exported_at timestamp"
)
RESULT = ("project_key", "server_url", "source_path", "languages_analyzed", "languages_excluded", "status", "analyzed_at", "depth_exclusion", "error_message")


def load(spark: SparkSession, folder: str, schema: str = RUN) -> DataFrame:
    """The table in a folder; an empty one where it is missing or can't be listed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(schema).json(folder) if there else spark.createDataFrame([], schema)


def with_results(known: DataFrame, results: DataFrame) -> DataFrame:
    """Runs after new results (project_name and ``RESULT``), one row a project.

    A project's new result replaces its run. After a success the state of its report stays as it was
    (never, where there was none); after a failure it is never again.
    """
    old = known.select("project_name", F.col("hotspots_status").alias("old_status"), F.col("hotspots_exported_at").alias("old_at"))
    ok = F.col("status") == "success"
    dashboard = F.concat("server_url", F.lit("/dashboard?id="), "project_key")
    new = results.join(old, "project_name", "left").select(
        "project_name", *(F.array_sort(c).alias(c) if c.startswith("languages_") else F.coalesce(c, F.lit("")).alias(c) if c == "error_message" else c for c in RESULT),
        dashboard.alias("dashboard_url"), F.when(ok, F.coalesce("old_status", F.lit("never"))).otherwise("never").alias("hotspots_status"), F.when(ok, F.col("old_at")).alias("hotspots_exported_at"),
    )
    return known.join(results.select("project_name"), "project_name", "left_anti").unionByName(new.select(known.columns))


def record(spark: SparkSession, folder: str, results: DataFrame) -> int:
    """Writes new results back to the table of runs in a folder, beside other writers; see ``with_results``. Returns the table's version."""
    results = saved(results)
    return VersionedTable(spark, folder, RUN).change(lambda known: with_results(known, results))


def record_states(spark: SparkSession, folder: str, states: DataFrame, state: str, at: str, done: str, also: str | None = None) -> int:
    """Writes new states back to the table of runs in a folder, see ``with_states``."""
    states = saved(states)
    return VersionedTable(spark, folder, RUN).change(lambda known: with_states(known, states, state, at, done, also))


def with_states(known: DataFrame, states: DataFrame, state: str, at: str, done: str, also: str | None = None) -> DataFrame:
    """Runs after new states (project_name, state, at): column ``state`` is set, ``at`` only with the state ``done``; projects that aren't known are left out.

    ``also``: a column that a state sets too, where it has a value.
    """
    extra = [F.col(also).alias("new_also")] if also else []
    new = states.select("project_name", F.col("state").alias("new_state"), F.col("at").alias("new_at"), F.lit(True).alias("told"), *extra)
    rows = known.join(new, "project_name", "left")
    changed = {state: F.when(F.col("told"), F.col("new_state")).otherwise(F.col(state)), at: F.when(F.col("told"), F.when(F.col("new_state") == done, F.col("new_at"))).otherwise(F.col(at))}
    if also:
        changed[also] = F.when(F.coalesce("new_also", F.lit("")) != "", F.col("new_also")).otherwise(F.col(also))
    return rows.withColumns(changed).select(known.columns)


def to_do(projects: DataFrame, known: DataFrame, state: str, done: str) -> DataFrame:
    """Projects whose run isn't done yet: an anti-join with the table of runs."""
    return projects.join(known.filter(F.col(state) == done).select("project_name"), "project_name", "left_anti")


def profiles(known: DataFrame, new: DataFrame, key: str = "project") -> DataFrame:
    """The table of all projects' profiles after new ones, each of which replaces its project's."""
    return known.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)
