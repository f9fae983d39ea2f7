"""Incremental counts over build traces that arrive as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import basename
from ..sources.trace import COMMANDS


def tool_counts(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Streaming (tool, commands) over trace files of a folder; state is one row a tool, so it needs no watermark."""
    rows = spark.readStream.schema(COMMANDS).option("multiLine", True).option("allowUnquotedControlChars", True).option("maxFilesPerTrigger", files_per_batch).json(folder)
    commands = rows.select(F.explode("component_commands").alias("c"))
    tool = F.coalesce(basename(F.try_element_at("c.command", F.lit(1))), F.lit("__no_command__"))
    return commands.groupBy(tool.alias("tool")).agg(F.count("*").alias("commands"))
