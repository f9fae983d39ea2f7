"""Session helpers: table access and shipping this package to executors."""

from __future__ import annotations

import os
import tempfile
import urllib.parse
import uuid
import zipfile

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()

#: Bytes of a batch that a Python operator gets, so that its memory doesn't follow the number of rows times their length.
BATCH_BYTES = 4 << 20


def ship_code(spark: SparkSession) -> None:
    """Adds this package to the application's Python files, once, so that executors can import it, and bounds the session's Arrow batches in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="package-"), "buildlens.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("buildlens", os.path.relpath(path, root)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read by Spark from wherever it lies."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of its store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The store (local, S3, GCS, HDFS) of a path as Spark writes it, with a scheme and nothing escaped, and the path within it; for tasks that read or write files themselves."""
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(urllib.parse.quote(path, safe="/:@"))


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, for tables between steps.

    Where none is set, a temporary one is made and set, but only for a local master: on a cluster
    other machines couldn't see it, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """The table written to the shared folder and read back: cuts lineage and survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/tables-{df.sparkSession.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Rounds:
    """A table that grows by a part a round. Each part is written as by ``saved``, and all are read as one table, so that plans don't grow with the rounds."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
        self.paths: list[str] = []

    def add(self, part: DataFrame) -> DataFrame:
        """The part as written."""
        path = f"{self.folder}/round={len(self.paths)}"
        part.write.parquet(path)
        self.paths.append(path)
        self.kind = part.schema
        return self.spark.read.schema(self.kind).parquet(path)

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.kind).parquet(*self.paths)


def clear_saved(spark: SparkSession) -> None:
    """Deletes all tables that ``saved`` wrote in this application; results that still read them must be written before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
