"""Tables that are their own input: a change reads the newest version and writes the next, and no writer loses another's rows.

A table is a folder with data folders, one a version, and ``_log`` with a small file a version that names its data.
A writer stages its data, then publishes the log's next file in one step that fails if another writer was there first;
it then makes its change again, on the other's version. Readers see a version whole or not at all, staged data never. The store's
rename of a file must be atomic and refuse a taken name, as HDFS does; on a local disk a hard link does that.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cluster import saved

#: Versions whose data stay, for readers that began before.
KEPT = 5
TRIES = 50


class VersionedTable:
    """The table of this schema in a folder; without a version it is empty."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        log = self._path(f"{self.folder}/_log")
        if not self._system.exists(log):
            return []
        names = (s.getPath().getName() for s in self._system.listStatus(log))
        return sorted(int(n) for n in names if n.isdigit())

    def _data(self, version: int) -> str:
        return self.spark.read.text(f"{self.folder}/_log/{version:012d}").first().value

    def load(self, version: int | None = None) -> DataFrame:
        """The newest version's rows, or those of one that is still kept."""
        known = self.versions()
        if not known:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/{self._data(known[-1] if version is None else version)}")

    def _published(self, version: int, data: str) -> bool:
        """Whether this writer made the version; false if another did."""
        staged, target = self._path(f"{self.folder}/_staged-{uuid.uuid4().hex}"), self._path(f"{self.folder}/_log/{version:012d}")
        out = self._system.create(staged, False)
        out.write(bytearray(data.encode()))
        out.close()
        self._system.mkdirs(target.getParent())
        try:
            if self._system.getUri().getScheme() != "file":
                return self._system.rename(staged, target)
            files, uri = self.spark._jvm.java.nio.file.Files, lambda p: self.spark._jvm.java.nio.file.Paths.get(p.toUri().getPath(), self.spark.sparkContext._gateway.new_array(self.spark._jvm.java.lang.String, 0))
            try:
                files.createLink(uri(target), uri(staged))
            except Py4JJavaError as taken:
                if "FileAlreadyExists" in taken.java_exception.getClass().getName():
                    return False
                raise
            return True
        finally:
            self._system.delete(staged, False)

    def change(self, make: Callable[[DataFrame], DataFrame]) -> int:
        """Makes the next version from the newest one, again as often as other writers come first, and returns its number."""
        for _ in range(TRIES):
            newest = (self.versions() or [0])[-1]
            data = f"data-{newest + 1:012d}-{uuid.uuid4().hex}"
            make(self.load(newest) if newest else self.load()).select(*(f.name for f in self.load().schema)).write.parquet(f"{self.folder}/{data}")
            if self._published(newest + 1, data):
                self._forget(newest + 1 - KEPT)
                return newest + 1
            self._system.delete(self._path(f"{self.folder}/{data}"), True)
        raise RuntimeError(f"{self.folder}: other writers came first {TRIES} times")

    def _forget(self, last: int) -> None:
        """Deletes the data of versions up to this one; their log files stay, so that numbers aren't used again."""
        kept = {self._data(v) for v in self.versions() if v > last}
        for s in self._system.listStatus(self._path(self.folder)):
            name = s.getPath().getName()
            if name.startswith("data-") and name not in kept and int(name.split("-")[1]) <= last:
                self._system.delete(s.getPath(), True)

    def upsert(self, rows: DataFrame, *keys: str, newest: str | None = None) -> int:
        """The next version with these rows in place of those of equal keys (a null key equals a null one); columns that rows lack become null.

        Of a key's rows, old ones among them, the one with the largest ``newest`` stays; without it new rows replace old ones, and a key that comes twice is an error.
        """
        rows = saved(rows)

        def merged(known: DataFrame) -> DataFrame:
            given = known.limit(0).unionByName(rows, allowMissingColumns=True)
            if newest is None:
                mark = given.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
                same = None
                for k in keys:
                    same = F.col(k).eqNullSafe(F.col(f"_{k}")) if same is None else same & F.col(k).eqNullSafe(F.col(f"_{k}"))
                return known.join(mark, same, "left_anti").unionByName(given)
            whole = F.struct(*known.columns)
            return known.unionByName(given).groupBy(*keys).agg(F.max_by(whole, F.struct(newest, whole)).alias("row")).select("row.*")

        if newest is None and not rows.groupBy(*keys).count().filter("count > 1").isEmpty():
            raise ValueError(f"rows with equal {', '.join(keys)}")
        return self.change(merged)
