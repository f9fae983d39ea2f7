"""Good commands of a build whose traces arrive one after another.

What is kept between arrivals lies in a folder, a part for each arrival: the keys that commands read and make, the good commands,
and the keys that these need. A new producer can make old commands good, and an old need a new command, so an arrival starts from
its own commands that write to the distribution or to a needed key, and walks on over all edges from the commands that became good.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import saved
from ..operators.closure import by_hash_or_path, command_keys
from ..sources import trace
from ..sources.ranges import elements

COMMAND = ["file", "pos"]
PARTS = {"files": "file string", "reads": "file string, pos long, key string", "makes": "file string, pos long, key string", "good": "file string, pos long", "needs": "key string"}


class Closure:
    """The closure kept in a folder; a command is (file, pos). One writer at a time; an arrival that is made again, with its number, replaces what it left behind."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _part(self, name: str, before: int | None = None) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], PARTS[name])
        rows = self.spark.read.schema(f"{PARTS[name]}, arrival long").option("basePath", path.toString()).parquet(path.toString())
        return (rows if before is None else rows.filter(F.col("arrival") < before)).drop("arrival")

    def _add(self, name: str, arrival: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{name}/arrival={arrival}")

    def good(self) -> DataFrame:
        """(file, pos) of the good commands so far."""
        return self._part("good")

    def add(self, arrival: int, commands: DataFrame, shipped: DataFrame) -> None:
        """Takes in commands (file, pos, dependencies, output) and what the distribution (hash, path_norm) has; commands of files that came in earlier arrivals change nothing."""
        files = saved(commands.select("file").distinct().join(self._part("files", arrival), "file", "left_anti"))
        own = commands.join(files, "file", "left_semi").withColumn("cmd_idx", F.struct(*COMMAND))

        def keyed(edges: DataFrame) -> DataFrame:
            return saved(command_keys(edges).select("cmd_idx.*", "key"))

        out = saved(trace.edges(own, "output"))
        new_makes = keyed(out)
        self._add("reads", arrival, keyed(trace.edges(own, "dependencies")))
        self._add("makes", arrival, new_makes)
        reads, makes = self._part("reads", arrival + 1), self._part("makes", arrival + 1)
        good, needs = self._part("good", arrival), self._part("needs", arrival)
        ships = by_hash_or_path(out, shipped).select("cmd_idx.*")
        frontier = saved(ships.union(new_makes.join(needs, "key", "left_semi").select(*COMMAND)).distinct())
        found, wanted = [frontier], []
        while not frontier.isEmpty():
            known = needs
            for k in wanted:
                known = known.union(k)
            keys = saved(reads.join(frontier, COMMAND, "left_semi").select("key").distinct().join(known, "key", "left_anti"))
            wanted.append(keys)
            have = good
            for f in found:
                have = have.union(f)
            frontier = saved(makes.join(keys, "key", "left_semi").select(*COMMAND).distinct().join(have, COMMAND, "left_anti"))
            found.append(frontier)
        for name, parts in (("good", found), ("needs", wanted)):
            rows = self.spark.createDataFrame([], PARTS[name])
            for p in parts:
                rows = rows.union(p)
            self._add(name, arrival, rows)
        self._add("files", arrival, files)  # last: an arrival that broke off is made again


def follow(spark: SparkSession, folder: str, shipped: DataFrame, state: str, files_per_batch: int = 100):
    """A streaming query that takes in trace files of a folder as they come, each batch as an arrival, and ends when all that lie there are in; run it again for later ones.

    Files that can't be parsed are left out of the closure.
    """
    closure = Closure(spark, f"{state}/closure")

    def batch(rows: DataFrame, number: int) -> None:
        names = [r.path for r in rows.select("path").collect()]  # at most files_per_batch
        if names:
            found, _ = elements(spark, names, "component_commands", trace.COMMAND)
            closure.add(number, found.select("file", "pos", "c.dependencies", "c.output"), shipped)

    listed = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", files_per_batch).load(folder)
    return listed.select("path").writeStream.foreachBatch(batch).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
