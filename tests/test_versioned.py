"""Tables written back to: many writers at once, broken off ones, keys with nulls."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from buildlens import versioned
from buildlens.plans import runs

KIND = "key string, value long, at long"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_writers_at_once_lose_nothing(spark, tmp_path):
    folder, n = str(tmp_path / "t"), 5
    start, wrong = threading.Barrier(n), []

    def work(k):
        try:
            start.wait()
            own = versioned.VersionedTable(spark, folder, KIND)
            own.upsert(spark.createDataFrame([(f"k{k}", k, 0), ("shared", k, k)], KIND), "key")
            own.change(lambda known: known.withColumn("at", F.when(F.col("key") == f"k{k}", F.col("at") + 1).otherwise(F.col("at"))))
        except Exception as e:  # noqa: BLE001
            wrong.append(e)

    threads = [threading.Thread(target=work, args=(k,)) for k in range(n)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    table = versioned.VersionedTable(spark, folder, KIND)
    assert not wrong and table.versions() == list(range(1, 2 * n + 1))
    found = rows(table.load())
    assert [r for r in found if r[0] != "shared"] == [(f"k{k}", k, 1) for k in range(n)] and sum(r[0] == "shared" for r in found) == 1
    assert len([x for x in os.listdir(folder) if x.startswith("data-")]) == versioned.KEPT and not [x for x in os.listdir(folder) if x.startswith("_staged")]


def test_versions_stay_and_staged_data_are_not_seen(spark, tmp_path):
    table = versioned.VersionedTable(spark, str(tmp_path / "t"), KIND)
    assert table.load().count() == 0 and table.versions() == []
    table.upsert(spark.createDataFrame([("a", 1, 1), (None, 2, 1)], KIND), "key")
    before = table.load()
    table.upsert(spark.createDataFrame([(None, 3, 2), ("b", 4, 2)], KIND), "key")
    assert rows(before) == [("a", 1, 1), (None, 2, 1)] and rows(table.load()) == [("a", 1, 1), ("b", 4, 2), (None, 3, 2)]
    assert rows(table.load(1)) == rows(before)
    spark.createDataFrame([("lost", 0, 0)], KIND).write.parquet(str(tmp_path / "t" / "data-000000000003-abc"))  # a writer that broke off
    assert table.load().count() == 3
    table.upsert(spark.createDataFrame([("c",)], "key string"), "key")
    assert rows(table.load(3).filter("key = 'c'")) == [("c", None, None)]
    with pytest.raises(ValueError, match="equal key"):
        table.upsert(spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], KIND), "key")


def test_the_newest_row_stays(spark, tmp_path):
    table = versioned.VersionedTable(spark, str(tmp_path / "t"), KIND)
    table.upsert(spark.createDataFrame([("a", 1, 5), ("a", 2, 4), ("b", 3, 1)], KIND), "key", newest="at")
    table.upsert(spark.createDataFrame([("a", 9, 4), ("b", 8, 2)], KIND), "key", newest="at")
    assert rows(table.load()) == [("a", 1, 5), ("b", 8, 2)]


def test_another_writer_in_between(spark, tmp_path):
    one, two = (versioned.VersionedTable(spark, str(tmp_path / "t"), KIND) for _ in range(2))
    calls = []

    def make(known):
        if not calls:
            two.upsert(spark.createDataFrame([("other", 1, 1)], KIND), "key")
        calls.append(known.count())
        return known.unionByName(spark.createDataFrame([("own", 2, 2)], KIND))

    assert one.change(make) == 2 and calls == [0, 1] and rows(one.load()) == [("other", 1, 1), ("own", 2, 2)]


def test_runs_are_written_back(spark, tmp_path):
    folder = str(tmp_path / "runs")
    empty = {c.split(" ")[0]: F.lit(None).cast(c.split(" ")[1]) for c in runs.RUN.split(", ")}

    def result(name, status):
        return spark.createDataFrame([(name, status)], "project_name string, status string").withColumns({c: empty[c] for c in runs.RESULT if c != "status"})

    runs.record(spark, folder, result("p", "success"))
    runs.record_states(spark, folder, spark.createDataFrame([("p", "exported", None), ("q", "exported", None)], "project_name string, state string, at timestamp"), "hotspots_status", "hotspots_exported_at", "exported")
    runs.record(spark, folder, result("q", "failed"))
    table = versioned.VersionedTable(spark, folder, runs.RUN)
    state = lambda: sorted((r.project_name, r.status, r.hotspots_status) for r in table.load().collect())
    assert state() == [("p", "success", "exported"), ("q", "failed", "never")]
    runs.record(spark, folder, result("p", "failed"))
    assert state() == [("p", "failed", "never"), ("q", "failed", "never")]
