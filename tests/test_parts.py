import json

import pytest
from pyspark.sql import functions as F

from buildlens import sinks


@pytest.fixture
def parts(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(sinks.PARTS, "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    spark.conf.unset(sinks.PARTS)


def whole(folder):
    files = sorted(p for p in folder.iterdir() if p.name.startswith("part-"))
    return "".join(p.read_text() for p in files), len([p for p in files if p.stat().st_size])


def test_parts_one_after_another_are_the_file(spark, tmp_path, parts):
    rows = spark.range(500).select(F.when(F.col("id") % 50 > 0, F.format_string("p/%03d", F.col("id") % 97)).alias("path"), F.md5(F.col("id").cast("string")).alias("hash"))
    same = lambda text: [x for x in text.split("\n") if "enerated" not in x]
    sinks.write_category_json(rows, f"{tmp_path}/x.json", "direct")
    sinks.write_tsv(rows, f"{tmp_path}/x.txt", "direct")
    (document, many), (text, more) = whole(tmp_path / "x.json"), whole(tmp_path / "x.txt")
    assert many > 1 and more > 1
    spark.conf.set(sinks.PARTS, "false")
    sinks.write_category_json(rows, f"{tmp_path}/y.json", "direct")
    sinks.write_tsv(rows, f"{tmp_path}/y.txt", "direct")
    assert same(text) == same((tmp_path / "y.txt").read_text())
    got, want = json.loads(document), json.loads((tmp_path / "y.json").read_text())
    ordered = lambda d: ([f["path"] for f in d["files"]], sorted(f["hash"] for f in d["files"]), d["total"])
    assert ordered(got) == ordered(want) and len(got["files"]) == 500


@pytest.mark.parametrize("rows", [[], [("a", "1")], [("a", "1")] * 40, [(None, "1"), ("", "2"), ("b", None)]])
def test_few_rows_ties_and_nulls(spark, tmp_path, parts, rows):
    df = spark.createDataFrame(rows, "path string, hash string").repartition(3)
    for _ in range(2):  # the second replaces the first
        assert sinks.write_category_json(df, f"{tmp_path}/x.json", "direct") == len(rows)
    found = json.loads(whole(tmp_path / "x.json")[0])["files"]
    assert sorted(f["path"] for f in found) == sorted(p or "" for p, _ in rows)


def test_summary_stays_a_file_and_lists_folders(spark, tmp_path, parts):
    path = sinks.write_tsv(spark.createDataFrame([("a", "1")], "path string, hash string"), f"{tmp_path}/x.txt", "direct")
    assert sinks.copy_reports(spark, {"x.txt": (path, "text")}, f"{tmp_path}/summary") == ["x.txt"]
    assert f"`x.txt`: text ({path})" in (tmp_path / "summary" / "README.md").read_text() and not (tmp_path / "summary" / "x.txt").exists()
