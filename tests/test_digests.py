"""Digests of files in chunks: long ones, slow ones, ones that can't be read."""

import hashlib

import pytest

from buildlens.sources import files


def test_digests_of_a_folder(spark, tmp_path):
    (tmp_path / "a_dir" / "b").mkdir(parents=True)
    made = {"a": b"x" * 100, "a_dir/b/c d.txt": b"", "a_dir/é": bytes(range(256)) * 50_000}
    for name, data in made.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / ".queue.1").write_bytes(b"")
    (tmp_path / "a_dir" / "loop").symlink_to(tmp_path)
    found = files.digests(spark, str(tmp_path))
    assert sorted(tuple(r) for r in found.collect()) == sorted((n, len(d), hashlib.sha256(d).hexdigest(), None) for n, d in made.items())
    rows = {r.path: r for r in files.signatures(found, "P", "src").collect()}
    assert rows["P/src/a"].archive == 1 and rows["P/src/a/b/c d.txt"].parents_chain == [hashlib.sha256(b"x" * 100).hexdigest()]
    (tmp_path / "none").mkdir()
    assert files.digests(spark, str(tmp_path / "none")).count() == 0


def test_a_file_beyond_two_gb(spark, tmp_path):
    n = (1 << 31) + 5
    with open(tmp_path / "long", "wb") as f:
        f.truncate(n)
    plain, block = hashlib.sha1(), bytes(1 << 24)
    for _ in range(n >> 24):
        plain.update(block)
    plain.update(block[: n % (1 << 24)])
    assert [tuple(r) for r in files.digests(spark, str(tmp_path), "sha1").collect()] == [("long", n, plain.hexdigest(), None)]


def test_slow_and_missing_files_are_told(spark, tmp_path):
    (tmp_path / "slow").write_bytes(b"x" * 1000)
    listed = spark.createDataFrame([("slow", 1000), ("gone", 5)], "path string, length long")
    found = files.hashed(listed, f"file:{tmp_path}", seconds=lambda n: -1.0 if n == 1000 else 60.0)
    assert sorted(tuple(r) for r in found.collect()) == [("gone", 5, None, "FAILED"), ("slow", 1000, None, "TIMEOUT")]
    assert {(r.path, r.hash, r.error) for r in files.signatures(found, "P", "src").collect()} == {("P/src/gone", "", "FAILED"), ("P/src/slow", "", "TIMEOUT")}


@pytest.mark.parametrize(("mb", "seconds"), [(0, 120), (99, 120), (100, 180), (2048, 120 + 20 * 60)])
def test_time_allowed(mb, seconds):
    assert files.budget(mb << 20) == seconds
