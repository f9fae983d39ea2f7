"""Trace and signature files as they are found: broken ones, bad bytes, one name in two folders, padded hashes; closures on hot keys."""

import json

import pytest
from pyspark.errors import PySparkException

from buildlens.operators import closure
from buildlens.plans import passes
from buildlens.sources import trace

EDGE = "cmd_idx long, pos int, path string, path_norm string, hash string"


def commands_of(*argvs, **fields):
    return json.dumps({"component_commands": [{"command": a, **fields} for a in argvs]})


def test_files_of_one_name_in_two_folders(spark, tmp_path):
    for folder, argvs in (("d1", [["gcc"], ["ld"]]), ("d2", [["cp"], ["mv"], ["ar"]])):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "b.json").write_text(commands_of(*argvs))
    (tmp_path / "d2" / "a.json").write_text(commands_of(["first"]))
    rows = trace.read_commands(spark, [str(tmp_path)]).orderBy("cmd_idx").collect()
    assert [(r.cmd_idx, r.command[0]) for r in rows] == [(0, "first"), (1, "gcc"), (2, "ld"), (3, "cp"), (4, "mv"), (5, "ar")]


def test_bad_bytes_are_replaced_and_hashes_stripped(spark, tmp_path):
    text = commands_of(["gcc", "X.c"], dependencies={"a\x01b": " h1 ", "c": "  "}, output=[{"path": " o ", "hash": "h2\t"}]).replace("\\u0001", "\x01")
    (tmp_path / "t.json").write_bytes(text.encode().replace(b"X", b"\xff\xfe"))
    rows = trace.read_commands(spark, [str(tmp_path)])
    assert rows.first().command[1] == "��.c"
    assert [(r.path, r.hash) for r in trace.edges(rows, "dependencies").orderBy("pos").collect()] == [("a\x01b", "h1"), ("c", None)]
    assert [(r.path, r.hash) for r in trace.edges(rows, "output").collect()] == [("o", "h2")]


def test_files_that_cannot_be_read_are_told(spark, tmp_path):
    (tmp_path / "good.json").write_text(commands_of(["gcc"]))
    (tmp_path / "cut.json").write_text(commands_of(["gcc"], ["ld"])[:-20])
    (tmp_path / "empty.json").write_text('{"component_commands": []}')
    with pytest.raises(PySparkException, match="cut.json"):
        trace.read_commands(spark, [str(tmp_path)]).collect()
    assert trace.read_commands(spark, [str(tmp_path)], strict=False).count() == 1
    assert [r.file.rsplit("/", 1)[1] for r in trace.broken_files(spark, [str(tmp_path)]).collect()] == ["cut.json"]
    (tmp_path / "s.json").write_text('{"directory": "P/src", "signatures": [{"path": "P/src/a/../b.c", "hash": " H ", "archive": 0, "parents_hash": "0", "parents_chain": []}, {"path": "", "hash": ""}]}')
    row = trace.read_signatures(spark, [str(tmp_path / "s.json")]).orderBy("ord").first()
    assert (row.path_norm, row.hash) == ("P/src/b.c", "H")
    hashes, paths = trace.shipped_sets(spark, [str(tmp_path / "s.json")])
    assert [r[0] for r in hashes.collect()] == ["H"] and [r[0] for r in paths.collect()] == ["P/src/b.c"]
    assert all(t.isEmpty() for t in trace.shipped_sets(spark, []))


def test_a_hot_key_makes_no_pairs(spark):
    """2000 commands write one hash, and 2000 read it: the closure's tables stay as large as the edges."""
    dep = spark.range(2000).selectExpr("id AS cmd_idx", "0 AS pos", "'r' || id AS path", "'r' || id AS path_norm", "'hot' AS hash")
    out = spark.range(4000).selectExpr("id AS cmd_idx", "0 AS pos", "'w' || id AS path", "'w' || id AS path_norm", "CASE WHEN id >= 2000 THEN 'hot' ELSE 'own' || id END AS hash")
    shipped = spark.createDataFrame([("own7", "x"), ("own8", "y")], "hash string, path_norm string")
    good = sorted(r.cmd_idx for r in closure.good_commands(dep, out, shipped).collect())
    assert good == [7, 8, *range(2000, 4000)]
    assert closure.command_keys(dep).count() == 4000


def test_roles_switch_passes(spark):
    edge = lambda rows: spark.createDataFrame([(c, k, p, p, h) for k, (c, p, h) in enumerate(rows)], EDGE)
    src = spark.createDataFrame([(1, "a.c", "a.c", "h1", []), (2, "b.py", "b.py", "h2", [])], "ord long, path string, path_norm string, hash string, chain array<string>")
    bin_ = spark.createDataFrame([(1, "x", "x", "hx")], "ord long, path string, path_norm string, hash string")
    cmd = spark.createDataFrame([(1, "mycc"), (2, "mypy"), (3, "cp")], "cmd_idx long, tool string")
    dep, out = edge([(1, "a.c", "h1"), (2, "b.py", "h2"), (3, "o", "ho")]), edge([(1, "o", "ho"), (2, "q", "hq"), (3, "x", "hx")])
    tools = spark.createDataFrame([("compilers", "mycc"), ("interpreters", "mypy"), ("other", "cp")], "role string, tool string")

    def run(roles):
        b = passes.Build(src, bin_, cmd, dep, out, roles)
        good = passes.good(b)
        second = {r.path: r.category for r in passes.pass2(b, passes.pass1(b), good).collect()}
        return sorted(r[0] for r in good.collect()), second, {r.path: r.category for r in passes.pass3(b, good).collect()}

    assert run(passes.roles_of(tools)) == ([1, 3], {"a.c": "direct", "b.py": "direct"}, {"b.py": "executed"})
    # without compilers only direct outputs count and pass 2 moves nothing; without interpreters pass 3 is empty
    assert run(passes.Roles((), (), ("mypy",))) == ([3], {"a.c": "direct", "b.py": "direct"}, {"b.py": "executed"})
    assert run(passes.Roles(("other",), (), ())) == ([1, 3], {"a.c": "not_compiled", "b.py": "direct"}, {})
