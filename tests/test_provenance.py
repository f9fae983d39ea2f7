import json
import random

from pyspark.sql import functions as F

from buildlens.operators import closure
from buildlens.operators.closure import good_commands
from buildlens.plans import passes
from buildlens.sources import trace

EDGE = "cmd_idx long, pos int, path string, path_norm string, hash string"


def edges(spark, rows):
    return spark.createDataFrame([(c, k, p, p, h) for k, (c, p, h) in enumerate(rows)], EDGE)


def test_closure_on_a_cycle(spark):
    # 1 and 2 feed each other, 2 feeds 3, whose output is shipped; 4 is apart
    dep = edges(spark, [(1, "b", None), (2, "a", None), (3, None, "hb"), (4, "z", None)])
    out = edges(spark, [(1, "a", "ha"), (2, "b", "hb"), (3, "c", "hc"), (4, "y", "hy")])
    shipped = spark.createDataFrame([("bin/c", "bin/c", "hc")], "path string, path_norm string, hash string")
    assert sorted(r[0] for r in good_commands(dep, out, shipped).collect()) == [1, 2, 3]


def test_pass1_takes_the_nearest_traced_archive(spark):
    src = spark.createDataFrame(
        [(1, "a.c", "a.c", "h1", ["x"]), (2, "b.c", "b.c", "h2", ["no", "arc", "ha"]), (3, "c.c", "c.c", "h3", []), (4, "d.c", "d.c", None, None), (5, "e.c", "e.c", "h5", ["no"])],
        "ord long, path string, path_norm string, hash string, chain array<string>",
    )
    dep = edges(spark, [(1, "a.c", "h1"), (1, "arc", "arc"), (1, "ha", "ha")])
    out = edges(spark, [(1, "o", "ho")])
    shipped = spark.createDataFrame([("bin/c", "bin/c", "h5")], "path string, path_norm string, hash string")
    cmd = spark.createDataFrame([(1, "gcc")], "cmd_idx long, tool string")
    rows = passes.pass1(passes.Build(src, shipped, cmd, dep, out)).orderBy("ord").collect()
    assert [(r.category, r.parent_hash) for r in rows] == [("direct", None), ("parent", "arc"), ("redundant", None), ("redundant", None), ("untraced_in_distrib", None)]


def test_trace_reader_takes_all_shapes(spark, tmp_path):
    first = {"component_commands": [{"id": 7, "command": ["/usr/bin/gcc"], "dependencies": {"/z": "h1", "a/../b": ""}, "output": [{"path": "o", "hash": "h2"}]}]}
    second = {"component_commands": [{"command": ["cp"], "dependencies": ["x", "y"]}]}
    (tmp_path / "a.json").write_text(json.dumps(first))
    (tmp_path / "b.json").write_text(json.dumps(second))
    commands = trace.read_commands(spark, [str(tmp_path)])
    assert [(r.cmd_idx, r.id) for r in commands.orderBy("cmd_idx").collect()] == [(0, 7), (1, None)]
    dep = trace.edges(commands, "dependencies").orderBy("cmd_idx", "pos").collect()
    assert [(r.cmd_idx, r.pos, r.path, r.path_norm, r.hash) for r in dep] == [(0, 0, "/z", "/z", "h1"), (0, 1, "a/../b", "b", None), (1, 0, "x", "x", None), (1, 1, "y", "y", None)]
    assert trace.edges(commands, "output").filter(F.col("hash") == "h2").count() == 1


def test_closure_writes_only_reads_that_meet_a_writer(spark, monkeypatch):
    # 1 reads what 2 and 3 write; nobody writes what 4 and all others read
    dep = edges(spark, [(1, "both", None), (3, None, "aa"), (3, None, "AA")] + [(1000 + k, f"u{k}", f"{k:04x}") for k in range(300)])
    out = edges(spark, [(1, "o", "01"), (2, "both", "b2"), (3, "both", "b3"), (5, "f", "aa"), (6, "g", "AA"), (7, "h", "xaa")])
    shipped = spark.createDataFrame([("bin/o", "bin/o", "01")], "path string, path_norm string, hash string")
    written, real = [], closure.saved
    monkeypatch.setattr(closure, "saved", lambda df: written.append(real(df)) or written[-1])
    assert sorted(r[0] for r in good_commands(dep, out, shipped).collect()) == [1, 2, 3, 5, 6]
    assert sum(w.count() for w in written) < 20


def test_closure_equals_a_walk(spark):
    rng = random.Random(3)
    some = lambda: [(c, rng.choice([None, f"f{rng.randrange(25)}"]), rng.choice([None, f"{rng.randrange(25):02x}"])) for c in range(40) for _ in range(rng.randrange(3))]
    dep, out = some(), some()
    want = {c for c, p, h in out if p in ("f1", "f2") or h in ("03", "04")}
    while more := {c for c, p, h in out for d, q, g in dep if d in want and (p == q and p or h == g and h)} - want:
        want |= more
    shipped = spark.createDataFrame([("f1", "f1", "03"), ("f2", "f2", "04")], "path string, path_norm string, hash string")
    assert sorted(r[0] for r in good_commands(edges(spark, dep), edges(spark, out), shipped).collect()) == sorted(want)


def test_traced_keys_take_half_of_a_hash_and_keep_texts_apart(spark):
    texts = ["ab" * 16, "AB" * 16, "ab" * 16 + "\n", "abc", "é", "", None, "ab" * 16]
    src = spark.createDataFrame([(k, f"{k}.c", f"{k}.c", t, []) for k, t in enumerate(texts)], "ord long, path string, path_norm string, hash string, chain array<string>")
    none = spark.createDataFrame([], "path string, path_norm string, hash string")
    cmd = spark.createDataFrame([(1, "gcc")], "cmd_idx long, tool string")
    for k, text in enumerate(texts):
        b = passes.Build(src, none, cmd, edges(spark, [(1, "p", text)]), edges(spark, []))
        assert [len(r.key) for r in passes.traced_keys(b).collect()] == ([] if text is None else [17 if text == texts[0] else 1 + len(text.encode())])
        assert {r.ord for r in passes.pass1(b).filter("category = 'direct'").collect()} == {j for j, t in enumerate(texts) if t == text and t is not None}


def semi_joins(df):
    """The kinds of left semi joins in the plan; tables made from lists have no known size, so Spark broadcasts none of them."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return {"broadcast" if "BroadcastHashJoin" in line else "shuffled" for line in plan if "LeftSemi" in line}


def test_few_commands_and_sources_are_broadcast(spark):
    src = spark.createDataFrame([(1, "a.c", "a.c", "aa", ["cc"]), (2, "b.c", "b.c", None, None), (3, "c.c", "c.c", "dd", [None, "cc"])], "ord long, path string, path_norm string, hash string, chain array<string>")
    shipped = spark.createDataFrame([("bin/o", "bin/o", "01")], "path string, path_norm string, hash string")
    cmd = spark.createDataFrame([(1, "gcc"), (2, "cp"), (3, "gcc")], "cmd_idx long, tool string")
    dep = edges(spark, [(1, "a.c", "aa"), (2, "x", "bb"), (3, "y", "cc")])
    b = passes.Build(src, shipped, cmd, dep, edges(spark, [(1, "o", "01"), (3, "q", "02")]))
    good = passes.good(b)
    keys = passes.compiler_inputs(b, good)
    assert semi_joins(keys) == {"broadcast"} and sorted(r.key for r in keys.collect()) == ["a.c", "aa"]
    first = passes.pass1(b)
    assert semi_joins(first) == {"broadcast"}
    assert sorted((r.ord, r.category, r.parent_hash) for r in first.collect()) == [(1, "direct", None), (2, "redundant", None), (3, "parent", "cc")]
