"""Many projects in one plan give what each gives alone, also where they share hashes, paths, names and command numbers."""

import random

import pytest

from buildlens.__main__ import classified
from buildlens.plans import binaries, passes, summaries

FILE = "project string, ord long, path string, path_norm string, hash string, chain array<string>"
EDGE = "project string, cmd_idx long, pos int, path string, path_norm string, hash string"
NAMES = ["P", "Q"]


def made(seed):
    rng = random.Random(seed)
    h = lambda k: f"{k:040x}"
    endings = [".c", ".py", ".java", ".o", ".so.1", ".class", ".h", ""]
    src, bin_, cmd, dep, out = [], [], [], [], []
    for p in NAMES:
        for k in range(25):
            path = f"{p}/src/d{k % 2}/f{k}{rng.choice(endings)}"
            src.append((p, k, path, path, h(rng.randrange(40)), [h(rng.randrange(40))]))
        for k in range(14):
            path = f"{p}/bin/d1/" + rng.choice(["", "x.deb_dir/", "site-packages/w/"]) + f"b{k}" + rng.choice(["", ".class", ".py"])
            bin_.append((p, 1000 + k, path, path, rng.choice([h(rng.randrange(80)), h(40 + rng.randrange(20)), None]), None))
        for c in range(30):
            tool = rng.choice(["gcc", "ld", "python3", "cp", "apt", "javac"])
            cmd.append((p, c, tool, [tool, "download"] if tool == "apt" else [tool, "-o"]))
            for pos in range(rng.randrange(4)):
                path = rng.choice(["obj/", "/opt/e/", "/usr/lib/"]) + f"i{rng.randrange(12)}{rng.choice(endings)}"
                dep.append((p, c, pos, path, path, rng.choice([h(rng.randrange(80)), None])))
            for pos in range(rng.randrange(3)):
                path = "x.deb" if tool == "apt" else f"obj/i{rng.randrange(12)}{rng.choice(endings)}"
                out.append((p, c, pos, path, path, h(40 + rng.randrange(25))))
    return src, bin_, cmd, dep, out


def build(spark, rows, project=None):
    tables = []
    for found, kind in zip(rows, (FILE, FILE, "project string, cmd_idx long, tool string, argv array<string>", EDGE, EDGE), strict=True):
        df = spark.createDataFrame([r for r in found if project in (None, r[0])], kind)
        tables.append(df.drop("project") if project else df)
    return passes.Build(*tables)


def results(b):
    classes, executed, content, counts = classified(b, True)
    assert {r.category: r["count"] for r in classes.groupBy("category").count().collect()} == {c: n for c, n in counts.items() if n and c != "rows"} and counts["rows"] == classes.count()
    scanned = binaries.scan(b)
    fourth = binaries.pass4(b, scanned=scanned)
    return {
        "classes": classes, "executed": executed, "content": content, "external": passes.merged_aliases(passes.external_dependencies(b)), "filtered": binaries.filtered_dependencies(b, fourth),
        "inputs": binaries.external_inputs(b, fourth, scanned, transitive=True), "transitive": binaries.pass4(b, transitive=True, scanned=scanned),
    }


def rows_of(df, project=None):
    return sorted(((project or r.project, *(r[c] for c in df.columns if c != "project")) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1])
def test_two_projects_in_one_plan_equal_two_runs(spark, seed):
    rows = made(seed)
    both = results(build(spark, rows))
    alone = {p: results(build(spark, rows, p)) for p in NAMES}
    for name, found in both.items():
        want = sorted((r for p in NAMES for r in rows_of(alone[p][name], p)), key=repr)
        assert rows_of(found) == want, name
        assert want or name in ("executed",), name


def test_sums(spark):
    rows = [("P", "direct")] * 3 + [("P", "redundant"), ("P", "copied"), ("Q", "direct"), ("Q", "external_built"), ("Q", "odd")]
    got = {tuple(r)[:3]: (r.files, r.percent) for r in summaries.rollup(spark.createDataFrame(rows, "project string, category string")).collect()}
    assert got[None, None, None] == (8, None if got[None, None, None][1] is None else 100.0)
    assert got["P", None, None] == (5, 62.5) and got["P", "source", None] == (4, 80.0) and got["P", "source", "direct"] == (3, 75.0)
    assert got["Q", "other", "odd"] == (1, 100.0) and got["Q", "binaries", "external_built"] == (1, 100.0) and len(got) == 1 + 2 + 5 + 6
