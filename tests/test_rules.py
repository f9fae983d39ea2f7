import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from buildlens import __main__ as cli
from buildlens import sinks, sql
from buildlens.functions import paths, rules
from buildlens.plans import binaries, passes
from buildlens.sources import lists
from tests.test_projects import build, made

PATHS = ["a.c", "a.C", "x/Makefile", "s.sh", "m.py", "m.pyc", "/usr/include/z.h", "/opt/lib/q.so.1", "/opt/q.so", "/lib2/q.so", "d/r.XML", "/opt/z.bin", "/a+b/z.bin", "/aab/z.bin", "", "a.", None]


def kinds(spark, r):
    df = spark.createDataFrame([(k, p) for k, p in enumerate(PATHS)], "k int, p string")
    p = F.col("p")
    checks = {"source": r.is_source, "compiled": r.is_compiled, "interpreted": r.is_interpreted, "python": r.is_python, "system": r.is_system, "resource": r.is_resource, "allowed": r.is_allowed}
    rows = df.select("k", *(f(p).alias(name) for name, f in checks.items())).orderBy("k").collect()
    return {name: {PATHS[x.k] for x in rows if x[name]} for name in checks}


def test_defaults_are_the_fixed_values(spark):
    found = kinds(spark, rules.Rules())
    assert found == {
        "source": {"a.c", "a.C", "x/Makefile", "m.py", "/usr/include/z.h"}, "compiled": {"a.c", "a.C", "/usr/include/z.h"}, "interpreted": {"m.py", "m.pyc"}, "python": {"m.py"},
        "system": {"/usr/include/z.h"}, "resource": {"d/r.XML"}, "allowed": {"/usr/include/z.h", "/opt/lib/q.so.1", "/lib2/q.so"},
    }
    assert rules.Rules().interpreted == paths.INTERPRETED and rules.of({}) == rules.parsed(" ") == rules.Rules()


def test_changed_rules_change_the_answer(spark):
    r = rules.of({"sources": {"add": [".XML"], "remove": [".C"]}, "excluded": [], "build_files": [], "system_folders": ["/a+b/"], "headers": [], "library_parts": [], "library_folders": ["/opt/q"], "python": [".pyc"], "resources": []})
    found = kinds(spark, r)
    assert found["source"] == {"s.sh", "m.py", "/usr/include/z.h", "d/r.XML"}
    assert found["system"] == {"/a+b/z.bin"}  # a folder's name is no pattern
    assert found["allowed"] == {"/a+b/z.bin", "/opt/q.so"} and found["python"] == {"m.pyc"} and found["resource"] == set()
    assert found["interpreted"] == {"s.sh", "m.py", "m.pyc", "d/r.XML"}
    nothing = rules.Rules(*((),) * 11)
    assert not any(kinds(spark, nothing).values())


def test_wrong_rules_are_told():
    for wrong in ({"source": [".c"]}, {"sources": ["c"]}, {"sources": ".c"}, {"sources": {"plus": [".c"]}, }, {"system_folders": [""]}):
        with pytest.raises(ValueError):
            rules.of(wrong)
    with pytest.raises(ValueError):
        rules.parsed("[1]")


def test_rules_reach_every_pass(spark, tmp_path):
    file = tmp_path / "rules.json"
    file.write_text(json.dumps({"compilers": ["cp"], "linkers": [], "interpreters": {"add": ["awk"]}, "system_folders": {"add": ["/ext/"]}}))
    r = lists.read_rules(spark, str(file))
    assert r.roles == rules.Roles(("cp",), (), (*rules.INTERPRETERS, "awk")) and r.system_folders[-1] == "/ext/"
    b = build(spark, made(1), "P")
    assert b.rules == rules.Rules() and b.roles == rules.Roles()
    other = dataclasses.replace(b, rules=r, roles=None)
    assert other.roles == r.roles and dataclasses.replace(b, rules=r).roles == rules.Roles()  # roles that are given stay
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(passes.makers(other)) == rows(b.cmd.filter("tool = 'cp'").select("cmd_idx"))
    # all of the trace's folders as the system's: nothing is suspicious any more
    every = dataclasses.replace(b, rules=rules.of({"system_folders": ["/", "P", "o", "a", "s", "x", "e", "l", "u"]}))
    before = {x.bucket for x in binaries.judged_inputs(b, b.out.limit(0).selectExpr("hash AS key")).select("bucket").distinct().collect()}
    after = {x.bucket for x in binaries.judged_inputs(every, b.out.limit(0).selectExpr("hash AS key")).select("bucket").distinct().collect()}
    assert len(before) > 1 and after == {"system"}
    assert rows(sql.tables(other)["rules"]) == sorted(r.rows(), key=repr)


def test_the_command_line_with_rules_and_parts(spark, tmp_path):
    base = tmp_path
    (base / "unpacked/P/src").mkdir(parents=True)
    (base / "unpacked/P/bin").mkdir()
    (base / "unpacked/P/src/a.c").write_text("int a;")
    (base / "unpacked/P/src/b.foo").write_text("int b;")
    (base / "unpacked/P/bin/prog").write_bytes(b"\x7fELF\x02\x01\x01" + b"\0" * 60)
    assert cli.main(["sign", str(base)], spark) == 0 and cli.main(["profile", str(base), "-p", "P"], spark) == 0
    (base / "builds/P").mkdir(parents=True)
    (base / "builds/P/t.json").write_text(json.dumps({"component_commands": [{"command": ["gcc", "a.c"], "dependencies": {}, "output": {}}]}))
    (base / "rules.json").write_text('{"sources": {"add": [".foo"], "remove": [".c"]}}')
    assert cli.main(["analyze", str(base), "--parts", "--rules", f"{base}/rules.json"], spark) == 0
    folder = base / "results/P/reports/try1/P_redundant.json"
    text = "".join(p.read_text() for p in sorted(folder.iterdir()) if p.name.startswith("part-"))
    assert [f["path"] for f in json.loads(text)["files"]] == ["P/src/b.foo"]
    assert cli.main(["sql", str(base), "-q", "SELECT * FROM rules", "--rules", f"{base}/rules.json"], spark) == 0
    (base / "rules.json").write_text('{"source": []}')
    assert cli.main(["analyze", str(base), "--rules", f"{base}/rules.json"], spark) == 1
    assert spark.conf.get(sinks.PARTS) == "false"
