import json

from buildlens.sources import lists
from buildlens.streaming.tools import tool_counts


def test_lists(spark, tmp_path):
    (tmp_path / "b.txt").write_text("TYPE          PATH\n------------  ----\nELF           bin/x y.iso_dir/f\nOTHER         bin/q\nBINARY_EXT    a.class\n\nELF\n")
    got = [tuple(r) for r in lists.read_binary_list(spark, [str(tmp_path / "b.txt")]).collect()]
    assert got == [("ELF", "bin/x y.iso_dir/f"), ("BINARY_EXT", "a.class")]
    (tmp_path / "t.yaml").write_text("# roles\nutilities:\n  compilers:\n    - gcc  # C\n    - g++\n    - 'rustc'\n  linkers: [ld, \"ar\"]\n  other:\n    - gcc\n    - true\n")
    got = sorted(tuple(r) for r in lists.read_tools(spark, str(tmp_path / "t.yaml")).collect())
    assert got == [("compilers", "g++"), ("compilers", "gcc"), ("compilers", "rustc"), ("linkers", "ar"), ("linkers", "ld"), ("other", "gcc"), ("other", "true")]


def test_stream(spark, tmp_path):
    for k, commands in enumerate(([["/usr/bin/gcc", "a.c"], []], [["gcc"], ["ld"]])):
        (tmp_path / f"{k}.json").write_text(json.dumps({"component_commands": [{"command": c} for c in commands]}))
    stream = tool_counts(spark, str(tmp_path), 1).writeStream.format("memory").queryName("tools").outputMode("complete").trigger(availableNow=True).start()
    stream.awaitTermination(120)
    assert {r.tool: r.commands for r in spark.table("tools").collect()} == {"gcc": 2, "ld": 1, "__no_command__": 1}
