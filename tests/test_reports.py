"""Files, archives, reports, runs, searches and the command line, on small folders."""

import bz2
import gzip
import http.server
import io
import json
import random
import tarfile
import threading
import zipfile
from datetime import datetime

from buildlens import __main__ as cli
from buildlens import sinks
from buildlens.functions import magic, text
from buildlens.operators import naming, unpack
from buildlens.plans import binaries, languages, passes, runs, summaries, tools
from buildlens.sources import files, hotspots, lists, trace
from pyspark.sql import functions as F


def zipped(**members):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for name, content in members.items():
            z.writestr(name.replace("__", "/").replace("DOT", "."), content)
    return data.getvalue()


def tarred(mode, **members):
    data = io.BytesIO()
    with tarfile.open(fileobj=data, mode=mode) as t:
        for name, content in members.items():
            info = tarfile.TarInfo(name.replace("DOT", "."))
            info.size = len(content)
            t.addfile(info, io.BytesIO(content))
    return data.getvalue()


ELF = b"\x7fELF\x02\x01\x01" + bytes(9) + b"\x02\x00" + bytes(40)
PE = b"MZ" + bytes(58) + (64).to_bytes(4, "little") + b"PE\0\0" + bytes(20) + b"\x0b\x02" + bytes(30)


def test_magic_and_kinds(spark):
    cases = {
        ELF: ("ELF 64-bit LSB executable", "ELF"), ELF.replace(b"\x02\x00", b"\x01\x00", 1): ("ELF 64-bit LSB relocatable", None), PE: ("PE32+ executable", "PE32"), b"MZ" + bytes(100): ("MS-DOS executable", "MSDOS"),
        zipped(a="x"): ("Zip archive data", None), gzip.compress(b"x"): ("gzip compressed data", None), b"": ("empty", None), b"hello": ("data", None), tarred("w:", a=b"x"): ("POSIX tar archive", None),
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "k int, content binary")
    got = rows.select("k", magic.magic(F.substring("content", 1, magic.HEADER)).alias("w")).select("k", "w", magic.executable(F.col("w")).alias("t")).orderBy("k").collect()
    assert [(r.w, r.t) for r in got] == list(cases.values())


def test_archives_within_archives(spark):
    inner = zipped(deep__aDOTtxt="deep", bDOTtgz=tarred("w:gz", cDOTc=b"int x;"))
    given = {
        "p/outer.zip": zipped(innerDOTzip=inner, readme="hi"), "p/plain.gz": gzip.compress(b"plain"), "p/t.tar": tarred("w:", xDOTpy=b"pass"), "p/noname": bz2.compress(b"z" * 100), "p/bad.zip": b"PK\x03\x04" + bytes(40),
        "p/tiny.zip": b"PK", "p/lib.jar": zipped(ADOTclass="c"), "p/skip.zip": zipped(a="never"), "p/up.zip": zipped(**{"DOTDOT__DOTDOT__evil": "e"}),
    }
    made, log = unpack.unpack(spark.createDataFrame(list(given.items()), "path string, content binary"), skip="skip")
    found = {r.path: bytes(r.content) for r in made.collect()}
    assert {k: v for k, v in found.items() if k not in given} == {
        "p/outer.zip_dir/inner.zip": inner, "p/outer.zip_dir/readme": b"hi", "p/outer.zip_dir/inner.zip_dir/deep/a.txt": b"deep", "p/outer.zip_dir/inner.zip_dir/b.tgz": found["p/outer.zip_dir/inner.zip_dir/b.tgz"],
        "p/outer.zip_dir/inner.zip_dir/b.tgz_dir/c.c": b"int x;", "p/plain.gz_dir/plain": b"plain", "p/t.tar_dir/x.py": b"pass", "p/noname_dir/noname": b"z" * 100, "p/up.zip_dir/evil": b"e",
    }
    events = {(r.path, r.event) for r in log.collect()}
    assert {("p/bad.zip", "failed"), ("p/tiny.zip", "too_small"), ("p/skip.zip", "skipped"), ("p/outer.zip", "unpacked")} <= events and not any(p == "p/lib.jar" for p, _ in events)


def test_names(spark):
    names = {"Отдел".encode("cp1251"): "Отдел", "plain".encode(): "plain", "ё".encode(): "ё", None: None}
    rows = spark.createDataFrame([(k, n) for k, n in enumerate(names)], "k int, name binary")
    assert [r.n for r in rows.select("k", text.repaired(F.col("name")).alias("n")).orderBy("k").collect()] == list(names.values())
    rng = random.Random(1)
    wanted = [(f"f{rng.randrange(2)}", rng.choice(["a.txt", "b", "a_1.txt", "a_2.txt", "b_1"]), k) for k in range(30)]
    got = naming.unique_names(spark.createDataFrame(wanted, "folder string, name string, ord int"), keep_extension=True).collect()
    assert len({(r.folder, r.unique) for r in got}) == 30
    first = {}
    for r in sorted(got, key=lambda r: r.ord):
        assert first.setdefault((r.folder, r.name), r.unique) == r.name or r.unique != r.name
    row = spark.range(1).select(
        text.shown_command(F.array(*map(F.lit, "abcdefgh"))).alias("a"), text.shown_command(F.array(F.lit("x"))).alias("b"), text.json_escaped(F.lit('a"b\n\\')).alias("c"), text.snapshot_name(F.lit("P"), "_v1").alias("d")
    ).first()
    assert (row.a, row.b, row.c, row.d) == ("a b c d e f ...", "x", 'a\\"b\\n\\\\', "P_v1")


def test_languages(spark):
    rows = spark.createDataFrame([(".ts",), (".RB",), (".c",), (".xyz",)], "ext string")
    got = languages.language_sets(rows).first()
    assert got.to_analyze == ["ruby", "typescript"] and set(got.to_exclude) == set(languages.EXTENSIONS) - {"ruby", "typescript"}
    shown = spark.range(1).select(languages.exclusions(F.array(F.lit("go"), F.lit("c")), 2).alias("e")).first().e.split(",")
    assert shown[-4:] == ["**/*.c", "**/*.h", "**/*.go", "**/*_dir/**/*_dir/**"] and shown[: len(languages.STANDARD_EXCLUSIONS)] == list(languages.STANDARD_EXCLUSIONS)
    deep = spark.createDataFrame([("a.zip_dir/b.zip_dir/" + "x" * 400 + ".c",), ("a.zip_dir/" + "y" * 400,), ("short",)], "path string")
    assert languages.depth_needed(deep, "k").first().depth == 1 and languages.depth_needed(deep.limit(1), "k").first().depth == 2
    assert languages.depth_needed(deep.filter("path = 'short'"), "k").first().depth is None
    assert {r.ext: r.files for r in languages.long_path_histogram(deep, "k").collect()} == {".c": 1, "no_extension": 1}
    tried = []
    assert languages.first_that_works(lambda d: (d == 2, True) if not tried.append(d) else None) == (True, 2) and tried == [None, 3, 2]
    assert languages.first_that_works(lambda d: (False, False)) == (False, None)
    present = files.languages_present(spark.createDataFrame([("a/b.py",), ("c.JS",)], "path string"), {"python": (".py",), "javascript": (".js",)}).first()
    assert (present.python, present.javascript) == (True, False)


def test_runs(spark, tmp_path):
    assert runs.load(spark, str(tmp_path / "none")).count() == 0
    day = datetime(2024, 1, 1)
    old = spark.createDataFrame([("a", "exported", day), ("b", "exported", day), ("c", "never", None)], "project_name string, hotspots_status string, hotspots_exported_at timestamp")
    kinds = [c.split(" ") for c in runs.RUN.split(", ")]
    known = old.withColumns({n: F.lit(None).cast(t) for n, t in kinds if n not in old.columns}).select(*(n for n, _ in kinds))
    results = spark.createDataFrame([("a", "success"), ("b", "failed"), ("d", "success")], "project_name string, status string").withColumns({n: F.lit(None).cast(t) for n, t in kinds if n in runs.RESULT and n != "status"})
    results = results.withColumns({"server_url": F.lit("http://s"), "project_key": F.lit("k"), "languages_analyzed": F.array(F.lit("b"), F.lit("a"))})
    new = runs.with_results(known, results)
    got = {r.project_name: r for r in new.collect()}
    assert {k: (r.hotspots_status, r.hotspots_exported_at) for k, r in got.items()} == {"a": ("exported", day), "b": ("never", None), "c": ("never", None), "d": ("never", None)}
    assert got["a"].dashboard_url == "http://s/dashboard?id=k" and got["a"].languages_analyzed == ["a", "b"] and got["a"].error_message == ""
    states = spark.createDataFrame([("c", "exported", day), ("a", "failed", day), ("zz", "exported", day)], "project_name string, state string, at timestamp")
    done = runs.with_states(new, states, "hotspots_status", "hotspots_exported_at", "exported")
    assert {r.project_name: (r.hotspots_status, r.hotspots_exported_at) for r in done.collect()} == {"a": ("failed", None), "b": ("never", None), "c": ("exported", day), "d": ("never", None)}
    assert {r[0] for r in runs.to_do(done.select("project_name"), done, "hotspots_status", "exported").collect()} == {"a", "b", "d"}
    one, two = (spark.createDataFrame(x, "project string, total int") for x in ([("p", 1), ("q", 2)], [("p", 5)]))
    assert sorted(map(tuple, runs.profiles(one, two).collect())) == [("p", 5), ("q", 2)]


def test_reports_and_folders(spark, tmp_path):
    at = str(tmp_path)
    rows = spark.createDataFrame([("b", "2"), ("a", '"1'), ("a", '"1'), (None, "3"), (None, None)], "path string, hash string")
    assert sinks.write_category_json(rows, f"{at}/x.json", "direct") == 5
    doc = json.loads((tmp_path / "x.json").read_text())
    assert (doc["category"], doc["total"], [f["path"] for f in doc["files"]]) == ("direct", 5, ["", "", "a", "a", "b"])
    assert sinks.write_tsv(rows, f"{at}/x.txt", "direct") == f"{at}/x.txt" and sinks.write_tsv(rows.limit(0), f"{at}/y.txt", "none") == f"{at}/y_EMPTY.txt"
    assert [x for x in (tmp_path / "x.txt").read_text().split("\n") if not x.startswith("#")] == ["\t3", 'a\t"1', "b\t2", ""]
    assert [tuple(r) for r in files.read_report(spark, [f"{at}/x.txt"]).collect()] == [("", "3"), ("a", '"1'), ("b", "2")]
    assert sinks.versioned(spark, f"{at}/x.json") == f"{at}/x_v1.json" and sinks.versioned(spark, f"{at}/new.json") == f"{at}/new.json"
    for k in (1, 2, 4):
        (tmp_path / "runs" / f"try{k}").mkdir(parents=True)
    assert sinks.run_folder(spark, f"{at}/runs", keep=True) == f"{at}/runs/try3"
    assert sinks.run_folder(spark, f"{at}/runs") == f"{at}/runs/try1" and sorted(p.name for p in (tmp_path / "runs").iterdir()) == ["try4"]
    content = spark.createDataFrame([("f1", "h1", "deb", "x.deb", "s", "apt"), ("f0", "h0", "deb", "x.deb", "s0", None), ("g", "", "pip", "p", "", "pip")], "path string, hash string, package_type string, container string, source string, command string")
    assert sinks.write_packages(summaries.packages(content), f"{at}/p.json") == f"{at}/p.json" and sinks.write_packages(summaries.packages(content), f"{at}/p.json") == f"{at}/p_v1.json"
    doc = json.loads((tmp_path / "p.json").read_text())
    assert (doc["total_files"], doc["total_packages"], [(p["container"], p["files_count"], p["source"], p["command"]) for p in doc["packages"]]) == (3, 2, [("x.deb", 2, "s0", "deb"), ("p", 1, "", "pip")])
    sinks.write_package_tsv(content, f"{at}/p.txt")
    assert (tmp_path / "p.txt").read_text().split("\n")[2] == "# Total files: 3, Total packages: 2"
    assert sinks.copy_reports(spark, {"x.txt": (f"{at}/x.txt", "text"), "y.txt": (f"{at}/y_EMPTY.txt", "none")}, f"{at}/summary") == ["x.txt"]
    assert "`x.txt`: text" in (tmp_path / "summary" / "README.md").read_text()
    sinks.write_categories(rows.withColumn("category", F.lit("c")), f"{at}/cats")
    sinks.write_by_disk(spark.createDataFrame([("P/src/d1/a", "h", "redundant"), ("q", "h", "redundant")], "path string, hash string, category string"), f"{at}/disks")
    assert sorted(p.name for p in (tmp_path / "disks" / "category=redundant").iterdir()) == ["disk=d1", "disk=unknown"]
    sinks.write_xlsx(spark.createDataFrame([("a<b", 1), (None, 2)], "name string, n int"), f"{at}/r.xlsx", {"name": 40})
    with zipfile.ZipFile(f"{at}/r.xlsx") as z:
        sheet = z.read("xl/worksheets/sheet1.xml").decode()
    assert "a&lt;b" in sheet and 'autoFilter ref="A1:B3"' in sheet and 'state="frozen"' in sheet and 'width="40"' in sheet


def test_totals(spark):
    rows = spark.createDataFrame([(c,) for c in ["direct"] * 3 + ["parent", "redundant", "not_compiled", "executed", "not_used", "compiled_from_src"]], "category string")
    t = summaries.totals(rows).first()
    assert (t.total_source, t.total_interpreted, t.total_all, t.redundant_all, t.used_all, t.total_binaries) == (5, 2, 7, 2, 5, 1)
    lines = sinks.summary_lines("P", summaries.shares(rows).collect(), t)
    assert any("direct" in x and "60.0%" in x for x in lines) and any("redundant" in x and "28.6%" in x for x in lines)
    assert summaries.totals(rows.limit(0)).first().total_all == 0


def test_binary_entries_try_four_ways(spark, tmp_path):
    entries = [("P/bin/a.iso/f", "h1"), ("P/bin/g", "h2"), ("bin/k", "old"), ("/bin/k", "h3"), ("P/bin/a.iso_dir/f", "h4"), ("bin/x", "  ")]
    shapes = {"list.json": [{"path": p, "hash": h} for p, h in entries], "sig.json": {"signatures": [{"path": p, "hash": h} for p, h in entries], "files": []}, "files.json": {"files": [{"path": p, "hash": h} for p, h in entries]}}
    (tmp_path / "b.txt").write_text("TYPE          PATH\nELF           bin/a.iso_dir/f\nELF           bin/g\nPE32          bin/k\nELF           bin/none\nELF           bin/g\n")
    listed = lists.read_binary_list(spark, [str(tmp_path / "b.txt")])
    for name, shape in shapes.items():
        (tmp_path / name).write_text(json.dumps(shape))
        known = lists.read_path_hashes(spark, [str(tmp_path / name)])
        got = sorted(tuple(r) for r in lists.binary_entries(listed, known, "P").collect())
        assert got == [("P/bin/a.iso/f", "h1"), ("P/bin/g", "h2"), ("P/bin/g", "h2"), ("P/bin/k", "h3")]


def test_searches(spark, tmp_path):
    rows = [
        {"id": 1, "command": ["/usr/bin/apt", "download", *"abcdef"], "output": {f"o{k}.deb": "h" for k in range(7)}, "dependencies": ["d1", "d2", "d3", "d4"]},
        {"id": 2, "command": ["python3.9"], "modified": [{"path": "x/Foo.cpython-39.pyc", "hash": "new", "pre_hash": "was"}], "output": {"foo.PYC": " hh "}}, {"id": 3, "command": []},
    ]
    (tmp_path / "t.json").write_text(json.dumps({"component_commands": rows}))
    commands = trace.read_commands(spark, [str(tmp_path)])
    match = tools.tool_matches(commands, ["apt", "ython"]).orderBy("cmd_idx").collect()
    assert [(r.tool, r.file, len(r.command), len(r.outputs), r.inputs) for r in match] == [("apt", "t.json", 6, 5, ["d1", "d2", "d3"]), ("python3.9", "t.json", 1, 1, [])]
    by = lambda **k: sorted((r.id, r.section, r.path, r.hash) for r in tools.find_file(commands, **k).collect())
    assert by(hash_="was") == [(2, "modified", "x/Foo.cpython-39.pyc", "new")] and by(hash_="hh") == [(2, "output", "foo.PYC", "hh")]
    assert by(name="foo.py") == [(2, "modified", "x/Foo.cpython-39.pyc", "new"), (2, "output", "foo.PYC", "hh")]
    assert tools.by_command(tools.find_file(commands, name="foo")).first().files[0].section == "modified"
    cmd = commands.select("cmd_idx", tools.tool_of(F.col("command")).alias("tool"), F.col("command").alias("argv"))
    assert tuple(tools.tool_totals(cmd).first()) == (3, 1, 3) and [r.tool for r in tools.tool_samples(cmd, 1, ["apt"]).collect()] == ["apt"]
    b = passes.Build(None, None, cmd, trace.edges(commands, "dependencies"), trace.edges(commands, "output"))
    assert sorted(r[0] for r in binaries.apt_containers(b).collect()) == [f"o{k}.deb" for k in range(7)]


def test_hotspots_of_a_service(spark):
    found = {s: [{"ruleKey": f"{s}{k}", "component": "P:a.py", "vulnerabilityProbability": "HIGH", "line": k} for k in range(n)] for s, n in (("TO_REVIEW", 7), ("REVIEWED", 0))}

    class Answer(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            q = dict(x.split("=") for x in self.path.split("?")[1].split("&"))
            rows, size, page = found[q["status"]], int(q["ps"]), int(q["p"])
            self.send_response(200 if q["projectKey"] == "P" else 404)
            self.end_headers()
            self.wfile.write(json.dumps({"paging": {"total": len(rows)}, "hotspots": rows[(page - 1) * size : page * size]}).encode())

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    spark.dataSource.register(hotspots.HotspotSource)
    rows = spark.read.format("hotspots").option("url", url).option("project", "P").option("pagesize", 3).load().collect()
    server.shutdown()
    assert sorted(r.ruleKey for r in rows) == [f"TO_REVIEW{k}" for k in range(7)] and rows[0].message is None


def test_the_command_line(spark, tmp_path):
    base = tmp_path
    (base / "unpacked/P/src/d1").mkdir(parents=True)
    (base / "unpacked/P/src/d1/a.c").write_text("int a;")
    (base / "unpacked/P/src/d1/b.c").write_text("int b;")
    (base / "unpacked/P/src/d1/t.py").write_text("pass")
    (base / "unpacked/P/src/.queue.x").write_text("no")
    (base / "unpacked/P/bin/x.deb_dir").mkdir(parents=True)
    (base / "unpacked/P/bin/x.deb").write_bytes(b"deb")
    (base / "unpacked/P/bin/x.deb_dir/prog").write_bytes(ELF)
    assert cli.main(["sign", str(base)], spark) == 0 and cli.main(["profile", str(base), "-p", "P"], spark) == 0
    src = {s["path"]: s for s in json.loads((base / "results/P/sources/P_src.json").read_text())["signatures"]}
    own = {s["path"]: s for s in json.loads((base / "results/P/sources/P_bin.json").read_text())["signatures"]}
    assert sorted(src) == ["P/src/d1/a.c", "P/src/d1/b.c", "P/src/d1/t.py"]
    assert own["P/bin/x.deb"]["archive"] == 1 and own["P/bin/x.deb/prog"]["parents_chain"] == [own["P/bin/x.deb"]["hash"]]
    assert json.loads((base / "results/P/ext/extensions_src.json").read_text())["extensions"] == {".c": 2, ".py": 1}
    assert (base / "results/P/ext/binaries_in_bin.txt").read_text().split("\n")[2] == "ELF           bin/x.deb_dir/prog"
    commands = [
        {"command": ["gcc", "a.c"], "dependencies": {"d1/a.c": src["P/src/d1/a.c"]["hash"]}, "output": {"prog": own["P/bin/x.deb/prog"]["hash"]}},
        {"command": ["python3", "t.py"], "dependencies": {"t.py": src["P/src/d1/t.py"]["hash"]}, "output": {}},
    ]
    (base / "builds/P").mkdir(parents=True)
    (base / "builds/P/t.json").write_text(json.dumps({"component_commands": commands}))
    assert cli.main(["analyze", str(base), "-d"], spark) == 0
    at = base / "results/P/reports/try1"
    read = lambda c: json.loads((at / f"P_{c}.json").read_text())["files"]
    assert [f["path"] for f in read("redundant")] == ["P/src/d1/b.c"] and [f["path"] for f in read("compiled_from_src")] == ["P/bin/x.deb/prog"]
    assert json.loads(read("executed")[0]["commands"]) == ["python3 t.py"] and "direct" in (at / "summary.txt").read_text() and (at / "by_disk").exists()
    assert cli.main(["analyze", str(base), "--together"], spark) == 0
    rows = spark.read.json(f"{base}/together/classes").collect()
    assert {(r.project, r.category, r.path) for r in rows} >= {("P", "redundant", "P/src/d1/b.c"), ("P", "compiled_from_src", "P/bin/x.deb/prog")}
    sums = {(r.project, r.section, r.category): r.files for r in spark.read.json(f"{base}/together/summary").collect()}
    assert sums[None, None, None] == len(rows) == sums["P", None, None] and sums["P", "source", "redundant"] == 1
    for argv in (["sql", str(base), "-q", "SELECT * FROM files_of_class('redundant')"], ["search", str(base), "--tools", "gcc", "--packages", "a.c"], ["sample", str(base), "-n", "1"], ["trace", str(base), "-f", "t.py"]):
        assert cli.main(argv, spark) == 0
    assert cli.main(["analyze", str(base), "-p", "missing"], spark) == 1
