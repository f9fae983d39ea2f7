from pyspark.sql import functions as F

from buildlens.functions import packages
from buildlens.plans import binaries
from buildlens.plans.passes import Build


def h(n):
    return f"{n:064x}"


def build(spark, src, bin_, cmd, dep, out):
    edge = "cmd_idx long, pos int, path string, path_norm string, hash string"
    edges = lambda rows: spark.createDataFrame([(c, 0, p, p, x) for c, p, x in rows], edge)
    files = lambda rows: spark.createDataFrame([(i, p, p, x) for i, (p, x) in enumerate(rows)], "ord long, path string, path_norm string, hash string")
    return Build(files(src), files(bin_), spark.createDataFrame(cmd, "cmd_idx long, tool string"), edges(dep), edges(out))


def test_pass4_cascade(spark):
    b = build(
        spark,
        src=[("P/src/a.c", h(1)), ("P/src/t.bin", h(2)), ("P/src/r.bin", h(3)), ("P/src/null.c", None)],
        bin_=[
            ("P/bin/d/clean", h(10)), ("P/bin/d/dirty", h(11)), ("P/bin/d/deep", h(12)), ("P/bin/d/t", h(2)), ("P/bin/d/r", h(3)), ("P/bin/d/pre", h(20)),
            ("P/bin/usr/lib/x.so", h(10)), ("P/bin/d/y.deb_dir/f", h(99)), ("P/bin/d/nohash", None), ("P/bin/d/apt.deb_dir/f", h(10)), ("P/bin/d/zz", "0xzz"),
        ],
        cmd=[(1, "gcc"), (2, "ld"), (3, "ld"), (4, "cp"), (5, "gcc")],
        dep=[(1, "a.c", h(1)), (1, "/usr/include/s", h(30)), (2, "/opt/v.a", h(31)), (3, "mid.o", h(13)), (4, "/opt/tool", h(20)), (4, "r.bin", h(3)), (5, "/opt/w.a", h(32)), (4, "clean", h(10))],
        out=[(1, "clean", h(10)), (2, "dirty", h(11)), (3, "deep", h(12)), (4, "copy", h(12)), (5, "mid.o", h(13))],
    )
    apt = spark.createDataFrame([("apt.deb",)], "container string")
    got = {r.path.removeprefix("P/bin/"): r.category for r in binaries.pass4(b, apt).collect()}
    assert got == {
        "d/clean": "compiled_from_src", "d/dirty": "external_built", "d/deep": "compiled_from_src", "d/t": "untraced_from_src", "d/r": "binaries_from_src",
        "d/pre": "external_prebuilt", "usr/lib/x.so": "system_binaries", "d/y.deb_dir/f": "untraced_external", "d/nohash": "untraced_external",
        "d/apt.deb_dir/f": "apt_package_content", "d/zz": "untraced_external",
    }
    # an input of an input belongs to the intermediate file, not to the distribution's
    external = {(r.bin_key, r.path) for r in binaries.scan(b).external.collect()}
    assert external == {(h(11)[-16:], "/opt/v.a"), (h(13)[-16:], "/opt/w.a")}
    content = [tuple(r) for r in binaries.package_content(binaries.pass4(b, apt)).collect()]
    assert content == [("P/bin/d/y.deb_dir/f", h(99), "deb", "y.deb")]


def test_pass4_on_cycles_and_empty_tables(spark):
    cycle = build(spark, [], [("P/bin/a", h(1))], [(1, "gcc"), (2, "gcc")], [(1, "b", h(2)), (2, "a", h(1))], [(1, "a", h(1)), (2, "b", h(2))])
    assert [r.category for r in binaries.pass4(cycle).collect()] == ["compiled_from_src"]
    empty = build(spark, [], [], [], [], [])
    assert binaries.pass4(empty).collect() == []


def test_packages(spark):
    rows = [
        ("b/x.DEB_dir/site-packages/p/f", "deb", "x.DEB"), ("b/x.rpm_dir/y.deb_dir/f", "deb", "x.rpm"), ("v/site-packages/p/f.py", "pip", "p"),
        ("v/lib/dist-packages/__pycache__/f", "pip", "lib"), ("site-packages", "pip", "unknown"), ("site-packages/__x/f", "pip", "unknown"), ("a/w.whl_dir/f", "pip", "w.whl"),
        ("a/node_modules/@s/n/f", "npm", "@s/n"), ("a/node_modules/n/f", "npm", "n"), ("a\\node_modules\\m\\f", "npm", "m"), ("a/b", None, None), ("", None, None), (None, None, None),
    ]
    got = spark.createDataFrame([(r[0],) for r in rows], "p string").select("p", packages.package(F.col("p")).alias("s")).select("p", "s.*").collect()
    assert [tuple(r) for r in got] == rows
    system = [
        ("P/bin/usr/lib/f", True), ("P/bin/d/usr/lib/f", False), ("P/bin/a.iso_dir/etc/f", True), ("P/bin/a.iso_dir/b.tar/x/lib/f", False),
        ("P/bin/a.deb_dir/usr/lib/f", False), ("/usr/lib/f", True), ("usr/bin/lib/f", True), ("P/bin/a.iso", False),
    ]
    got = spark.createDataFrame([(r[0],) for r in system], "p string").select(packages.is_distro_system(F.col("p"))).collect()
    assert [r[0] for r in got] == [r[1] for r in system]


def test_transitive_java_and_filtered(spark):
    b = build(
        spark,
        src=[("P/src/A.java", h(1)), ("P/src/x$y.java", h(2))],
        bin_=[("P/bin/d/deep", h(10)), ("P/bin/d/far", h(14)), ("P/bin/d/A$In.class", h(20)), ("P/bin/d/x$Q.class", h(21)), ("P/bin/d/lib", h(22)), ("P/bin/d/lib2", h(22))],
        cmd=[(1, "ld"), (2, "gcc"), (3, "ld"), (4, "ld"), (5, "ld"), (6, "javac"), (7, "javac"), (8, "gcc"), (9, "cp")],
        dep=[
            (1, "a.o", h(11)), (2, "/opt/v.c", h(30)), (3, "m2", h(13)), (4, "m3", h(12)), (5, "a.o", h(11)), (6, "/opt/Q.class", h(31)), (7, "/opt/Q.class", h(31)), (7, "/opt/A.class", h(33)),
            (8, "/opt/z.so.1", h(34)), (8, "/opt/z.so", h(35)), (8, "/usr/include/s.h", h(36)), (8, "/etc/c", None), (9, "/opt/r.hpp", h(37)), (9, "/opt/r.hpp", h(38)),
        ],
        out=[(1, "deep", h(10)), (2, "a.o", h(11)), (3, "far", h(14)), (4, "m2", h(13)), (5, "m3", h(12)), (6, "A$In.class", h(20)), (7, "x$Q.class", h(21)), (8, "lib", h(22)), (9, "lib", h(22))],
    )
    direct, transitive = binaries.pass4(b), binaries.pass4(b, transitive=True)
    classes = lambda df: {r.path.removeprefix("P/bin/d/"): r.category for r in df.collect()}
    assert {k for k, v in classes(direct).items() if v == "external_built"} == {"A$In.class", "lib", "lib2", "x$Q.class"}
    # one step to /opt/v.c is direct for a.o, two for deep, four for far, which is too many
    changed = {k: v for k, v in classes(transitive).items() if classes(direct)[k] != v}
    assert changed == {"deep": "external_built"}
    trusted = {r.path.removeprefix("P/bin/d/"): (r.category, r.deps_removed) for r in binaries.trusted_java(b, direct).collect()}
    assert trusted == {"A$In.class": ("compiled_from_src", None), "x$Q.class": ("external_built", 1), "lib": ("compiled_from_src", 1), "lib2": ("compiled_from_src", 1)}
    rows = [(r.path, r.dep_path, r.dep_hash, r.reason) for r in binaries.filtered_dependencies(b, direct).collect()]
    assert rows in ([("P/bin/d/lib2", "/opt/r.hpp", x, "header")] for x in (h(37), h(38)))
    empty = build(spark, [], [], [], [], [])
    for f in (binaries.trusted_java, binaries.filtered_dependencies):
        assert f(empty, binaries.pass4(empty, transitive=True)).collect() == []


def test_the_walk_writes_keys_that_matter_alone(spark, monkeypatch):
    # of 200 inputs of system folders none is written, of the other inputs keys without paths and hashes
    dep = [(1, f"/usr/include/s{k}", h(1000 + k)) for k in range(200)] + [(1, "/opt/v.a", h(31)), (1, "a.c", h(1))]
    b = build(spark, [("P/src/a.c", h(1))], [("P/bin/d/x", h(11)), ("P/bin/d/i", h(1003))], [(1, "gcc")], dep, [(1, "x", h(11))])
    written, real = [], binaries.saved
    monkeypatch.setattr(binaries, "saved", lambda df: written.append(real(df)) or written[-1])
    scanned = binaries.scan(b)
    assert sum(w.count() for w in written) < 20 and not any({"path", "hash"} & set(w.columns) for w in written)
    assert [tuple(r) for r in scanned.external.collect()] == [(h(11)[-16:], "/opt/v.a", h(31))]
    assert {r.path: r.category for r in binaries.pass4(b, scanned=scanned).collect()} == {"P/bin/d/x": "external_built", "P/bin/d/i": "external_prebuilt"}
    assert {tuple(r) for r in binaries.filter_statistics(scanned).collect()} == {("system", 200, 99), ("suspicious", 1, 0), ("src", 1, 0)}


def test_suspicious_inputs_are_judged_among_those_of_their_commands(spark, monkeypatch):
    b = build(
        spark, src=[], bin_=[("P/bin/a", h(1))], cmd=[(1, "gcc"), (2, "gcc")],
        dep=[(1, "/opt/v.a", h(31)), (1, "/opt/v.a", h(31)), (1, "/usr/include/s", h(31)), (1, "/opt/w.a", h(32)), *((2, f"/opt/{k}", h(100 + k)) for k in range(50))], out=[(1, "a", h(1)), (2, "b", h(2))],
    )
    s = binaries.scan(b)
    written, real = [], binaries.saved
    monkeypatch.setattr(binaries, "saved", lambda df: written.append(real(df)) or written[-1])
    files = binaries.suspicious_files(s, s.found.select("cmd_idx").distinct())
    assert sorted((r.cmd_idx, r.path) for r in files.collect()) == [(1, "/opt/v.a"), (1, "/opt/v.a"), (1, "/opt/w.a")]
    assert [w.count() for w in written] == [2, 4]
    assert "SortMergeJoin" not in files._jdf.queryExecution().executedPlan().toString()
