from pyspark.sql import functions as F

from buildlens.functions import archives as A
from buildlens.plans import hotspots, packages

from .test_binaries import build, h


def test_index_and_origin(spark):
    b = build(
        spark, [], [],
        cmd=[(1, "apt"), (2, "cp"), (3, "pip3.9"), (4, "wget"), (5, None)],
        dep=[(1, "/m/LibX_1.DEB", h(1)), (3, "/w/Numlib-2.tar", h(2)), (3, "/w/numlib/x", h(3)), (4, "/q", h(4))],
        out=[(1, "d/libx_1.deb", h(5)), (2, "e/libx_1.deb", h(5)), (3, "d/NumLib-2.whl", h(6)), (3, "d/numlib_3.whl", h(6)), (4, "d/z.rpm", h(7)), (5, "d/y.deb", h(8)), (4, "d/plain", h(9))],
    )
    index = packages.package_index(b)
    got = {r.container: (r.package_type, r.source, r.command) for r in index.collect()}
    first = got.pop("numlib_3.whl")
    assert first[0] == "pip" and first[1] in ("/w/Numlib-2.tar", "/w/numlib/x") and first[2] == "pip install"
    assert got == {"libx_1.deb": ("deb", "/m/LibX_1.DEB", "apt download"), "NumLib-2.whl": ("pip", "d/NumLib-2.whl", "pip install"), "z.rpm": ("deb", "d/z.rpm", "wget")}
    rows = [
        ("a", "deb", "libx_1.deb", "/m/LibX_1.DEB", "apt download"), ("b", "deb", "none.deb", "", "deb"), ("c", "pip", "NUMLIB", None, "pip install"), ("d", "pip", "mL", None, "pip install"),
        ("e", "pip", "absent", "", "pip"), ("f", "npm", "numlib", "", "npm"), ("g", "pip", "unknown", "", "pip"),
    ]
    content = spark.createDataFrame([(r[0], h(1), r[1], r[2]) for r in rows], "path string, hash string, package_type string, container string")
    told = {r.path: (r.package_type, r.container, r.source, r.command) for r in packages.content_with_origin(content, index).collect()}
    assert len(told) == len(rows)
    for path, kind, container, source, command in rows:
        assert told[path][:2] == (kind, container) and told[path][3] == command
        assert told[path][2] == source or source is None and told[path][2] != ""
    empty = build(spark, [], [], [], [], [])
    assert packages.content_with_origin(content.limit(0), packages.package_index(empty)).collect() == []


def test_archives(spark):
    rows = [
        ("a/X.TAR.GZ", "gzip compressed data", ["tar_gz", "gzip_plain"], "archive", "MAGIC"), ("b.gz", "", ["tar_gz", "gzip_plain"], "archive", "MAGIC"), ("c.jar", "Zip archive data", ["zip"], "skipped", "BINARY_EXT"),
        ("d", "compress'd data 16 bits", ["compress"], "check", "MAGIC"), ("e.bin", None, [], "check", "MAGIC"), ("f.lz4", "", [], "archive", "MAGIC"), ("g.py", "", [], "other", "SAFE"),
        ("h.zip", "RAR archive", ["zip", "rar"], "archive", "MAGIC"), (None, None, [], "other", "MAGIC"),
    ]
    p = F.col("p")
    got = spark.createDataFrame([r[:2] for r in rows], "p string, m string").select("p", "m", A.plan(p, F.col("m")), A.kind(p), A.triage(p)).collect()
    assert [tuple(r) for r in got] == rows


def test_hotspots(spark):
    schema = "ruleKey string, message string, securityCategory string, vulnerabilityProbability string, component string, line int, status string, resolution string"
    rows = [("r", "a\x01b", "xss", "HIGH", "K:src/a.PY", 3, "REVIEWED", "SAFE"), (None, "m" * 40000, "new", "LOW", "other:Makefile", None, "TO_REVIEW", None), (None,) * 8, ("r", "", "", "MEDIUM", "K:x.", 0, "", "")]
    got = [tuple(r) for r in hotspots.report(spark.createDataFrame(rows, schema), "K").collect()]
    assert got[0] == ("r", "ab", "Cross-Site Scripting (XSS)", "HIGH", "CRITICAL", "Python", "src/a.PY", "3", "REVIEWED", "SAFE", "")
    assert got[1][:1] + got[1][2:] == ("", "new", "LOW", "MINOR", "Unknown", "other:Makefile", "", "TO_REVIEW", "", "")
    assert len(got[1][1]) == 32767 and got[1][1].endswith("...")
    assert got[2] == ("", "", "", "", "MINOR", "Unknown", "", "", "", "", "")
    assert got[3] == ("r", "", "", "MEDIUM", "MAJOR", "Unknown", "x.", "0", "", "", "")
