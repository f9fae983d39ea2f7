import itertools
import posixpath
from pathlib import PurePosixPath

from pyspark.sql import functions as F

from buildlens.functions import paths as P
from buildlens.functions import text as X


def test_paths_match_posixpath(spark):
    parts = ["", ".", "..", "a", "b.c", ".x", "..y.z", "m.tar.gz", "x."]
    every = sorted({"/".join(c) for n in (1, 2, 3) for c in itertools.product(parts, repeat=n)} | {"/" + "/".join(c) for c in itertools.product(parts, repeat=2)} | {"//a/b", "///a"})
    p = F.col("p")
    rows = spark.createDataFrame([(x,) for x in every], "p string").select("p", P.basename(p).alias("b"), P.splitext(p).alias("e"), P.normpath(p).alias("n"), P.name(p).alias("m")).collect()
    for r in rows:
        assert r.b == posixpath.basename(r.p)
        assert r.e == posixpath.splitext(r.p)[1]
        assert r.n == posixpath.normpath(r.p)
        assert r.m == PurePosixPath(r.p).name


def test_rules(spark):
    p = F.col("p")
    rows = [("P/bin/d1/x.iso_dir/y.deb_dir/usr/f", "y.deb", "d1"), ("P/bin/d3/x.DEB_dir/f", "x.DEB", "d3"), ("P/src/d2/a.c", None, "d2"), ("a/b", None, "unknown")]
    got = spark.createDataFrame([(r[0],) for r in rows], "p string").select("p", P.container(p).alias("c"), P.disk(p).alias("d")).collect()
    assert [tuple(r) for r in got] == rows
    names = [("x/a.tar.gz", ".tar.gz"), ("a.TAR.Z", ".tar.Z"), (".bashrc", ".bashrc"), ("x.", "."), ("README", "no_extension"), ("a.tar.lz4", ".tar.lz4")]
    got = spark.createDataFrame([(n[0],) for n in names], "p string").select(P.shell_extension(p)).collect()
    assert [r[0] for r in got] == [n[1] for n in names]
    stems = [("l/A.cpython-311.pyc", "a"), ("m.pyo", "m"), ("n.py", "n"), ("o.txt", "o.txt")]
    got = spark.createDataFrame([(n[0],) for n in stems], "p string").select(P.stem(p)).collect()
    assert [r[0] for r in got] == [n[1] for n in stems]


def test_text(spark):
    rows = [("Привет мир.txt", "PRIVET_MIR.TXT"), ("щука__x", "SCHUKA_X"), ("Щёлк ЁЛКА", "SCHELK_ELKA"), (" a ", "A"), (None, None)]
    got = spark.createDataFrame([(r[0],) for r in rows], "s string").select(X.transliterate(F.col("s"))).collect()
    assert [r[0] for r in got] == [r[1] for r in rows]
    keys = [("ABCDEF", "0000000000abcdef"), ("f" * 64, "f" * 16), ("0x12", None), ("", None), (None, None)]
    got = spark.createDataFrame([(r[0],) for r in keys], "s string").select(X.hash_key(F.col("s"))).collect()
    assert [r[0] for r in got] == [r[1] for r in keys]
