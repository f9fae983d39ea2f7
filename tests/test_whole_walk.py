import duckdb
import pytest

from buildlens import catalog
from buildlens.plans import binaries

TABLES = ("documents", "orders", "part", "lineitem")


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """b0, made by gcc from p1, that from p2 and so on to p8, which is made from an external file; commands 5 and 6, that write p5 and p6, read shipped files too."""
    folder = str(tmp_path_factory.mktemp("chain"))
    items = [(k, k + 1, 1) for k in range(8)] + [(8, 500, 5), (5, 100, 1), (6, 103, 1), (8, 0, 1)]
    rows = {
        "documents": ([(1, "int x;", "c", "s", 6)], "doc_id long, text string, lang string, source string, n_chars long"),
        "orders": ([(k, 8) for k in range(9)], "o_orderkey long, o_custkey long"),
        "part": ([(k, 5) for k in (0, 100, 103, 106)] + [(k, 50) for k in range(1, 9)], "p_partkey long, p_size int"),
        "lineitem": ([(o, p, 1, n, 1.0, 1.0, "1995-01-01") for o, p, n in items], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate string"),
    }
    for name in TABLES:
        spark.createDataFrame(*rows[name]).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def by_query(spark, folder, name):
    """Rows of the query, which must be those of its SQL."""
    got = catalog.queries()[name](spark, folder)
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    asked = db.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in asked.description]
    want = sorted((tuple(r) for r in asked.fetchall()), key=repr)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=repr) == want
    return [dict(zip(names, r, strict=True)) for r in want]


def test_packages_are_without_files_that_far_commands_read(spark, chain):
    # files 100 (site-packages) and 103 (x.deb) are read five and six steps away from b0, so they are known; 106 is read by nobody
    assert [(r["package_type"], r["container"], r["files"].split(" ")[0]) for r in by_query(spark, chain, "package_groups")] == [("pip", "p", "P/bin/d2/site-packages/p/b106")]


def test_the_walk_ends_on_cycles_and_goes_from_a_key_once(spark, chain):
    b = catalog._build(spark, chain)
    assert sorted(r.cmd_idx for r in binaries.scan(b, None).touched.collect()) == list(range(9))
    assert sorted(r.cmd_idx for r in binaries.scan(b).touched.collect()) == [0, 1, 2]


def test_external_inputs_count_however_far_away(spark, chain):
    got = {r["path"].rsplit("/", 1)[1]: r["category"] for r in by_query(spark, chain, "pass4_classes_transitive")}
    assert got == {"b0.class": "external_built", "b100": "external_prebuilt", "b103": "external_prebuilt", "b106": "untraced_external"}
    edges = binaries.maker_edges(catalog._build(spark, chain), binaries.scan(catalog._build(spark, chain), None))
    assert [binaries.tainted_within(edges, k).count() for k in (1, 2, 3, None)] == [3, 5, 6, 9]


def test_shares_count_files_that_far_commands_read(spark, chain):
    got = {r["category"]: r["files"] for r in by_query(spark, chain, "summary_shares") if r["section"] == "binaries"}
    assert got == {"compiled_from_src": 1, "external_prebuilt": 2, "untraced_external": 1}
