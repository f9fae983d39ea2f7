from buildlens.plans import signatures


def test_parent_chain(spark):
    files = [("a.iso", "1"), ("a.iso_dir/b.deb", "2"), ("a.iso_dir/b.deb_dir/usr/f", "3"), ("c.zip_dir/f", "4"), ("d/n.tar", ""), ("d/n.tar_dir/f", "5"), ("plain", None), (None, "6"), ("/a.iso_dir/f", "7")]
    got = {r.path: (r.virtual_path, r.parents_hash, r.parents_chain) for r in signatures.parent_chain(spark.createDataFrame(files, "path string, hash string")).collect()}
    assert got["a.iso_dir/b.deb_dir/usr/f"] == ("a.iso/b.deb/usr/f", "2", ["2", "1"])
    assert got["a.iso_dir/b.deb"] == ("a.iso/b.deb", "1", ["1"])
    assert len(got) == len(files) and all(v[1:] == ("0", []) for k, v in got.items() if not (k or "").startswith("a.iso_dir"))
