from pyspark.sql import functions as F

from buildlens import adapters

SF = "/root/testdata/sf0.001"


def test_every_order_and_line_item_is_in_the_build(spark):
    b = adapters.build(spark, SF)
    orders, items = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("orders", "lineitem"))
    every = sorted(r[0] for r in orders.select("o_orderkey").collect())
    assert sorted(r[0] for r in b.cmd.select("cmd_idx").collect()) == every
    assert sorted(r[0] for r in b.out.select("cmd_idx").collect()) == every
    assert sorted(r[0] for r in b.dep.select("cmd_idx").collect()) == sorted(r[0] for r in items.select("l_orderkey").collect())
    assert b.dep.filter("path IS NULL OR hash IS NULL").isEmpty()


def test_inputs_are_those_of_the_relation(spark):
    names = ("documents", "orders", "part", "lineitem")
    frames = {name: spark.read.parquet(f"{SF}/{name}.parquet") for name in names}
    frames["sig"] = adapters.over(spark, adapters.RELATIONS["sig"], **frames)
    got, want = adapters.inputs(spark, frames), adapters.over(spark, adapters.RELATIONS["dep"], **frames)
    assert got.schema == want.schema and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_few_sources_go_to_the_line_items(spark, monkeypatch):
    def dep():
        frames = {name: spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "orders", "part", "lineitem")}
        frames["sig"] = adapters.over(spark, adapters.RELATIONS["sig"], **frames)
        return adapters.inputs(spark, frames)

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = dep()
        assert "SortMergeJoin" not in few._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(adapters, "BROADCAST_BYTES", 0)
        many = dep()
        assert "SortMergeJoin" in many._jdf.queryExecution().executedPlan().toString()
        assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_size_of_sources(spark):
    docs = spark.createDataFrame([("é" * 10, "en"), (None, None)], "source string, lang string")
    assert adapters.small(docs, "source", "lang") and adapters.small(docs.limit(0), "source", "lang")
    wide = docs.select(F.repeat("source", 1 << 19).alias("source"))
    assert not adapters.small(wide, "source")
