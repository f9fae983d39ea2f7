from buildlens import sql
from buildlens.plans import binaries, summaries
from tests.test_projects import build, made


def test_passes_in_sql_equal_the_functions(spark):
    b = build(spark, made(1), "P")
    names = sql.register(spark, b, "p_")
    assert {"p_pass4", "p_inputs", "p_files_of_class", "p_commands_that_made"} <= set(names)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    fourth = binaries.pass4(b)
    assert rows(spark.sql("SELECT * FROM p_pass4")) == rows(fourth)
    kind = fourth.first().category
    assert set(rows(spark.sql(f"SELECT * FROM p_files_of_class('{kind}')"))) >= set(rows(fourth.filter(f"category = '{kind}'").select("path", "hash")))
    assert rows(spark.sql("SELECT * FROM p_inputs_of(3)")) == rows(b.dep.filter("cmd_idx = 3").select("pos", "path", "hash"))
    at = b.out.filter("path LIKE 'obj/%'").first()
    assert (at.cmd_idx,) in rows(spark.sql(f"SELECT cmd_idx FROM p_commands_that_made('{at.path}')"))
    joined = spark.sql("SELECT tool, count(*) AS n FROM p_commands JOIN p_good_commands USING (cmd_idx) GROUP BY tool")
    assert joined.agg({"n": "sum"}).first()[0] == spark.table("p_good_commands").count()


def test_counts_without_a_job(spark):
    rows = spark.createDataFrame([(c,) for c in ["direct"] * 7 + ["redundant"] * 2 + ["not_compiled", "executed", "copied", "external_built"] * 3 + ["not_used"]], "category string")
    watched, seen = summaries.observed(rows)
    watched.write.format("noop").mode("overwrite").save()
    counts = seen.get
    spark.sparkContext.setJobGroup("summary", "no job")
    shares, totals = summaries.summary_of(counts)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("summary")
    spark.sparkContext.setJobGroup("other", "")
    assert sorted(map(tuple, shares)) == sorted(map(tuple, summaries.shares(rows).select("section", "category", "files", "percent").collect()))
    assert totals.asDict() == summaries.totals(rows).first().asDict() and counts["rows"] == 22
