import random

from pyspark.sql import functions as F

from buildlens.operators import reach


def test_sets_match_a_walk_and_stay_linear_in_edges(spark, monkeypatch):
    rng = random.Random(5)
    edges = {(p, rng.randrange(40), rng.randrange(40)) for p in "PQ" for _ in range(70)}
    own = {(p, rng.randrange(40), rng.choice([1, 2, 32768, 32769, 65536, 65537, (1 << 33) + 1, (1 << 33) + 32768])) for p in "PQ" for _ in range(25)}
    written = []
    real = reach.saved
    monkeypatch.setattr(reach, "saved", lambda df: written.append(real(df)) or written[-1])
    sets = reach.reached(spark.createDataFrame(sorted(own), "project string, key long, id long"), spark.createDataFrame(sorted(edges), "project string, key long, used long"), 2, ["project"])
    want = set(own)
    for _ in range(2):
        want |= {(p, k, i) for p, k, u in edges for q, v, i in want if (p, u) == (q, v)}
    got = [tuple(r) for r in reach.members(sets).select("project", "key", "id").collect()]
    assert len(got) == len(want) and set(got) == want
    assert max(w.count() for w in written) <= (len(edges) + len(own)) * 6
    assert reach.members(sets.limit(0)).count() == 0


def test_numbers_are_distinct(spark):
    found = reach.numbered(spark.range(1000).select(F.col("id").alias("path")), "path")
    assert found.select("id").distinct().count() == 1000 and found.agg(F.min("id")).first()[0] >= 1
