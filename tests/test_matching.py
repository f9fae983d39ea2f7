import random

from buildlens.operators.matching import holding


def test_many_patterns_equal_the_plain_test(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abCД/.") for _ in range(rng.randint(0, 12))) for _ in range(300)] + [None]
    patterns = ["".join(rng.choice("aBcд/") for _ in range(rng.randint(1, 6))) for _ in range(10_000)] + ["", "A", "a"]
    rows = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "k long, path string, _ string")
    found = holding(rows, "path", patterns, "package")
    want = {(k, p) for k, t in enumerate(texts) if t is not None for p in patterns if p.lower() in t.lower()}
    got = [(r.k, r.package) for r in found.collect()]
    assert len(got) == len(want) and set(got) == want and found.columns == ["k", "path", "_", "package"]
    few = holding(rows, "path", ["a"], "package")
    size = lambda df: len(df._jdf.queryExecution().executedPlan().toString())
    assert abs(size(found) - size(few)) < 20
    assert holding(rows, "path", [], "package").count() == 0 and holding(rows.limit(0), "path", patterns, "package").count() == 0
