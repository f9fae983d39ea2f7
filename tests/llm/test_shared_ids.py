import random

from buildlens.llm import graph, minhash


def test_a_unique_text_stays_beside_a_copy_with_its_id(spark):
    copied, unique = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    docs = spark.createDataFrame([(3, copied), (5, copied), (5, unique), (7, copied)], "doc_id long, text string")
    left = {(r.doc_id, r.text) for r in minhash.keep(docs).collect()}
    assert {(3, copied), (5, unique)} <= left and (7, copied) not in left


def test_texts_that_share_an_id_are_linked_by_their_own_words(spark):
    one, two, far = (" ".join(f"{c}{k}" for k in range(40)) for c in "abc")
    docs = spark.createDataFrame([(1, one), (1, two), (2, one), (3, two), (0, two + " more"), (9, far), (9, None)], "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.duplicates(docs).collect()}
    assert got[2, 36] == (1, False) and got[3, 36] == (0, False) and got[0, 37] == (0, True) and got[9, 36] == got[9, 0] == (9, True)
    assert sorted((r.component_id, r.kept) for r in minhash.duplicates(docs).filter("doc_id = 1").collect()) == [(0, False), (1, True)]


def test_a_path_needs_few_rounds(spark, monkeypatch):
    written = []
    real = graph.saved
    monkeypatch.setattr(graph, "saved", lambda df: written.append(1) or real(df))
    n = 4096
    found = graph.components(spark.createDataFrame(list(zip([0, *range(n - 1, 1, -1)], range(n - 1, 0, -1), strict=True)), "a long, b long"))
    assert found.count() == n and found.filter("component <> 0").isEmpty()
    assert len(written) <= 20


def test_a_shuffled_path_needs_few_contractions(spark, monkeypatch):
    rounds = []
    real = graph._ends
    monkeypatch.setattr(graph, "_ends", lambda p: rounds.append(1) or real(p))
    way = list(range(1024))
    random.Random(2).shuffle(way)
    found = graph.components(spark.createDataFrame(list(zip(way[:-1], way[1:], strict=True)), "a long, b long"))
    assert found.count() == 1024 and found.filter("component <> 0").isEmpty() and len(rounds) <= 10


def test_components_match_a_search(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(400, k) for k in range(401, 480)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    ends = {x for a, b in links if a != b for x in (a, b)}
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in ends}


def test_columns_of_any_name_pass(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6, 7), (2, "a b", 5, 6, 7)], "doc_id long, text string, gone_id long, node long, component_id long")
    left = minhash.keep(docs)
    assert left.columns == docs.columns and [r.doc_id for r in left.collect()] == [1]
