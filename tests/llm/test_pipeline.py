"""The pipeline stage by stage against plain versions of what each stage should keep, and its odd tables."""

from collections import defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from buildlens.llm import neighbours
from buildlens.llm.queries import tokenizer_file
from tests.llm.test_operators import DOCS, EDGE, WORD, brute_components, brute_lines

SF = "/root/testdata/sf0.001"


def plain_repeats(words):
    """Length of the longest substring from each word on that occurs elsewhere, by growing windows."""
    longest, n = [0] * len(words), 1
    while True:
        at = defaultdict(list)
        for i in range(len(words) - n + 1):
            at[tuple(words[i : i + n])].append(i)
        twice = [i for places in at.values() if len(places) > 1 for i in places]
        for i in twice:
            longest[i] = n
        if not twice:
            return longest
        n += 1


def passes_rules(text):
    words = WORD.findall(text or "")
    longest = plain_repeats(words)
    in_windows = {i + k for i, m in enumerate(longest) if m >= 8 for k in range(8)}
    covered = {i + k for i, m in enumerate(longest) if m >= 8 for k in range(m)}
    peak = max(longest, default=0)
    return len(words) >= 20 and 100 * len(in_windows) <= 30 * len(words) and len(covered) <= 0.3 * len(words) and not (peak >= 24 and peak > 0.15 * len(words))


def test_each_stage_does_its_whole_job(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 20000 OR text IS NULL").cache()
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns
    before = docs.collect()

    docs = stages["quality rules"](spark, docs, SF).cache()
    rows = docs.collect()
    assert docs.columns == columns and sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in before if passes_rules(r.text))

    # a vote among all voters, one text at a time
    voters = neighbours.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    vectors = voters.vectors_of(pa.array([r.text for r in rows]))
    good = []
    for r, v in zip(rows, vectors, strict=True):
        cosine = np.clip(voters.vectors @ v, 0, 1).astype(float)
        near = np.argsort(-cosine, kind="stable")[: neighbours.NEAREST]
        weight = cosine[near] ** neighbours.POWER + 1e-9
        if (weight * voters.marks[near]).sum() / weight.sum() >= 0.3:
            good.append(r.doc_id)
    docs = stages["quality classifier"](spark, docs, SF).cache()
    rows = docs.collect()
    assert docs.columns == columns and sorted(r.doc_id for r in rows) == sorted(good)

    want = {i: t for i, t in brute_lines([(r.doc_id, r.text) for r in rows], 50).items() if WORD.search(t)}
    docs = stages["line dedup"](spark, docs, SF).cache()
    rows = docs.collect()
    assert docs.columns == columns and {r.doc_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)

    component = brute_components([(r.doc_id, r.text) for r in rows])
    docs = stages["near dedup"](spark, docs, SF).cache()
    rows = docs.collect()
    assert docs.columns == columns and {r.doc_id for r in rows} == {i for i, (_, c) in component.items() if i == c}

    tokenizer = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    pieces, filled = defaultdict(list), defaultdict(int)
    for p in sorted(stages["packing"](spark, docs, SF).collect(), key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled[p.sequence_id]
        filled[p.sequence_id] += p.length
        pieces[p.doc_id].append(p)
    assert max(filled.values()) <= 1024 and set(pieces) == {r.doc_id for r in rows}
    for r in rows:
        assert [i for p in sorted(pieces[r.doc_id], key=lambda p: p.start) for i in p.ids] == [*tokenizer.encode(r.text, add_special_tokens=False).ids, 0]


def test_stages_on_odd_tables(spark):
    """Nulls, empty texts, repeated rows and ids, columns named as those that the operators use, tables without n_chars, empty tables."""
    extra = ["gone_id", "removed", "kept", "score", "component_id", "doc", "place", "node", "key", "_salt"]
    docs = spark.createDataFrame(EDGE, DOCS).withColumns({c: F.lit(f"own {c}") for c in extra})
    for table in (docs, docs.limit(0), docs.drop("n_chars", "lang", "source")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, table, SF)
            assert left.dtypes == table.dtypes, name
            rows = left.collect()
            assert all(r[c] == f"own {c}" for r in rows for c in extra if c in table.columns), name
        corpus_pipeline.STAGES[-1][1](spark, table, SF).collect()
    lines = corpus_pipeline.line_dedup(spark, docs, SF).collect()
    assert sorted(str(r.doc_id) for r in lines) == sorted(str(r[0]) for r in EDGE)
    near = corpus_pipeline.near_dedup(spark, docs, SF).collect()
    assert sum(r.doc_id == 5 for r in near) == 2 and sum(r.doc_id is None for r in near) == 1
