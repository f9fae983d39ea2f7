"""Tables with columns of other operators' names, repeated rows, empty tables and very long texts."""

from pyspark.sql import functions as F

from buildlens.llm import chat, ivfpq, langid, lines, minhash, neighbours, packing, repetition, sentencepiece, toxicity
from buildlens.llm.queries import tokenizer_file
from tests.llm.test_operators import DOCS, EDGE

CLASH = ["held_out", "score", "list", "shard", "part", "codes", "node", "x", "y", "bands", "place", "at", "rank", "id", "h", "spot", "letters", "ids", "kept", "predicted", "marked_id", "quality", "toxic", "o", "last", "n_turns", "copies", "kept_id"]


def test_other_columns_do_not_matter(spark):
    docs = spark.createDataFrame(EDGE, DOCS)
    wide = docs.withColumns({c: F.lit("own") for c in CLASH})
    marks = spark.createDataFrame([(k, k % 2, k % 2) for k in range(30)], "doc_id long, quality int, toxic int")
    bpe, piece = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    operators = [
        langid.identify, repetition.judge, lambda d: packing.pack(d, bpe), lambda d: toxicity.score(d, marks), lambda d: sentencepiece.digests(d, piece),
        minhash.duplicates, lambda d: lines.dedup(d).select("doc_id", "text", "removed"), lambda d: neighbours.score(d, marks),
    ]
    for op in operators:
        assert sorted(map(str, op(wide).collect())) == sorted(map(str, op(docs).collect()))
        assert op(wide.limit(0)).count() == 0
    vectors = spark.createDataFrame([(k, [float(k % 7 + 1), 1.0]) for k in range(60)] + [(None, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(map(str, ivfpq.search(vectors.withColumns({c: F.lit("own") for c in CLASH})).collect())) == sorted(map(str, ivfpq.search(vectors).collect()))


def test_chat_on_odd_tables(spark):
    kind = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 0, "user", "a"), (4, 0, "user", "long " * 50_000), (5, None, None, None), (6, 0, None, "")]
    talks = spark.createDataFrame(rows, kind)
    got = {r.conv_id: r for r in chat.render(talks).collect()}
    # 2 begins 1; the repeated row makes two turns of 3; 5 and 6 are equal, so the smaller id stays
    assert set(got) == {1, 3, 4, 5} and got[3].n_turns == 2 and got[5].copies == 2 and len(got[4].rendered) > 250_000
    wide = talks.withColumns({c: F.lit("own") for c in ("o", "place", "last", "n_turns", "copies", "kept_id", "turns", "x", "y", "r", "a", "b")})
    assert sorted(map(str, chat.render(wide).collect())) == sorted(map(str, chat.render(talks).collect()))
    assert chat.render(talks.limit(0)).count() == 0
