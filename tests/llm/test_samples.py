import numpy as np

from buildlens.llm import neighbours, toxicity

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def marked(spark, column):
    """1500 rows, one in ten of which has the rare mark."""
    rows = [(k, "web", "en", 20, f"word{k % 7} other{k % 11} text{k}") for k in range(1500)]
    marks = [(k, int(k % 10 > 0) if column == "quality" else int(k % 10 == 0)) for k in range(1500)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, f"doc_id long, {column} int")


def test_voters_have_the_marks_natural_shares(spark, monkeypatch):
    docs, labels = marked(spark, "quality")
    whole = neighbours.train(docs, labels).marks
    assert len(whole) > 1000 and 0.85 < np.mean(whole) < 0.95
    monkeypatch.setattr(neighbours, "TRAIN_ROWS", 100)
    bounded = neighbours.train(docs, labels).marks
    assert 140 < len(bounded) < 260 and 0.83 < np.mean(bounded) < 0.97


def test_toxicity_learns_from_natural_shares(spark, monkeypatch):
    docs, labels = marked(spark, "toxic")
    monkeypatch.setattr(toxicity, "TRAIN_ROWS", 100)
    marks = [r.toxic for r in toxicity._marked(docs, labels).collect()]
    assert 140 < len(marks) < 260 and 0.03 < np.mean(marks) < 0.17
    # no term tells the marks apart: the score is the share of toxic rows, not one half
    assert toxicity.score(docs, labels).filter("score > 0.3").isEmpty()
