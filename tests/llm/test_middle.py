import hashlib
import random
import re

import pytest

from buildlens.llm import middle

DOCS = "doc_id long, text string, n long, form string, output string"


def plain(doc_id, text, rate=100, spm=50):
    """(n, form, lengths, output) by lists of lines."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    form = "spm" if h4 % 100 < spm else "psm"
    return len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def rows():
    rng = random.Random(5)
    made = [(k, "".join(rng.choice(["a", "ж", "𝔘", "\n", "<", "P>", "S", "\r", " "]) for _ in range(rng.randint(0, 60)))) for k in range(300)]
    odd = [(None, "no id\nhere"), (None, None), (900, None), (901, ""), (902, "\n\n\n"), (903, "one <M> marker\n"), (904, "line\n" * 200_000), (905, "x" * 2_000_000), (906, "same\nrow"), (906, "same\nrow"), (2**60 + 1, "a\nb\nc")]
    return [(*r, 5, "own", "own") for r in made + odd]


@pytest.mark.parametrize(("rate", "spm"), [(100, 50), (40, 0), (0, 50), (100, 100)])
def test_cuts_match_plain_ones(spark, rate, spm):
    given = rows()
    docs = spark.createDataFrame(given, DOCS)
    found = middle.transform(docs, rate=rate, spm=spm)
    got = [tuple(r) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(((i, *plain(i, t, rate, spm)) for i, t, *_ in given), key=repr)
    back = found.select("doc_id", middle.restored("output", "form").alias("text")).collect()
    assert sorted((r.doc_id or -1, r.text) for r in back) == sorted((i or -1, t or "") for i, t, *_ in given)
    sums = {(r.doc_id, r.output_sha256, r.restored_sha256) for r in middle.digests(found).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sums == {(i, sha(plain(i, t, rate, spm)[4]), sha(t or "")) for i, t, *_ in given}


def test_empty_tables_and_other_units(spark):
    docs = spark.createDataFrame(rows(), DOCS)
    assert middle.transform(docs.limit(0)).count() == middle.digests(middle.transform(docs.limit(0))).count() == 0
    # units that leave a rest without a match: it belongs to the suffix
    words = middle.transform(spark.createDataFrame([(k, "ab cd ef") for k in range(40)], "doc_id long, text string"), unit=r"\S+ ")
    assert {r.n for r in words.collect()} == {2}
    assert {r.text for r in words.select(middle.restored("output", "form").alias("text")).collect()} == {"ab cd ef"}


def test_markers_that_could_overlap_are_refused():
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("aa", "b", "c"), ("ab", "bc", "x"), ("abc", "b", "x")):
        with pytest.raises(ValueError):
            middle.checked(bad)
    with pytest.raises(ValueError):
        middle.joined("no marker here", "psm")
