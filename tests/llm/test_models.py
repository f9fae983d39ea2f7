"""Learned operators against plain versions: the chain's links and folds, cosines and votes, the search over several shards, unigram pieces."""

import random
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece as theirs

from buildlens.llm import ivfpq, neighbours, packing, sentencepiece, subwords, text, toxicity
from buildlens.llm.queries import tokenizer_file


def plain_logistic(x, y, rounds=4000):
    """The same ridge model by plain gradient steps."""
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        w = w - 0.02 * (x.T @ (p - y) + toxicity.RIDGE * w)
        b -= 0.02 * ((p - y).sum() + 1e-3 * b)
    return w, b


def test_links_match_a_plain_fit():
    rng = np.random.default_rng(1)
    x = (rng.random((80, 4)) < 0.4).astype(float)
    y = (x[:, 0] + rng.random(80) > 0.9).astype(float)
    w, (v, b) = toxicity.fit(x, y, 60), plain_logistic(x, y)
    assert np.allclose(w, [*v, b], atol=2e-2)


def test_later_links_learn_from_probabilities_out_of_their_fold():
    rng = np.random.default_rng(2)
    n = 400
    toxic = (rng.random(n) < 0.3).astype(float)
    x = np.stack([((rng.random(n) < 0.6) & (toxic == 1)) | (rng.random(n) < 0.02) for _ in range(6)], axis=1).astype(float)
    fold = np.array([crc32(str(k).encode()) // 5 % toxicity.FOLDS for k in range(n)])
    made = toxicity.chain(x, toxic, fold, {f"t{k}": k for k in range(6)})
    groups, held = made.groups, np.zeros((n, 0))
    targets = [toxic * (x[:, groups == g].sum(1) > 0) for g in range(toxicity.CATEGORIES)] + [toxic]
    for link, y in zip(made.links, targets, strict=True):
        assert np.allclose(link, toxicity.fit(np.hstack([x, held]), y))
        out = np.zeros(n)
        for f in range(toxicity.FOLDS):
            rest = [k for k in range(n) if fold[k] != f]
            share = toxic[rest].mean()
            used = [t for t in range(6) if x[rest, t].sum() >= 3 and (x[rest, t] @ toxic[rest] - x[rest, t].sum() * share) / np.sqrt(x[rest, t].sum() * share * (1 - share)) >= toxicity.LEAST_Z]
            columns = np.hstack([x[:, used], held])
            w = toxicity.fit(columns[rest], y[rest])
            for k in range(n):
                if fold[k] == f:
                    out[k] = 1 / (1 + np.exp(-(columns[k] @ w[:-1] + w[-1])))
        held = np.hstack([held, out[:, None]])
    p = made.probabilities(x)
    assert np.allclose(p[:, 0], 1 / (1 + np.exp(-(x @ made.links[0][:-1] + made.links[0][-1])))) and p.shape == (n, 4)


def test_votes_match_a_search_of_all_voters():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(120)]
    texts += texts[:30]  # ties
    terms = []
    for t in texts:
        _, place, weight = neighbours.counted(pa.array([t]))
        terms.append((place, weight))
    marks = np.array([rng.random() < 0.6 for _ in texts], float)
    voters = neighbours.fit(terms, marks)
    asked = pa.array([*texts[:40], "", None, "quite other words"])
    vectors = voters.vectors_of(asked)
    assert np.allclose(np.linalg.norm(voters.vectors, axis=1), 1, atol=1e-5)
    cosine = np.clip(vectors @ voters.vectors.T, 0, 1)
    for k, score in enumerate(voters.votes(vectors)):
        near = sorted(range(len(texts)), key=lambda j: (-cosine[k, j], j))[: neighbours.NEAREST]
        weight = [float(cosine[k, j]) ** neighbours.POWER + 1e-9 for j in near]
        assert abs(score - sum(w * marks[j] for w, j in zip(weight, near, strict=True)) / sum(weight)) < 1e-6
    assert neighbours.fit([], np.zeros(0)).votes(np.zeros((2, 1))).tolist() == [0.5, 0.5]


def test_projection_keeps_the_largest_part_of_the_terms():
    rng = random.Random(4)
    texts = [" ".join(rng.choices([f"{c}{k}" for k in range(20)], k=30)) for c in "ab" for _ in range(40)]
    terms = [neighbours.counted(pa.array([t]))[1:] for t in texts]
    voters = neighbours.fit(terms, np.array([0.0] * 40 + [1.0] * 40))
    text_no, place = np.repeat(np.arange(80), [len(p) for p, _ in terms]), np.concatenate([p for p, _ in terms])
    dense = np.zeros((80, neighbours.WIDTH))
    dense[text_no, place] = neighbours.weighted(text_no, place, np.concatenate([w for _, w in terms]), 80, voters.idf)
    _, s, _ = np.linalg.svd(dense, full_matrices=False)
    kept = np.linalg.norm(dense @ voters.axes) ** 2
    assert abs(kept - (s[: voters.axes.shape[1]] ** 2).sum()) < 1e-3 * kept


def embeddings(spark, x, ids=None):
    return spark.createDataFrame([(int(i), [float(v) for v in row]) for i, row in zip(ids or range(len(x)), x, strict=True)], "vec_id long, embedding array<double>")


def test_search_over_shards_lists_and_groups(spark, monkeypatch):
    """A query scores less than half of the rows and still finds nine of ten."""
    monkeypatch.setattr(ivfpq, "SHARD_ROWS", 300)
    monkeypatch.setattr(ivfpq, "QUERY_BLOCK", 100)
    monkeypatch.setattr(ivfpq, "RERANK", 64)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(0, 40, 6000)] + 0.5 * rng.normal(size=(6000, 24))
    x[1000:3000] = centres[0] + 0.05 * rng.normal(size=(2000, 24))  # a list that needs several shards
    got = ivfpq.search(embeddings(spark, x).withColumnRenamed("x", "x"), least_rows=0).toPandas()
    assert got.groupby("query_id").size().tolist() == [20] * 300
    hits = 0
    for q, mine in got.groupby("query_id"):
        score = (x[q] * x).sum(1)
        score[q] = -np.inf
        best = np.lexsort((np.arange(6000), -score))[:20]
        hits += len({*best.tolist()} & {*mine.vec_id.tolist()})
        assert np.allclose(mine.sort_values("rank").score, np.sort(score[mine.vec_id])[::-1], atol=1e-12, rtol=0)
    assert hits >= 0.9 * 20 * 300


def test_rows_scored_are_those_of_probed_lists(monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 16))
    index = ivfpq.fit(x, 60)
    at = index.assign(x)
    sizes = np.bincount(at, minlength=60)
    chosen = ivfpq.probes(index, x[:50], sizes, 1400)
    held = (chosen * sizes).sum(1)
    assert (held >= 1400).all() and (held < 1400 + sizes.max()).all() and held.mean() < 1500
    left = pd.DataFrame({"vec_id": np.arange(3000), "v": list(x), "list": at, "codes": [c.tobytes() for c in index.encode(x, at)]})
    right = pd.DataFrame({"query_id": np.arange(50), "v": list(x[:50]), "lists": [np.flatnonzero(c) for c in chosen]})
    found, scored = ivfpq.best_of(index, left, right, 20)
    assert scored == held.sum() and found.groupby("query_id").size().tolist() == [20] * 50
    assert all(chosen[q, at[v]] and q != v for q, v in zip(found.query_id, found.vec_id, strict=True))
    first, many, shards = ivfpq.plan(np.array([10, 9000, 0, 4000, 200]))
    assert (first.tolist(), many.tolist(), shards) == ([0, 1, 4, 4, 5], [1, 3, 1, 1, 1], 6)


def test_every_query_gets_its_neighbours(spark):
    """Nineteen vectors near the query, and thousands of copies of the opposite one in one list."""
    rng = np.random.default_rng(7)
    near = rng.normal(size=(19, 8)) * 0.1 + 1
    x = np.vstack([near, np.tile(-np.ones(8), (4999, 1))])
    got = ivfpq.search(embeddings(spark, x)).toPandas()
    mine = got[got.query_id == 0].sort_values("rank")
    assert len(mine) == 20 and set(mine.vec_id[:18]) == set(range(1, 19)) and mine.vec_id.iloc[18:].tolist() == [19, 20]
    few = ivfpq.search(embeddings(spark, near[:5], [0, 20, 20, 3, 4]).selectExpr("vec_id", "embedding", "1 AS list", "2 AS shard")).toPandas()
    assert len(few[few.query_id == 0]) == 4 and set(few[few.query_id == 20].vec_id) == {0, 3, 4}


def field(number, kind, value):
    def varint(n):
        out = b""
        while n > 0x7F:
            out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
        return out + bytes([n])

    return varint(number << 3 | kind) + (varint(value) if kind == 0 else value if kind == 5 else varint(len(value)) + value)


def unigram_model(tmp_path):
    """A small unigram model, written by hand in the format of its library."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *((f"<0x{b:02X}>", -9.0, 6) for b in range(256))]
    pieces += [("▁", -2.5, 1), *((c, -4.0 - k / 7, 1) for k, c in enumerate("abcdeo,.")), ("ab", -3.1, 1), ("▁ab", -3.3, 1), ("abc", -4.1, 1), ("▁a", -3.4, 1), ("cd", -3.7, 1), ("bcd", -4.4, 1), ("▁de", -4.05, 1)]
    body = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, np.float32(s).tobytes()) + field(3, 0, k)) for p, s, k in pieces)
    trainer = field(3, 0, 1) + field(35, 0, 1)
    normalizer = field(1, 2, b"identity") + field(3, 0, 1) + field(4, 0, 0) + field(5, 0, 1)
    path = str(tmp_path / "unigram.model")
    with open(path, "wb") as f:
        f.write(body + field(2, 2, trainer) + field(3, 2, normalizer))
    return path


def test_unigram_models_have_their_librarys_ids(spark, tmp_path):
    path = unigram_model(tmp_path)
    rng = random.Random(8)
    texts = ["", "abcd", "ab abc", " a", "é", "abcdé, de", "日a", *("".join(rng.choices("abcdeo,. é", k=rng.randint(0, 25))) for _ in range(200))]
    assert theirs.SentencePieceProcessor(model_file=path).encode("ab")  # it reads the model
    assert sentencepiece.parity(texts, path) == []
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(None, None)], "doc_id long, text string")
    assert sentencepiece.encode(docs, path).count() == len(texts) + 1


def test_ids_are_those_of_the_plain_call(monkeypatch):
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    plain, own = Tokenizer.from_file(path), subwords.byte_bpe(path)
    monkeypatch.setattr(subwords, "CACHE_PARTS", 500)
    rng = random.Random(9)
    pool = ["a", "b", "é", " ", "  ", "\n", "<|endoftext|>", "<|", "|>", "'s", "1", "日", "ß", "don't", "word", ".", " the", "\t", " ", "😀", "x" * 300]
    for _ in range(60):
        texts = ["".join(rng.choices(pool, k=rng.randint(0, 30))) for _ in range(40)]
        ids, off = own(*text.raw(pa.array(texts)))
        for k, t in enumerate(texts):
            assert ids[off[k] : off[k + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids
    assert own(*text.raw(pa.array(["a <|endoftext|> b"])))[0].tolist() == [64, 220, 50256, 275]


def test_windows_of_powers_of_two_need_no_padding():
    rng = random.Random(10)
    for _ in range(60):
        pos = [0]
        for _ in range(rng.randint(1, 14)):
            pos.append(pos[-1] + rng.randint(1, 10))
        pen = [0, *(rng.choice([0, 2, 5]) for _ in pos[1:])]
        pad = lambda n: 0 if n in (2, 4, 8) else 12 - n
        way = packing.cuts(np.array(pos), np.array(pen), 12, 2)
        best = [0.0] + [float("inf")] * (len(pos) - 1)
        for j in range(1, len(pos)):
            best[j] = min(best[i] + pad(pos[j] - pos[i]) + pen[j] for i in range(j) if pos[j] - pos[i] <= 12)
        assert sum(pad(pos[b] - pos[a]) + pen[b] for a, b in zip([0, *way], way, strict=False)) == best[-1]
    assert packing.in_powers(700) == [512, 128, 32, 16, 8, 4]
