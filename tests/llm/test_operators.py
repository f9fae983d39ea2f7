"""Operators against brute force, exact round trips, and edge cases: null, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from buildlens.llm import chat, ivfpq, langid, lines, minhash, neighbours, packing, repetition, sentencepiece, subwords, text, toxicity
from buildlens.llm.queries import tokenizer_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [(None, "no id here", "en", "s", 1), (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t", "en", "s", 3), (4, "x " * 30_000, "en", "s", 9), (5, "same old text of six words", "en", "s", 1), (5, "same old text of six words", "en", "s", 1), (6, "日本語 тест ***", "en", "s", 1)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, (k + 1) % 2) for k in range(40)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")


def brute_repeats(ws):
    out = [0] * len(ws)
    for i in range(len(ws)):
        for j in range(len(ws)):
            k = 0
            while i != j and max(i, j) + k < len(ws) and ws[i + k] == ws[j + k]:
                k += 1
            out[i] = max(out[i], k)
    return out


def test_repeats_and_counts_match_brute_force():
    rng = random.Random(1)
    for _ in range(120):
        texts = [" ".join(rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 5))]
        codes, _, counts = text.words(*text.raw(pa.array(texts)))
        found = repetition.repeats(codes, counts)
        assert found.tolist() == sum((brute_repeats(t.split()) for t in texts), [])
        got = repetition.measured(pa.array(texts))
        for k, t in enumerate(texts):
            ws = WORD.findall(t)
            windows = defaultdict(list)
            for i in range(len(ws) - 7):
                windows[tuple(ws[i : i + 8])].append(i)
            hit = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
            assert (got["n_words"][k], got["n_repeat_words"][k]) == (len(ws), len(hit))
            longest = brute_repeats(ws)
            assert got["longest_repeat"][k] == max(longest, default=0)
            assert got["covered_words"][k] == len({i + j for i, n in enumerate(longest) if n >= 8 for j in range(n)})


def test_rules_on_edges(edge, empty):
    rows = {r.doc_id: r for r in repetition.judge(edge).collect()}
    assert rows[1].n_words == rows[2].n_words == rows[3].n_words == 0 and not rows[1].kept
    assert rows[4].n_words == 30_000 and rows[4].base_failed
    assert repetition.judge(edge).count() == len(EDGE) and repetition.judge(empty).count() == 0
    counted = repetition.measured(pa.array(["a #$ b\na #$ b\n\n", "é |x"]))
    assert counted["n_symbols"].tolist() == [4, 1] and counted["n_dup_lines"].tolist() == [1, 0] and counted["word_chars"].tolist() == [8, 3]


def test_language(spark, edge, empty):
    rng = random.Random(2)
    kinds = {"aa": ["the", "of", "and", "then"], "bb": ["der", "und", "ß", "nicht"]}
    rows = [(k, " ".join(rng.choices(kinds[lang], k=30)), lang, "s", 1) for k in range(200) for lang in [rng.choice(list(kinds))]]
    got = langid.identify(spark.createDataFrame(rows, DOCS)).collect()
    truth = {r[0]: r[2] for r in rows}
    assert all(r.lang_pred == truth[r.doc_id] and 0.99 < r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert {r.doc_id: r.lang_pred for r in langid.identify(edge).collect()}[1] == "und"
    assert langid.identify(empty).count() == 0


def test_code_lengths_match_a_plain_ppm():
    texts = {"a": [b"abracadabra abracadabra"], "b": [b"banana bandana banana"]}
    model = langid.Ppm(texts, order=2, max_contexts=10_000)

    def plain(lang, known, data):
        counts = defaultdict(lambda: defaultdict(int))
        for t in texts[lang]:
            for i in range(len(t)):
                for k in range(3):
                    if i >= k:
                        counts[t[i - k : i]][t[i]] += 1
        total = 0.0
        for i, c in enumerate(data):
            context = next(data[i - k : i] for k in (2, 1, 0) if k <= i and (k == 0 or data[i - k : i] in known))
            while True:
                seen = counts.get(context)
                if seen:
                    n, u = sum(seen.values()), len(seen)
                    if c in seen:
                        total -= np.log2(seen[c] / (n + u))
                        break
                    total -= np.log2(u / (n + u))
                if not context:
                    total += 8
                    break
                context = context[1:]
        return total

    union = defaultdict(int)
    for ts in texts.values():
        for t in ts:
            for k in (1, 2):
                for i in range(len(t) - k + 1):
                    union[t[i : i + k]] += 1
    known = {c for c, n in union.items() if n >= 2}
    for probe in (b"banana", b"abra band", b"cad", b"zz a"):
        bits = model.code_lengths(np.frombuffer(probe, np.uint8), np.array([0, len(probe)]))[:, 0]
        for g, lang in enumerate(model.langs):
            assert abs(bits[g] - plain(lang, known, probe)) < 1e-3


def test_search_finds_what_brute_force_finds(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x[100:300] = x[100]
    rows = [(k, [float(v) for v in row]) for k, row in enumerate(x)] + [(700, None), (720, [0.0] * 16), (740, [float("nan")] * 16), (760, [1.0] * 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ivfpq.search(table).collect()
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append((r.vec_id, r.score))
    full = x.astype(float)
    hits = 0
    assert sorted(found) == list(range(0, 600, 20))
    for q, mine in found.items():
        score = (full[q] * full).sum(1)
        best = [k for k in sorted(range(600), key=lambda k: (-score[k], k)) if k != q][:20]
        hits += len(set(best) & {k for k, _ in mine})
        assert all(abs(s - score[k]) < 1e-12 for k, s in mine) and len(mine) == 20
        assert mine == sorted(mine, key=lambda m: (-m[1], m[0]))
    assert hits >= 0.9 * 20 * len(found)
    assert ivfpq.search(table.limit(0)).count() == 0


def test_packing_keeps_every_id(spark, edge, empty):
    path = tokenizer_file("byte_bpe_50k.json")
    tokenizer = subwords.byte_bpe(path).tokenizer
    rows = packing.pack(edge, path).collect()
    filled = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 1024
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for doc_id, t, *_ in EDGE:
        own = sorted(pieces[doc_id], key=lambda r: (r.start, r.sequence_id, r.offset))
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        copies = 2 if doc_id == 5 else 1
        assert sum(r.length for r in own) == copies * len(ids) and own[0].doc_tokens == len(ids)
        if copies == 1:
            assert [i for r in own for i in r.ids] == ids
    assert packing.pack(empty, path).count() == 0
    crc = {(r.doc_id, r.start): r.ids_crc32 for r in packing.pack(edge, path, digest=True).collect()}
    assert all(crc[r.doc_id, r.start] == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows if r.doc_id != 5)


def test_cuts_are_cheapest():
    rng = random.Random(4)
    for _ in range(60):
        pos = [0]
        for _ in range(rng.randint(1, 14)):
            pos.append(pos[-1] + rng.randint(1, 10))
        pen = [0, *(rng.choice([0, 2, 5]) for _ in pos[1:])]

        def cost(way):
            return sum(12 - (pos[b] - pos[a]) + pen[b] for a, b in zip([0, *way], way, strict=False))

        way = packing.cuts(np.array(pos), np.array(pen), 12)
        best = [0.0] + [float("inf")] * (len(pos) - 1)
        for j in range(1, len(pos)):
            best[j] = min(best[i] + 12 - (pos[j] - pos[i]) + pen[j] for i in range(j) if pos[j] - pos[i] <= 12)
        assert way[-1] == len(pos) - 1 and cost(way) == best[-1]


def test_sentencepiece_parity_and_round_trip(edge, empty):
    path = tokenizer_file("piece_bpe_32k.model")
    texts = ["", "a", " a", "a  b   c\n\n d", "▁x ▁ y", "<s> hi </s>", "日本語😀 x", "\x00\x01 a", "don't, stop... now!"]
    rng = random.Random(5)
    texts += ["".join(rng.choices("ab é\n.▁<0x>", k=rng.randint(0, 30))) for _ in range(200)]
    assert sentencepiece.parity(texts, path) == []
    rows = {r.doc_id: r for r in sentencepiece.encode(edge, path).collect()}
    assert rows[1].ids == [] and rows[1].decoded == "" and rows[6].decoded == EDGE[-1][1]
    assert all(r.round_trip for r in sentencepiece.digests(edge, path).collect()) and sentencepiece.encode(empty, path).count() == 0


def brute_components(rows):
    sets = {}
    for i, t in rows:
        ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(tuple(ws[k : k + 5]) for k in range(len(ws) - 4)) if len(ws) >= 5 else frozenset([tuple(ws)] if ws else [])
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates_match_brute_force(spark, edge, empty):
    rng = random.Random(6)
    rows, words = [], [f"w{k}" for k in range(400)]
    for base in range(12):
        ws = rng.choices(words, k=rng.randint(3, 120))
        for _ in range(8):
            own = list(ws)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((len(rows) + 10, " ".join(own).upper() if base % 2 else "  ".join(own)))
    rows += [(1, ""), (2, None), (3, "one"), (4, "ONE")]
    got = minhash.duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    truth = brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == truth
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert minhash.duplicates(edge).count() == len(EDGE) and minhash.duplicates(empty).count() == 0
    assert minhash.keep(edge.withColumn("component_id", edge.doc_id)).columns == [*edge.columns, "component_id"]


def brute_lines(rows, least):
    seen, gone = {}, defaultdict(set)
    for i, t in sorted(rows):
        all_lines = t.split("\n")
        at = [k for k, x in enumerate(all_lines) if x.split()]
        for a in range(len(at)):
            for b in range(a, len(at)):
                run = tuple(all_lines[k] for k in at[a : b + 1])
                if sum(len(x.split()) for x in run) >= least:
                    if run in seen:
                        gone[i].update(at[a : b + 1])
                    else:
                        seen[run] = i
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in rows}


def test_line_dedup_matches_brute_force(spark, edge, empty):
    rng = random.Random(7)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.randint(1, 4))) for _ in range(5)] + [""]
    for seed in range(3):
        rng.seed(seed)
        rows = [(k, "\n".join(rng.choices(pool, k=rng.randint(1, 14)))) for k in range(14)]
        got = lines.dedup(spark.createDataFrame(rows, "doc_id long, text string"), 6).collect()
        assert {r.doc_id: r.text for r in got} == brute_lines(rows, 6)
    clash = edge.withColumn("removed", edge.doc_id).withColumn("doc", edge.doc_id)
    rows = lines.dedup(clash).collect()
    assert len(rows) == len(EDGE) and [r.text for r in rows if r.doc_id == 5] == [EDGE[5][1]] * 2
    assert lines.dedup(empty).count() == 0


def test_chat_collapse_matches_brute_force(spark):
    rng = random.Random(8)
    talks = [[("user", rng.choice("ab")) if k % 2 == 0 else ("assistant", rng.choice("ab")) for k in range(rng.randint(1, 4))] for _ in range(40)]
    rows = [(i, t, r, x) for i, talk in enumerate(talks) for t, (r, x) in enumerate(talk)] + [(None, 0, None, None)]
    got = {r.conv_id: r for r in chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    keep = {i for i, a in enumerate(talks) if not any(b[: len(a)] == a and (len(b) > len(a) or j < i) for j, b in enumerate(talks) if j != i)}
    # the null conversation has one empty turn, which nothing else begins with
    assert set(got) == keep | {None}
    for i in keep:
        assert got[i].n_turns == len(talks[i]) and got[i].copies == sum(t == talks[i] for t in talks)
        assert got[i].rendered == "".join(f"<|{r}|>\n{x}\n<|end|>\n" for r, x in talks[i])
    plan = chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_toxicity_and_quality_learn(spark, edge, empty, labels):
    rng = random.Random(9)
    clean = ["tree", "river", "stone", "cloud", "grass", "light", "water", "field"]
    rows, marks = [], []
    for k in range(400):
        toxic, junk = k % 4 == 0, k % 5 < 2
        ws = rng.choices(clean, k=60) + (rng.choices(["idiotic", "idiotly", "scumbag"], k=2) if toxic else [])
        rng.shuffle(ws)
        rows.append((k, " ".join(w.upper() + "!!" if junk else w for w in ws), "en", "s", 1))
        marks.append((k, int(not junk), int(toxic)))
    docs, marked = spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    truth = {m[0]: m for m in marks}
    held = [r for r in toxicity.score(docs, marked).collect() if r.held_out]
    assert held and all(r.predicted == truth[r.doc_id][2] for r in held)
    held = [r for r in neighbours.score(docs, marked).collect() if r.held_out]
    assert held and all(r.predicted == truth[r.doc_id][1] and 0 <= r.score <= 1 for r in held)
    for op in (toxicity, neighbours):
        for some in (labels, labels.limit(0)):
            assert op.score(edge, some).count() == len(EDGE) and op.score(empty, some).count() == 0


def test_tallies_match_counting():
    texts, toxic = ["foo foobar x", "foobarbaz", "x foo"], np.array([1, 0, 1])
    terms, n, hit = toxicity.tallies(pa.array(texts), toxic)
    want = defaultdict(set)
    for k, t in enumerate(texts):
        for w in t.split():
            for term in toxicity.terms_of(w.encode()):
                want[term].add(k)
    assert dict(zip(terms, n.tolist(), strict=True)) == {t: len(s) for t, s in want.items()}
    assert dict(zip(terms, hit.tolist(), strict=True)) == {t: sum(int(toxic[k]) for k in s) for t, s in want.items()}
