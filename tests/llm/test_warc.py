import gzip
import hashlib
import io
import json
import os
import random

import pytest

from buildlens.llm import warc

PAGES = "page_id long, url string, html string, payload string, digest string, same string"
BIG = "<p>" + "copy " * 300


def rows():
    rng = random.Random(4)
    made = [(k, f"http://h{k % 3}/p{k}", rng.choice([BIG, BIG + "2", "short", f"<p>{k} " * rng.randint(1, 400)])) for k in range(200)]
    odd = [(300, None, None), (301, "http://x/\r\nWARC-Type: none", ""), (302, "", "ж𝔘\r\n\r\nWARC/1.1\r\n" * 80), (303, "u", "y" * 3_000_000), (None, "u", BIG), (None, "u", "z" * 2000), (304, "u", "twin" * 400), (304, "u", "twin" * 400), (305, "u", "\r\n\r\n" * 500)]
    return made + odd


def brute(pages):
    newest = {}
    for i, _, html in pages:
        if i is not None:
            newest[html or ""] = max(newest.get(html or "", i), i)
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        first = newest.get(html or "") if len(data) >= 1000 else None
        revisit = first is not None and first != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return out


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("warc"))
    pages = spark.createDataFrame([(*r, "own", "own", "own") for r in rows()], PAGES).repartition(3)
    warc.write(pages, f"{base}/streams")
    return base, warc.normalise(spark, f"{base}/streams", f"{base}/records")


def test_pages_come_back(spark, archives):
    base, manifest = archives
    found = warc.read(spark, f"{base}/records")
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(brute(rows()), key=repr)
    whole = sorted((r.page_id or -1, bytes(r.payload).decode()) for r in warc.resolved(found).collect())
    assert whole == sorted((i or -1, html or "") for i, _, html in rows())
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows()) and manifest.filter("error is not null").isEmpty()
    assert warc.read(spark, f"{base}/records", payload=False).filter("payload is not null").isEmpty()
    assert warc.read(spark, f"{base}/records", types=("revisit",)).count() == sum(r[3] == "revisit" for r in brute(rows()))


def test_each_record_is_a_member_at_its_offset(archives):
    base, _ = archives
    names = [n for n in os.listdir(f"{base}/records") if n.endswith(".warc.gz")]
    assert names and not [n for n in os.listdir(f"{base}/records") if n.startswith("_")]
    for name in names:
        data = open(f"{base}/records/{name}", "rb").read()
        streams = [gzip.decompress(open(f"{base}/streams/{s}", "rb").read()) for s in os.listdir(f"{base}/streams") if s.endswith(".gz")]
        assert gzip.decompress(data) in streams  # nothing but the members changed
        end = 0
        for line in open(f"{base}/records/{name}.index.jsonl"):
            row = json.loads(line)
            assert row["offset"] == end
            end += row["length"]
            assert gzip.decompress(data[row["offset"] : end]).startswith(b"WARC/1.1\r\n")
        assert end == len(data)


def record(kind, body, name="x", extra=""):
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{name}>\r\n{extra}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def test_archives_of_others(spark, tmp_path):
    given = [record("warcinfo", b"software: x"), record("resource", b"abc" * 9, "page:7", "WARC-Target-URI: a\r\n b\r\n"), record("metadata", b""), record("response", b"no head", "urn")]
    os.makedirs(tmp_path / "in" / "deep")
    (tmp_path / "in" / "deep" / "whole.warc.gz").write_bytes(gzip.compress(b"".join(given)))
    (tmp_path / "in" / "mémbers 1.warc.gz").write_bytes(b"".join(map(gzip.compress, given)))
    (tmp_path / "in" / "none.warc.gz").write_bytes(gzip.compress(b""))
    (tmp_path / "in" / "zero.warc.gz").write_bytes(b"")
    (tmp_path / "in" / "notes.txt").write_bytes(b"no archive")
    found = {os.path.basename(r.source): r for r in warc.normalise(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()}
    assert {n: r.records for n, r in found.items()} == {"whole.warc.gz": 4, "mémbers 1.warc.gz": 4, "none.warc.gz": 0}
    got = warc.read(spark, str(tmp_path / "out")).collect()
    assert sorted((r.record_type, r.page_id, bytes(r.payload), r.target_uri) for r in got if r.record_type == "resource") == [("resource", 7, b"abc" * 9, "a b")] * 2
    assert sum(r.record_type == "response" and r.page_id is None for r in got) == 2


def test_broken_archives_are_told(spark, tmp_path):
    good = record("resource", b"x" * 5000, "page:1")
    os.makedirs(tmp_path / "in")
    whole = gzip.compress(good + record("resource", os.urandom(50_000), "page:2"))
    for name, data in {"cut": whole[:-2000], "text": gzip.compress(b"hello\r\n\r\n"), "plain": good, "tail": gzip.compress(good + b"WARC/1.0\r\nWARC-Ty"), "endless": gzip.compress(b"WARC/1.0\r\n" + b"a" * 3_000_000)}.items():
        (tmp_path / "in" / f"{name}.warc.gz").write_bytes(data)
    found = {os.path.basename(r.source)[:-8]: r for r in warc.normalise(spark, str(tmp_path / "in"), str(tmp_path / "out"), strict=False).collect()}
    assert {n: r.records for n, r in found.items()} == {"cut": 1, "text": 0, "plain": 0, "tail": 1, "endless": 0} and all(r.error for r in found.values())
    assert [r.page_id for r in warc.read(spark, str(tmp_path / "out")).collect()] == [1, 1]
    with pytest.raises(Exception, match="ends early"):
        warc.normalise(spark, str(tmp_path / "in" / "cut.warc.gz"), str(tmp_path / "strict"))
    with pytest.raises(warc.Broken, match="digest"):
        warc.parsed(gzip.compress(record("resource", b"abc", extra="WARC-Payload-Digest: sha1:00\r\n")), True)


def test_memory_holds_a_chunk(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 1000)
    rng = random.Random(2)
    given = [record("resource", rng.randbytes(rng.choice([0, 1, 999, 1000, 1001, 30_000])), f"page:{k}") for k in range(40)]
    stream, most = warc.Inflated(io.BytesIO(gzip.compress(b"".join(given)))), 0
    out = io.BytesIO()
    monkeypatch.setattr(warc, "Inflated", lambda source: stream)
    for offset, length, _ in warc.members(None, out):
        most = max(most, len(stream.inflated))
    assert most <= 2500 and gzip.decompress(out.getvalue()) == b"".join(given)


def test_empty_tables(spark, tmp_path):
    warc.write(spark.createDataFrame([], "page_id long, html string"), str(tmp_path / "s"))
    warc.normalise(spark, str(tmp_path / "s"), str(tmp_path / "r"))
    assert warc.read(spark, str(tmp_path / "r")).count() == 0
