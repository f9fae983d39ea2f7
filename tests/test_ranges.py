"""JSON files cut into byte ranges of any length give what they give as a whole."""

import gzip
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from buildlens.sources import ranges, trace

SCHEMA = "id bigint, command array<string>, dependencies string"


@pytest.fixture
def cut(spark):
    """Sets the length of ranges; one file a partition."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}

    def to(length):
        spark.conf.set(names[0], str(length))
        spark.conf.set(names[1], "0")

    yield to
    for n, v in before.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def odd_text(rng):
    return "".join(rng.choice(['"', "\\", "}", "{", "[", "]", ",", ":", "\n", "ж", "𝔘", "a", " ", "component_commands", "\x01"]) for _ in range(rng.randint(0, 9)))


def command(rng, k):
    deps = rng.choice([{odd_text(rng): "h"}, [{"path": odd_text(rng), "hash": "}"}], [odd_text(rng)], None, {}])
    return {"id": k, "command": [odd_text(rng) for _ in range(rng.randint(0, 4))], "dependencies": deps, "more": {"a": [{"b": {"c": []}}]}}


def documents(rng):
    """Whole objects as text, with their commands."""
    for _ in range(8):
        commands = [command(rng, k) for k in range(rng.randint(0, 8))]
        around = [("directory", odd_text(rng)), ("meta", {"x": {"y": 1}, "z": {}}), ("other", [{"id": -1, "command": ["no"]}, {"id": -2}]), ("matrix", [[{"id": -3}], 4, "component_commands"]), ("empty", []), ("component_commands", commands)]
        rng.shuffle(around)
        doc = dict(around[: rng.randint(0, 6)])
        doc["component_commands"] = doc.get("component_commands", commands)
        yield json.dumps(doc, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5).replace("\\u0001", "\x01") + rng.choice(["", "\n", " \n\n"]), doc["component_commands"]


def expected(commands):
    return [(k, c["id"], c["command"], None if c["dependencies"] is None else json.dumps(c["dependencies"])) for k, c in enumerate(commands)]


@pytest.mark.parametrize("length", [100, 1 << 27])
def test_ranges_give_the_whole(spark, tmp_path, cut, length):
    rng = random.Random(length)
    wanted = {}
    for k, (text, commands) in enumerate(documents(rng)):
        (tmp_path / f"{k}.json").write_text(text)
        wanted[f"{k}.json"] = expected(commands)
    cut(length)
    found, broken = ranges.elements(spark, [str(tmp_path)], "component_commands", SCHEMA)
    assert broken.count() == 0
    got = {n: [] for n in wanted}
    for r in found.collect():
        deps = None if r.c.dependencies is None else json.dumps(json.loads(r.c.dependencies, strict=False))
        got[r.file.rsplit("/", 1)[1]].append((r.pos, r.c.id, r.c.command, deps))
    assert {n: sorted(v) for n, v in got.items()} == wanted


def test_a_long_file_is_many_tasks(spark, tmp_path, cut):
    rng = random.Random(1)
    commands = [command(rng, k) for k in range(300)]
    (tmp_path / "long.json").write_text(json.dumps({"component_commands": commands}, ensure_ascii=False).replace("\\u0001", "\x01"))
    cut(1024)
    assert ranges.fragments(spark, [str(tmp_path)]).rdd.getNumPartitions() > 25
    rows = trace.read_commands(spark, [str(tmp_path)]).orderBy("cmd_idx").collect()
    assert [(r.cmd_idx, r.id, r.command) for r in rows] == [(k, k, c["command"]) for k, c in enumerate(commands)]
    # a command that is longer than a range
    (tmp_path / "long.json").write_text(json.dumps({"component_commands": [{"command": ["x" * 9000, "} " * 900]}, {"command": ["y"]}]}))
    assert [len(r.command[0]) for r in trace.read_commands(spark, [str(tmp_path)]).orderBy("cmd_idx").collect()] == [9000, 1]


@pytest.mark.parametrize("length", [16, 1 << 27])
def test_broken_files_are_told(spark, tmp_path, cut, length):
    good = '{"component_commands": [{"command": ["a"]}, {"command": ["b"]}]}'
    files = {
        "good": good, "bare": '{"x": 1}', "gone": good[:-1], "cut": good[:-12], "string": good[:40], "twice": good + good, "array": f"[{good}]", "text": "no json", "torn": good.replace('["b"]', '["b"'),
        "value": good.replace('["b"]', "[b]"), "brace": "}", "empty": "", "blank": " \n",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.json").write_text(text)
    cut(length)
    found, broken = ranges.elements(spark, [str(tmp_path)], "component_commands", SCHEMA)
    name = lambda r: r.file.rsplit("/", 1)[1].removesuffix(".json")
    assert {name(r) for r in broken.collect()} == set(files) - {"good", "bare", "empty"}
    assert sorted((name(r), r.pos, r.c.command) for r in found.collect()) == [("good", 0, ["a"]), ("good", 1, ["b"])]


def test_compressed_files(spark, tmp_path):
    with gzip.open(tmp_path / "t.json.gz", "wt") as f:
        f.write('{"component_commands": [{"command": ["a"]}, {"command": ["b"]}]}')
    assert trace.read_commands(spark, [str(tmp_path)]).count() == 2


def test_structure_matches_a_walk():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice('a"\\{}[]') for _ in range(rng.randint(1, 40)))
        flipped, step = ranges.structure(np.frombuffer(text.encode(), np.uint8))
        inside = escaped = False
        for k, c in enumerate(text):
            if escaped:
                escaped = False
            elif c == "\\":
                escaped = True
            elif c == '"':
                inside = not inside
            assert flipped[k] == inside
        assert step.tolist() == [(c in "[{") - (c in "]}") for c in text]


def test_no_files(spark, tmp_path):
    (tmp_path / "none.json").write_text("")
    assert trace.read_commands(spark, [str(tmp_path)]).count() == 0
    assert trace.read_commands(spark, [str(tmp_path)]).select(F.max("cmd_idx")).first()[0] is None
