"""The closure over traces that arrive one after another equals that over all at once."""

import json
import random

import pytest
from pyspark.sql import functions as F

from buildlens.operators.closure import good_commands
from buildlens.sources import trace
from buildlens.sources.ranges import elements
from buildlens.streaming.closure import Closure, follow


@pytest.fixture
def traces(tmp_path):
    rng = random.Random(8)
    (tmp_path / "in").mkdir()
    names = []
    for k in range(4):
        file = lambda: {f"f{rng.randrange(60)}": f"h{rng.randrange(60)}" for _ in range(rng.randint(0, 2))}
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"component_commands": [{"dependencies": file(), "output": file()} for _ in range(25)]}))
        names.append(str(tmp_path / "in" / f"{k}.json"))
    return names


def shipped(spark):
    return spark.createDataFrame([("h1", "x"), ("h2", "f3"), (None, "f7")], "hash string, path_norm string")


def whole(spark, names):
    rows = trace.read_commands(spark, names)
    good = good_commands(trace.edges(rows, "dependencies"), trace.edges(rows, "output"), shipped(spark))
    place = rows.select("cmd_idx", "file", F.row_number().over(trace.Window.partitionBy("file").orderBy("cmd_idx")).alias("k"))
    return sorted((r.file.rsplit("/", 1)[1], r.k - 1) for r in place.join(good, "cmd_idx").collect())


def state(closure):
    return sorted((r.file.rsplit("/", 1)[1], r.pos) for r in closure.good().collect())


def test_one_at_a_time_equals_all_at_once(spark, traces, tmp_path):
    closure = Closure(spark, str(tmp_path / "state"))
    order = [2, 0, 3, 2, 1]  # one comes twice

    def arrive(number, k):
        found, _ = elements(spark, [traces[k]], "component_commands", trace.COMMAND)
        closure.add(number, found.select("file", "pos", "c.dependencies", "c.output"), shipped(spark))

    sizes = []
    for number, k in enumerate(order):
        arrive(number, k)
        sizes.append(len(state(closure)))
    want = whole(spark, traces)
    assert state(closure) == want and sizes[3] == sizes[2] and 10 < len(want) < 100
    arrive(4, 1)  # an arrival that is made again
    assert state(closure) == want


def test_a_folder_is_followed(spark, traces, tmp_path):
    follow(spark, str(tmp_path / "in"), shipped(spark), str(tmp_path / "state"), files_per_batch=3).awaitTermination()
    assert state(Closure(spark, str(tmp_path / "state/closure"))) == whole(spark, traces)
