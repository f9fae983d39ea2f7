"""Sets of what nodes of a graph lead to, as bitmaps that go along edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..cluster import saved

#: Numbers in one bitmap of Spark's bitmap functions.
WIDTH = 1 << 15


def numbered(rows: DataFrame, *by: str) -> DataFrame:
    """The rows with a number ``id`` from 1, dense within a partition's range of them, so that few bitmaps hold all."""
    return saved(rows.repartitionByRange(*by).withColumn("id", F.monotonically_increasing_id() + 1))


def reached(own: DataFrame, edges: DataFrame, hops: int, by: list[str]) -> DataFrame:
    """(by, key, bucket, bits): bitmaps of the ids that a key holds itself, or by way of up to so many edges (by, key, used).

    A round sends each bitmap once along each edge to its user and joins what arrives by OR: its rows are the edges times the
    buckets of ids, never keys times what they reach.
    """
    first = saved(
        own.select(*by, "key", F.expr("bitmap_bucket_number(id)").alias("bucket"), F.expr("bitmap_bit_position(id)").alias("bit"))
        .groupBy(*by, "key", "bucket").agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))
    )
    sets = first
    for _ in range(hops):
        sent = edges.join(sets.withColumnRenamed("key", "used"), [*by, "used"]).select(*first.columns)
        sets = saved(first.union(sent).groupBy(*by, "key", "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits")))
    return sets


def members(sets: DataFrame) -> DataFrame:
    """A row with ``id`` for each number in a bitmap, in place of ``bucket`` and ``bits``."""
    kept = [f for f in sets.schema.fields if f.name not in ("bucket", "bits")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                bits = np.unpackbits(np.frombuffer(batch.column("bits")[k].as_py(), np.uint8), bitorder="little")
                ids = (batch.column("bucket")[k].as_py() - 1) * WIDTH + np.flatnonzero(bits) + 1
                one = batch.select([f.name for f in kept]).take(pa.array(np.full(len(ids), k)))
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array(ids)], names=[*one.schema.names, "id"])

    return sets.mapInArrow(rows, T.StructType([*kept, T.StructField("id", T.LongType())]))
