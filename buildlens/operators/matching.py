"""Rows whose text holds one of many patterns: one automaton for all patterns, so the plan doesn't grow with them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def holding(rows: DataFrame, column: str, patterns: list[str], label: str) -> DataFrame:
    """The rows once for each distinct pattern that ``column`` holds whatever the case, with the pattern as ``label``; a null holds none.

    Patterns go to all tasks in one broadcast, which they alone make as large as it is; a task builds their Aho-Corasick automaton once and
    reads a text once, however many there are.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(list(dict.fromkeys(patterns)))
    spare = "_" * (1 + max(map(len, rows.columns)))
    schema = T.StructType([*rows.schema.fields, T.StructField(label, T.StringType())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        by_text: dict[str, list[str]] = {}
        for p in shared.value:
            by_text.setdefault(p.lower(), []).append(p)
        always = by_text.pop("", [])
        automaton = ahocorasick.Automaton()
        for text, own in by_text.items():
            automaton.add_word(text, own)
        automaton.make_automaton()
        for batch in batches:
            at, hits = [], []
            for k, text in enumerate(batch.column(spare).to_pylist()):
                if text is not None:
                    own = dict.fromkeys(always)
                    for _, names in automaton.iter(text) if by_text else ():
                        own.update(dict.fromkeys(names))
                    at += [k] * len(own)
                    hits += own
            kept = batch.drop_columns([spare]).take(pa.array(np.array(at, np.int64)))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(hits, pa.string())], names=[*kept.schema.names, label])

    return rows.withColumn(spare, F.lower(column)).mapInArrow(found, schema)
