"""From raw documents to packed training sequences, in five stages.

Each stage works on the documents that the one before kept. Documents pass the repetition rules and
the quality classifier whole or not at all; line dedup shortens texts (and drops those of which
nothing is left); of near duplicates one document stays; the rest is packed.

In every stage an empty table gives an empty one, columns of any name and type are passed on (not by packing), and
repeated rows are judged alike, each by its own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buildlens.cluster import ship_code, table
from buildlens.llm import lines, minhash, neighbours, packing, repetition
from buildlens.llm.queries import tokenizer_file
from buildlens.llm.store import saved


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of too few words or too much repetition go; so do null and empty texts, which have no words."""
    ship_code(spark)
    return repetition.keep(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the marked ones among the documents that are left; without any all stay. Null texts are scored as empty ones, null ids teach nothing; ties at the last vote go to the smallest ids."""
    ship_code(spark)
    return neighbours.keep(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of long runs of lines, the first in order of id (null first) stays; one that loses its last word goes. Null texts stay; rows with one id and text lose the same lines."""
    ship_code(spark)
    note = "_" * (1 + max(map(len, docs.columns)))  # longer than any column of the table
    found = lines.dedup(docs, note=note)
    changed = F.size(note) > 0
    left = found.filter(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id. Rows that share an id stay or go together; rows without id, words or text stay."""
    ship_code(spark)
    return minhash.keep(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a piece, see ``packing``; a null text is packed as an empty one, and every row has its own pieces."""
    ship_code(spark)
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("packing", pack),
]

#: A fitted model, MinHash and a tokenizer aren't SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
