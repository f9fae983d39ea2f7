"""Chat formatting with cumulative-snapshot collapse, in DataFrame functions only.

A conversation may have been logged again after each turn, so a log holds prefixes of longer
conversations. Every turn gets a rolling hash of the turns up to it: the exclusive or of 128 bits
a turn, each drawn from the turn's place and content, so that prefixes of equal turns have equal
hashes. A conversation is a snapshot if its last hash is that of a proper prefix of another; an
anti-join drops it. Of equal conversations the one with the smallest id stays. What remains is
rendered. Text is moved once, for conversations that stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How a turn is written.
OPENING, ROLE_END, CLOSING = "<|", "|>\n", "<|end|>\n"


def _digest(seed: int) -> Column:
    """64 bits of a turn's role and text; null and empty differ from each other for neither."""
    return F.xxhash64(F.lit(seed), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))


def collapse(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies) of maximal conversations: no other conversation begins with all their turns.

    Turns are ordered by turn, then role, then text, nulls first. A null role or text is empty. Rows
    without conv_id form one conversation with id null, which counts as smaller than any other.
    Repeated rows are turns of their own. copies counts equal conversations, itself included.
    """
    turns = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").alias("r"), _digest(1).alias("a"), _digest(2).alias("b"))
    by = Window.partitionBy("conv_id").orderBy("turn", F.coalesce("r", F.lit("")), "a", "b")
    placed = turns.withColumn("place", F.row_number().over(by))
    rolling = placed.select(
        "conv_id", "place",
        F.bit_xor(F.xxhash64("place", "a")).over(Window.partitionBy("conv_id").orderBy("place")).alias("x"),
        F.bit_xor(F.xxhash64("place", "b")).over(Window.partitionBy("conv_id").orderBy("place")).alias("y"),
        F.lead("place").over(Window.partitionBy("conv_id").orderBy("place")).isNull().alias("last"),
    )
    whole = (
        rolling.filter("last").groupBy("place", "x", "y")
        .agg(F.min("conv_id").alias("least"), F.count("conv_id").alias("named"), F.count("*").alias("copies"))
        .select(F.when(F.col("named") == F.col("copies"), F.col("least")).alias("conv_id"), F.col("place").alias("n_turns"), "x", "y", "copies")
    )
    begun = rolling.filter(~F.col("last")).select(F.col("place").alias("n_turns"), "x", "y").distinct()
    return whole.join(begun, ["n_turns", "x", "y"], "left_anti").select("conv_id", "n_turns", "copies")


def render(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies, rendered) of maximal conversations, see ``collapse``."""
    kept = collapse(conversations).select(F.col("conv_id").alias("kept_id"), "n_turns", "copies")
    turn = F.concat(F.lit(OPENING), F.coalesce("role", F.lit("")), F.lit(ROLE_END), F.coalesce("text", F.lit("")), F.lit("\n" + CLOSING))
    order = F.struct("turn", F.coalesce("role", F.lit("")).alias("r"), _digest(1).alias("a"), _digest(2).alias("b"), turn.alias("shown"))
    written = (
        conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").select("conv_id", order.alias("o"))
        .join(kept, F.col("conv_id").eqNullSafe(F.col("kept_id")))
        .groupBy("conv_id", "n_turns", "copies").agg(F.sort_array(F.collect_list("o")).alias("turns"))
    )
    return written.select("conv_id", F.col("n_turns").cast("long"), "copies", F.array_join(F.col("turns.shown"), "").alias("rendered"))
