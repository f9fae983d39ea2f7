"""Names that must differ from each other and from those that are taken."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import splitext


def unique_names(wanted: DataFrame, keep_extension: bool = False) -> DataFrame:
    """``wanted`` (folder, name, ord) with ``unique``: the first of a name in a folder, by ord, keeps it, the next get _1, _2, ... at its end.

    With ``keep_extension`` the number stands before the extension. A numbered name that another row
    wants itself, or that two rows would get, is passed over: rows are numbered again until none meets another.
    """
    by = Window.partitionBy("folder", "name").orderBy("ord")
    ext = splitext(F.col("name")) if keep_extension else F.lit("")
    numbered = wanted.withColumn("n", F.row_number().over(by) - 1)
    base = F.left("name", F.length("name") - F.length(ext))
    # a name with k rows needs at most as many numbers more as there are wanted names of its own form
    taken = wanted.select("folder", F.col("name").alias("made")).distinct()
    sizes = numbered.groupBy("folder", "name").agg(F.max("n").alias("most")).filter("most > 0")
    form = F.regexp_extract("made", r"^(.*)_[0-9]+(\.[^.]*)?$", 1)
    rivals = taken.withColumn("form", form).filter("form <> ''").groupBy("folder", "form").agg(F.count("*").alias("rivals"))
    room = sizes.withColumn("form", base).join(rivals, ["folder", "form"], "left").select("folder", "name", F.explode(F.sequence(F.lit(1), (F.col("most") + F.coalesce("rivals", F.lit(0))).cast("int"))).alias("number"))
    made = F.concat(base, F.lit("_"), F.col("number").cast("string"), ext)
    free = room.withColumn("made", made).join(taken, ["folder", "made"], "left_anti")
    ranked = free.withColumn("n", F.row_number().over(Window.partitionBy("folder", "name").orderBy("number"))).select("folder", "name", "n", "made")
    return numbered.join(ranked, ["folder", "name", "n"], "left").withColumn("unique", F.coalesce("made", "name")).drop("n", "made")
