"""The driver's tables as relations of a build. The text is SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cluster import table
from .functions.paths import normpath
from .plans.passes import Build


def _case(key: str, values: tuple[str, ...]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values)) + " END"


EXTENSIONS = (".c", ".h", ".cpp", ".py", ".js", ".java", ".sh", ".txt", ".rs", ".go", "", ".pyc")
TOOLS = ("gcc", "ld", "python3", "cp", "apt", "bash", "rustc", "g++")
FOLDERS = ("/usr/include/", "/opt/ext/", "/home/b/", "/usr/lib/", "/srv/lib/", "/tmp/")
ENDINGS = (".c", ".h", ".so.1", ".so.2", ".class", ".so")
PLACES = ("P/bin/d1/", "P/bin/d1/x.deb_dir/", "P/bin/usr/lib/", "P/bin/d2/node_modules/@s/n/", "P/bin/d2/site-packages/p/", "P/bin/d4/e8_1.deb_dir/")

#: Sources of at most so many bytes go to all executors rather than line items to the sources.
BROADCAST_BYTES = 8 << 20

_PLACE = "row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_shipdate) - 1"

#: Every order is a command with an output, every line item an input: an output, a source, an external file, an archive, or else a file of
#: the system. Sources with ord % 5 = 0 aren't read by their own row's command, so that some are redundant.
RELATIONS = {
    "sig": f"""
SELECT doc_id AS ord, 'P/src/' || source || '/' || lang || '/f' || CAST(doc_id AS STRING) || {_case("doc_id % 12", EXTENSIONS)} AS path, md5(text) AS hash,
       md5('arc' || source) AS parent
FROM documents""",
    "cmd": f"""
SELECT o_orderkey AS cmd_idx, {_case("o_custkey % 8", TOOLS)} AS tool,
       CASE WHEN o_custkey % 50 = 0 THEN '' ELSE {_case("o_custkey % 8", TOOLS)} || CASE WHEN o_orderkey % 2 = 0 THEN ' download p' ELSE ' -x p' END || CAST(o_orderkey % 100 AS STRING) END AS line FROM orders""",
    "out": """
SELECT o_orderkey AS cmd_idx, 0 AS pos, 'obj/p' || CAST(o_orderkey AS STRING) || CASE WHEN o_orderkey % 3 = 0 THEN '.py' ELSE '.o' END AS path,
       md5('p' || CAST(o_orderkey AS STRING)) AS hash
FROM orders""",
    "dep": f"""
SELECT l.l_orderkey AS cmd_idx,
       {_PLACE} AS pos,
       CASE WHEN l_linenumber = 1 THEN 'obj/p' || CAST(l_partkey AS STRING) || CASE WHEN l_partkey % 3 = 0 THEN '.py' ELSE '.o' END
            WHEN l_linenumber IN (2, 3, 4) AND s.ord IS NOT NULL THEN s.path
            WHEN l_linenumber = 5 THEN {_case("l_orderkey % 6", FOLDERS)} || 'e' || CAST(l_orderkey AS STRING) || {_case("l_partkey % 6", ENDINGS)}
            WHEN l_linenumber = 6 AND l_suppkey % 10 < 3 THEN 'arc/a' || CAST(l_suppkey % 40 AS STRING)
            ELSE '/usr/share/d' || CAST(l_suppkey AS STRING) END AS path,
       CASE WHEN l_linenumber = 1 THEN md5('p' || CAST(l_partkey AS STRING)) WHEN l_linenumber IN (2, 3, 4) AND s.ord IS NOT NULL THEN s.hash
            WHEN l_linenumber = 5 THEN md5('x' || CAST(l_partkey AS STRING)) WHEN l_linenumber = 6 AND l_suppkey % 10 < 3 THEN md5('arcsrc' || CAST(l_suppkey % 40 AS STRING))
            ELSE md5('d' || CAST(l_suppkey AS STRING)) END AS hash
FROM lineitem l LEFT JOIN sig s ON s.ord = l.l_partkey % (SELECT count(*) FROM documents) AND s.ord % 5 <> 0""",
    "bin": f"""
SELECT p_partkey AS ord, {_case("p_partkey % 6", PLACES)} || 'b' || CAST(p_partkey AS STRING) || CASE WHEN p_partkey % 7 = 0 THEN '.class' ELSE '' END AS path,
       md5('p' || CAST(p_partkey AS STRING)) AS hash
FROM part WHERE p_size <= 5
UNION ALL
SELECT 1000000000 + ord AS ord, 'P/bin/d3/s' || CAST(ord AS STRING) AS path, hash FROM sig WHERE ord % 17 = 0
UNION ALL
SELECT 2000000000 + p_partkey AS ord, {_case("p_partkey % 6", PLACES)} || 'u' || CAST(p_partkey AS STRING) AS path, md5('u' || CAST(p_partkey AS STRING)) AS hash
FROM part WHERE p_size = 6
UNION ALL
SELECT 3000000000 + p_partkey AS ord, 'P/bin/d5/x' || CAST(p_partkey AS STRING) AS path, md5('x' || CAST(p_partkey AS STRING)) AS hash FROM part WHERE p_size <= 9 AND p_size > 6""",
}

#: For oracles: the relations as common table expressions.
WITH = "WITH RECURSIVE " + ",".join(f"{k} AS ({v})" for k, v in RELATIONS.items())


def over(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """The result of SQL in which tables are these DataFrames; the session's own views are left alone."""
    names = "|".join(frames)
    return spark.sql(re.sub(rf"\b(FROM|JOIN) ({names})\b", r"\1 {\2}", text), **frames)


def small(df: DataFrame, *texts: str) -> bool:
    """Whether rows with 128 bytes beside the longest of these texts surely fit ``BROADCAST_BYTES``; only one row reaches the driver."""
    length = sum((F.coalesce(F.octet_length(t), F.lit(0)) for t in texts), F.lit(0))
    rows, longest = df.agg(F.count("*"), F.max(length)).first()
    return rows * (128 + (longest or 0)) <= BROADCAST_BYTES


def inputs(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """The relation ``dep``: line items that read no document stay out of the join with documents, so it shuffles 3 of 7, or none where documents are few.

    Spark guesses the size of ``sig`` from that of the texts, which aren't in it.
    """
    if small(frames["documents"], "source", "lang"):
        frames = frames | {"sig": F.broadcast(frames["sig"])}
    placed = over(spark, f"SELECT l.*, {_PLACE} AS pos FROM lineitem l", lineitem=frames["lineitem"])
    text, reads = RELATIONS["dep"].replace(_PLACE, "l.pos"), F.coalesce(F.col("l_linenumber").isin(2, 3, 4), F.lit(False))
    rest = {"lineitem": placed.filter(~reads), "sig": frames["sig"].filter("false")}
    return over(spark, text, **(frames | {"lineitem": placed.filter(reads)})).union(over(spark, text, **(frames | rest)))


def build(spark: SparkSession, sf_dir: str) -> Build:
    """The relations over the tables of a folder, with normalised paths."""
    frames = {name: table(spark, sf_dir, name) for name in ("documents", "orders", "part", "lineitem")}
    for name, text in RELATIONS.items():
        frames[name] = inputs(spark, frames) if name == "dep" else over(spark, text, **frames)
    made = {name: frames[name] for name in RELATIONS}
    normal = {k: v.withColumn("path_norm", normpath(F.col("path"))) if k != "cmd" else v.withColumn("argv", F.filter(F.split("line", " "), lambda w: w != "")) for k, v in made.items()}
    src = normal["sig"].withColumn("chain", F.array("parent")).drop("parent")
    return Build(src, normal["bin"], normal["cmd"], normal["dep"], normal["out"])
