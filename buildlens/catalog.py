"""Registered queries of the provenance engine, each with its SQL for DuckDB."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import adapters, versioned
from .cluster import shared_folder, table
from .functions import archives as A
from .functions import packages as K
from .functions import paths as P
from .functions import rules
from .functions import text as X
from .operators import naming
from .plans import binaries, hotspots, languages, packages, passes, runs, signatures, summaries, tools
from .sources import files

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _listed(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _case(expr: str) -> str:
    return rf"lower(regexp_extract({expr}, '(?:^|/)\.*[^/.][^/]*?(\.[^./]*)$', 1))"


_SUFFIX = r"lower(regexp_extract(regexp_extract(path, '([^/]*)$', 1), '^.+(\.[^.]+)$', 1))"
_SOURCES = tuple(x for x in P.SOURCES if x not in P.EXCLUDED)
_IS_SOURCE = f"{_SUFFIX} IN {_listed(_SOURCES)}"
_POOL = "pool AS (SELECT hash FROM dep UNION SELECT hash FROM out)"
_PASS1 = f"""{_POOL},
p1 AS (SELECT s.ord, s.path, s.hash, CASE WHEN s.hash NOT IN (SELECT hash FROM pool) AND s.parent IN (SELECT hash FROM pool) THEN s.parent END AS parent_hash,
  CASE WHEN s.hash IN (SELECT hash FROM pool) THEN 'direct' WHEN s.parent IN (SELECT hash FROM pool) THEN 'parent'
       WHEN s.hash IN (SELECT hash FROM bin) THEN 'untraced_in_distrib' ELSE 'redundant' END AS category
  FROM sig s WHERE {_IS_SOURCE})"""
_GOOD = """good AS (SELECT cmd_idx FROM out WHERE hash IN (SELECT hash FROM bin) OR path IN (SELECT path FROM bin)
  UNION SELECT o.cmd_idx FROM good g JOIN dep d ON d.cmd_idx = g.cmd_idx JOIN out o ON o.hash = d.hash OR o.path = d.path)"""
_KEYS = f"""makers AS (SELECT cmd_idx FROM cmd WHERE tool IN {_listed((*passes.COMPILERS, *passes.LINKERS))} AND cmd_idx IN (SELECT cmd_idx FROM good)),
keys AS (SELECT hash AS key FROM dep WHERE cmd_idx IN (SELECT cmd_idx FROM makers) UNION SELECT path FROM dep WHERE cmd_idx IN (SELECT cmd_idx FROM makers))"""
_PASS2 = f"""p2 AS (SELECT ord, path, hash, parent_hash,
  CASE WHEN category IN ('direct', 'parent') AND {_case("path")} IN {_listed(P.COMPILED)} AND hash NOT IN (SELECT key FROM keys) AND path NOT IN (SELECT key FROM keys)
       THEN 'not_compiled' ELSE category END AS category FROM p1)"""
_FIRST = f"""reads AS (SELECT * FROM (SELECT d.*, row_number() OVER (PARTITION BY d.hash ORDER BY d.cmd_idx, d.pos) AS k FROM dep d JOIN cmd c ON c.cmd_idx = d.cmd_idx
  WHERE c.tool IN {_listed(passes.INTERPRETERS)} AND {_case("d.path")} IN {_listed(P.INTERPRETED)}) WHERE k = 1),
writes AS (SELECT o.* FROM out o JOIN cmd c ON c.cmd_idx = o.cmd_idx WHERE c.tool IN {_listed(passes.INTERPRETERS)} AND {_case("o.path")} IN {_listed(P.INTERPRETED)})"""
_PASS3 = f"""p3 AS (SELECT s.ord, s.path, s.hash, CASE
  WHEN s.hash IN (SELECT hash FROM bin) OR s.path IN (SELECT path FROM bin) THEN 'copied'
  WHEN s.hash IN (SELECT hash FROM writes) OR s.path IN (SELECT path FROM writes) THEN 'compiled_unused'
  WHEN (CASE WHEN s.hash IN (SELECT hash FROM reads) THEN s.hash IN (SELECT hash FROM reads r WHERE r.cmd_idx IN (SELECT cmd_idx FROM good))
             ELSE s.path IN (SELECT path FROM reads r WHERE r.cmd_idx IN (SELECT cmd_idx FROM good)) END) THEN 'compiled_used'
  WHEN {_case("s.path")} IN {_listed(P.PYTHON)} AND (s.hash IN (SELECT hash FROM reads) OR s.path IN (SELECT path FROM reads)) THEN 'executed' ELSE 'not_used' END AS category
  FROM sig s WHERE {_case("s.path")} IN {_listed(P.INTERPRETED)})"""


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def _build(spark: SparkSession, sf_dir: str) -> passes.Build:
    return adapters.build(spark, sf_dir)


W = adapters.WITH


@query(f"{W}, {_PASS1} SELECT ord, path, hash, parent_hash, category FROM p1")
def pass1_classes(spark, sf_dir):
    return passes.pass1(_build(spark, sf_dir)).drop("path_norm")


def _pass1_only(category: str) -> None:
    def f(spark, sf_dir):
        return passes.pass1(_build(spark, sf_dir)).filter(F.col("category") == category).select("path", "hash")

    f.__name__ = f"pass1_{category}"
    query(f"{W}, {_PASS1} SELECT path, hash FROM p1 WHERE category = '{category}'")(f)


for _c in ("direct", "parent", "redundant", "untraced_in_distrib"):
    _pass1_only(_c)


@query(f"{W}, {_GOOD} SELECT cmd_idx FROM good")
def good_commands(spark, sf_dir):
    return passes.good(_build(spark, sf_dir))


@query(f"{W}, {_GOOD}, {_KEYS} SELECT key FROM keys")
def good_compiler_inputs(spark, sf_dir):
    b = _build(spark, sf_dir)
    return passes.compiler_inputs(b, passes.good(b))


@query(f"{W}, {_PASS1}, {_GOOD}, {_KEYS}, {_PASS2} SELECT path, hash, parent_hash FROM p2 WHERE category = 'not_compiled'")
def pass2_not_compiled(spark, sf_dir):
    b = _build(spark, sf_dir)
    return passes.pass2(b, passes.pass1(b), passes.good(b)).filter("category = 'not_compiled'").select("path", "hash", "parent_hash")


@query(f"{W}, {_PASS1}, {_GOOD}, {_KEYS}, {_PASS2} SELECT DISTINCT path, hash FROM p2 WHERE category IN ('not_compiled', 'redundant')")
def redundant_union(spark, sf_dir):
    b = _build(spark, sf_dir)
    return passes.pass2(b, passes.pass1(b), passes.good(b)).filter("category IN ('not_compiled', 'redundant')").select("path", "hash").distinct()


@query(f"{W}, {_FIRST} SELECT cmd_idx, pos, path, hash FROM reads")
def interp_inputs_first(spark, sf_dir):
    b = _build(spark, sf_dir)
    return passes.interpreter_files(b, b.dep).select("cmd_idx", F.col("pos").cast("long"), "path", "hash")


@query(f"{W}, {_GOOD}, {_FIRST}, {_PASS3} SELECT ord, path, hash, category FROM p3")
def pass3_classes(spark, sf_dir):
    b = _build(spark, sf_dir)
    return passes.pass3(b, passes.good(b))


@query(f"""{W}, {_GOOD}, {_FIRST}, {_PASS3},
w1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hash ORDER BY cmd_idx, pos) AS k FROM writes) WHERE k = 1),
w2 AS (SELECT * FROM (SELECT cmd_idx, pos, path, hash, row_number() OVER (PARTITION BY path ORDER BY cmd_idx, pos) AS k FROM w1) WHERE k = 1)
SELECT path, hash, CASE WHEN hash IN (SELECT hash FROM bin) OR path IN (SELECT path FROM bin)
  OR CASE WHEN hash IN (SELECT hash FROM reads) THEN hash IN (SELECT hash FROM reads WHERE cmd_idx IN (SELECT cmd_idx FROM good)) ELSE path IN (SELECT path FROM reads WHERE cmd_idx IN (SELECT cmd_idx FROM good)) END
  THEN 'compiled_used' ELSE 'compiled_unused' END AS category FROM w2 WHERE path NOT IN (SELECT path FROM p3 WHERE category IN ('compiled_used', 'compiled_unused'))""")
def pass3_outputs(spark, sf_dir):
    b = _build(spark, sf_dir)
    good = passes.good(b)
    return passes.pass3_outputs(b, good, passes.pass3(b, good))


_EXT = f"""made AS (SELECT o.cmd_idx, b.path AS bin_path, b.hash AS bin_hash FROM out o JOIN bin b ON b.hash = o.hash JOIN cmd c ON c.cmd_idx = o.cmd_idx
  WHERE c.tool IN {_listed((*passes.COMPILERS, *passes.LINKERS))}),
ext AS (SELECT DISTINCT m.bin_path, m.bin_hash, d.path AS dep_path, d.hash AS dep_hash FROM made m JOIN dep d ON d.cmd_idx = m.cmd_idx
  WHERE NOT ({" OR ".join(f"starts_with(d.path, '{x}')" for x in P.SYSTEM_PREFIXES)})
    AND {_case("d.path")} NOT IN {_listed((*P.RESOURCES, *P.HEADERS))}
    AND NOT (regexp_matches(d.path, '\\.so(\\.\\d+)*$') AND (regexp_matches(d.path, '/(lib|lib64|include)/') OR starts_with(d.path, '/usr/') OR starts_with(d.path, '/lib')))
    AND d.hash NOT IN (SELECT hash FROM sig) AND d.hash NOT IN (SELECT hash FROM out))"""


@query(f"{W}, {_EXT} SELECT * FROM ext")
def external_deps(spark, sf_dir):
    return passes.external_dependencies(_build(spark, sf_dir))


_ALIASED = r"""regexp_matches(dep_path, '\.so(\.\d+)*$')"""


@query(rf"""{W}, {_EXT}, based AS (SELECT *, regexp_replace(dep_path, '\.so(\.\d+)*$', '.so') AS base FROM ext WHERE {_ALIASED})
SELECT bin_path, bin_hash, CASE WHEN count(*) > 1 THEN base ELSE min(dep_path) END AS dep_path, first(dep_hash ORDER BY length(dep_path), dep_path, dep_hash) AS dep_hash,
       CASE WHEN count(*) > 1 THEN string_agg(DISTINCT dep_path, ',' ORDER BY dep_path) END AS aliases FROM based GROUP BY bin_path, bin_hash, base
UNION ALL SELECT bin_path, bin_hash, dep_path, dep_hash, NULL FROM ext WHERE NOT {_ALIASED}""")
def external_deps_alias_merged(spark, sf_dir):
    return passes.merged_aliases(passes.external_dependencies(_build(spark, sf_dir)))


@query(f"{W}, {_PASS1} SELECT category, count(*) AS files, round(100.0 * count(*) / (SELECT count(*) FROM p1), 4)::DOUBLE AS percent FROM p1 GROUP BY category")
def summary_percent(spark, sf_dir):
    return passes.summary(passes.pass1(_build(spark, sf_dir)))


@query(f"{W} SELECT coalesce(tool, '__no_command__') AS tool, count(*) AS commands FROM cmd GROUP BY 1")
def tool_histogram(spark, sf_dir):
    return tools.tool_counts(_build(spark, sf_dir).cmd)


@query(f"{W}, c AS (SELECT CASE WHEN line <> '' THEN tool ELSE '__no_command__' END AS tool FROM cmd) SELECT count(*) AS commands, count(*) FILTER (WHERE tool = '__no_command__') AS no_command, count(DISTINCT tool) AS tools FROM c")
def tool_totals(spark, sf_dir):
    cmd = _build(spark, sf_dir).cmd
    return tools.tool_totals(cmd.withColumn("tool", tools.tool_of(F.col("argv"))))


@query(f"{W} SELECT tool, cmd_idx FROM (SELECT *, row_number() OVER (PARTITION BY tool ORDER BY cmd_idx) AS k FROM cmd) WHERE k <= 5")
def tool_first_n(spark, sf_dir):
    return tools.tool_samples(_build(spark, sf_dir).cmd, 5).select("tool", "cmd_idx")


@query(f"{W} SELECT cmd_idx, tool FROM cmd WHERE tool IN ('apt', 'cc') OR contains(lower(tool), 'cc') OR contains(lower(tool), 'apt')")
def tool_search(spark, sf_dir):
    return _build(spark, sf_dir).cmd.filter(tools.is_tool(F.col("tool"), ["apt", "cc"])).select("cmd_idx", "tool")


_FOUND = """found AS (SELECT p.package, f.role, c.tool, f.cmd_idx, f.path, f.hash FROM (VALUES ('OPT/ext/e1'), ('obj/p1')) p(package)
  JOIN (SELECT 'INPUT' AS role, cmd_idx, path, hash FROM dep UNION ALL SELECT 'OUTPUT', cmd_idx, path, hash FROM out) f ON contains(lower(f.path), lower(p.package)) LEFT JOIN cmd c USING (cmd_idx))"""


def _found(spark, sf_dir) -> DataFrame:
    b = _build(spark, sf_dir)
    return tools.package_matches(b.cmd, b.dep, b.out, ["OPT/ext/e1", "obj/p1"])


@query(f"{W}, {_FOUND} SELECT * FROM found")
def package_search(spark, sf_dir):
    return _found(spark, sf_dir)


@query(f"{W}, {_FOUND} SELECT package, role, tool, path, count(*) AS matches FROM found GROUP BY package, role, tool, path")
def package_role_counts(spark, sf_dir):
    return tools.package_roles(_found(spark, sf_dir))


@query(f"""{W}, {_FOUND} SELECT package, path, CASE WHEN bool_or(role = 'OUTPUT') AND bool_or(role = 'INPUT') THEN 'external_built or compiled_from_src' WHEN bool_or(role = 'OUTPUT') THEN 'external_prebuilt or untraced_from_src' ELSE 'external_prebuilt' END AS likely,
  count(*) AS matches FROM found GROUP BY package, path""")
def package_role_category(spark, sf_dir):
    return tools.likely_origin(_found(spark, sf_dir), "package", "path")


_DISK = r"coalesce(nullif(regexp_extract(path, '^(?:[^/]*/)*?(?:src|bin)/([^/]*)', 1), ''), 'unknown')"


@query(f"{W}, {_PASS1} SELECT category, {_DISK} AS disk, count(*) AS files FROM p1 GROUP BY 1, 2")
def by_disk(spark, sf_dir):
    return passes.pass1(_build(spark, sf_dir)).groupBy("category", P.disk(F.col("path")).alias("disk")).agg(F.count("*").alias("files"))


@query(rf"""{W} SELECT CASE WHEN contains(regexp_extract(path, '([^/]*)$', 1), '.') THEN lower(regexp_extract(path, '(\.[^.]*)$', 1)) ELSE 'no_extension' END AS ext, count(*) AS files FROM sig GROUP BY 1""")
def ext_histogram(spark, sf_dir):
    return _build(spark, sf_dir).src.groupBy(P.shell_extension(F.col("path")).alias("ext")).agg(F.count("*").alias("files"))


@query(rf"""SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base, regexp_extract(url, '(?:^|/)\.*[^/.][^/]*?(\.[^./]*)$', 1) AS ext FROM pages""")
def path_functions(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", P.basename(F.col("url")).alias("base"), P.splitext(F.col("url")).alias("ext"))


@query(rf"""{W} SELECT path, list_last(list_filter(list_transform(string_split(path, '/'), lambda c: regexp_replace(c, '_dir$', '')), lambda c: regexp_matches(c, '\.(iso|deb|rpm|tar|tgz|zip|gz|xz|bz2)$'))) AS container FROM bin""")
def innermost_container(spark, sf_dir):
    return _build(spark, sf_dir).bin.select("path", P.container(F.col("path")).alias("container"))


@query(f"{W} SELECT ord, right(hash, 16) AS key FROM sig UNION ALL SELECT -1, '00000000000000ff' UNION ALL SELECT -2, NULL UNION ALL SELECT -3, NULL")
def hash_key(spark, sf_dir):
    extra = spark.createDataFrame([(-1, " FF "), (-2, "0xzz"), (-3, "")], "ord long, hash string")
    return _build(spark, sf_dir).src.select("ord", "hash").union(extra).select("ord", X.hash_key(F.col("hash")).alias("key"))


@query(r"SELECT doc_id, CASE WHEN length(t) > 100 THEN left(t, 97) || '...' ELSE t END AS shown FROM (SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g') AS t FROM documents)")
def report_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.report_text(F.col("text"), 100).alias("shown"))


_LETTERS = (
    "а:a б:b в:v г:g д:d е:e ё:e ж:zh з:z и:i й:y к:k л:l м:m н:n о:o п:p р:r с:s т:t у:u ф:f х:kh ц:ts ч:ch ш:sh щ:sch ъ: ы:y ь: э:e ю:yu я:ya А:A Б:B В:V Г:G Д:D Е:E Ё:E Ж:ZH З:Z И:I Й:Y К:K Л:L М:M "
    "Н:N О:O П:P Р:R С:S Т:T У:U Ф:F Х:KH Ц:TS Ч:CH Ш:SH Щ:SCH Ъ: Ы:Y Ь: Э:E Ю:YU Я:YA"
)
_WORDS = "Отдел Щёлк ЁЛКА съешь же ещё этих мягких французских булок да выпей чаю ХЦЧШЪЫЬЭЮЯЖ"


@query(rf"""WITH letters AS (SELECT split_part(x, ':', 1) AS k, split_part(x, ':', 2) AS v FROM (SELECT unnest(string_split('{_LETTERS}', ' ')) AS x)),
known AS (SELECT map(list(k), list(v)) AS m FROM letters),
t AS (SELECT doc_id, upper(list_aggregate(list_transform(string_split(name, ''), lambda c: coalesce(m[c], c)), 'string_agg', '')) AS t FROM (SELECT doc_id, source || ' {_WORDS} ' || lang || '__№' || doc_id || '.tar' AS name FROM documents), known)
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(replace(t, ' ', '_'), '[^A-Z0-9_.-]', '', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g') AS name FROM t""")
def translit(spark, sf_dir):
    name = F.concat("source", F.lit(f" {_WORDS} "), "lang", F.lit("__№"), F.col("doc_id").cast("string"), F.lit(".tar"))
    return table(spark, sf_dir, "documents").select("doc_id", X.transliterate(name).alias("name"))


_TAILS = (".tar.gz", ".tar.bz2", ".TAR.XZ", ".tar.zst", ".tar.Z", ".tar.lz4", ".tar.lzma", ".lz4", ".gz", ".c++", ".C", "", "./x", ".tar")


@query(rf"""WITH p AS (SELECT doc_id, 'a.b/' || doc_id || list_extract({list(_TAILS)}, 1 + (doc_id % {len(_TAILS)})::INT) AS path FROM documents), n AS (SELECT *, lower(regexp_extract(path, '([^/]*)$', 1)) AS low FROM p)
SELECT doc_id, CASE WHEN regexp_matches(low, '\.tar\.z$') THEN '.tar.Z' WHEN regexp_matches(low, '\.tar\.(gz|bz2|xz|zst|lz4|lzma)$') THEN regexp_extract(low, '(\.tar\.[^.]*)$', 1)
  WHEN contains(low, '.') THEN regexp_extract(low, '(\.[^.]*)$', 1) ELSE 'no_extension' END AS ext FROM n""")
def profiler_extension(spark, sf_dir):
    ending = F.element_at(F.array(*map(F.lit, _TAILS)), (1 + F.col("doc_id") % len(_TAILS)).cast("int"))
    path = F.concat(F.lit("a.b/"), F.col("doc_id").cast("string"), ending)
    return table(spark, sf_dir, "documents").select("doc_id", P.shell_extension(path).alias("ext"))


@query("""WITH p AS (SELECT source, 'x/' || doc_id || list_extract(['.c++', '.h', '.C', '.py', '.cpp', '.rsx'], 1 + (length(source) % 3 + doc_id % 2 * 3)::INT) AS path FROM documents)
SELECT source, bool_or(ends_with(path, '.c') OR ends_with(path, '.h')) AS c, bool_or(ends_with(path, '.c++') OR ends_with(path, '.h++') OR ends_with(path, '.cpp')) AS cpp,
  bool_or(ends_with(path, '.py') OR ends_with(path, '.pyw')) AS python, bool_or(ends_with(path, '.rs')) AS rust FROM p GROUP BY source""")
def language_flags(spark, sf_dir):
    endings = F.array(*map(F.lit, (".c++", ".h", ".C", ".py", ".cpp", ".rsx")))
    ending = F.element_at(endings, (1 + F.length("source") % 3 + F.col("doc_id") % 2 * 3).cast("int"))
    rows = table(spark, sf_dir, "documents").select("source", F.concat(F.lit("x/"), F.col("doc_id").cast("string"), ending).alias("path"))
    return files.languages_by(rows, {"c": (".c", ".h"), "cpp": (".c++", ".h++", ".cpp"), "python": (".py", ".pyw"), "rust": (".rs",)}, "source")


_STEM = "regexp_replace(lower(regexp_extract({}, '([^/]*)$', 1)), '\\.py[co]?$', '')"


@query(f"""{W}, target AS (SELECT min(hash) AS h FROM out), met AS (SELECT 'dependencies' AS section, cmd_idx, path, hash FROM dep UNION ALL SELECT 'output', cmd_idx, path, hash FROM out)
SELECT m.cmd_idx, CASE WHEN c.line = '' THEN '?' ELSE c.tool END AS tool, m.section, m.path FROM met m JOIN cmd c USING (cmd_idx), target
WHERE m.hash = h OR {_STEM.format('m.path')} = 'p12.o'""")
def trace_by_hash(spark, sf_dir):
    b = _build(spark, sf_dir)
    listed = F.to_json(F.array_sort(F.collect_list(F.struct("pos", "path", "hash"))))
    commands = b.cmd.select("cmd_idx", F.col("cmd_idx").alias("id"), F.col("argv").alias("command"))
    for section, edges in (("dependencies", b.dep), ("output", b.out)):
        commands = commands.join(edges.groupBy("cmd_idx").agg(listed.alias(section)), "cmd_idx", "left")
    commands = commands.withColumn("modified", F.lit(None).cast("string"))
    return tools.find_file(commands, b.out.agg(F.min("hash")).first()[0], "p12.o").select("cmd_idx", "tool", "section", "path")


@query(f"{W}, s AS (SELECT ord, {_STEM.format('path')} AS stem FROM sig) SELECT stem, count(*) AS files, min(ord) AS first_ord FROM s GROUP BY stem")
def stem_match(spark, sf_dir):
    return _build(spark, sf_dir).src.groupBy(P.stem(F.col("path")).alias("stem")).agg(F.count("*").alias("files"), F.min("ord").alias("first_ord"))


@query(f"{W}, w AS (SELECT DISTINCT 'f' || (o_orderkey % 300) || '.pyc' AS name FROM orders) SELECT w.name, s.path, s.hash FROM w JOIN sig s ON {_STEM.format('s.path')} = {_STEM.format('w.name')}")
def similar_files(spark, sf_dir):
    names = table(spark, sf_dir, "orders").select(F.concat(F.lit("f"), (F.col("o_orderkey") % 300).cast("string"), F.lit(".pyc")).alias("name")).distinct()
    return tools.similar_files(names, _build(spark, sf_dir).src)


_LONG = """long AS (SELECT url AS path, 4 + length(url) AS key_length, CASE WHEN ext = '' THEN 'no_extension' ELSE ext END AS ext
  FROM (SELECT url, lower(regexp_extract(url, '(?:^|/)\\.*[^/.][^/]*?(\\.[^./]*)$', 1)) AS ext FROM pages) WHERE 4 + length(url) > 34)"""


@query(f"WITH {_LONG}, r AS (SELECT *, row_number() OVER (PARTITION BY ext ORDER BY key_length DESC, path DESC) AS k FROM long) SELECT ext, count(*) AS files, string_agg(path, ' ' ORDER BY k) FILTER (WHERE k <= 5) AS examples FROM r GROUP BY ext")
def long_path_hist(spark, sf_dir):
    files = table(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    return languages.long_path_histogram(files, "key", 34).withColumn("examples", F.array_join("examples", " "))


_BY_LANGUAGE = " ".join(f"WHEN ext IN {_listed(e)} THEN '{n}'" for n, e in languages.EXTENSIONS.items())
_KNOWN = "[" + ", ".join(f"'{n}'" for n in sorted(languages.EXTENSIONS)) + "]"
_ALWAYS = "[" + ", ".join(f"'{n}'" for n in languages.ALWAYS_EXCLUDED) + "]"


@query(f"""{W}, e AS (SELECT split_part(path, '/', 3) AS source, {_case("path")} AS ext FROM sig), l AS (SELECT source, CASE {_BY_LANGUAGE} END AS language FROM e),
g AS (SELECT source, coalesce(list(DISTINCT language) FILTER (WHERE language IS NOT NULL), []) AS found FROM l GROUP BY source)
SELECT source, array_to_string(list_sort(list_filter(found, lambda x: NOT list_contains({_ALWAYS}, x))), ',') AS to_analyze,
  array_to_string(list_sort(list_distinct(list_concat(list_filter({_KNOWN}, lambda x: NOT list_contains(found, x)), {_ALWAYS}))), ',') AS to_exclude FROM g""")
def language_sets(spark, sf_dir):
    rows = _build(spark, sf_dir).src.select(F.split("path", "/")[2].alias("source"), P.splitext(F.col("path")).alias("ext"))
    sets = languages.language_sets(rows, "source")
    return sets.select("source", F.array_join("to_analyze", ",").alias("to_analyze"), F.array_join("to_exclude", ",").alias("to_exclude"))


@query(r"""SELECT doc_id, left(trim(regexp_replace(source || ' ' || lang || '/' || doc_id || '__x', '[^\p{L}\p{N}\-_.:]', '_', 'g'), '_'), 95) || '_ab12' AS key FROM documents""")
def sanitize(spark, sf_dir):
    name = F.concat("source", F.lit(" "), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit("__x"))
    return table(spark, sf_dir, "documents").select("doc_id", X.project_key(name, F.lit("ab12")).alias("key"))


@query("""SELECT doc_id, CASE WHEN n < 1000 THEN n || 'ms' WHEN n < 60000 THEN CASE WHEN n < 1000 THEN '' ELSE CAST(n // 1000 AS VARCHAR) END || '.' || lpad(CAST(n % 1000 // 10 AS VARCHAR), 2, '0') || 's'
  ELSE CAST(n // 60000 AS VARCHAR) || 'm' || lpad(CAST(n // 1000 % 60 AS VARCHAR), 2, '0') || 's' END AS short,
  lpad(CAST(n // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(n % 3600 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(n % 60 AS VARCHAR), 2, '0') AS clock
  FROM (SELECT doc_id, doc_id * 77 % 200000 AS n FROM documents)""")
def durations(spark, sf_dir):
    n = F.col("doc_id") * 77 % 200000
    return table(spark, sf_dir, "documents").select("doc_id", X.short_duration(n * 1_000_000 + 7).alias("short"), X.clock(n + 0.5).alias("clock"))


@query("""SELECT user_id, event_type AS status, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def run_status(spark, sf_dir):
    """Two writes to a table of runs, in which the newer event of a user stays whichever comes first."""
    events = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("status"), "ts", F.struct("ts", "event_id").alias("at"))
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema)
    known = versioned.VersionedTable(spark, f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}/runs-{uuid.uuid4().hex}", kind)
    for part in (F.col("status") >= "n", ~F.coalesce(F.col("status") >= "n", F.lit(False))):
        known.upsert(events.filter(part), "user_id", newest="at")
    return known.load().drop("at")


@query("SELECT event_type AS status, count(*) AS runs FROM events GROUP BY 1")
def run_status_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("runs"))


_MAKERS = _listed((*passes.COMPILERS, *passes.LINKERS))


def _round(k: int) -> str:
    """CTEs of one step of pass 4: commands touched, suspicious edges, and the next keys unless it is the last."""
    before = " UNION ALL ".join(f"SELECT bin_key FROM x{i}" for i in range(1, k + 1))
    after = f""",
f{k + 1} AS (SELECT DISTINCT key FROM d4 WHERE bucket = 'intermediate' AND cmd_idx IN (SELECT cmd_idx FROM t{k}) AND key NOT IN ({before}))"""
    return f"""t{k} AS (SELECT o.cmd_idx, o.key FROM o4 o JOIN f{k} USING (key)),
x{k} AS (SELECT DISTINCT t.key AS bin_key FROM t{k} t JOIN cmd c USING (cmd_idx) JOIN d4 d USING (cmd_idx) WHERE c.tool IN {_MAKERS} AND d.bucket = 'suspicious')""" + (after if k < binaries.ROUNDS else "")


_STEPS = range(1, binaries.ROUNDS + 1)
_CONTAINER = r"list_last(list_filter(list_transform(string_split(path, '/'), lambda c: regexp_replace(c, '_dir$', '')), lambda c: regexp_matches(c, '\.(iso|deb|rpm|tar|tgz|zip|gz|xz|bz2)$')))"
_DISTRO = rf"NOT regexp_matches(path, '\.(deb|rpm)(_dir)?(/|$)') AND regexp_matches(regexp_replace(path, '^.*?bin/', ''), '^/?({'|'.join(K.DISTRO_PREFIXES)})')"
_PASS4 = f"""o4 AS (SELECT DISTINCT cmd_idx, right(hash, 16) AS key FROM out WHERE hash IS NOT NULL),
d4 AS (SELECT cmd_idx, path, right(hash, 16) AS key, CASE WHEN {" OR ".join(f"starts_with(path, '{x}')" for x in P.SYSTEM_PREFIXES)} THEN 'system' WHEN hash IN (SELECT hash FROM sig WHERE hash IS NOT NULL) THEN 'src'
  WHEN {_case("path")} IN {_listed(P.RESOURCES)} THEN 'resource'
  WHEN {_case("path")} IN {_listed(P.HEADERS)} OR regexp_matches(path, '\\.so(\\.\\d+)*$') AND (regexp_matches(path, '/(lib|lib64|include)/') OR starts_with(path, '/usr/') OR starts_with(path, '/lib')) THEN 'allowed'
  WHEN hash IN (SELECT hash FROM out) THEN 'intermediate' ELSE 'suspicious' END AS bucket FROM dep WHERE hash IS NOT NULL),
f1 AS (SELECT DISTINCT right(hash, 16) AS key FROM bin WHERE hash IS NOT NULL),
{", ".join(_round(k) for k in _STEPS)},
seen AS (SELECT DISTINCT key FROM d4 WHERE {" OR ".join(f"cmd_idx IN (SELECT cmd_idx FROM t{k})" for k in _STEPS)}),
tainted AS ({" UNION ".join(f"SELECT bin_key FROM x{k}" for k in _STEPS)}),
b4 AS (SELECT ord, path, hash, {_CONTAINER} AS container, {_DISTRO} AS system, coalesce(hash IN (SELECT hash FROM sig WHERE hash IS NOT NULL), false) AS own,
  coalesce(hash IN (SELECT hash FROM out), false) AS made, coalesce(right(hash, 16) IN (SELECT key FROM seen), false) AS read, coalesce(right(hash, 16) IN (SELECT bin_key FROM tainted), false) AS tainted FROM bin),
p4 AS (SELECT ord, path, hash, container, CASE WHEN system THEN 'system_binaries' WHEN hash IS NULL THEN 'untraced_external'
  WHEN NOT made AND NOT read THEN CASE WHEN own THEN 'untraced_from_src' ELSE 'untraced_external' END
  WHEN NOT made THEN CASE WHEN own THEN 'binaries_from_src' ELSE 'external_prebuilt' END
  WHEN tainted THEN 'external_built' WHEN own THEN 'binaries_from_src' ELSE 'compiled_from_src' END AS category FROM b4)"""


#: Pass 4 with all commands that lead to the distribution in place of those at most ``ROUNDS`` steps away.
_TAINTED = f"""tainted AS ({" UNION ".join(f"SELECT bin_key FROM x{k}" for k in _STEPS)})"""
_STEPWISE = _PASS4[_PASS4.index("t1 AS ("):_PASS4.index(_TAINTED)]
_WALKED = """g4 AS (SELECT DISTINCT o.key, d.key AS used FROM o4 o JOIN d4 d USING (cmd_idx) WHERE d.bucket = 'intermediate'),
w4 AS (SELECT key FROM f1 UNION SELECT g.used FROM w4 w JOIN g4 g ON g.key = w.key),
t4 AS (SELECT cmd_idx, key FROM o4 WHERE key IN (SELECT key FROM w4)),
seen AS (SELECT DISTINCT key FROM d4 WHERE cmd_idx IN (SELECT cmd_idx FROM t4)),
"""
_WHOLE = _PASS4.replace(_STEPWISE, _WALKED).replace(_TAINTED, f"""tainted AS (SELECT DISTINCT t.key AS bin_key FROM t4 t JOIN cmd c USING (cmd_idx) JOIN d4 d USING (cmd_idx) WHERE c.tool IN {_MAKERS} AND d.bucket = 'suspicious')""")


@query(f"{W}, {_PASS4} SELECT ord, path, hash, container, category FROM p4")
def pass4_classes_direct(spark, sf_dir):
    return binaries.pass4(_build(spark, sf_dir))


@query(f"{W}, {_PASS4} SELECT category, count(*) AS files, round(100.0 * count(*) / (SELECT count(*) FROM p4), 4)::DOUBLE AS percent FROM p4 GROUP BY category")
def pass4_percent(spark, sf_dir):
    return passes.summary(binaries.pass4(_build(spark, sf_dir)))


_REACHED = f"""e4 AS (SELECT DISTINCT o.key AS made, d.key AS used, d.bucket FROM o4 o JOIN cmd c USING (cmd_idx) JOIN d4 d USING (cmd_idx) WHERE c.tool IN {_MAKERS} AND d.bucket IN ('intermediate', 'suspicious')),
r1 AS (SELECT DISTINCT made FROM e4 WHERE bucket = 'suspicious'),
{", ".join(f"r{k} AS (SELECT DISTINCT made FROM e4 WHERE bucket = 'intermediate' AND used IN (SELECT made FROM r{k - 1}))" for k in _STEPS if k > 1)},
tainted AS (SELECT made AS bin_key FROM ({" UNION ".join(f"SELECT made FROM r{k}" for k in _STEPS)}))"""


_WHOLLY_REACHED = f"""{_REACHED[:_REACHED.index("r1 AS (")]}tainted AS (SELECT made AS bin_key FROM e4 WHERE bucket = 'suspicious'
  UNION SELECT e.made FROM tainted t JOIN e4 e ON e.used = t.bin_key WHERE e.bucket = 'intermediate')"""


@query(f"{W}, {_PASS4.replace(_STEPWISE, _WALKED).replace(_TAINTED, _WHOLLY_REACHED)} SELECT ord, path, hash, container, category FROM p4")
def pass4_classes_transitive(spark, sf_dir):
    return binaries.pass4(_build(spark, sf_dir), transitive=True, rounds=None)


_SUSPICIOUS = f"""x4 AS (SELECT DISTINCT key, regexp_replace(path, '\\.so(\\.\\d+)*$', '.so') AS dep_path FROM (
  {" UNION ".join(f"SELECT t.key, d.path FROM t{k} t JOIN cmd c USING (cmd_idx) JOIN d4 d USING (cmd_idx) WHERE c.tool IN {_MAKERS} AND d.bucket = 'suspicious'" for k in _STEPS)})),
s4 AS (SELECT p.ord, p.path, p.hash, x.dep_path FROM p4 p JOIN x4 x ON x.key = right(p.hash, 16) WHERE p.category = 'external_built')"""


@query(f"{W}, {_PASS4}, {_SUSPICIOUS} SELECT ord, path, hash, dep_path FROM s4")
def suspicious_inputs(spark, sf_dir):
    b = _build(spark, sf_dir)
    scanned = binaries.scan(b)
    return binaries.suspicious_inputs(b, binaries.pass4(b, scanned=scanned), scanned)


def _outer(path: str) -> str:
    return rf"lower(split_part(regexp_replace(regexp_extract({path}, '([^/]*)$', 1), '\.[^.]*$', ''), '$', 1))"


@query(f"""{W}, {_PASS4}, {_SUSPICIOUS}, named AS (SELECT lower(regexp_replace(regexp_extract(path, '([^/]*)$', 1), '\\.[^.]*$', '')) AS stem FROM sig WHERE {_case("path")} = '.java'),
judged AS (SELECT *, {_case("dep_path")} = '.class' AND {_outer("dep_path")} NOT IN (SELECT stem FROM named) AS real, ends_with(lower(path), '.class') AND {_outer("path")} IN (SELECT stem FROM named) AS trusted FROM s4)
SELECT ord, path, hash, CASE WHEN trusted OR NOT bool_or(real) THEN 'compiled_from_src' ELSE 'external_built' END AS category,
  CASE WHEN NOT trusted THEN count(*) FILTER (WHERE NOT real) END AS deps_removed FROM judged GROUP BY ord, path, hash, trusted""")
def java_trust(spark, sf_dir):
    b = _build(spark, sf_dir)
    scanned = binaries.scan(b)
    return binaries.trusted_java(b, binaries.pass4(b, scanned=scanned), scanned)


_ALLOWED = f"""({" OR ".join(f"starts_with(path, '{x}')" for x in P.SYSTEM_PREFIXES)} OR {_case("path")} IN {_listed(P.HEADERS)}
    OR regexp_matches(path, '\\.so(\\.\\d+)*$') AND (regexp_matches(path, '/(lib|lib64|include)/') OR starts_with(path, '/usr/') OR starts_with(path, '/lib')))"""


@query(f"""{W}, {_PASS4}, l4 AS (SELECT * FROM (SELECT *, right(hash, 16) AS key, row_number() OVER (PARTITION BY right(hash, 16) ORDER BY ord DESC) AS k FROM p4 WHERE category = 'external_built') WHERE k = 1),
a4 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cmd_idx, path ORDER BY pos) AS k FROM dep WHERE {_ALLOWED}) WHERE k = 1),
c4 AS (SELECT key, max(cmd_idx) AS cmd_idx FROM o4 WHERE key IN (SELECT key FROM l4) AND cmd_idx IN (SELECT cmd_idx FROM a4) GROUP BY key)
SELECT l.ord, l.path, l.hash, a.path AS dep_path, coalesce(a.hash, '') AS dep_hash, CASE WHEN {_case("a.path")} IN ('.h', '.hpp', '.hxx') THEN 'header' ELSE 'system_path' END AS reason
FROM c4 JOIN l4 l USING (key) JOIN a4 a ON a.cmd_idx = c4.cmd_idx""")
def filtered_deps(spark, sf_dir):
    b = _build(spark, sf_dir)
    return binaries.filtered_dependencies(b, binaries.pass4(b))


_PACKAGE = r"""CASE WHEN regexp_matches(path, '\.(deb|rpm)(_dir)?(/|$)') THEN 'deb' WHEN regexp_matches(path, '(^|/)(site|dist)-packages(/|$)') THEN 'pip' WHEN regexp_matches(path, '(^|/)node_modules(/|$)') THEN 'npm' END AS package_type,
  CASE WHEN regexp_matches(path, '\.(deb|rpm)(_dir)?(/|$)') THEN regexp_extract(path, '(?:^|/)([^/]*\.(?:deb|rpm))(?:_dir)?(?:/|$)', 1) WHEN regexp_matches(path, '(^|/)(site|dist)-packages(/|$)') THEN regexp_extract(path, '(?:site|dist)-packages/([^/]*)', 1)
    WHEN regexp_matches(path, '(^|/)node_modules(/|$)') THEN regexp_extract(path, 'node_modules/(@[^/]*/[^/]*|[^/]*)', 1) END AS container"""


@query(f"{W} SELECT path, {_PACKAGE} FROM bin")
def package_detect(spark, sf_dir):
    return _build(spark, sf_dir).bin.select("path", K.package(F.col("path")).alias("p")).select("path", "p.package_type", "p.container")


@query(f"{W}, {_PASS4}, u AS (SELECT path, hash FROM p4 WHERE category = 'untraced_external') SELECT * FROM (SELECT path, hash, {_PACKAGE} FROM u) WHERE package_type IS NOT NULL")
def package_content(spark, sf_dir):
    return binaries.package_content(binaries.pass4(_build(spark, sf_dir)))


@query(f"""{W}, {_PASS1}, {_PASS4} SELECT category, {_DISK} AS disk, count(*) AS files FROM (SELECT category, path FROM p1 UNION ALL SELECT category, path FROM p4) GROUP BY 1, 2""")
def pass5_by_disk(spark, sf_dir):
    b = _build(spark, sf_dir)
    return binaries.by_disk(passes.pass1(b), binaries.pass4(b))


_ENDINGS = (".tar.gz", ".jar", ".o", ".bin", "", ".TXT", ".tar.Z", ".rpm", ".whl", ".so", ".xz", ".png", ".lz4")
_NAMED = f"""f AS (SELECT doc_id AS ord, source || '/f' || doc_id || {adapters._case(f"doc_id % {len(_ENDINGS)}", _ENDINGS)} AS path,
  {adapters._case("doc_id % 4", ("gzip compressed data", "ELF 64-bit LSB executable", "Zip archive data", "RPM v3"))} AS magic FROM documents)"""
_NAME = "lower(regexp_extract(path, '([^/]*)$', 1))"


def _named_files(spark, sf_dir) -> DataFrame:
    return adapters.over(spark, f"WITH {_NAMED} SELECT * FROM f", documents=table(spark, sf_dir, "documents"))


_PLAN = f"""CASE {" ".join(f"WHEN regexp_matches({_NAME}, '{A.pattern(e)}') THEN '{m}'" for e, m in A.METHODS_BY_ENDING)} ELSE '' END AS m1,
  CASE {" ".join(f"WHEN contains(magic, '{part.replace(chr(39), chr(39) * 2)}') THEN '{m}'" for part, m in A.METHODS_BY_MAGIC)} ELSE '' END AS m2"""
_ARCHIVES = A.pattern(tuple(e for es, _ in A.METHODS_BY_ENDING for e in es) + A.ONLY_ARCHIVES)


@query(f"""WITH {_NAMED}, m AS (SELECT ord, path, {_PLAN} FROM f), l AS (SELECT *, list_filter(string_split(m1, ' '), lambda x: x <> '') AS a, list_filter(string_split(m2, ' '), lambda x: x <> '') AS b FROM m)
SELECT ord, array_to_string(list_concat(a, list_filter(b, lambda x: NOT list_contains(a, x))), ' ') AS methods,
  CASE WHEN ends_with({_NAME}, '.jar') THEN 'skipped' WHEN regexp_matches({_NAME}, '{_ARCHIVES}') THEN 'archive'
    WHEN NOT contains({_NAME}, '.') OR regexp_extract({_NAME}, '([^.]*)$', 1) IN {_listed(A.AMBIGUOUS)} THEN 'check' ELSE 'other' END AS kind FROM l""")
def archive_method_plan(spark, sf_dir):
    p = F.col("path")
    return _named_files(spark, sf_dir).select("ord", F.array_join(A.plan(p, F.col("magic")), " ").alias("methods"), A.kind(p).alias("kind"))


@query(f"""WITH {_NAMED}, e AS (SELECT path, CASE WHEN contains({_NAME}, '.') THEN regexp_extract({_NAME}, '(\\.[^.]*)$', 1) ELSE 'no_extension' END AS ext FROM f)
SELECT CASE WHEN ext IN {_listed(A.BINARY)} THEN 'BINARY_EXT' WHEN ext IN {_listed(A.SAFE)} THEN 'SAFE' ELSE 'MAGIC' END AS type, count(*) AS files FROM e GROUP BY 1""")
def binary_triage(spark, sf_dir):
    return _named_files(spark, sf_dir).groupBy(A.triage(F.col("path")).alias("type")).agg(F.count("*").alias("files"))


_SPOTS = f"""spots AS (SELECT 'rule:' || lang AS ruleKey, text AS message, {adapters._case("doc_id % 4", ("xss", "dos", "unheard-of", "auth"))} AS securityCategory,
  {adapters._case("doc_id % 3", ("HIGH", "MEDIUM", "LOW"))} AS vulnerabilityProbability, CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'K:' END || 'src/f' || doc_id || {adapters._case("doc_id % 12", adapters.EXTENSIONS)} AS component,
  CASE WHEN doc_id % 5 > 0 THEN doc_id % 100 END AS line, 'TO_REVIEW' AS status, CAST(NULL AS STRING) AS resolution FROM documents)"""


def _lookup(key: str, names: dict[str, str], other: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + f" ELSE {other} END"


@query(rf"""WITH {_SPOTS}, t AS (SELECT *, regexp_replace(message, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g') AS clean, CASE WHEN contains(component, '.') THEN regexp_extract(component, '([^.]*)$', 1) ELSE '' END AS ext FROM spots)
SELECT coalesce(ruleKey, '') AS "rule", coalesce(CASE WHEN length(clean) > 32767 THEN left(clean, 32764) || '...' ELSE clean END, '') AS message, {_lookup("securityCategory", hotspots.CATEGORIES, "securityCategory")} AS category,
  vulnerabilityProbability AS probability, CASE vulnerabilityProbability WHEN 'HIGH' THEN 'CRITICAL' WHEN 'MEDIUM' THEN 'MAJOR' ELSE 'MINOR' END AS severity,
  CASE WHEN ext = '' THEN 'Unknown' ELSE {_lookup("ext", hotspots.LANGUAGES, "upper(ext)")} END AS language, regexp_replace(component, '^K:', '') AS file, coalesce(CAST(line AS VARCHAR), '') AS line,
  status, '' AS resolution, '' AS comments FROM t""")
def hotspot_report(spark, sf_dir):
    return hotspots.report(adapters.over(spark, f"WITH {_SPOTS} SELECT * FROM spots", documents=table(spark, sf_dir, "documents")), "K")


_WRITTEN = "CASE WHEN tool IN ('apt', 'cp') THEN 'dl/e' || (cmd_idx % 50) || '_1' || CASE WHEN cmd_idx % 2 = 0 THEN '.deb' ELSE '.whl' END ELSE path END"
_INDEX = f"""o9 AS (SELECT cmd_idx, pos, tool, {_WRITTEN} AS path FROM out JOIN cmd USING (cmd_idx)),
i9 AS (SELECT * FROM (SELECT *, regexp_extract(path, '([^/]*)$', 1) AS container, row_number() OVER (PARTITION BY regexp_extract(path, '([^/]*)$', 1) ORDER BY cmd_idx, pos) AS k FROM o9 WHERE regexp_matches(path, '\\.(deb|rpm|whl)$')) WHERE k = 1),
d9 AS (SELECT i.container, d.path, row_number() OVER (PARTITION BY i.container ORDER BY regexp_extract(d.path, '([^/]*)$', 1) <> i.container, d.pos) AS k FROM i9 i JOIN dep d ON d.cmd_idx = i.cmd_idx
  WHERE contains(lower(d.path), split_part(i.container, '_', 1)))"""


@query(f"""{W}, {_INDEX} SELECT i.container, CASE WHEN ends_with(i.path, '.whl') THEN 'pip' ELSE 'deb' END AS package_type, coalesce(d.path, i.path) AS source,
  CASE i.tool WHEN 'apt' THEN 'apt download' ELSE i.tool END AS command, i.cmd_idx, i.pos FROM i9 i LEFT JOIN d9 d ON d.container = i.container AND d.k = 1""")
def package_index(spark, sf_dir):
    """The adapter's commands write no packages: outputs of two tools are renamed."""
    b = _build(spark, sf_dir)
    out = b.out.join(b.cmd.select("cmd_idx", "tool"), "cmd_idx").withColumn("path", F.expr(_WRITTEN)).drop("tool")
    return packages.package_index(replace(b, out=out))


_UNPACKED = """files AS (
SELECT 'x' || (p_partkey % 7) || '.iso_dir/y' || (p_partkey % 11) || '.deb_dir/f' || p_partkey AS path, md5('f' || p_partkey) AS hash FROM part
UNION ALL SELECT DISTINCT 'x' || (p_partkey % 7) || '.iso' AS path, md5('x' || (p_partkey % 7)) AS hash FROM part WHERE p_partkey % 7 < 5
UNION ALL SELECT DISTINCT 'x' || (p_partkey % 7) || '.iso_dir/y' || (p_partkey % 11) || '.deb' AS path, md5('y' || (p_partkey % 11)) AS hash FROM part WHERE p_partkey % 11 < 8)"""


@query(f"""WITH {_UNPACKED}, c AS (SELECT f.path, f.hash, coalesce(list(a.hash ORDER BY length(a.path) DESC) FILTER (WHERE a.hash IS NOT NULL), []) AS c FROM files f LEFT JOIN files a ON starts_with(f.path, a.path || '_dir/') GROUP BY f.path, f.hash)
SELECT path, hash, replace(path, '_dir/', '/') AS virtual_path, coalesce(c[1], '0') AS parents_hash, array_to_string(c, ',') AS parents_chain FROM c""")
def parent_chain(spark, sf_dir):
    return signatures.parent_chain(adapters.over(spark, f"WITH {_UNPACKED} SELECT * FROM files", part=table(spark, sf_dir, "part"))).withColumn("parents_chain", F.array_join("parents_chain", ","))


@query(f"""{W}, {_GOOD}, {_FIRST}, {_PASS3}, l AS (SELECT p.ord, p.path, p.hash, c.line FROM p3 p JOIN reads r ON r.hash = p.hash JOIN cmd c ON c.cmd_idx = r.cmd_idx WHERE p.category = 'executed')
SELECT p.ord, p.path, p.hash, coalesce(string_agg(DISTINCT l.line, '; ') FILTER (WHERE l.line <> ''), '') AS commands FROM p3 p LEFT JOIN l USING (ord) WHERE p.category = 'executed' GROUP BY p.ord, p.path, p.hash""")
def executed_commands(spark, sf_dir):
    b = _build(spark, sf_dir)
    return passes.executed_commands(b, passes.pass3(b, passes.good(b))).withColumn("commands", F.array_join("commands", "; "))


_ALL = f"""{W}, {_PASS1}, {_GOOD}, {_KEYS}, {_PASS2}, {_FIRST}, {_PASS3}, {_PASS4},
classes AS (SELECT category FROM p2 UNION ALL SELECT 'redundant' FROM p2 WHERE category = 'not_compiled' UNION ALL SELECT category FROM p3 UNION ALL SELECT category FROM p4)"""


def _classes(spark, sf_dir, rounds: int | None = binaries.ROUNDS) -> DataFrame:
    b = _build(spark, sf_dir)
    good = passes.good(b)
    second = summaries.with_redundant(passes.pass2(b, passes.pass1(b), good))
    return second.select("category").union(passes.pass3(b, good).select("category")).union(binaries.pass4(b, rounds=rounds).select("category"))


@query(f"""{_ALL}, t AS (SELECT count(*) FILTER (WHERE category IN {_listed(summaries.SOURCES)}) AS total_source, count(*) FILTER (WHERE category IN {_listed(summaries.INTERPRETED)}) AS total_interpreted,
  count(*) FILTER (WHERE category IN {_listed(summaries.SPARE)}) AS redundant_all, count(*) FILTER (WHERE category IN {_listed(summaries.BINARIES)}) AS total_binaries FROM classes)
SELECT total_source, total_interpreted, total_source + total_interpreted AS total_all, redundant_all, total_source + total_interpreted - redundant_all AS used_all, total_binaries FROM t""")
def summary_counts(spark, sf_dir):
    return summaries.totals(_classes(spark, sf_dir))


@query(f"""{_ALL.replace(_PASS4, _WHOLE)}, s AS (SELECT CASE WHEN category IN {_listed(summaries.SOURCES)} THEN 'source' WHEN category IN {_listed(summaries.INTERPRETED)} THEN 'interpreted' WHEN category IN {_listed(summaries.BINARIES)} THEN 'binaries' END AS section, category FROM classes)
SELECT section, category, count(*) AS files, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY section), 1)::DOUBLE AS percent FROM s WHERE section IS NOT NULL GROUP BY section, category""")
def summary_shares(spark, sf_dir):
    return summaries.shares(_classes(spark, sf_dir, rounds=None))


@query(f"""{W}, {_PASS4}, r4 AS (SELECT DISTINCT cmd_idx FROM ({" UNION ".join(f"SELECT cmd_idx FROM t{k}" for k in _STEPS)}))
SELECT bucket, count(*) AS inputs, count(*) * 100 // sum(count(*)) OVER () AS percent FROM d4 JOIN r4 USING (cmd_idx) GROUP BY bucket""")
def filter_statistics(spark, sf_dir):
    return binaries.filter_statistics(binaries.scan(_build(spark, sf_dir))).withColumn("percent", F.col("percent").cast("long"))


_LOADED = f"""{_INDEX}, loaded AS (SELECT DISTINCT regexp_extract(o.path, '([^/]*)$', 1) AS container FROM o9 o JOIN cmd c USING (cmd_idx) WHERE c.tool = 'apt' AND split_part(c.line, ' ', 2) = 'download' AND ends_with(lower(o.path), '.deb'))"""


def _with_packages(spark, sf_dir) -> passes.Build:
    """The adapter's commands write no packages: outputs of two tools are renamed."""
    b = _build(spark, sf_dir)
    return replace(b, out=b.out.join(b.cmd.select("cmd_idx", "tool"), "cmd_idx").withColumn("path", F.expr(_WRITTEN)).drop("tool"))


@query(f"{W}, {_LOADED} SELECT container FROM loaded")
def apt_containers(spark, sf_dir):
    return binaries.apt_containers(_with_packages(spark, sf_dir))


_CONTENT = f"""{_PASS4}, {_LOADED}, a4c AS (SELECT path, hash, container, CASE WHEN container IN (SELECT container FROM loaded) THEN 'apt_package_content' ELSE category END AS category FROM p4),
n4 AS (SELECT path, hash, package_type, container FROM (SELECT path, hash, {_PACKAGE} FROM a4c WHERE category = 'untraced_external') WHERE package_type IS NOT NULL
  UNION ALL SELECT path, hash, 'deb', container FROM a4c WHERE category = 'apt_package_content'),
f9 AS (SELECT i.container, CASE WHEN ends_with(i.path, '.whl') THEN 'pip' ELSE 'deb' END AS package_type, coalesce(d.path, i.path) AS source, CASE i.tool WHEN 'apt' THEN 'apt download' ELSE i.tool END AS command, i.cmd_idx
  FROM i9 i LEFT JOIN d9 d ON d.container = i.container AND d.k = 1),
s9 AS (SELECT n.path, n.package_type, n.container, f.source, f.command, row_number() OVER (PARTITION BY n.path ORDER BY f.cmd_idx) AS k FROM n4 n JOIN f9 f ON f.package_type = 'pip' AND n.package_type = 'pip' AND contains(lower(f.container), lower(n.container))),
c9 AS (SELECT n.*, coalesce(f.source, s.source, '') AS source, coalesce(f.command, s.command, n.package_type) AS command FROM n4 n LEFT JOIN f9 f ON f.container = n.container LEFT JOIN s9 s ON s.path = n.path AND s.k = 1)"""


def _content(spark, sf_dir, rounds: int | None = binaries.ROUNDS) -> DataFrame:
    b, plain = _with_packages(spark, sf_dir), _build(spark, sf_dir)
    return binaries.all_package_content(binaries.pass4(plain, binaries.apt_containers(b), rounds=rounds), packages.package_index(b))


@query(f"{W}, {_CONTENT} SELECT path, hash, package_type, container, source, command FROM c9")
def package_content_origin(spark, sf_dir):
    return _content(spark, sf_dir)


@query(f"""{W}, {_CONTENT.replace(_PASS4, _WHOLE)} SELECT package_type, container, first(source ORDER BY path, hash) AS source, first(command ORDER BY path, hash) AS command, count(*) AS files_count,
  string_agg(path || ' ' || hash, ',' ORDER BY path, hash) AS files FROM c9 GROUP BY package_type, container""")
def package_groups(spark, sf_dir):
    shown = F.array_join(F.transform("files", lambda f: F.concat_ws(" ", f.path, f.hash)), ",")
    return summaries.packages(_content(spark, sf_dir, rounds=None)).withColumn("files", shown)


@query(f"{W}, {_CONTENT} SELECT count(*) AS total_files, count(DISTINCT (package_type, container)) AS total_packages FROM c9")
def package_totals(spark, sf_dir):
    return summaries.package_count(_content(spark, sf_dir))


_DIRECT = f"""x5 AS ({" UNION ".join(f"SELECT t.key, p.path AS dep_path, p.hash AS dep_hash FROM t{k} t JOIN cmd c USING (cmd_idx) JOIN d4 d USING (cmd_idx) JOIN dep p ON p.cmd_idx = d.cmd_idx AND p.path = d.path AND right(p.hash, 16) = d.key WHERE c.tool IN {_MAKERS} AND d.bucket = 'suspicious'" for k in _STEPS)})"""


@query(f"{W}, {_PASS4}, {_DIRECT} SELECT p.ord, p.path, p.hash, x.dep_path, x.dep_hash FROM p4 p JOIN x5 x ON x.key = right(p.hash, 16) WHERE p.category = 'external_built' AND NOT {_ALIASED}")
def external_inputs(spark, sf_dir):
    """Those that aren't shared libraries; versions of these are merged in external_deps_alias_merged."""
    b = _build(spark, sf_dir)
    scanned = binaries.scan(b)
    rows = binaries.external_inputs(b, binaries.pass4(b, scanned=scanned), scanned)
    return rows.filter(~F.col("dep_path").rlike(r"\.so(\.\d+)*$")).select("ord", "path", "hash", "dep_path", "dep_hash").distinct()


_TRANSITIVE = f"""m5 AS (SELECT o.cmd_idx, o.key FROM o4 o JOIN cmd c USING (cmd_idx) WHERE c.tool IN {_MAKERS}),
e5 AS (SELECT DISTINCT m.key, d.key AS used FROM m5 m JOIN d4 d USING (cmd_idx) WHERE d.bucket = 'intermediate'),
s5 AS (SELECT DISTINCT m.key, p.path AS dep_path, p.hash AS dep_hash FROM m5 m JOIN d4 d USING (cmd_idx) JOIN dep p ON p.cmd_idx = d.cmd_idx AND p.path = d.path AND right(p.hash, 16) = d.key WHERE d.bucket = 'suspicious'),
w1 AS (SELECT DISTINCT right(hash, 16) AS key, right(hash, 16) AS node FROM p4 WHERE category = 'external_built'),
{", ".join(f"w{k} AS (SELECT DISTINCT w.key, e.used AS node FROM w{k - 1} w JOIN e5 e ON e.key = w.node)" for k in _STEPS if k > 1)},
x5 AS (SELECT DISTINCT w.key, s.dep_path, s.dep_hash FROM ({" UNION ".join(f"SELECT key, node FROM w{k}" for k in _STEPS)}) w JOIN s5 s ON s.key = w.node)"""


@query(f"{W}, {_PASS4.replace(_TAINTED, _REACHED)}, {_TRANSITIVE} SELECT p.ord, p.path, p.hash, x.dep_path, x.dep_hash FROM p4 p JOIN x5 x ON x.key = right(p.hash, 16) WHERE p.category = 'external_built' AND NOT {_ALIASED}")
def external_inputs_transitive(spark, sf_dir):
    """As ``external_inputs``, over up to three steps of made inputs."""
    b = _build(spark, sf_dir)
    scanned = binaries.scan(b)
    rows = binaries.external_inputs(b, binaries.pass4(b, transitive=True, scanned=scanned), scanned, transitive=True)
    return rows.filter(~F.col("dep_path").rlike(r"\.so(\.\d+)*$")).select("ord", "path", "hash", "dep_path", "dep_hash").distinct()


def _projects(spark, sf_dir) -> passes.Build:
    """Two projects with the same files; odd commands are of one, even ones of the other."""
    b = _build(spark, sf_dir)
    name = F.when(F.col("cmd_idx") % 2 == 1, "odd").otherwise("even").alias("project")
    own = lambda df: df.select("*", name)
    both = lambda df: df.select("*", F.explode(F.array(F.lit("odd"), F.lit("even"))).alias("project"))
    return passes.Build(both(b.src), both(b.bin), own(b.cmd), own(b.dep), own(b.out), b.roles, b.rules)


_PROJECT = "CASE WHEN cmd_idx % 2 = 1 THEN 'odd' ELSE 'even' END AS project"
_BOTH = "(SELECT unnest(['odd', 'even']) AS project)"


@query(f"""{W}, pool AS (SELECT {_PROJECT}, hash FROM dep UNION SELECT {_PROJECT}, hash FROM out)
SELECT n.project, s.ord, s.path, CASE WHEN (n.project, s.hash) IN (SELECT (project, hash) FROM pool) THEN 'direct' WHEN (n.project, s.parent) IN (SELECT (project, hash) FROM pool) THEN 'parent'
  WHEN s.hash IN (SELECT hash FROM bin) THEN 'untraced_in_distrib' ELSE 'redundant' END AS category FROM sig s, {_BOTH} n WHERE {_IS_SOURCE}""")
def projects_pass1(spark, sf_dir):
    return passes.pass1(_projects(spark, sf_dir)).select("project", "ord", "path", "category")


@query(f"""{W}, good AS (SELECT {_PROJECT}, cmd_idx FROM out WHERE hash IN (SELECT hash FROM bin) OR path IN (SELECT path FROM bin)
  UNION SELECT g.project, o.cmd_idx FROM good g JOIN dep d ON d.cmd_idx = g.cmd_idx JOIN out o ON (o.hash = d.hash OR o.path = d.path) AND o.cmd_idx % 2 = g.cmd_idx % 2) SELECT * FROM good""")
def projects_good_commands(spark, sf_dir):
    return passes.good(_projects(spark, sf_dir)).select("project", "cmd_idx")


@query(f"""{W}, {_PASS1}, k AS (SELECT split_part(path, '/', 4) AS project, CASE WHEN category = 'untraced_in_distrib' THEN 'other' ELSE 'source' END AS section, category FROM p1),
sums AS (SELECT project, section, category, count(*) AS files, GROUPING_ID(project, section, category) AS level FROM k GROUP BY ROLLUP (project, section, category))
SELECT s.project, s.section, s.category, s.files, round(100.0 * s.files / a.files, 4)::DOUBLE AS percent FROM sums s LEFT JOIN sums a ON a.level > 0 AND a.level = CASE s.level WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 7 END
  AND (s.level = 3 OR s.level = 7 OR a.project = s.project) AND (s.level > 0 OR a.section = s.section)""")
def projects_rollup(spark, sf_dir):
    rows = passes.pass1(_build(spark, sf_dir)).select(F.split("path", "/")[3].alias("project"), "category")
    return summaries.rollup(rows)


@query("""WITH w AS (SELECT page_id AS ord, 'd' || (page_id % 3) AS folder, 'n' || (page_id % 40) || CASE WHEN page_id % 41 = 0 THEN '_1' ELSE '' END AS name FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY folder, name ORDER BY ord) - 1 AS n FROM w),
c AS (SELECT DISTINCT s.folder, s.name, s.name || '_' || k AS made, k FROM (SELECT DISTINCT folder, name FROM w) s, (SELECT unnest(generate_series(1, 200)) AS k)),
f AS (SELECT folder, name, made, row_number() OVER (PARTITION BY folder, name ORDER BY k) AS n FROM c WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.folder = c.folder AND w.name = c.made))
SELECT r.folder, r.name, r.ord, coalesce(f.made, r.name) AS "unique" FROM r LEFT JOIN f ON f.folder = r.folder AND f.name = r.name AND f.n = r.n""")
def unique_names(spark, sf_dir):
    name = F.concat(F.lit("n"), (F.col("page_id") % 40).cast("string"), F.when(F.col("page_id") % 41 == 0, "_1").otherwise(""))
    return naming.unique_names(table(spark, sf_dir, "pages").select(F.concat(F.lit("d"), (F.col("page_id") % 3).cast("string")).alias("folder"), name.alias("name"), F.col("page_id").alias("ord")))


@query("""WITH k AS (SELECT DISTINCT user_id, CASE WHEN user_id % 3 = 0 THEN 'exported' ELSE 'never' END AS state FROM events WHERE user_id % 4 <> 0),
n AS (SELECT user_id, max(event_id) AS last FROM events WHERE event_type IN ('purchase', 'error') AND user_id % 2 = 0 GROUP BY user_id), r AS (SELECT n.user_id, CASE WHEN e.event_type = 'error' THEN 'failed' ELSE 'success' END AS status FROM n JOIN events e ON e.event_id = n.last)
SELECT 'u' || coalesce(k.user_id, r.user_id) AS project_name, coalesce(r.status, 'success') AS status,
  CASE WHEN r.status = 'failed' THEN 'never' ELSE coalesce(k.state, 'never') END AS hotspots_status FROM k FULL JOIN r ON r.user_id = k.user_id""")
def run_upserts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    name = F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("project_name")
    empty = {c.split(" ")[0]: F.lit(None).cast(c.split(" ")[1]) for c in runs.RUN.split(", ")}
    state = F.when(F.col("user_id") % 3 == 0, "exported").otherwise("never")
    known = events.filter("user_id % 4 <> 0").select("user_id").distinct().select(name, state.alias("hotspots_status")).withColumns({c: v for c, v in empty.items() if c not in ("project_name", "hotspots_status")})
    known = known.withColumn("status", F.lit("success")).select(*empty)
    last = events.filter("event_type IN ('purchase', 'error') AND user_id % 2 = 0").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("kind"))
    results = last.select(name, F.when(F.col("kind") == "error", "failed").otherwise("success").alias("status")).withColumns({c: empty[c] for c in runs.RESULT if c != "status"})
    return runs.with_results(known, results).select("project_name", "status", "hotspots_status")


_RULES = {
    "sources": [".PY", ".js", ".sh"], "excluded": [], "compiled": [".js"], "byte_code": [], "build_files": {"remove": ["Makefile"]}, "system_folders": ["/opt/ext/", "/usr/share/"], "headers": [],
    "resources": {"add": [".h"], "remove": [".sql"]}, "library_folders": ["/srv/"], "library_parts": [], "compilers": ["cp", "gcc"], "linkers": {"remove": ["ar", "gold", "lld"]}, "interpreters": ["bash"],
}


def _ruled(sql: str) -> str:
    """The passes' SQL with the lists of ``_RULES`` written out."""
    changed = {
        _listed(_SOURCES): "('.py', '.js', '.sh')", _listed(P.COMPILED): "('.js')", _listed((*passes.COMPILERS, *passes.LINKERS)): "('cp', 'gcc', 'ld')", _listed(passes.INTERPRETERS): "('bash')",
        _listed(P.INTERPRETED): "('.py', '.sh')",
    }
    for old, new in changed.items():
        sql = sql.replace(old, new)
    return sql


@query(_ruled(f"""{W}, {_PASS1}, {_GOOD}, {_KEYS}, {_PASS2}, {_FIRST}, {_PASS3}
SELECT 'compiled' AS kind, ord, path, hash, category FROM p2 UNION ALL SELECT 'interpreted', ord, path, hash, category FROM p3"""))
def rules_classes(spark, sf_dir):
    """Passes 1 to 3 under other rules than the defaults."""
    b = replace(_build(spark, sf_dir), rules=rules.of(_RULES), roles=None)
    good = passes.good(b)
    columns = ["ord", "path", "hash", "category"]
    second = passes.pass2(b, passes.pass1(b), good).select(F.lit("compiled").alias("kind"), *columns)
    return second.union(passes.pass3(b, good).select(F.lit("interpreted").alias("kind"), *columns))


@query(f"""{W}, made AS (SELECT o.cmd_idx, b.path AS bin_path, b.hash AS bin_hash FROM out o JOIN bin b ON b.hash = o.hash JOIN cmd c ON c.cmd_idx = o.cmd_idx WHERE c.tool IN ('cp', 'gcc', 'ld'))
SELECT DISTINCT m.bin_path, m.bin_hash, d.path AS dep_path, d.hash AS dep_hash FROM made m JOIN dep d ON d.cmd_idx = m.cmd_idx
WHERE NOT (starts_with(d.path, '/opt/ext/') OR starts_with(d.path, '/usr/share/')) AND {_case("d.path")} <> '.h' AND NOT (regexp_matches(d.path, '\\.so(\\.\\d+)*$') AND starts_with(d.path, '/srv/'))
  AND d.hash NOT IN (SELECT hash FROM sig) AND d.hash NOT IN (SELECT hash FROM out)""")
def rules_external_deps(spark, sf_dir):
    """External dependencies under other rules: headers are resources, two folders are the system's."""
    return passes.external_dependencies(replace(_build(spark, sf_dir), rules=rules.of(_RULES), roles=None))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
