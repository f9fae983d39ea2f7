"""Pass 4: what the files of a distribution were made from, and what of them came from external packages."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import Rounds, saved
from ..functions import packages, paths
from ..functions.text import hash_key
from ..operators.closure import scope
from ..operators.reach import members, numbered, reached
from . import passes
from .passes import Build

#: So many steps from a distribution's file back along the commands that made it, where nobody asks for all (``None``).
ROUNDS = 3


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("key", hash_key(F.col("hash"))).filter("key IS NOT NULL")


def _packed(df: DataFrame) -> DataFrame:
    """As ``_keyed``, with the 16 digits as 8 bytes. Exploded, as the filter would otherwise make a hash again for each place that the key has it in."""
    return df.withColumn("key", F.explode(F.array(packed_key(F.col("hash"))))).filter("key IS NOT NULL")


def packed_key(h: F.Column) -> F.Column:
    return F.unhex(hash_key(h))


def _flag(df: DataFrame, name: str) -> DataFrame:
    return df.distinct().withColumn(name, F.lit(True))


def judged_inputs(b: Build, made: DataFrame) -> DataFrame:
    """(cmd_idx, path, hash, key, bucket) of inputs with a valid hash: system, src, resource, allowed, intermediate or suspicious, the first that holds."""
    p = F.col("path")
    by = b.by
    rows = _keyed(b.dep).join(_flag(_keyed(b.src).select(*by, "key"), "own"), [*by, "key"], "left").join(_flag(made, "made"), [*by, "key"], "left")
    bucket = (
        F.when(b.rules.is_system(p), "system").when(F.col("own"), "src").when(b.rules.is_resource(p), "resource").when(b.rules.is_allowed(p), "allowed")
        .when(F.col("made"), "intermediate").otherwise("suspicious")
    )
    return rows.select(*by, "cmd_idx", "path", "hash", "key", bucket.alias("bucket"))


def judged_keys(b: Build) -> DataFrame:
    """(cmd_idx, key, bucket, shipped) of inputs, by keys in bytes alone: bucket is intermediate, suspicious or else null as in ``judged_inputs``, shipped that the distribution has the key.

    Inputs that are neither of the two nor shipped are left out. Sources, outputs and the distribution are one table of
    keys, so inputs are shuffled once, without paths and hashes.
    """
    by, p = b.by, F.col("path")
    marks = {"own": b.src, "made": b.out, "shipped": b.bin}
    facts = reduce(DataFrame.union, (_packed(df).select(*by, "key", *(F.lit(m == name).alias(m) for m in marks)) for name, df in marks.items()))
    facts = facts.groupBy(*by, "key").agg(*(F.bool_or(m).alias(m) for m in marks))
    open_ = ~F.coalesce(b.rules.is_system(p) | b.rules.is_resource(p) | b.rules.is_allowed(p), F.lit(False))
    rows = _packed(b.dep).select(*by, "cmd_idx", "key", open_.alias("open")).join(facts, [*by, "key"], "left")
    bucket = F.when(F.col("open") & ~F.coalesce("own", F.lit(False)), F.when(F.col("made"), "intermediate").otherwise("suspicious"))
    return rows.select(*by, "cmd_idx", "key", bucket.alias("bucket"), F.coalesce("shipped", F.lit(False)).alias("shipped")).filter("bucket IS NOT NULL OR shipped")


@dataclass
class Scan:
    """What one walk back from the distribution found; pass 4 and all that follows share it. Keys are in bytes.

    out: (cmd_idx, key) of outputs; edges: ``judged_keys``; made: keys of outputs; seen: keys of the distribution read on the way;
    found: (cmd_idx, bin_key) of outputs of compilers and linkers with suspicious inputs; touched: (cmd_idx) of the commands on the way.
    """

    build: Build
    out: DataFrame
    edges: DataFrame
    made: DataFrame
    seen: DataFrame
    found: DataFrame
    touched: DataFrame

    @property
    def external(self) -> DataFrame:
        """(bin_key, path, hash) of the suspicious inputs found, keys as digits."""
        by = self.build.by
        files = suspicious_files(self, self.found.select(*by, "cmd_idx").distinct())
        return self.found.join(files, [*by, "cmd_idx"]).select(*by, F.lower(F.hex("bin_key")).alias("bin_key"), "path", "hash")


def suspicious_files(s: Scan, commands: DataFrame) -> DataFrame:
    """(cmd_idx, path, hash) of the suspicious inputs of these commands, once an input.

    Their keys are written first: where they are few, Spark broadcasts them. So are the inputs of their commands, as paths of all inputs would be judged otherwise, once for each use.
    """
    b, by, p = s.build, s.build.by, F.col("path")
    keys = saved(s.edges.filter("bucket = 'suspicious'").join(commands, [*by, "cmd_idx"], "left_semi").select(*by, "cmd_idx", "key").distinct())
    read = saved(b.dep.join(keys.select(*by, "cmd_idx").distinct(), [*by, "cmd_idx"], "left_semi").select(*by, "cmd_idx", "path", "hash"))
    rows = _packed(read.filter(~F.coalesce(b.rules.is_system(p) | b.rules.is_resource(p) | b.rules.is_allowed(p), F.lit(False))))
    return rows.join(keys, [*by, "cmd_idx", "key"], "left_semi").select(*by, "cmd_idx", "path", "hash")


def scan(b: Build, rounds: int | None = ROUNDS) -> Scan:
    """From the distribution's keys the commands that made them are found, and from their intermediate inputs the next keys: so many rounds, or with ``None`` until no key is new.

    A key is walked from once, so that cycles end and the results of all rounds differ. Rounds read commands and keys alone;
    paths and hashes of suspicious inputs are looked up where they are asked for.
    """
    by = b.by
    out = saved(_packed(b.out).select(*by, "cmd_idx", "key").distinct())
    made = out.select(*by, "key").distinct()
    edges = saved(judged_keys(b))
    suspicious, inner = edges.filter("bucket = 'suspicious'").select(*by, "cmd_idx"), edges.filter("bucket = 'intermediate'")
    walked, written = Rounds(out.sparkSession), Rounds(out.sparkSession)
    frontier, turn = walked.add(_packed(b.bin).select(*by, "key").distinct()), 0
    while turn == 0 or not frontier.isEmpty():
        last = written.add(out.join(frontier, [*by, "key"], "left_semi"))
        turn += 1
        if turn == rounds:
            break
        read = inner.join(last, [*by, "cmd_idx"], "left_semi").select(*by, "key").distinct()
        frontier = walked.add(read.join(walked.rows, [*by, "key"], "left_anti"))
    found = saved(written.rows.join(suspicious, [*by, "cmd_idx"], "left_semi").join(passes.makers(b), [*by, "cmd_idx"], "left_semi").withColumnRenamed("key", "bin_key"))
    touched = saved(written.rows.select(*by, "cmd_idx").distinct())
    seen = saved(edges.filter("shipped").join(touched, [*by, "cmd_idx"], "left_semi").select(*by, "key").distinct())
    return Scan(b, out, edges, made, seen, found, touched)


def filter_statistics(s: Scan) -> DataFrame:
    """(bucket, inputs, percent): what the inputs of the commands on the way were judged to be, whole percents."""
    b = replace(s.build, dep=s.build.dep.join(s.touched, [*s.build.by, "cmd_idx"], "left_semi"))
    counts = judged_inputs(b, s.made.withColumn("key", F.lower(F.hex("key")))).groupBy("bucket").agg(F.count("*").alias("inputs"))
    total = counts.agg(F.sum("inputs").alias("total"))  # one row of at most six
    return counts.join(F.broadcast(total)).select("bucket", "inputs", F.expr("inputs * 100 div total").alias("percent"))


def pass4(b: Build, apt: DataFrame | None = None, transitive: bool = False, scanned: Scan | None = None, rounds: int | None = ROUNDS) -> DataFrame:
    """(ord, path, hash, container, category) of the distribution's files.

    ``apt``: names (column container) of packages that the build downloaded. The first that holds:
    apt_package_content, system_binaries, untraced_external without a valid hash; for files that no
    command made or read untraced_from_src or untraced_external, for those only read binaries_from_src
    or external_prebuilt; for built ones external_built with a suspicious input, else
    binaries_from_src or compiled_from_src. In transitive mode suspicious inputs of compiled or linked
    inputs count too, up to ``rounds`` steps away. Whether a file is in the sources is told by its whole hash.
    ``rounds``: those of the walk, and of ``scan`` where it isn't given; ``None`` for all.
    """
    s = scanned or scan(b, rounds)
    by, made, seen = b.by, s.made, s.seen
    tainted = tainted_within(maker_edges(b, s), rounds) if transitive else s.found.select(*by, "bin_key")
    p = F.col("path")
    rows = b.bin.select(*by, "ord", "path", "hash").withColumns({"key": packed_key(F.col("hash")), "container": paths.container(p)})
    rows = (
        rows.join(_flag(made, "made"), [*by, "key"], "left").join(_flag(seen, "seen"), [*by, "key"], "left")
        .join(_flag(tainted.select(*by, F.col("bin_key").alias("key")), "tainted"), [*by, "key"], "left")
        .join(_flag(b.src.select(*by, "hash").filter("hash IS NOT NULL"), "own"), [*by, "hash"], "left")
    )
    rows = rows.withColumn("loaded", F.lit(None).cast("boolean")) if apt is None else rows.join(_flag(apt.select(*by, "container"), "loaded"), [*by, "container"], "left")

    def by_source(yes: str, no: str) -> F.Column:
        return F.when(F.col("own"), yes).otherwise(no)

    category = (
        F.when(F.col("loaded"), "apt_package_content").when(packages.is_distro_system(p), "system_binaries").when(F.col("key").isNull(), "untraced_external")
        .when(F.col("made").isNull() & F.col("seen").isNull(), by_source("untraced_from_src", "untraced_external"))
        .when(F.col("made").isNull(), by_source("binaries_from_src", "external_prebuilt"))
        .when(F.col("tainted"), "external_built").otherwise(by_source("binaries_from_src", "compiled_from_src"))
    )
    return rows.select(*by, "ord", "path", "hash", "container", category.alias("category"))


def apt_containers(b: Build) -> DataFrame:
    """(container): names of .deb files that commands ``apt download`` wrote. ``cmd`` needs argv."""
    loads = b.cmd.filter((F.col("tool") == "apt") & (F.try_element_at("argv", F.lit(2)) == "download")).select(*b.by, "cmd_idx")
    name = paths.basename(F.col("path"))
    return b.out.join(loads, [*b.by, "cmd_idx"], "left_semi").select(*b.by, name.alias("container")).filter(F.lower("container").endswith(".deb")).distinct()


def all_package_content(fourth: DataFrame, index: DataFrame) -> DataFrame:
    """(path, hash, package_type, container, source, command): untraced files in packages with their origin, and the content of packages that apt loaded."""
    from .packages import content_with_origin

    loaded = fourth.filter("category = 'apt_package_content'").select(*scope(fourth), "path", "hash", F.lit("deb").alias("package_type"), "container")
    return content_with_origin(package_content(fourth).unionByName(loaded), index)


def package_content(fourth: DataFrame) -> DataFrame:
    """(path, hash, package_type, container) of untraced external files that lie in a package."""
    rows = fourth.filter("category = 'untraced_external'").select(*scope(fourth), "path", "hash", packages.package(F.col("path")).alias("p"))
    return rows.select(*scope(fourth), "path", "hash", "p.package_type", "p.container").filter("package_type IS NOT NULL")


def by_disk(*tables: DataFrame) -> DataFrame:
    """Pass 5: files by category and disk over the category tables of other passes."""
    counted = None
    for rows in tables:
        part = rows.select("category", paths.disk(F.col("path")).alias("disk"))
        counted = part if counted is None else counted.union(part)
    return counted.groupBy("category", "disk").agg(F.count("*").alias("files"))


def tainted_within(edges: DataFrame, hops: int | None = ROUNDS) -> DataFrame:
    """bin_key of outputs that lead over at most so many inputs, or with ``None`` any number, to a suspicious one.

    ``edges``: (made, used, bucket), intermediate or suspicious. The walk goes from suspicious inputs
    towards outputs, from each once, so each round costs its edges, not products of outputs and all they reach.
    """
    by = scope(edges)
    inner = edges.filter("bucket = 'intermediate'").select(*by, "made", "used")
    found, turn = Rounds(edges.sparkSession), 1
    new = found.add(edges.filter("bucket = 'suspicious'").select(*by, F.col("made").alias("bin_key")).distinct())
    while (hops is None or turn < hops) and not new.isEmpty():
        more = inner.join(new.select(*by, F.col("bin_key").alias("used")), [*by, "used"], "left_semi").select(*by, F.col("made").alias("bin_key")).distinct()
        new = found.add(more.join(found.rows, [*by, "bin_key"], "left_anti"))
        turn += 1
    return found.rows


def maker_edges(b: Build, s: Scan) -> DataFrame:
    """(made, used, bucket): keys of outputs and inputs of compiler and linker commands; inputs that need a source or an origin only."""
    by = b.by
    deps = s.edges.filter("bucket IS NOT NULL").select(*by, "cmd_idx", F.col("key").alias("used"), "bucket")
    out = s.out.select(*by, "cmd_idx", F.col("key").alias("made")).join(passes.makers(b), [*by, "cmd_idx"], "left_semi")
    return saved(out.join(deps, [*by, "cmd_idx"]).drop("cmd_idx").distinct())


def suspicious_inputs(b: Build, fourth: DataFrame, scanned: Scan | None = None) -> DataFrame:
    """(ord, path, hash, dep_path) of external_built files: the suspicious inputs of direct mode, versions of one shared library as one."""
    external = (scanned or scan(b)).external.select(*b.by, F.col("bin_key").alias("key"), paths.so_base(F.col("path")).alias("dep_path")).distinct()
    built = fourth.filter("category = 'external_built'").select(*b.by, "ord", "path", "hash", hash_key(F.col("hash")).alias("key"))
    return built.join(external, [*b.by, "key"]).drop("key")


def external_inputs(b: Build, fourth: DataFrame, scanned: Scan | None = None, transitive: bool = False) -> DataFrame:
    """(ord, path, hash, dep_path, dep_hash, aliases) of external_built files: their external inputs, versions of a shared library in one folder as one row.

    Such a row has the folder and the library's name without versions, the hash of the shortest path, and all
    its paths, sorted; others have no aliases. In transitive mode inputs that are up to ``ROUNDS`` steps away
    over made ones count too.
    """
    s = scanned or scan(b)
    by = b.by
    reach = s.external.select(*by, F.col("bin_key").alias("key"), "path", "hash")
    if transitive:
        made = s.out.join(passes.makers(b), [*by, "cmd_idx"], "left_semi")
        files = suspicious_files(s, made.select(*by, "cmd_idx").distinct())
        own = saved(made.join(files, [*by, "cmd_idx"]).select(*by, "key", "path", "hash").distinct())
        inner = saved(made.join(s.edges.filter("bucket = 'intermediate'").select(*by, "cmd_idx", F.col("key").alias("used")), [*by, "cmd_idx"]).select(*by, "key", "used").distinct())
        inputs = numbered(own.select(*by, "path", "hash").distinct(), *by, "path", "hash")
        sets = reached(own.join(inputs, [*by, "path", "hash"]).select(*by, "key", "id"), inner, ROUNDS - 1, by)
        wanted = fourth.filter("category = 'external_built'").select(*by, packed_key(F.col("hash")).alias("key")).distinct()
        reach = members(sets.join(wanted, [*by, "key"], "left_semi")).join(inputs.select("id", "path", "hash"), "id").select(*by, F.lower(F.hex("key")).alias("key"), "path", "hash")
    built = fourth.filter("category = 'external_built'").select(*by, "ord", "path", "hash", hash_key(F.col("hash")).alias("key"))
    rows = built.join(reach.select(*by, "key", F.col("path").alias("dep_path"), F.col("hash").alias("dep_hash")), [*by, "key"])
    return passes.with_aliases(rows, *by, "ord", "path", "hash")


def trusted_java(b: Build, fourth: DataFrame, scanned: Scan | None = None) -> DataFrame:
    """(ord, path, hash, category, deps_removed) of external_built files after trust in Java classes.

    A class file whose stem (before a dollar sign, in lower case) names a Java source is
    compiled_from_src. Of the others only suspicious inputs count that are class files without such a
    source; a file of any language that has none left is compiled_from_src too. deps_removed counts
    the inputs left out, null for a trusted class file itself.
    """
    def stem(p: F.Column) -> F.Column:
        name = paths.basename(p)
        return F.lower(F.left(name, F.length(name) - F.length(paths.splitext(p))))

    def outer(p: F.Column) -> F.Column:
        return F.split(stem(p), r"\$")[0]

    java = F.lower(paths.splitext(F.col("path"))) == ".java"
    by = b.by
    named = _flag(b.src.filter(java).select(*by, stem(F.col("path")).alias("stem")), "named")
    deps = suspicious_inputs(b, fourth, scanned).withColumn("class", F.lower(paths.splitext(F.col("dep_path"))) == ".class")
    judged = deps.withColumn("stem", outer(F.col("dep_path"))).join(named, [*by, "stem"], "left").withColumn("real", F.col("class") & F.col("named").isNull())
    counts = judged.groupBy(*by, "ord", "path", "hash").agg(F.count_if("real").alias("real"), F.count_if(~F.col("real")).alias("removed"))
    own = counts.withColumn("stem", outer(F.col("path"))).join(named, [*by, "stem"], "left")
    trusted = F.coalesce(F.col("named"), F.lit(False)) & F.lower(F.col("path")).endswith(".class")
    category = F.when(trusted | (F.col("real") == 0), "compiled_from_src").otherwise("external_built")
    return own.select(*by, "ord", "path", "hash", category.alias("category"), F.when(~trusted, F.col("removed")).alias("deps_removed"))


def filtered_dependencies(b: Build, fourth: DataFrame) -> DataFrame:
    """(ord, path, hash, dep_path, dep_hash, reason) of inputs that external_built files may have: header or system_path.

    They come from the last command, of any tool, that made the file and had such inputs; a path
    counts once, by its first place. Of files with one hash only the last gets them.
    """
    p = F.col("path")
    by = b.by
    built = fourth.filter("category = 'external_built'").select(*by, hash_key(F.col("hash")).alias("key"), "ord", "path", "hash")
    last = built.groupBy(*by, "key").agg(F.max_by(F.struct("ord", "path", "hash"), "ord").alias("file"))
    makers = saved(_keyed(b.out).select(*by, "cmd_idx", "key").distinct().join(last.select(*by, "key"), [*by, "key"]))
    # inputs of the commands that made one of the files, not of all
    own = saved(b.dep.filter(b.rules.is_system(p) | b.rules.is_allowed(p)).join(makers.select(*by, "cmd_idx").distinct(), [*by, "cmd_idx"], "left_semi").select(*by, "cmd_idx", "pos", "path", "hash"))
    last_made = makers.join(own.select(*by, "cmd_idx").distinct(), [*by, "cmd_idx"], "left_semi").groupBy(*by, "key").agg(F.max("cmd_idx").alias("cmd_idx"))
    chosen = last_made.join(last, [*by, "key"])
    allowed = own.join(last_made.select(*by, "cmd_idx").distinct(), [*by, "cmd_idx"], "left_semi").groupBy(*by, "cmd_idx", "path").agg(F.min_by(F.struct(F.coalesce("hash", F.lit("")).alias("hash")), "pos").alias("first"))
    reason = F.when(F.lower(paths.splitext(F.col("dep_path"))).isin(".h", ".hpp", ".hxx"), "header").otherwise("system_path")
    rows = chosen.join(allowed.withColumnRenamed("path", "dep_path"), [*by, "cmd_idx"])
    return rows.select(*by, "file.*", "dep_path", F.col("first.hash").alias("dep_hash"), reason.alias("reason"))
