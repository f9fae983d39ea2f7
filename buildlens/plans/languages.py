"""Languages of a project by its files' extensions, what a scanner should leave out, and paths too long for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import archive_depth, splitext

# Extensions by language.
EXTENSIONS = {
    "c": (".c", ".h"), "cpp": (".cpp", ".cc", ".cxx", ".c++", ".hpp", ".hh", ".hxx", ".h++"), "python": (".py", ".pyw"), "java": (".java",),
    "javascript": (".js", ".jsx", ".mjs", ".cjs"), "typescript": (".ts", ".tsx"), "go": (".go",), "csharp": (".cs",), "php": (".php", ".phtml"), "kotlin": (".kt", ".kts"),
    "ruby": (".rb", ".rake"), "scala": (".scala", ".sc"), "swift": (".swift",),
}
# Languages that another tool analyses.
ALWAYS_EXCLUDED = ("java", "cpp", "c", "python", "javascript", "go")
# Patterns that are always left out.
STANDARD_EXCLUSIONS = (
    "**/.scannerwork/**", "**/.git/**", "**/.svn/**", "**/.idea/**", "**/node_modules/**", "**/*.min.js", "**/*.bundle.js", "**/dist/**", "**/build/**", "**/*.log", "**/*.class",
)
#: Longest key of a file on the server, and folders of archives that retries leave out, mildest first.
LONGEST_KEY = 400
DEPTHS = (None, 3, 2, 1)


def language(ext: Column) -> Column:
    """Language of an extension, whatever its case; null for others."""
    low = F.lower(ext)
    out = F.lit(None).cast("string")
    for name, endings in EXTENSIONS.items():
        out = F.when(low.isin(*endings), name).otherwise(out)
    return out


def language_sets(extensions: DataFrame, *by: str) -> DataFrame:
    """(by, to_analyze, to_exclude): sorted languages with files (ext) that aren't always excluded, and all others with those that are."""
    known, always = F.array(*map(F.lit, sorted(EXTENSIONS))), F.array(*map(F.lit, ALWAYS_EXCLUDED))
    found = F.collect_set(language(F.col("ext"))).alias("found")
    rows = extensions.groupBy(*by).agg(found) if by else extensions.agg(found)
    return rows.select(
        *by, F.array_sort(F.array_except("found", always)).alias("to_analyze"), F.array_sort(F.array_union(F.array_except(known, F.col("found")), always)).alias("to_exclude")
    )


def exclusions(to_exclude: Column, depth: int | None = None) -> Column:
    """Patterns to leave out, by commas: the standard ones, those of the languages, and files in so many archives or more."""
    patterns = F.create_map(*(F.lit(x) for name, endings in EXTENSIONS.items() for x in (name, ",".join(f"**/*{e}" for e in endings))))
    own = F.transform(F.array_sort(to_exclude), lambda name: F.try_element_at(patterns, name))
    deep = [F.lit("**/" + "*_dir/**/" * (depth - 1) + "*_dir/**")] if depth else []
    return F.array_join(F.concat(F.array(*map(F.lit, STANDARD_EXCLUSIONS)), F.array_compact(own), F.array(*deep).cast("array<string>")), ",")


def long_paths(files: DataFrame, key: str, longest: int = LONGEST_KEY) -> DataFrame:
    """(path, key_length, ext) of files whose key on the server, the project's key and the path, is too long."""
    length = F.lit(len(key) + 1) + F.length("path")
    ext = F.lower(splitext(F.col("path")))
    return files.select("path", length.alias("key_length"), F.when(ext == "", "no_extension").otherwise(ext).alias("ext")).filter(F.col("key_length") > longest)


def long_path_histogram(files: DataFrame, key: str, longest: int = LONGEST_KEY, examples: int = 5) -> DataFrame:
    """(ext, files, examples): too long paths by extension, and the longest few of each."""
    rows = long_paths(files, key, longest)
    longest_first = F.slice(F.sort_array(F.collect_list(F.struct("key_length", "path")), asc=False), 1, examples)
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("ext").orderBy(F.desc("key_length"), F.desc("path")))
    shown = rows.withColumn("k", place).filter(F.col("k") <= examples).groupBy("ext").agg(longest_first.alias("examples"))
    return rows.groupBy("ext").agg(F.count("*").alias("files")).join(shown, "ext").select("ext", "files", F.col("examples.path").alias("examples"))


def depth_needed(files: DataFrame, key: str, longest: int = LONGEST_KEY) -> DataFrame:
    """One row (depth): the mildest of ``DEPTHS`` that leaves out every too long path, null where none is too long, -1 where none of them does."""
    deep = long_paths(files, key, longest).agg(F.min(archive_depth(F.col("path"))).alias("least"), F.count("*").alias("files"))
    out = F.when(F.col("files") == 0, F.lit(None).cast("int"))
    for depth in DEPTHS[1:]:
        out = out.when(F.col("least") >= depth, depth)
    return deep.select(out.otherwise(-1).alias("depth"))


def first_that_works(attempt, depths=DEPTHS) -> tuple[bool, int | None]:
    """(success, depth): tries the depths in order; attempt(depth) tells (success, whether a key was too long), and only that is worth another try."""
    for depth in depths:
        done, too_long = attempt(depth)
        if done or not too_long:
            return done, depth
    return False, depths[-1]
