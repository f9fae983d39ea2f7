"""Which files are archives or binaries, and the methods that may unpack them, by name and by magic text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .paths import basename, shell_extension

# Endings of a name in lower case and the methods for them, in the order they are tried.
METHODS_BY_ENDING = (
    ((".tar.gz", ".tgz"), "tar_gz"), ((".tar.bz2", ".tbz2"), "tar_bz2"), ((".tar.xz", ".txz"), "tar_xz"), ((".tar.zst",), "tar_zst"), ((".tar.z",), "tar_z"),
    ((".tar.lz4",), "tar_lz4"), ((".tar.lzma",), "tar_lzma"), ((".tar",), "tar_plain"), ((".gz",), "tar_gz gzip_plain"), ((".bz2",), "tar_bz2 bzip2_plain"),
    ((".xz",), "tar_xz xz_plain"), ((".zst",), "tar_zst zstd_plain"), ((".z",), "compress"),
    ((".zip", ".whl", ".egg", ".jar", ".war", ".ear", ".apk", ".ipa", ".xpi", ".crx", ".nupkg", ".epub", ".aar"), "zip"),
    ((".rar",), "rar"), ((".7z",), "7z"), ((".iso",), "iso"), ((".rpm",), "rpm"), ((".deb",), "deb"), ((".cab",), "cab"), ((".msi",), "msi"), ((".squashfs",), "squashfs"), ((".pkg",), "pkg"),
)
# Archives by ending without a method of their own.
ONLY_ARCHIVES = (".lz4", ".lzma")
# Parts of a magic text and the methods for it.
METHODS_BY_MAGIC = (
    ("Zip archive", "zip"), ("RAR archive", "rar"), ("7-zip archive", "7z"), ("tar archive", "tar_plain"), ("gzip compressed", "tar_gz gzip_plain"),
    ("bzip2 compressed", "tar_bz2 bzip2_plain"), ("XZ compressed", "tar_xz xz_plain"), ("Zstandard compressed", "tar_zst zstd_plain"), ("compress'd data", "compress"),
    ("cpio archive", "cpio"), ("ISO 9660", "iso"), ("RPM", "rpm"), ("Debian binary package", "deb"), ("Microsoft Cabinet archive", "cab"), ("MSI Installer", "msi"),
    ("Squashfs filesystem", "squashfs"), ("Apple pkg archive", "pkg"),
)
# Endings that tell nothing, and those left packed.
AMBIGUOUS = ("bin", "dat", "img", "image", "raw", "dump", "pak", "data", "bak", "old", "orig", "tmp", "temp")
SKIPPED = ("jar",)
# Extensions of binaries, and of files that need no look inside.
BINARY = (
    ".class", ".jar", ".war", ".jmod", ".aar", ".ear", ".sar", ".pyc", ".pyd", ".pyo", ".egg", ".whl", ".so", ".dll", ".exe", ".a", ".o", ".lib", ".obj", ".pdb", ".ko",
    ".node", ".wasm", ".swf", ".rlib", ".dex", ".apk", ".ipa", ".nupkg", ".rpm",
)
SAFE = (
    ".java", ".kt", ".scala", ".groovy", ".clj", ".cljs", ".py", ".rb", ".php", ".pl", ".pm", ".lua", ".tcl", ".r", ".js", ".ts", ".jsx", ".tsx", ".mjs", ".cjs", ".coffee",
    ".c", ".cc", ".cpp", ".cxx", ".h", ".hh", ".hpp", ".hxx", ".cs", ".vb", ".fs", ".fsx", ".swift", ".m", ".mm", ".go", ".rs", ".dart", ".ex", ".exs", ".erl", ".hrl",
    ".sh", ".bash", ".zsh", ".fish", ".ksh", ".csh", ".tcsh", ".ps1", ".psm1", ".psd1", ".bat", ".cmd", ".xml", ".xsd", ".xsl", ".xslt", ".dtd", ".wsdl", ".pom",
    ".json", ".jsonc", ".json5", ".yaml", ".yml", ".toml", ".ini", ".cfg", ".conf", ".config", ".properties", ".env", ".html", ".htm", ".xhtml", ".vue", ".svelte",
    ".css", ".scss", ".sass", ".less", ".styl", ".txt", ".md", ".rst", ".adoc", ".textile", ".wiki", ".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".odt",
    ".csv", ".tsv", ".sql", ".log", ".diff", ".patch", ".jpg", ".jpeg", ".png", ".gif", ".bmp", ".svg", ".ico", ".webp", ".tiff", ".tif", ".psd", ".ai", ".eps", ".raw",
    ".mp3", ".mp4", ".wav", ".avi", ".mkv", ".mov", ".flac", ".ogg", ".ttf", ".otf", ".woff", ".woff2", ".eot", ".gradle", ".maven", ".sbt", ".lock", ".sum",
    ".gitignore", ".gitattributes", ".editorconfig", ".tsbuildinfo", ".map",
)


def pattern(endings: tuple[str, ...]) -> str:
    """Pattern of names with one of the endings."""
    return "(" + "|".join(map(re.escape, endings)) + ")$"


def _first(cases) -> Column:
    out = None
    for test, value in cases:
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise("")


def methods_by_name(p: Column) -> Column:
    """Methods for a file's name, by blanks; empty if the name tells none."""
    n = F.lower(basename(p))
    return _first((n.rlike(pattern(endings)), methods) for endings, methods in METHODS_BY_ENDING)


def methods_by_magic(magic: Column) -> Column:
    """Methods for a magic text, by blanks; empty if it names no archive."""
    return _first((magic.contains(part), methods) for part, methods in METHODS_BY_MAGIC)


def plan(p: Column, magic: Column) -> Column:
    """Methods to try in order: those of the name, then those of the magic text that aren't among them."""
    both = F.concat(F.split(methods_by_name(p), " "), F.split(F.coalesce(methods_by_magic(magic), F.lit("")), " "))
    return F.array_distinct(F.filter(both, lambda m: m != ""))


def kind(p: Column, every: bool = False) -> Column:
    """skipped (left packed unless ``every``), archive by its name, check where only the magic text tells, or other."""
    n = F.lower(basename(p))
    last = F.regexp_extract(n, r"([^.]*)$", 1)
    endings = tuple(e for es, _ in METHODS_BY_ENDING for e in es) + ONLY_ARCHIVES
    skip = F.lit(False) if every else last.isin(*SKIPPED)
    return F.when(skip, "skipped").when(n.rlike(pattern(endings)), "archive").when(~n.contains(".") | last.isin(*AMBIGUOUS), "check").otherwise("other")


def triage(p: Column) -> Column:
    """BINARY_EXT by extension, SAFE for known texts, media and documents, MAGIC where the content must be looked at."""
    ext = shell_extension(p)
    return F.when(ext.isin(*BINARY), "BINARY_EXT").when(ext.isin(*SAFE) | ext.startswith(".env."), "SAFE").otherwise("MAGIC")
