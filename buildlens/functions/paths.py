"""POSIX path functions and path rules as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File kinds by extension (compared in lower case).
SOURCES = (
    ".c", ".cpp", ".cc", ".cxx", ".c++", ".h", ".hpp", ".hh", ".hxx", ".h++", ".py", ".pyx", ".pxd", ".pxi", ".go", ".java", ".rs",
    ".js", ".ts", ".jsx", ".tsx", ".mjs", ".cjs", ".rb", ".rake", ".gemspec", ".sh", ".bash", ".zsh", ".fish", ".ksh", ".csh",
    ".pl", ".pm", ".pod", ".t", ".cs", ".swift", ".kt", ".kts", ".scala", ".sc", ".php", ".phtml", ".php3", ".php4", ".php5", ".php7",
    ".hs", ".lhs", ".erl", ".hrl", ".ex", ".exs", ".lua", ".r", ".f", ".f77", ".f90", ".f95", ".f03", ".for", ".ftn", ".asm", ".s",
    ".vhd", ".vhdl", ".v", ".sv", ".svh", ".m", ".mm", ".d", ".nim", ".zig", ".ml", ".mli", ".fs", ".fsi", ".fsx", ".clj", ".cljs", ".cljc",
    ".groovy", ".gvy", ".gy", ".gsh", ".dart", ".jl", ".sql", ".cmake", ".mk",
)
EXCLUDED = (".sh", ".bash", ".zsh", ".fish", ".ksh", ".csh", ".sql", ".cmake", ".mk")
COMPILED = (
    ".c", ".cc", ".cpp", ".cxx", ".c++", ".h", ".hh", ".hpp", ".hxx", ".s", ".asm", ".rs", ".java", ".kt", ".kts", ".scala", ".go", ".cs", ".swift",
    ".d", ".nim", ".zig", ".ml", ".mli", ".fs", ".fsi", ".fsx", ".hs", ".lhs", ".erl", ".hrl", ".f", ".f77", ".f90", ".f95", ".f03", ".for", ".ftn",
)
BYTE_CODE = (".pyc", ".pyo", ".pyd")
INTERPRETED = (*(x for x in SOURCES if x not in COMPILED and x not in EXCLUDED), *BYTE_CODE)
PYTHON = (".py", ".pyx", ".pxd", ".pxi")
BUILD_FILES = ("Makefile", "makefile", "GNUmakefile", "Kbuild", "Kconfig")
HEADERS = (".h", ".hpp", ".hxx", ".h++", ".hh")
RESOURCES = (
    ".xml", ".properties", ".yaml", ".yml", ".json", ".toml", ".ini", ".cfg", ".txt", ".csv", ".tsv", ".md", ".rst", ".html", ".htm", ".css", ".adoc",
    ".png", ".jpg", ".jpeg", ".gif", ".svg", ".ico", ".bmp", ".tiff", ".ttf", ".woff", ".woff2", ".eot", ".otf", ".mp3", ".mp4", ".wav", ".ogg",
    ".mf", ".sf", ".dsp", ".dtd", ".xsd", ".xsl", ".xslt", ".bat", ".cmd", ".ps1", ".sql", ".graphql", ".lock", ".map",
)
# Folders inside others of the list are left out.
SYSTEM_PREFIXES = (
    "/usr/lib/", "/usr/lib64/", "/lib/", "/lib64/", "/usr/include/", "/usr/local/lib/", "/usr/local/include/", "/etc/", "/proc/", "/sys/", "/dev/",
    "/usr/share/", "/var/", "/tmp/hsperfdata_", "/run/", "/snap/",
    "/usr/arm-linux-gnueabi/", "/usr/arm-linux-gnueabihf/", "/usr/aarch64-linux-gnu/", "/usr/mips-linux-gnu/", "/usr/mipsel-linux-gnu/", "/usr/powerpc-linux-gnu/",
    "/usr/powerpc64-linux-gnu/", "/usr/powerpc64le-linux-gnu/", "/usr/riscv64-linux-gnu/", "/usr/s390x-linux-gnu/", "/usr/x86_64-linux-gnu/", "/usr/i686-linux-gnu/",
    "/usr/sparc64-linux-gnu/", "/usr/m68k-linux-gnu/", "/usr/sh4-linux-gnu/", "/usr/hppa-linux-gnu/",
)
# Shared libraries need no source below these folders, or in a folder of these names.
LIBRARY_FOLDERS = ("/usr/", "/lib")
LIBRARY_PARTS = ("lib", "lib64", "include")
CONTAINERS = (".iso", ".deb", ".rpm", ".tar", ".tgz", ".zip", ".gz", ".xz", ".bz2")


def basename(p: Column) -> Column:
    return F.substring_index(p, "/", -1)


def splitext(p: Column) -> Column:
    """Extension with its dot; leading dots of a name begin none."""
    n = F.ltrim(basename(p), F.lit("."))
    return F.when(~n.contains("."), "").otherwise(F.concat(F.lit("."), F.substring_index(n, ".", -1)))


def name(p: Column) -> Column:
    """Last component that is neither empty nor a single dot."""
    parts = F.filter(F.split(p, "/"), lambda c: (c != "") & (c != "."))
    return F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit(""))


def suffix(p: Column) -> Column:
    """Extension of ``name``; unlike ``splitext`` a final dot or leading dots make none."""
    n = name(p)
    return F.when(n == "..", "").otherwise(F.regexp_extract(n, r"^.+(\.[^.]+)$", 1))


def normpath(p: Column) -> Column:
    """Path without empty and single-dot components, with parents resolved; empty gives a dot. Most paths have nothing to resolve and stay as they are."""
    plain = ~p.rlike(r"//|/\z|^\z|(?:^|/)\.\.?(?:/|\z)")
    rooted = p.startswith("/")
    empty = F.array().cast("array<string>")

    def step(acc: Column, c: Column) -> Column:
        top = F.try_element_at(acc, F.lit(-1))
        pops = (F.size(acc) > 0) & (top != "..")
        up = F.when(pops, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(rooted, acc).otherwise(F.array_append(acc, c))
        return F.when((c == "") | (c == "."), acc).when(c == "..", up).otherwise(F.array_append(acc, c))

    parts = F.array_join(F.aggregate(F.split(p, "/"), empty, step), "/")
    root = F.when(p.startswith("//") & ~p.startswith("///"), "//").when(rooted, "/").otherwise("")
    whole = F.concat(root, parts)
    return F.when(plain, p).when(whole == "", ".").otherwise(whole)


def disk(p: Column) -> Column:
    """Component after the first ``src`` or ``bin``."""
    parts = F.split(p, "/")
    at = F.array_position(F.transform(parts, lambda c: c.isin("src", "bin")), True)
    return F.coalesce(F.when(at > 0, F.try_element_at(parts, (at + 1).cast("int"))), F.lit("unknown"))


def container(p: Column) -> Column:
    """Innermost component that names an archive, without its folder suffix; null if none."""
    parts = F.transform(F.split(p, "/"), lambda c: F.regexp_replace(c, "_dir$", ""))
    return F.try_element_at(F.filter(parts, lambda c: c.rlike(r"\.(?i:" + "|".join(x[1:] for x in CONTAINERS) + ")$")), F.lit(-1))


def without_dir(p: Column) -> Column:
    """Path in which the folders of unpacked archives have the archives' own names."""
    return F.regexp_replace(p, "_dir(?=/|$)", "")


def archive_depth(p: Column) -> Column:
    """How many folders of unpacked archives the path lies in."""
    return F.size(F.filter(F.slice(F.split(p, "/"), 1, F.size(F.split(p, "/")) - 1), lambda c: c.endswith("_dir")))


def so_base(p: Column) -> Column:
    """Shared library's path without version numbers."""
    return F.regexp_replace(p, r"\.so(\.\d+)*$", ".so")


def stem(p: Column) -> Column:
    """Lower-case name without the endings of Python sources and byte code."""
    n = F.lower(basename(p))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(n, r"\.cpython-\d+.*\.pyc$", ""), r"\.py[co]$", ""), r"\.py$", "")


def shell_extension(p: Column) -> Column:
    """Extension as the profiler counts it: compound tar endings first, else from the last dot; no dot gives no_extension."""
    n = basename(p)
    tar = F.regexp_extract(F.lower(n), r"(\.tar\.(gz|bz2|xz|zst|z|lz4|lzma))$", 1)
    return F.when(tar == ".tar.z", ".tar.Z").when(tar != "", tar).when(~n.contains("."), "no_extension").otherwise(F.lower(F.regexp_extract(n, r"(\.[^.]*)$", 1)))
