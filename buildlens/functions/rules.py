"""Rules of paths and tools as one object, from which the passes' expressions are compiled."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field, fields, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import paths as P

# Roles of tools where no dictionary is given.
COMPILERS = ("gcc", "g++", "cc", "c++", "clang", "rustc", "javac", "go")
LINKERS = ("ld", "ar", "gold", "lld")
INTERPRETERS = ("python3", "python", "node", "bash", "sh", "perl", "ruby")


@dataclass(frozen=True)
class Roles:
    """Names of tools by role. Without compilers pass 2 moves nothing and only commands with an output in the distribution are good; without interpreters pass 3 is empty."""

    compilers: tuple[str, ...] = COMPILERS
    linkers: tuple[str, ...] = LINKERS
    interpreters: tuple[str, ...] = INTERPRETERS

    @property
    def makers(self) -> tuple[str, ...]:
        return (*self.compilers, *self.linkers)


def _one_of(value: Column, values: tuple[str, ...]) -> Column:
    return value.isin(*values) if values else F.lit(False)


def _begins(path: Column, prefixes: tuple[str, ...]) -> Column:
    """One pattern, as a chain of prefixes overgrows generated code."""
    return path.rlike("^(?:" + "|".join(map(re.escape, prefixes)) + ")") if prefixes else F.lit(False)


@dataclass(frozen=True)
class Rules:
    """Lists that say what a file is by its path, and roles of tools. The defaults are the fixed values.

    Lists of extensions begin with a dot and are compared in lower case; folders are prefixes of paths, names are
    whole names of files. A list may be empty: then nothing is of its kind. ``of`` makes rules from data.
    """

    sources: tuple[str, ...] = P.SOURCES
    excluded: tuple[str, ...] = P.EXCLUDED
    compiled: tuple[str, ...] = P.COMPILED
    byte_code: tuple[str, ...] = P.BYTE_CODE
    python: tuple[str, ...] = P.PYTHON
    headers: tuple[str, ...] = P.HEADERS
    resources: tuple[str, ...] = P.RESOURCES
    build_files: tuple[str, ...] = P.BUILD_FILES
    system_folders: tuple[str, ...] = P.SYSTEM_PREFIXES
    library_folders: tuple[str, ...] = P.LIBRARY_FOLDERS
    library_parts: tuple[str, ...] = P.LIBRARY_PARTS
    roles: Roles = field(default_factory=Roles)

    EXTENSIONS = ("sources", "excluded", "compiled", "byte_code", "python", "headers", "resources")

    def __post_init__(self) -> None:
        for name in self.EXTENSIONS:
            values = tuple(x.lower() for x in getattr(self, name))
            if wrong := [x for x in values if not re.fullmatch(r"\.[^./]+", x)]:
                raise ValueError(f"{name}: no extensions: {wrong}")
            object.__setattr__(self, name, values)
        if wrong := [x for x in (*self.system_folders, *self.library_folders) if not x]:
            raise ValueError("an empty folder would begin every path")

    @property
    def interpreted(self) -> tuple[str, ...]:
        """Extensions of sources that are neither compiled nor left out, and of byte code."""
        return (*(x for x in self.sources if x not in self.compiled and x not in self.excluded), *self.byte_code)

    def is_source(self, p: Column) -> Column:
        ext = F.lower(P.suffix(p))
        return ~_one_of(ext, self.excluded) & (_one_of(ext, self.sources) | _one_of(P.name(p), self.build_files))

    def is_compiled(self, p: Column) -> Column:
        return _one_of(F.lower(P.splitext(p)), self.compiled)

    def is_interpreted(self, p: Column) -> Column:
        return _one_of(F.lower(P.splitext(p)), self.interpreted)

    def is_python(self, p: Column) -> Column:
        return _one_of(F.lower(P.splitext(p)), self.python)

    def is_system(self, p: Column) -> Column:
        """Inside a system folder."""
        return _begins(p, self.system_folders)

    def is_resource(self, p: Column) -> Column:
        return _one_of(F.lower(P.splitext(p)), self.resources)

    def is_allowed(self, p: Column) -> Column:
        """External dependency that needs no source: a header, a system file, or a shared library in a library folder."""
        inside = p.rlike("/(?:" + "|".join(map(re.escape, self.library_parts)) + ")/") if self.library_parts else F.lit(False)
        library = P.basename(p).rlike(r"\.so(\.\d+)*$") & (inside | _begins(p, self.library_folders))
        return (p != "") & (_one_of(F.lower(P.splitext(p)), self.headers) | self.is_system(p) | library)

    def rows(self) -> list[tuple[str, str]]:
        """(rule, value) of every value, in the lists' order; roles by their own names."""
        lists = {k: v for k, v in asdict(self).items() if k != "roles"} | asdict(self.roles)
        return [(name, value) for name, values in lists.items() for value in values]


def of(changes: Mapping[str, Iterable[str] | Mapping[str, Iterable[str]]], base: Rules | None = None) -> Rules:
    """Rules with some lists changed: a list takes the place of the one it names, an object adds values (``add``) or takes some away (``remove``).

    Lists of tools are named ``compilers``, ``linkers`` and ``interpreters``. Another name, or another key of an object, is an error.
    """
    base = base or Rules()

    def changed(name: str, old: tuple[str, ...]) -> tuple[str, ...]:
        change = changes[name]
        if isinstance(change, str):
            raise ValueError(f"{name}: a list is wanted, not a text")
        if not isinstance(change, Mapping):
            return tuple(change)
        if unknown := set(change) - {"add", "remove"}:
            raise ValueError(f"{name}: unknown keys {sorted(unknown)}")
        fold = str.lower if name in Rules.EXTENSIONS else str
        gone = set(map(fold, change.get("remove", ())))
        return (*(x for x in old if fold(x) not in gone), *(x for x in change.get("add", ()) if x not in old))

    tools, lists = ({f.name for f in fields(kind)} - {"roles"} for kind in (Roles, Rules))
    if unknown := set(changes) - tools - lists:
        raise ValueError(f"unknown rules {sorted(unknown)}")
    roles = replace(base.roles, **{k: changed(k, getattr(base.roles, k)) for k in changes if k in tools})
    return replace(base, roles=roles, **{k: changed(k, getattr(base, k)) for k in changes if k in lists})


def parsed(text: str) -> Rules:
    """Rules from a JSON object, see ``of``; of nothing the defaults."""
    found = json.loads(text) if text.strip() else {}
    if not isinstance(found, dict):
        raise ValueError("rules are a JSON object")
    return of(found)
