"""Rules about paths inside a distribution: system folders and external packages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Folders of the operating system, from the root of an image or archive.
DISTRO_PREFIXES = ("usr/lib/", "usr/lib64/", "lib/", "lib64/", "usr/include/", "usr/local/lib/", "etc/", "proc/", "sys/", "dev/", "usr/share/", "var/")
# Components that begin a new root.
ROOTS = ("iso", "deb", "rpm", "tar", "tgz", "zip", "gz")


def in_package(p: Column) -> Column:
    """Whether a component is a deb or rpm package, unpacked or not."""
    return p.rlike(r"\.(?i:deb|rpm)(_dir)?(/|$)")


def is_distro_system(p: Column) -> Column:
    """Path of the operating system behind the first ``bin/`` and the last archive; contents of packages are none."""
    behind = F.regexp_replace(p, "(?s)^.*?bin/", "")
    inner = F.regexp_replace(behind, r"(?s)^(?:.*/)?[^/]*\.(?i:" + "|".join(ROOTS) + r")(?:_dir)?(?:/|$)", "")
    return ~in_package(p) & inner.rlike("^/?(" + "|".join(DISTRO_PREFIXES) + ")")


def package(p: Column) -> Column:
    """Struct (package_type, container) of the external package around a file; both null if there is none.

    The outermost deb or rpm comes first, then Python's package folders, wheels, and node_modules.
    """
    parts = F.split(F.replace(p, F.lit("\\"), F.lit("/")), "/")
    bare = F.transform(parts, lambda c: F.regexp_replace(c, "_dir$", ""))

    def at(i: Column) -> Column:
        # index 0 isn't valid
        return F.when(i > 0, F.try_element_at(parts, i.cast("int")))

    def first(pattern: str) -> Column:
        return F.try_element_at(F.filter(bare, lambda c: F.lower(c).rlike(pattern)), F.lit(1))

    unknown = F.lit("unknown")
    folder = F.array_position(F.transform(parts, lambda c: c.isin("site-packages", "dist-packages")), True)
    behind = F.coalesce(at(folder + 1), unknown)
    python = F.when(behind.startswith("__"), F.coalesce(at(folder - 1), unknown)).otherwise(behind)
    modules = F.array_position(parts, "node_modules")
    module = F.coalesce(at(modules + 1), unknown)
    scoped = F.when(module.startswith("@"), F.concat(module, F.lit("/"), at(modules + 2)))
    deb, wheel = first(r"\.(deb|rpm)$"), first(r"\.whl$")
    kind = F.when(deb.isNotNull(), "deb").when((folder > 0) | wheel.isNotNull(), "pip").when(modules > 0, "npm")
    name = F.when(deb.isNotNull(), deb).when(folder > 0, python).when(wheel.isNotNull(), wheel).when(modules > 0, F.coalesce(scoped, module))
    return F.struct(kind.alias("package_type"), name.alias("container"))
