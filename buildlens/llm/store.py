"""Written intermediate tables: they cut lineage and survive lost executors."""

from __future__ import annotations

from ..cluster import saved, shared_folder

__all__ = ["saved", "shared_folder"]
