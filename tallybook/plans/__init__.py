"""Operators put together: from pointer files to a manifest, and to leak-free splits."""

from tallybook.plans.ingest import build_manifest, checked_pointers
from tallybook.plans.splits import leak_free_split

__all__ = ["build_manifest", "checked_pointers", "leak_free_split"]
