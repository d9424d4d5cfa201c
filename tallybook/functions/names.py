"""Names for working columns that a table does not have yet."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores added until none of ``columns`` has it; case does not count."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def free_names(columns: Iterable[str], *names: str) -> list[str]:
    """A free name for each of ``names``, all different."""
    taken, found = list(columns), []
    for name in names:
        found.append(free_name(taken, name))
        taken.append(found[-1])
    return found
