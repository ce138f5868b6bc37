"""SQL text of expressions with many literals.

A plan built literal by literal costs a call to the JVM for each of them; the
same expression as one text costs one.  The texts depend on fixed values only
and are made once per process.
"""

from __future__ import annotations

from collections.abc import Iterable


def quoted(value) -> str:
    """A literal: text, number or null."""
    if value is None:
        return "null"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def listed(values: Iterable) -> str:
    return ", ".join(map(quoted, values))


def pick(values: Iterable, index: str) -> str:
    """The value at a 0-based index."""
    return f"element_at(array({listed(values)}), cast({index} as int) + 1)"


def column(name: str) -> str:
    return f"`{name}`"
