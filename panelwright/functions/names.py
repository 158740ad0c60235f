"""Names and texts inside SQL."""

from __future__ import annotations


def quoted(name: str) -> str:
    """A column name as an SQL identifier, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A text as an SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
