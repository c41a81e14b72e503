"""The three outcomes of a check. Expressions are SQL text."""

from __future__ import annotations

from collections.abc import Iterable

# Outcome names.
MISMATCH = "MISMATCH"
MATCH = "MATCH"
UNKNOWN = "UNKNOWN"


def verdict_text(matched: str) -> str:
    """TRUE, FALSE and NULL as the three outcomes."""
    return f"CASE WHEN {matched} THEN '{MATCH}' WHEN NOT ({matched}) THEN '{MISMATCH}' ELSE '{UNKNOWN}' END"


def roll_up(statuses: Iterable[str]) -> str:
    """Any MISMATCH wins, then any MATCH, else UNKNOWN."""
    seen = ", ".join(statuses)
    return (
        f"CASE WHEN '{MISMATCH}' IN ({seen}) THEN '{MISMATCH}' "
        f"WHEN '{MATCH}' IN ({seen}) THEN '{MATCH}' ELSE '{UNKNOWN}' END"
    )
