"""Source statuses onto the normalized ones."""

from __future__ import annotations

from collections.abc import Mapping

from tributary.functions.cells import quote
from tributary.model import UNKNOWN_STATUS


def resolve_status(cleaned: str, status_map: Mapping[str, str], default: str) -> str:
    """The mapped status of cleaned text: the exact key, then its lower-case form, else unknown."""
    if not status_map:
        return f"CASE WHEN {cleaned} IS NULL THEN {quote(default)} ELSE {quote(UNKNOWN_STATUS)} END"
    table = f"map({', '.join(quote(x) for pair in status_map.items() for x in pair)})"
    return (
        f"CASE WHEN {cleaned} IS NULL THEN {quote(default)} ELSE coalesce("
        f"try_element_at({table}, {cleaned}), try_element_at({table}, lower({cleaned})), {quote(UNKNOWN_STATUS)}) END"
    )
