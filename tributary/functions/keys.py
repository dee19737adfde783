"""Keys of records and runs."""

from __future__ import annotations

from datetime import datetime, timezone

_RUN_DATE = r"r'^(\d{4})-?(\d{2})-?(\d{2})'"


def surrogate_key(source: str, entity_type: str, source_id: str) -> str:
    """`source:entity_type:source_id`; null when a piece is null."""
    return f"concat({source}, ':', {entity_type}, ':', {source_id})"


def run_date(run_id: str, today: str) -> str:
    """YYYYMMDD of a run id that starts with a date, otherwise of `today`."""
    found = f"regexp_extract({run_id}, {_RUN_DATE}, 0)"
    return f"CASE WHEN {found} <> '' THEN replace({found}, '-', '') ELSE date_format({today}, 'yyyyMMdd') END"


def new_run_id(now: datetime | None = None) -> str:
    """`YYYY-MM-DDTHH-MM-SSZ`, made once per run on the driver."""
    return (now or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H-%M-%SZ")


def run_id_of(instant: str) -> str:
    """The run id of an instant, as `new_run_id` writes it; fractions of a second are cut off."""
    return f"date_format({instant}, \"yyyy-MM-dd'T'HH-mm-ss'Z'\")"


def timestamp_literal(moment: datetime) -> str:
    """A moment as a UTC timestamp. It must have an offset: a naive one could mean any zone."""
    if moment.tzinfo is None:
        raise ValueError(f"{moment} has no offset")
    return f"TIMESTAMP '{moment.astimezone(timezone.utc).strftime('%Y-%m-%d %H:%M:%S.%f')}+00:00'"
