"""Instants: epoch numbers, ISO-8601 text and dates to UTC timestamps."""

from __future__ import annotations

from tributary.functions.cells import Cell, choose, quote
from tributary.functions.text import strip, trimmed

_EPOCH_TEXT = r"^(?:\d{10}|\d{13})(?:\.\d+)?$"
_MILLISECOND_MAGNITUDE = 1e11
_FIRST_SECOND = -62135596800.0
_END_SECOND = 253402300800.0

# An offset may not push the first or the last day out of the calendar.
_YEARS = r"(?!0000|0001-?01-?01[T ].*\+|9999-?12-?31[T ].*-)"

# The spellings Spark's own cast reads exactly; nearly all real values take this branch.
_PLAIN_ISO = (
    rf"^{_YEARS}\d{{4}}-\d\d-\d\d"
    r"(?:[T ]\d\d:\d\d(?::\d\d(?:\.\d{1,6})?(?:Z|[+-](?:0\d|1[0-7])(?::?[0-5]\d)?)?)?)?$"
)

# The other spellings: compact digits, any separator, bare hours, comma or long fractions, offsets
# with seconds. They are spelled out in full with a leading mark, gaps are filled, and Spark casts.
_DATE = r"(\d{4})(?:-(\d\d)-(\d\d)|(\d\d)(\d\d))"
_FRACTION = r"(?:[.,](\d{1,6})\d*)?"
_CLOCK = rf"(\d\d)(?::(\d\d)(?::(\d\d){_FRACTION})?|(\d\d)(?:(\d\d){_FRACTION})?)?"
_OFFSET = r"(?:[Zz]|([+-]\d\d)(?::(\d\d)(?::(\d\d)(?:\.\d+)?)?|(\d\d)(\d\d)?)?)?"
_ANY_ISO = rf"^{_YEARS}{_DATE}(?:[\s\S]{_CLOCK}{_OFFSET}|[Zz])?$"
_IN_FULL = "#$1-$2$4-$3$5T$6:$7$10:$8$11.$9$12$13:$14$16:$15$17"
_NO_OFFSET = r"(?<![+-]\d\d)::$"
_GAP = r"(?<=[T:])(?=[:.+-]|$)"
_NO_FRACTION = r"\.(?=[+-]|$)"
_STARTS_LIKE_A_DATE = r"^\d{4}-?\d\d"


def _epoch_micros(epoch: str) -> str:
    scale = f"CASE WHEN abs({epoch}) > {_MILLISECOND_MAGNITUDE:.0f}D THEN 1000D ELSE 1000000D END"
    return f"CAST(rint({epoch} * {scale}) AS BIGINT)"


def epoch_to_timestamp(epoch: str) -> str:
    """Epoch seconds (a double), or milliseconds for large magnitudes; null outside the years 1 to 9999."""
    in_range = (
        f"({epoch} >= {_FIRST_SECOND:.0f}D OR {epoch} < -{_MILLISECOND_MAGNITUDE:.0f}D) "
        f"AND {epoch} >= {_FIRST_SECOND:.0f}000D AND {epoch} < {_END_SECOND:.0f}000D"
    )
    return f"CASE WHEN {in_range} THEN timestamp_micros({_epoch_micros(epoch)}) END"


def _spelled_out(text: str) -> str:
    """Timestamp of the less common ISO-8601 spellings."""
    full = f"regexp_replace({text}, {quote(_ANY_ISO)}, {quote(_IN_FULL)})"
    for pattern, filler in ((_NO_OFFSET, ""), (_GAP, "00"), (_NO_FRACTION, "")):
        full = f"regexp_replace({full}, {quote(pattern)}, '{filler}')"
    return f"TRY_CAST(regexp_extract({full}, '^#(.*)$', 1) AS TIMESTAMP)"


def parse_instant(x: str) -> str:
    """UTC timestamp of epoch or ISO-8601 text; text without an offset is UTC; anything else is null."""
    return parse_stripped(f"({strip(x)})")


def parse_stripped(text: str) -> str:
    """The rest of `parse_instant`, for trimmed text."""
    seconds = f"TRY_CAST({text} AS DOUBLE)"
    return (
        f"CASE WHEN {text} RLIKE {quote(_PLAIN_ISO)} THEN TRY_CAST({text} AS TIMESTAMP) "
        f"WHEN {text} RLIKE {quote(_EPOCH_TEXT)} THEN timestamp_micros({_epoch_micros(seconds)}) "
        f"WHEN {text} RLIKE {quote(_STARTS_LIKE_A_DATE)} "
        f"THEN {_spelled_out(text)} END"
    )


def standardize_datetime(cell: Cell) -> str:
    """UTC timestamp of a raw value of any kind; booleans and nested values become null."""
    if cell.is_instant:
        return f"CAST({cell.value} AS TIMESTAMP)"
    return choose(
        (cell.is_string, parse_stripped(trimmed(cell))),
        (cell.is_number, epoch_to_timestamp(f"TRY_CAST({cell.text} AS DOUBLE)")),
        otherwise="CAST(NULL AS TIMESTAMP)",
    )


def iso_utc(instant: str) -> str:
    """ISO-8601 text in UTC, with a fraction only where there is one."""
    return (
        f"CASE WHEN unix_micros({instant}) % 1000000 = 0 THEN date_format({instant}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") "
        f"ELSE date_format({instant}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") END"
    )
