"""Money rules. Integer minor units are the truth; the decimal amount derives from them."""

from __future__ import annotations

from tributary.functions.cells import Cell, choose, one_of, quote
from tributary.functions.text import strip, trimmed
from tributary.model import ZERO_DECIMAL_CURRENCIES

_DIGITS = r"\d+(?:_\d+)*"
_WHOLE_NUMBER = rf"^[+-]?{_DIGITS}$"
_POINT_NUMBER = rf"^[+-]?(?:{_DIGITS}\.(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
_ANY_NUMBER = rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?\d+)?$"


def _has_no_minor_unit(currency: str) -> str:
    return f"coalesce({one_of(f'upper({currency})', ZERO_DECIMAL_CURRENCIES)}, false)"


def currency_exponent(currency: str) -> str:
    """Digits after the decimal point: 0 for currencies without a minor unit, otherwise 2."""
    return f"CASE WHEN {_has_no_minor_unit(currency)} THEN 0 ELSE 2 END"


def _number(stripped: str) -> str:
    """Exact decimal of numeric text; null for anything else, non-finite values included."""
    return (
        f"CASE WHEN {stripped} RLIKE {quote(_ANY_NUMBER)} "
        f"THEN TRY_CAST(replace({stripped}, '_', '') AS DECIMAL(38,18)) END"
    )


def exact_amount(cell: Cell) -> str:
    """The exact decimal of a raw amount."""
    return _number(trimmed(cell))


def _by_unit(value: str, currency: str, whole: str, cents: str) -> str:
    return (
        f"CASE WHEN {value} >= 0 THEN CASE WHEN {_has_no_minor_unit(currency)} THEN {whole} ELSE {cents} END END"
    )


def minor_to_major(minor: str, currency: str) -> str:
    """Whole minor units to an amount; null when missing or negative."""
    return _by_unit(
        minor, currency,
        f"TRY_CAST({minor} AS DECIMAL(18,2))",
        f"TRY_CAST(CAST({minor} AS DECIMAL(20,0)) * 0.01BD AS DECIMAL(18,2))",
    )


def minor_text_to_major(x: str, currency: str) -> str:
    """Text of minor units to an amount, rounded half to even; null when it is not a number or negative."""
    value = _number(f"({strip(x)})")
    return _by_unit(
        value, currency,
        f"TRY_CAST(bround({value}, 0) AS DECIMAL(18,2))",
        f"TRY_CAST(bround({value} / 100, 2) AS DECIMAL(18,2))",
    )


def amount_to_minor(value: str, currency: str) -> str:
    """An exact decimal to minor units, rounded half to even; null when missing or negative."""
    return _by_unit(
        value, currency,
        f"TRY_CAST(bround({value}, 0) AS BIGINT)",
        f"TRY_CAST(bround({value}, 2) * 100 AS BIGINT)",
    )


def major_to_minor(x: str, currency: str) -> str:
    """Text of an amount to minor units; null when missing, negative or not finite."""
    return amount_to_minor(_number(f"({strip(x)})"), currency)


def coerce_minor_text(stripped: str) -> str:
    """Trimmed text to minor units: a whole number, or a number with a point and no fraction."""
    plain = f"replace({stripped}, '_', '')"
    return (
        f"CASE WHEN {stripped} RLIKE {quote(_WHOLE_NUMBER)} THEN {_non_negative(f'TRY_CAST({plain} AS BIGINT)')} "
        f"WHEN {stripped} RLIKE {quote(_POINT_NUMBER)} THEN {_whole_float(f'TRY_CAST({plain} AS DOUBLE)')} END"
    )


def _whole_float(value: str) -> str:
    return f"CASE WHEN {value} >= 0 AND {value} = floor({value}) THEN TRY_CAST({value} AS BIGINT) END"


def _non_negative(value: str) -> str:
    return f"CASE WHEN {value} >= 0 THEN {value} END"


def coerce_minor_amount(cell: Cell) -> str:
    """Minor units of a raw value; booleans, fractions, negatives and garbage become null."""
    if cell.is_integer is True:
        return _non_negative(f"CAST({cell.value} AS BIGINT)")
    return choose(
        (cell.is_integer, _non_negative(f"TRY_CAST({cell.text} AS BIGINT)")),
        (cell.is_number, _whole_float(f"TRY_CAST({cell.text} AS DOUBLE)")),
        (cell.is_string, coerce_minor_text(trimmed(cell))),
        otherwise="CAST(NULL AS BIGINT)",
    )
