"""The bag of source-specific extras, kept as JSON text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

from tributary.functions.cells import Cell, in_brackets, is_object, name, strict_json
from tributary.functions.text import null_if_missing


def attribute_value(cell: Cell, collapsed: str) -> str:
    """Cleaned text for strings, any other value as it is, null for missing values."""
    if cell.is_string is True:
        return null_if_missing(collapsed)
    if isinstance(cell.dtype, T.VariantType):
        return (
            f"CASE WHEN {cell.is_string} THEN CAST({null_if_missing(collapsed)} AS VARIANT) "
            f"WHEN NOT {cell.is_null} THEN {cell.value} END"
        )
    if isinstance(cell.dtype, (T.FloatType, T.DoubleType)):
        return f"CASE WHEN NOT isnan({cell.value}) THEN {cell.value} END"
    return cell.value


def attributes_json(values: Mapping[str, str]) -> str:
    """A JSON object without the missing values."""
    if not values:
        return "'{}'"
    return f"to_json(struct({', '.join(f'{value} AS {name(key)}' for key, value in values.items())}))"


def decode_attributes(text: str) -> str:
    """JSON text to JSON text of an object: bad JSON is wrapped under `_raw`, non-objects become null."""
    parsed = f"({strict_json(f'try_parse_json({in_brackets(text)})')})"
    return (
        f"CASE WHEN {text} IS NOT NULL AND {parsed} IS NULL THEN to_json(named_struct('_raw', {text})) "
        f"WHEN {is_object(parsed)} THEN CAST({parsed} AS STRING) END"
    )
