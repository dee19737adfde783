"""Rule results. A rule is a nullable struct expression: null when the row passes."""

from __future__ import annotations

from tributary.functions.cells import quote

ERROR_TYPE = "struct<field: string, type: string, msg: string>"
ERRORS_TYPE = f"array<{ERROR_TYPE}>"

# The message of each error type.
MESSAGES = {
    "missing": "Field required",
    "string_type": "Input should be a valid string",
    "string_pattern_mismatch": "String should match pattern '^[A-Z]{3}$'",
    "int_type": "Input should be a valid integer",
    "int_parsing": "Input should be a valid integer, unable to parse string as an integer",
    "int_from_float": "Input should be a valid integer, got a number with a fractional part",
    "greater_than_equal": "Input should be greater than or equal to 0",
    "float_type": "Input should be a valid number",
    "float_parsing": "Input should be a valid number, unable to parse string as a number",
    "bool_type": "Input should be a valid boolean",
    "bool_parsing": "Input should be a valid boolean, unable to interpret input",
    "datetime_type": "Input should be a valid datetime",
    "datetime_parsing": "Input should be a valid datetime or date",
    "enum": "Input should be one of the known values",
    "dict_type": "Input should be a valid dictionary",
    "json_invalid": "Input is not valid JSON",
}


def error(field: str, kind: str) -> str:
    return f"named_struct('field', {quote(field)}, 'type', {quote(kind)}, 'msg', {quote(MESSAGES[kind])})"


def first_error(*candidates: tuple[str, str]) -> str:
    """The error of the first condition that holds, or null."""
    return f"CASE {' '.join(f'WHEN {condition} THEN {result}' for condition, result in candidates)} END"


def all_pass(rules: list[str]) -> str:
    """True when no rule reports an error; plain null tests, so it stays in generated code."""
    return " AND ".join(f"{rule} IS NULL" for rule in rules)


def collect_errors(rules: list[str]) -> str:
    """All reported errors in rule order; null for a row that passes."""
    return f"CASE WHEN NOT ({all_pass(rules)}) THEN array_compact(array({', '.join(rules)})) END"


def pinned(verdict: str) -> str:
    """The same verdict, tied to the projection that computes it.

    A filter on a verdict would otherwise be pushed below that projection with a copy of every rule
    inside, and each rule would run twice. Row ids are never negative, so nothing else changes.
    """
    return f"CASE WHEN monotonically_increasing_id() >= 0 THEN {verdict} END"
