"""Text rules: missing values, whitespace, title case, e-mail, currency codes."""

from __future__ import annotations

from tributary.functions.cells import Cell, one_of, quote
from tributary.model import NULL_TOKENS

# The characters Unicode and ASCII count as whitespace. Java's `\s` knows fewer.
WHITESPACE = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)
_NOT_SPACE = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE_RUN = f"[ {_NOT_SPACE}]{{2,}}|[{_NOT_SPACE}]"
# One cheap range test spares most text the trimming and the replacing.
_MAY_HOLD_SPACE = r"[^!-~]"
_MAY_START_OR_END_WITH_SPACE = r"^[^!-~]|[^!-~]$"
_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"
_WORD_START = f"(?<![{_CASED}])(?=[{_CASED}])"


def _trim(x: str) -> str:
    return f"trim(BOTH {quote(WHITESPACE)} FROM {x})"


def strip(x: str) -> str:
    """Trim whitespace of every kind from both ends."""
    return f"CASE WHEN {x} RLIKE {quote(_MAY_START_OR_END_WITH_SPACE)} THEN {_trim(x)} ELSE {x} END"


def trimmed(cell: Cell) -> str:
    """The text of a cell without outer whitespace; only strings can have any."""
    return cell.text if cell.is_trimmed or cell.is_string is False else f"({strip(cell.text)})"


def collapse(x: str) -> str:
    """Trim, and turn every inner run of whitespace into one space."""
    return (
        f"CASE WHEN {x} RLIKE {quote(_MAY_HOLD_SPACE)} "
        f"THEN regexp_replace({_trim(x)}, {quote(_SPACE_RUN)}, ' ') ELSE {x} END"
    )


def is_missing(x: str) -> str:
    """Null, or text that stands for a missing value."""
    return f"({x} IS NULL OR {one_of(f'lower({strip(x)})', NULL_TOKENS)})"


def null_if_missing(collapsed: str) -> str:
    """The rest of `clean_string`, for text that is already collapsed."""
    return f"CASE WHEN NOT {one_of(f'lower({collapsed})', NULL_TOKENS)} THEN {collapsed} END"


def clean_string(x: str) -> str:
    """Collapsed text, or null when it stands for a missing value."""
    return null_if_missing(f"({collapse(x)})")


def title_case(cleaned: str) -> str:
    """Upper-case the first letter of every run of letters and lower-case the rest.

    `initcap` starts words at spaces only. Cleaned text never holds two spaces in a row, so a double
    space can mark every other word start for it and be taken out again.
    """
    return f"replace(initcap(regexp_replace({cleaned}, {quote(_WORD_START)}, '  ')), '  ', '')"


def clean_email(x: str) -> str:
    return f"lower({clean_string(x)})"


def currency_code(stripped: str) -> str:
    """The rest of `standardize_currency`, for trimmed text."""
    code = f"upper({stripped})"
    return f"CASE WHEN {code} RLIKE '^[A-Z]{{3}}$' AND {code} <> 'NAN' THEN {code} END"


def standardize_currency(x: str) -> str:
    """Three ASCII letters in upper case, or null."""
    return currency_code(strip(x))
