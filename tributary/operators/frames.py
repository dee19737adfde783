"""Cleaning of any frame by column role."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tributary.functions.cells import name, typed_cell
from tributary.functions.instants import standardize_datetime
from tributary.functions.text import clean_string, standardize_currency


def clean_frame(
    df: DataFrame,
    *,
    string_columns: Sequence[str] = (),
    datetime_columns: Sequence[str] = (),
    currency_columns: Sequence[str] = (),
    numeric_columns: Sequence[str] = (),
) -> DataFrame:
    """Apply the standard rule of each role in place; names the frame lacks are skipped."""
    columns = []
    for field in df.schema.fields:
        cell = typed_cell(name(field.name), field.dataType)
        rule = cell.value
        if field.name in string_columns:
            rule = clean_string(cell.text)
        elif field.name in datetime_columns:
            rule = standardize_datetime(cell)
        elif field.name in currency_columns:
            rule = standardize_currency(cell.text)
        elif field.name in numeric_columns:
            how = "CAST" if isinstance(field.dataType, T.BooleanType) else "TRY_CAST"
            rule = f"{how}({cell.value} AS BIGINT)"
        columns.append(f"{rule} AS {name(field.name)}")
    return df.selectExpr(*columns)


# The roles of the unified columns.
UNIFIED_ROLES = {
    "string_columns": ("name", "email"),
    "currency_columns": ("currency",),
    "datetime_columns": ("created_at", "updated_at", "ingested_at"),
    "numeric_columns": ("amount_minor",),
}
