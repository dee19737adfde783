"""The warehouse gate: typed coercion, and the columns that may not be empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tributary.functions.attributes import decode_attributes
from tributary.functions.cells import selected, typed_cell
from tributary.functions.instants import parse_instant
from tributary.model import REQUIRED_COLUMNS, REQUIRED_KEYS, UNIFIED_COLUMNS, UNIFIED_SCHEMA, UNKNOWN_STATUS
from tributary.operators.rules import pinned

_INSTANTS = ("created_at", "updated_at", "ingested_at")
_AMOUNTS = ("amount_minor", "amount")


def _attributes(dtype: T.DataType, decode: bool) -> str:
    if isinstance(dtype, T.StringType):
        return decode_attributes("attributes") if decode else "attributes"
    if isinstance(dtype, T.VariantType):
        return decode_attributes("CAST(attributes AS STRING)")
    return "to_json(attributes)" if isinstance(dtype, (T.StructType, T.MapType)) else "NULL"


def _value(schema: T.StructType, column: str, decode: bool) -> str:
    """The warehouse value of one column. Instants are read from instants and text, not from numbers."""
    if column not in schema.fieldNames():
        return f"'{UNKNOWN_STATUS}'" if column == "status" else "NULL"
    dtype = schema[column].dataType
    if column in _INSTANTS:
        if isinstance(dtype, T.StringType):
            return parse_instant(column)
        return column if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) else "NULL"
    if column == "attributes":
        return _attributes(dtype, decode)
    if column in _AMOUNTS:
        return f"TRY_CAST({column} AS {UNIFIED_SCHEMA[column].dataType.simpleString()})"
    text = typed_cell(column, dtype).text
    return f"coalesce({text}, '{UNKNOWN_STATUS}')" if column == "status" else text


def coerce_records(df: DataFrame, *, decode: bool = True) -> DataFrame:
    """Warehouse types for every unified column, `is_loadable`, and the `reason` of a refusal.

    A row is refused when a required column is empty or when an amount is there but is not a number.
    `decode=False` takes attribute text as the JSON it already is, as in rows this library wrote.
    """
    schema = df.schema
    values = {column: _value(schema, column, decode) for column in UNIFIED_COLUMNS}
    unread = [
        f"CASE WHEN {column} IS NOT NULL AND {values[column]} IS NULL THEN '{column}' END"
        for column in _AMOUNTS if column in schema.fieldNames()
    ]
    coerced = selected(df, (), {
        **{
            column: f"CAST({sql} AS {UNIFIED_SCHEMA[column].dataType.simpleString()})"
            for column, sql in values.items()
        },
        "_unread": f"concat_ws(',', {', '.join(unread)})" if unread else "''",
    })
    # The reasons below.
    gaps = {
        column: f"({column} IS NULL OR {column} = '')" if column in REQUIRED_KEYS else f"{column} IS NULL"
        for column in REQUIRED_COLUMNS
    }
    missing = ", ".join(f"CASE WHEN {gap} THEN '{column}' END" for column, gap in gaps.items())
    complete = " AND ".join(f"NOT {gap}" for gap in gaps.values())
    return selected(coerced, (), {
        **{column: column for column in UNIFIED_COLUMNS},
        "is_loadable": pinned(f"({complete} AND _unread = '')"),
        "reason": (
            f"CASE WHEN NOT ({complete}) THEN concat('record missing required columns: ', concat_ws(',', {missing})) "
            f"WHEN _unread <> '' THEN concat('not a number: ', _unread) END"
        ),
    })


def loadable(coerced: DataFrame) -> DataFrame:
    return coerced.where("is_loadable").drop("is_loadable", "reason")


def unloadable(coerced: DataFrame) -> DataFrame:
    return coerced.where("NOT is_loadable").drop("is_loadable")
