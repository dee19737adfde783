"""One row per key, the newest wins.

`row_number() = 1` plans a WindowGroupLimit on both sides of the shuffle, so a task sends on at most
one row per key. A key that holds a third of all rows shrinks to one row per task before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_row_of_key"


def deduplicate(
    df: DataFrame,
    keys: Sequence[str],
    order_column: str | None = None,
    position: Sequence[str | Column] = (),
) -> DataFrame:
    """Keep the row with the largest `order_column` per key, nulls oldest.

    `position` lists the columns that tell the input order, most significant first; among equals the
    last row wins. Rows equal in all of them are told apart by a hash of their values, so the result
    does not depend on how the input is partitioned. Keys the frame lacks are ignored.
    """
    known = [key for key in keys if key in df.columns]
    if not known:
        return df
    order: list[Column] = []
    if order_column and order_column in df.columns:
        order.append(F.col(order_column).desc_nulls_last())
    order += [(F.col(p) if isinstance(p, str) else p).desc_nulls_last() for p in position]
    order.append(row_hash(df).desc())
    window = Window.partitionBy(*known).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def row_hash(df: DataFrame) -> Column:
    """A hash of the comparable columns of a row."""
    return F.xxhash64(*[
        F.col(f"`{name}`").cast("string") if kind == "variant" else F.col(f"`{name}`")
        for name, kind in df.dtypes if not kind.startswith("map")
    ])


def count_duplicates(df: DataFrame, key: str, groups: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct keys and the difference, per group. Counts merge before they move."""
    per_key = df.groupBy(*groups, key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(*groups).agg(
        F.sum("n").alias("input_rows"),
        F.count(F.lit(1)).alias("output_rows"),
        (F.sum("n") - F.count(F.lit(1))).alias("duplicates_removed"),
    )
