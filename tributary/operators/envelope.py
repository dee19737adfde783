"""Envelopes: lineage around a payload."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from tributary.functions.cells import is_object, name, pick_variant, selected
from tributary.functions.instants import iso_utc
from tributary.functions.keys import timestamp_literal
from tributary.model import ENVELOPE_MARKERS
from tributary.operators.contracts import Contract, data_json


def unwrap(record: str) -> str:
    """The payload of an envelope; a record without an envelope key stays as it is.

    Keys count by presence: a marker that holds a null still marks an envelope.
    """
    data = pick_variant(record, "data")
    marked = " OR ".join(f"{pick_variant(record, marker)} IS NOT NULL" for marker in ENVELOPE_MARKERS)
    return f"CASE WHEN {is_object(data)} AND ({marked}) THEN {data} ELSE {record} END"


def wrap(valid: DataFrame, contract: Contract, extracted_at: datetime) -> DataFrame:
    """One envelope per valid row, with one extraction time per batch; `data` is a VARIANT."""
    return selected(valid, (), {
        "source": f"'{contract.source}'",
        "resource": f"'{contract.resource}'",
        "external_id": name(contract.id_field),
        "extracted_at": iso_utc(timestamp_literal(extracted_at)),
        "data": f"parse_json({data_json(contract)})",
    })
