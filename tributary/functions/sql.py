"""The rules as functions of plain SQL.

`register_rules` creates temporary SQL functions in the session. Catalyst puts their bodies in place of their calls, so a query
written in SQL plans as the same expressions as one built by this library, without any Python or copied rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from tributary.functions.attributes import decode_attributes
from tributary.functions.instants import epoch_to_timestamp, parse_instant
from tributary.functions.keys import run_date, run_id_of, surrogate_key
from tributary.functions.money import coerce_minor_text, currency_exponent, major_to_minor, minor_text_to_major, minor_to_major
from tributary.functions.text import clean_email, clean_string, collapse, is_missing, standardize_currency, strip, title_case


@dataclass(frozen=True)
class SqlFunction:
    """`takes` and `gives` are SQL types; `body` is an expression, or for a table function a query."""

    takes: str
    gives: str
    body: str
    is_table: bool = False

    def ddl(self, name: str) -> str:
        gives = f"TABLE ({self.gives})" if self.is_table else self.gives
        return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({self.takes}) RETURNS {gives} RETURN {self.body}"


RULES: dict[str, SqlFunction] = {
    "is_missing": SqlFunction("x STRING", "BOOLEAN", is_missing("x")),
    "strip_text": SqlFunction("x STRING", "STRING", strip("x")),
    "collapse_text": SqlFunction("x STRING", "STRING", collapse("x")),
    "clean_string": SqlFunction("x STRING", "STRING", clean_string("x")),
    "clean_email": SqlFunction("x STRING", "STRING", clean_email("x")),
    "title_case": SqlFunction("x STRING", "STRING", title_case(f"({clean_string('x')})")),
    "standardize_currency": SqlFunction("x STRING", "STRING", standardize_currency("x")),
    "currency_exponent": SqlFunction("currency STRING", "INT", currency_exponent("currency")),
    "parse_instant": SqlFunction("x STRING", "TIMESTAMP", parse_instant("x")),
    "epoch_to_timestamp": SqlFunction("epoch DOUBLE", "TIMESTAMP", epoch_to_timestamp("epoch")),
    "minor_units": SqlFunction("x STRING", "BIGINT", coerce_minor_text(f"({strip('x')})")),
    "minor_to_major": SqlFunction("minor BIGINT, currency STRING", "DECIMAL(18,2)", minor_to_major("minor", "currency")),
    "minor_text_to_major": SqlFunction("x STRING, currency STRING", "DECIMAL(18,2)", minor_text_to_major("x", "currency")),
    "major_to_minor": SqlFunction("x STRING, currency STRING", "BIGINT", major_to_minor("x", "currency")),
    "surrogate_key": SqlFunction("source STRING, entity_type STRING, source_id STRING", "STRING", surrogate_key("source", "entity_type", "source_id")),
    "run_id_of": SqlFunction("at TIMESTAMP", "STRING", run_id_of("at")),
    "run_date": SqlFunction("run_id STRING, today TIMESTAMP", "STRING", run_date("run_id", "today")),
    "decode_attributes": SqlFunction("x STRING", "STRING", decode_attributes("x")),
    "attributes_of": SqlFunction(
        "bag STRING", "name STRING, value STRING",
        "SELECT key, CAST(value AS STRING) FROM variant_explode(try_parse_json(bag))", is_table=True,
    ),
}


def register_rules(spark: SparkSession, prefix: str = "") -> list[str]:
    """Create all rules under their names, each with the prefix; returns the names."""
    names = []
    for name, function in RULES.items():
        names.append(f"{prefix}{name}")
        spark.sql(function.ddl(names[-1]))
    return names
