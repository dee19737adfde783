"""Source contracts: the fields a raw record must have, checked as columns.

`validate` tags each row with its errors; `valid_records` and `quarantined` split the tagged frame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.cells import Cell, Records, choose, flag, name, one_of, quote, selected
from tributary.functions.instants import iso_utc, standardize_datetime
from tributary.functions.text import strip, trimmed
from tributary.model import SALESFORCE, STRIPE
from tributary.operators.rules import all_pass, collect_errors, error, first_error, pinned

_INT_TEXT = r"^[+-]?\d+(?:_\d+)*(?:\.0+)?$"
_FLOAT_TEXT = (
    r"(?i)^[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:e[+-]?\d+)?|inf|infinity|nan)$"
)
# Texts read as booleans, compared in lower case.
_TRUE_TEXTS = ("1", "on", "t", "true", "y", "yes")
_FALSE_TEXTS = ("0", "off", "f", "false", "n", "no")


@dataclass(frozen=True)
class Field:
    """One field: its name, its type, whether it must be there, and its other spellings."""

    name: str
    type: str
    required: bool = True
    spellings: tuple[str, ...] = ()
    minimum: int | None = None
    lower: bool = False
    default: bool | None = None

    @property
    def paths(self) -> tuple[str, ...]:
        return self.spellings or (self.name,)


@dataclass(frozen=True)
class Contract:
    source: str
    resource: str
    fields: tuple[Field, ...] = field(default_factory=tuple)
    id_field: str = "id"


Checked = tuple[str, list[tuple[str, str]]]


def _plain(cell: Cell) -> str:
    return f"replace({trimmed(cell)}, '_', '')"


def _check_string(cell: Cell, spec: Field) -> Checked:
    value = f"lower({trimmed(cell)})" if spec.lower else trimmed(cell)
    is_string = flag(cell.is_string)
    return f"CASE WHEN {is_string} THEN {value} END", [(f"NOT {is_string}", error(spec.name, "string_type"))]


def _check_int(cell: Cell, spec: Field) -> Checked:
    number = f"TRY_CAST({cell.text} AS DOUBLE)"
    from_text = f"TRY_CAST(regexp_replace({_plain(cell)}, r'\\.0+$', '') AS BIGINT)"
    value = choose(
        (cell.is_integer, f"TRY_CAST({cell.text} AS BIGINT)"),
        (cell.is_string, f"CASE WHEN {trimmed(cell)} RLIKE {quote(_INT_TEXT)} THEN {from_text} END"),
        (cell.is_number, f"CASE WHEN {number} = floor({number}) THEN TRY_CAST({number} AS BIGINT) END"),
        (cell.is_bool, f"CASE WHEN {cell.text} = 'True' THEN 1L ELSE 0L END"),
        otherwise="CAST(NULL AS BIGINT)",
    )
    unread = choose(
        (cell.is_string, error(spec.name, "int_parsing")),
        (cell.is_number, error(spec.name, "int_from_float")),
        otherwise=error(spec.name, "int_type"),
    )
    coerced = name(f"_c_{spec.name}")
    rules = [(f"{coerced} IS NULL", unread)]
    if spec.minimum is not None:
        rules.append((f"{coerced} < {spec.minimum}", error(spec.name, "greater_than_equal")))
    return value, rules


def _check_float(cell: Cell, spec: Field) -> Checked:
    value = choose(
        (cell.is_string,
         f"CASE WHEN {trimmed(cell)} RLIKE {quote(_FLOAT_TEXT)} THEN TRY_CAST({_plain(cell)} AS DOUBLE) END"),
        (cell.is_number, f"TRY_CAST({cell.text} AS DOUBLE)"),
        (cell.is_bool, f"CASE WHEN {cell.text} = 'True' THEN 1D ELSE 0D END"),
        otherwise="CAST(NULL AS DOUBLE)",
    )
    unread = choose(
        (cell.is_string, error(spec.name, "float_parsing")), otherwise=error(spec.name, "float_type")
    )
    return value, [(f"{name('_c_' + spec.name)} IS NULL", unread)]


def _check_bool(cell: Cell, spec: Field) -> Checked:
    text = f"lower({trimmed(cell)})"
    number = f"TRY_CAST({cell.text} AS DOUBLE)"
    value = choose(
        (cell.is_bool, f"{cell.text} = 'True'"),
        (cell.is_string,
         f"CASE WHEN {one_of(text, _TRUE_TEXTS)} THEN true WHEN {one_of(text, _FALSE_TEXTS)} THEN false END"),
        (cell.is_number, f"CASE {number} WHEN 1 THEN true WHEN 0 THEN false END"),
        otherwise="CAST(NULL AS BOOLEAN)",
    )
    unread = choose(
        (cell.is_string, error(spec.name, "bool_parsing")),
        (cell.is_number, error(spec.name, "bool_parsing")),
        otherwise=error(spec.name, "bool_type"),
    )
    return value, [(f"{name('_c_' + spec.name)} IS NULL", unread)]


def _check_datetime(cell: Cell, spec: Field) -> Checked:
    value = standardize_datetime(cell)
    unread = choose(
        (cell.is_string, error(spec.name, "datetime_parsing")),
        (cell.is_number, error(spec.name, "datetime_parsing")),
        otherwise=error(spec.name, "datetime_type"),
    )
    return value, [(f"{name('_c_' + spec.name)} IS NULL", unread)]


_CHECKS: dict[str, Callable[[Cell, Field], Checked]] = {
    "string": _check_string,
    "int": _check_int,
    "float": _check_float,
    "bool": _check_bool,
    "datetime": _check_datetime,
}
_NULL_ERROR = {
    "string": "string_type", "int": "int_type", "float": "float_type",
    "bool": "bool_type", "datetime": "datetime_type",
}


def check_field(cell: Cell, spec: Field) -> tuple[str, str]:
    """The coerced value, and the rule of one field, which may look at the value as `_c_<field>`."""
    value, problems = _CHECKS[spec.type](cell, spec)
    absent = f"NOT {flag(cell.present)}"
    null_error = error(spec.name, _NULL_ERROR[spec.type])
    if spec.required:
        head = [(absent, error(spec.name, "missing")), (cell.is_null, null_error)]
    elif spec.default is not None:
        value = f"CASE WHEN {absent} THEN {flag(spec.default)} ELSE {value} END"
        head = [(absent, "NULL"), (cell.is_null, null_error)]
    else:
        head = [(cell.is_null, "NULL")]
    return value, first_error(*head, *problems)


def validate(records: Records, contract: Contract, keep: tuple[str, ...] = ()) -> DataFrame:
    """Coerced fields, `errors` (null for a good row) and the raw `payload`; `keep` passes through."""
    df, cells = records.cells({spec.name: spec.paths for spec in contract.fields})
    # Values are trimmed in a projection of their own: every check looks at them several times.
    trims = {}
    for i, (field_name, cell) in enumerate(cells.items()):
        if cell.is_string is not False:
            trims[f"_s{i}"] = strip(cell.text)
            cells[field_name] = replace(cell, text=f"_s{i}", is_trimmed=True)
    df = df.selectExpr("*", *[f"{sql} AS {alias}" for alias, sql in trims.items()])
    specs = {spec.name: spec for spec in contract.fields}
    checked = {field_name: check_field(cells[field_name], spec) for field_name, spec in specs.items()}
    # Then the values, which most rules look at again, then the rules, then the verdict.
    df = df.selectExpr("*", *[f"{value} AS {name('_c_' + n)}" for n, (value, _) in checked.items()])
    df = selected(df, keep, {
        **{f"_c_{n}": name(f"_c_{n}") for n in checked},
        **{f"_e_{n}": rule for n, (_, rule) in checked.items()},
        "_e_": f"CASE WHEN {records.not_an_object()} THEN {error('', 'dict_type')} END",
        "payload": records.payload(),
    })
    rules = [name(f"_e_{n}") for n in checked]
    return selected(df, keep, {
        **{n: name(f"_c_{n}") for n in checked},
        "is_valid": pinned(all_pass(["_e_", *rules])),
        "errors": f"CASE WHEN _e_ IS NOT NULL THEN array(_e_) ELSE {collect_errors(rules)} END",
        "payload": "payload",
    })


def valid_records(validated: DataFrame, contract: Contract) -> DataFrame:
    return validated.where("is_valid").select(*[spec.name for spec in contract.fields])


def quarantined(validated: DataFrame, contract: Contract, keep: tuple[str, ...] = ()) -> DataFrame:
    return validated.where("NOT is_valid").select(
        F.lit(contract.source).alias("source"), F.lit(contract.resource).alias("resource"),
        *keep, "payload", "errors",
    )


def first_message(errors: str) -> str:
    """The first error message of a row."""
    return f"coalesce(get({errors}, 0).msg, 'unknown validation error')"


def data_json(contract: Contract) -> str:
    """The coerced fields as a JSON object; instants are ISO-8601 in UTC."""
    values = {
        spec.name: iso_utc(name(spec.name)) if spec.type == "datetime" else name(spec.name)
        for spec in contract.fields
    }
    return f"to_json(struct({', '.join(f'{sql} AS {name(key)}' for key, sql in values.items())}))"


def _text(name: str, required: bool = True, **options) -> Field:
    return Field(name, "string", required, **options)


def _salesforce(name: str, type_: str, original: str, required: bool = False) -> Field:
    return Field(name, type_, required, spellings=(original, name))


_SALESFORCE_DATES = (
    _salesforce("created_date", "datetime", "CreatedDate"),
    _salesforce("last_modified_date", "datetime", "LastModifiedDate"),
)

CONTRACTS: dict[tuple[str, str], Contract] = {
    (c.source, c.resource): c
    for c in (
        Contract(STRIPE, "customers", (
            _text("id"), _text("email", False), _text("name", False), _text("description", False),
            Field("created", "datetime"), Field("livemode", "bool", False, default=False),
        )),
        Contract(STRIPE, "charges", (
            _text("id"), Field("amount", "int", minimum=0), _text("currency", lower=True), _text("status"),
            _text("customer", False), _text("description", False),
            Field("created", "datetime"), Field("livemode", "bool", False, default=False),
        )),
        Contract(STRIPE, "invoices", (
            _text("id"), _text("customer", False), Field("amount_due", "int"), Field("amount_paid", "int"),
            _text("currency", lower=True), _text("status", False), Field("created", "datetime"),
        )),
        Contract(SALESFORCE, "accounts", (
            _salesforce("id", "string", "Id", True), *_SALESFORCE_DATES,
            _salesforce("name", "string", "Name", True),
            _salesforce("industry", "string", "Industry"), _salesforce("website", "string", "Website"),
        )),
        Contract(SALESFORCE, "opportunities", (
            _salesforce("id", "string", "Id", True), *_SALESFORCE_DATES,
            _salesforce("name", "string", "Name", True),
            _salesforce("amount", "float", "Amount"),
            _salesforce("stage_name", "string", "StageName", True),
            _salesforce("close_date", "string", "CloseDate"),
        )),
    )
}
