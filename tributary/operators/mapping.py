"""Source records onto the unified schema, compiled from a declarative mapping into one projection."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import DataFrame

from tributary.functions.attributes import attribute_value, attributes_json
from tributary.functions.cells import Cell, Records, name, quote, selected
from tributary.functions.instants import standardize_datetime
from tributary.functions.keys import surrogate_key, timestamp_literal
from tributary.functions.money import amount_to_minor, coerce_minor_amount, exact_amount, minor_to_major
from tributary.functions.status import resolve_status
from tributary.functions.text import collapse, currency_code, null_if_missing, strip, title_case, trimmed
from tributary.model import (
    CUSTOMER, ENTITY_TYPES, OPPORTUNITY, SALESFORCE, STATUSES, STRIPE, TRANSACTION,
    UNIFIED_COLUMNS, UNKNOWN_STATUS,
)
from tributary.operators.rules import all_pass, collect_errors, error, first_error, pinned

REJECT_COLUMNS = ("reject_stage", "reject_reason", "reject_errors", "payload")


@dataclass(frozen=True)
class Moments:
    """Where the times of a record stand."""

    created: str
    updated: str | None = None


@dataclass(frozen=True)
class StatusRule:
    """The status field, its known values, and the status of a record without one."""

    path: str | None = None
    values: Mapping[str, str] = field(default_factory=dict)
    otherwise: str = UNKNOWN_STATUS


@dataclass(frozen=True)
class Money:
    """The amount, in minor units or `in_major` ones, and its currency or the one assumed."""

    amount: str
    currency: str | None = None
    in_major: bool = False
    assumed: str | None = None


@dataclass(frozen=True)
class ResourceMapping:
    """How the records of one resource become unified records. Paths may be dotted.

    `spellings` lists other names a source field is known by, tried when the first is absent. `titled`
    writes the name in title case.
    """

    origin: tuple[str, str]
    entity: str
    key: str
    moments: Moments
    status: StatusRule = StatusRule()
    money: Money | None = None
    name: str | None = None
    email: str | None = None
    titled: bool = False
    attributes: Mapping[str, str] = field(default_factory=dict)
    spellings: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.entity not in ENTITY_TYPES:
            raise ValueError(f"unknown entity type {self.entity!r}, known: {ENTITY_TYPES}")
        unknown = {self.status.otherwise, *self.status.values.values()} - set(STATUSES)
        if unknown:
            raise ValueError(f"unknown statuses {sorted(unknown)}, known: {STATUSES}")

    def worded(self) -> set[str]:
        """Paths whose values are read as words."""
        return {p for p in (self.key, self.status.path, self.name, self.email, *self.attributes.values()) if p}

    def parsed(self) -> set[str]:
        """Paths whose values are parsed: instants, codes and numbers."""
        money = (self.money.amount, self.money.currency) if self.money else ()
        return {p for p in (self.moments.created, self.moments.updated, *money) if p}

    def paths(self) -> dict[str, tuple[str, ...]]:
        return {path: (path, *self.spellings.get(path, ())) for path in sorted(self.worded() | self.parsed())}

    def attribute_names(self) -> tuple[str, ...]:
        return (*self.attributes, *(("raw_status",) if self.status.path else ()))


def map_records(
    records: Records,
    mapping: ResourceMapping,
    ingested_at: datetime,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Unified columns plus the reject columns, which are null for a good row.

    Every row of the input comes out once. `reject_stage` says `mapping` when there is no record, id
    or creation time, and `validation` when the mapped row breaks a rule of the unified schema.
    """
    df, cells = records.cells(mapping.paths())
    # First layer: whitespace is dealt with once per value. Later layers use each result several times,
    # so Catalyst keeps the layers apart instead of repeating the work.
    df, cells, texts = _tidy(df, cells, mapping)

    def cleaned(path: str | None) -> str:
        return null_if_missing(texts[path]) if path else _NO_TEXT

    def instant(path: str | None) -> str:
        return standardize_datetime(cells[path]) if path else "CAST(NULL AS TIMESTAMP)"

    titled = title_case(cleaned(mapping.name)) if mapping.titled else cleaned(mapping.name)
    money = mapping.money
    currency = quote(money.assumed.strip().upper()) if money and money.assumed else _NO_TEXT
    if money and money.currency:
        currency = f"coalesce({currency_code(trimmed(cells[money.currency]))}, {currency})"

    # Second layer: every value is cleaned and named.
    df = selected(df, keep, {
        "_not_object": records.not_an_object(),
        "_record": records.whole(),
        "source_id": cleaned(mapping.key),
        "name": titled,
        "email": f"lower({cleaned(mapping.email)})",
        "currency": currency,
        "_raw_status": cleaned(mapping.status.path),
        "created_at": instant(mapping.moments.created),
        "updated_at": instant(mapping.moments.updated),
        "_amount": _raw_amount(cells, money),
        **{
            f"_a_{target}": attribute_value(cells[path], texts[path])
            for target, path in mapping.attributes.items()
        },
    })
    # Third layer: values that depend on cleaned ones.
    bag = {target: name(f"_a_{target}") for target in mapping.attributes}
    if mapping.status.path:
        bag["raw_status"] = "_raw_status"
    source, resource = mapping.origin
    df = selected(df, keep, {
        "_not_object": "_not_object",
        "_record": "_record",
        "unified_id": surrogate_key(quote(source), quote(mapping.entity), "source_id"),
        "source": quote(source),
        "source_resource": quote(resource),
        "source_id": "source_id",
        "entity_type": quote(mapping.entity),
        "name": "name",
        "email": "email",
        "currency": "currency",
        "amount_minor": amount_to_minor("_amount", "currency") if money and money.in_major else "_amount",
        "status": resolve_status("_raw_status", mapping.status.values, mapping.status.otherwise),
        "created_at": "created_at",
        "updated_at": "updated_at",
        "ingested_at": timestamp_literal(ingested_at),
        "attributes": attributes_json(bag),
    })
    return _tag_rejects(df, mapping, keep, records.payload("_record"))


_NO_TEXT = "CAST(NULL AS STRING)"


def _raw_amount(cells: dict[str, Cell], money: Money | None) -> str:
    if not money:
        return "CAST(NULL AS BIGINT)"
    return exact_amount(cells[money.amount]) if money.in_major else coerce_minor_amount(cells[money.amount])


def _tidy(
    df: DataFrame, cells: dict[str, Cell], mapping: ResourceMapping
) -> tuple[DataFrame, dict[str, Cell], dict[str, str]]:
    """Name the collapsed text of each text field and the trimmed text of each other field."""
    worded, parsed = mapping.worded(), mapping.parsed()
    tidy: list[str] = []
    texts: dict[str, str] = {}
    tidied = dict(cells)
    for i, (path, cell) in enumerate(cells.items()):
        if path in worded:
            tidy.append(f"{cell.text if cell.is_string is False else collapse(cell.text)} AS _c{i}")
            texts[path] = f"_c{i}"
        if path in parsed and cell.is_string is not False:
            tidy.append(f"{strip(cell.text)} AS _s{i}")
            tidied[path] = replace(cell, text=f"_s{i}", is_trimmed=True)
    return df.selectExpr("*", *tidy), tidied, texts


def unified_rules(entity_type: str) -> dict[str, str]:
    """Rules of the unified schema that a mapped row can still break, in field order."""
    currency = [("NOT currency RLIKE '^[A-Z]{3}$'", error("currency", "string_pattern_mismatch"))]
    minor = [("amount_minor < 0", error("amount_minor", "greater_than_equal"))]
    if entity_type == TRANSACTION:
        currency.insert(0, ("currency IS NULL", error("currency", "string_type")))
        minor.insert(0, ("amount_minor IS NULL", error("amount_minor", "int_type")))
    return {"_rule_currency": first_error(*currency), "_rule_amount": first_error(*minor)}


def _tag_rejects(df: DataFrame, mapping: ResourceMapping, keep: tuple[str, ...], payload: str) -> DataFrame:
    same = {column: column for column in UNIFIED_COLUMNS}
    rules = unified_rules(mapping.entity)
    # The reasons a record is refused for.
    df = selected(df, keep, {
        **same,
        "amount": minor_to_major("amount_minor", "currency"),
        "_record": "_record",
        "_reason": (
            f"CASE WHEN _not_object THEN 'record is not a JSON object' "
            f"WHEN source_id IS NULL THEN {quote(f"missing id field '{mapping.key}'")} "
            f"WHEN created_at IS NULL THEN {quote(f"missing or unparseable '{mapping.moments.created}'")} END"
        ),
        **rules,
    })
    passes = all_pass(list(rules))
    stage = f"CASE WHEN _reason IS NOT NULL THEN 'mapping' WHEN NOT ({passes}) THEN 'validation' END"
    return selected(df, keep, {
        **same,
        # A stream's rows pass a stateful step before they are filtered, which pins the column as well.
        "reject_stage": stage if df.isStreaming else pinned(stage),
        "reject_reason": f"coalesce(_reason, coalesce({', '.join(rules)}).msg)",
        "reject_errors": f"CASE WHEN _reason IS NULL THEN {collect_errors(list(rules))} END",
        # Written out for rejects only: the text of every record would cost as much as its mapping.
        "payload": f"CASE WHEN _reason IS NOT NULL OR NOT ({passes}) THEN {payload} END",
    })


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where("reject_stage IS NULL").drop(*REJECT_COLUMNS)


def rejected(tagged: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return tagged.where("reject_stage IS NOT NULL").select("source", "source_resource", *keep, *REJECT_COLUMNS)


# The fields of each source, the entities they become, and their status words.
_SALESFORCE_SPELLINGS = {
    "Id": ("id",), "Name": ("name",), "Industry": ("industry",), "Website": ("website",),
    "Amount": ("amount",), "StageName": ("stage_name",), "CloseDate": ("close_date",),
    "CreatedDate": ("created_date",), "LastModifiedDate": ("last_modified_date",),
}
_STRIPE_TIMES = Moments("created")
_SALESFORCE_TIMES = Moments("CreatedDate", "LastModifiedDate")
_ALL = (
    ResourceMapping(
        (STRIPE, "customers"), CUSTOMER, "id", _STRIPE_TIMES, StatusRule(otherwise="active"),
        name="name", email="email", titled=True,
        attributes={"description": "description", "livemode": "livemode"},
    ),
    ResourceMapping(
        (STRIPE, "charges"), TRANSACTION, "id", _STRIPE_TIMES,
        StatusRule("status", {"succeeded": "succeeded", "pending": "pending", "failed": "failed"}),
        Money("amount", "currency"), name="description",
        attributes={"customer": "customer", "description": "description"},
    ),
    ResourceMapping(
        (STRIPE, "invoices"), TRANSACTION, "id", _STRIPE_TIMES,
        StatusRule("status", {
            "paid": "paid", "open": "open", "void": "canceled", "uncollectible": "failed", "draft": "pending",
        }),
        Money("amount_due", "currency"),
        attributes={"customer": "customer", "amount_paid": "amount_paid"},
    ),
    ResourceMapping(
        (SALESFORCE, "accounts"), CUSTOMER, "Id", _SALESFORCE_TIMES, StatusRule(otherwise="active"),
        name="Name", titled=True, spellings=_SALESFORCE_SPELLINGS,
        attributes={"industry": "Industry", "website": "Website"},
    ),
    ResourceMapping(
        (SALESFORCE, "opportunities"), OPPORTUNITY, "Id", _SALESFORCE_TIMES,
        StatusRule("StageName", {
            "Prospecting": "open", "Qualification": "open", "Needs Analysis": "open",
            "Proposal/Price Quote": "open", "Negotiation/Review": "open",
            "Closed Won": "closed_won", "Closed Lost": "closed_lost",
        }),
        Money("Amount", in_major=True), name="Name", titled=True, spellings=_SALESFORCE_SPELLINGS,
        attributes={"close_date": "CloseDate", "stage_name": "StageName"},
    ),
)
MAPPINGS: dict[tuple[str, str], ResourceMapping] = {m.origin: m for m in _ALL}


def get_mapping(source: str, resource: str) -> ResourceMapping:
    found = MAPPINGS.get((source, resource))
    if found is None:
        raise ValueError(f"no mapping for {source}/{resource}, only for " + " ".join(sorted(map("/".join, MAPPINGS))))
    return found
