"""Raw records as JSON text, laid over the given tables: numbers, floats, booleans, nulls, nested values and
absent keys where other values belong, and records that are no objects.

`JSON_VIEWS` is read by Spark and by the checking engine alike; what each record must become is written out
by key in `EXPECTED_MAPPED` and `EXPECTED_CHECKED`, for the checking engine only.
"""

from __future__ import annotations

# A field: conditions on the key `k` and the JSON text that stands there, None for an absent key.
Cases = tuple[tuple[str, str | None], ...]


def _field(name: str, cases: Cases) -> str:
    branches = " ".join(
        f"WHEN {condition} THEN " + ("''" if text is None else f"',\"{name}\":' || {text}") for condition, text in cases
    )
    return f"CASE {branches} ELSE '' END"


def _record(fields: dict[str, Cases], others: Cases = ()) -> str:
    """The record's JSON text; braces are doubled, since table names are filled in later."""
    body = "'{{\"_\":0' || " + " || ".join(_field(n, c) for n, c in fields.items()) + " || '}}'"
    branches = " ".join(f"WHEN {condition} THEN {text}" for condition, text in others)
    return f"CASE {branches} ELSE {body} END" if others else body


K = "CAST(k AS STRING)"
_NO_OBJECTS: Cases = (("k % 41 = 0", "'[1,2]'"), ("k % 43 = 0", "'\"text\"'"), ("k % 47 = 0", "'null'"), ("k % 53 = 0", "'12'"))
_OBJECT = "NOT (k % 41 = 0 OR k % 43 = 0 OR k % 47 = 0 OR k % 53 = 0)"

JSON_VIEWS: dict[str, str] = {
    "json_customers": "SELECT k, " + _record({
        "id": (("k % 29 = 0", None), ("true", f"'\"cus_' || {K} || '\"'")),
        "name": (("k % 3 = 0", "'\"o''brien \"'"), ("k % 3 = 1", "'\" N/A \"'"), ("true", "'5.0'")),
        "email": (("k % 5 = 0", "'[\"X\"]'"), ("k % 5 = 1", None), ("true", "'\" A@B.C \"'")),
        "description": (("k % 4 = 0", "'true'"), ("k % 4 = 1", "'null'"), ("true", "'\"d\"'")),
        "created": (("k % 7 = 0", "'\"x\"'"), ("k % 7 = 1", "'null'"), ("true", "CAST(1600000000 + k AS STRING)")),
        "livemode": (("k % 6 = 0", "'true'"), ("k % 6 = 1", "'1'"), ("k % 6 = 2", "'\"yes\"'"), ("k % 6 = 3", None), ("k % 6 = 4", "'\"maybe\"'"), ("true", "'2'")),
    }, _NO_OBJECTS) + " AS text FROM (SELECT c_custkey AS k FROM {customer})",
    "json_charges": "SELECT k, " + _record({
        "id": (("k % 29 = 0", None), ("k % 31 = 0", "'null'"), ("k % 7 = 0", K), ("true", f"'\"ch_' || {K} || '\"'")),
        "amount": (
            ("k % 13 = 1", f"{K} || '.0'"), ("k % 13 = 2", f"{K} || '.5'"), ("k % 13 = 3", f"'\"' || {K} || '\"'"),
            ("k % 13 = 4", "'true'"), ("k % 13 = 5", "'null'"), ("k % 13 = 6", None), ("k % 13 = 7", "'{{\"value\":1}}'"),
            ("k % 13 = 8", "'-5'"), ("k % 13 = 9", "'\"12.0\"'"), ("k % 13 = 10", "'\" 12 \"'"), ("k % 13 = 11", "'\"abc\"'"), ("true", K),
        ),
        "currency": (("k % 17 = 0", None), ("k % 19 = 0", "'7'"), ("k % 5 = 0", "'\"usd\"'"), ("k % 5 = 1", "'\" EUR \"'"), ("k % 5 = 2", "'\"jpy\"'"), ("k % 5 = 3", "'null'"), ("true", "'\"Krw\"'")),
        "status": (("k % 4 = 0", "'\"succeeded\"'"), ("k % 4 = 1", "'\" PENDING \"'"), ("k % 4 = 2", "'\"disputed\"'")),
        "customer": (("k % 3 = 0", "'{{\"id\":\"c\"}}'"), ("k % 3 = 1", f"'\"cus_' || {K} || '\"'"), ("true", "'null'")),
        "description": (("true", f"'\"d ' || {K} || '\"'"),),
        "created": (("k % 23 = 0", "'true'"), ("k % 37 = 0", None), ("k % 2 = 0", "CAST(1600000000 + k AS STRING)"), ("true", "'\"2024-03-05\"'")),
        "livemode": (("k % 6 = 0", "'true'"), ("k % 6 = 1", "'1'"), ("k % 6 = 2", "'\"yes\"'"), ("k % 6 = 3", None), ("k % 6 = 4", "'\"maybe\"'"), ("true", "'0'")),
    }, _NO_OBJECTS) + " AS text FROM (SELECT o_orderkey AS k FROM {orders})",
    "json_invoices": "SELECT k, " + _record({
        "id": (("k % 29 = 0", None), ("k % 31 = 0", "'true'"), ("true", f"'\"in_' || {K} || '\"'")),
        "customer": (("true", "'\"sup\"'"),),
        "amount_due": (("k % 5 = 0", K), ("k % 5 = 1", f"{K} || '.0'"), ("k % 5 = 2", "'\"12.5\"'"), ("k % 5 = 3", "'null'")),
        "amount_paid": (("k % 2 = 0", "'0'"), ("true", "'\"7\"'")),
        "currency": (("k % 11 = 0", "'\"US\"'"), ("true", "'\"usd\"'")),
        "status": (("k % 6 = 0", "'\"paid\"'"), ("k % 6 = 1", "'\"void\"'"), ("k % 6 = 2", "'\"open\"'"), ("k % 6 = 3", "'\"draft\"'"), ("k % 6 = 4", "'\"uncollectible\"'"), ("true", "'null'")),
        "created": (("k % 37 = 0", "'{{\"t\":1}}'"), ("true", "'\"2024-01-01T10:00:00+05:30\"'")),
    }, _NO_OBJECTS) + " AS text FROM (SELECT l_orderkey * 8 + l_linenumber AS k FROM {lineitem})",
    "json_accounts": "SELECT k, " + _record({
        "Id": (("k % 2 = 0 AND k % 29 <> 0", f"'\"acc_' || {K} || '\"'"),),
        "id": (("k % 2 = 1 AND k % 29 <> 0", f"'\"acc_' || {K} || '\"'"),),
        "Name": (("k % 7 = 0", None), ("k % 11 = 0", "'5'"), ("true", f"'\"acme ' || {K} || '\"'")),
        "Industry": (("k % 3 = 0", "'\"n/a\"'"), ("k % 3 = 1", "'false'"), ("true", "'\"x\"'")),
        "CreatedDate": (("k % 13 = 0", "'\"2024-1-1\"'"), ("true", "'\"2024-01-05T00:00:00.000+0000\"'")),
        "LastModifiedDate": (("k % 4 = 0", "'null'"), ("true", "'\"2024-02-05\"'")),
    }, _NO_OBJECTS) + " AS text FROM (SELECT s_suppkey AS k FROM {supplier})",
    "json_opportunities": "SELECT k, " + _record({
        "Id": (("k % 29 = 0", "'\"  \"'"), ("true", f"'\"opp_' || {K} || '\"'")),
        "Name": (("true", f"'\"n ' || {K} || '\"'"),),
        "Amount": (("k % 8 = 0", "'12.345'"), ("k % 8 = 1", "'\"12.355\"'"), ("k % 8 = 2", "'-1'"), ("k % 8 = 3", "'null'"), ("k % 8 = 4", None), ("k % 8 = 5", "'\"abc\"'"), ("k % 8 = 6", "'1e3'"), ("true", "'{{\"v\":1}}'")),
        "StageName": (("k % 9 = 0", None), ("k % 9 = 1", "'\"closed won\"'"), ("k % 9 = 2", "'3'"), ("true", "'\"Closed Won\"'")),
        "CloseDate": (("true", "'\"2024-06-30\"'"),),
        "CreatedDate": (("k % 23 = 0", "'false'"), ("true", "CAST(1700000000000 + k * 1000 AS STRING)")),
    }, _NO_OBJECTS) + " AS text FROM (SELECT p_partkey AS k FROM {part})",
}
JSON_RESOURCES = {
    "json_customers": ("stripe", "customers"),
    "json_charges": ("stripe", "charges"),
    "json_invoices": ("stripe", "invoices"),
    "json_accounts": ("salesforce", "accounts"),
    "json_opportunities": ("salesforce", "opportunities"),
}
JSON_TABLES = ("customer", "orders", "lineitem", "supplier", "part")


def json_sql(name: str) -> str:
    return JSON_VIEWS[name].format(**{t: t for t in JSON_TABLES})


_KEY = "CAST(k AS VARCHAR)"

# Entity; then by column: source_id, created_at, updated_at, name, email, currency, amount_minor, status,
# and the attributes.
EXPECTED_MAPPED: dict[str, tuple[str, dict[str, str], dict[str, str]]] = {
    "json_customers": ("customer", {
        "source_id": f"CASE WHEN k % 29 <> 0 THEN 'cus_' || {_KEY} END",
        "created_at": "CASE WHEN k % 7 > 1 THEN make_timestamp((1600000000 + k) * 1000000) END",
        "name": "CASE k % 3 WHEN 0 THEN 'O''Brien' WHEN 2 THEN '5.0' END",
        "email": "CASE WHEN k % 5 = 0 THEN '[\"x\"]' WHEN k % 5 > 1 THEN 'a@b.c' END",
        "status": "'active'",
    }, {
        "description": "CASE WHEN k % 4 = 0 THEN 'true' WHEN k % 4 > 1 THEN 'd' END",
        "livemode": "CASE k % 6 WHEN 0 THEN 'true' WHEN 1 THEN '1' WHEN 2 THEN 'yes' WHEN 4 THEN 'maybe' WHEN 5 THEN '2' END",
    }),
    "json_charges": ("transaction", {
        "source_id": f"CASE WHEN k % 29 = 0 OR k % 31 = 0 THEN NULL WHEN k % 7 = 0 THEN {_KEY} ELSE 'ch_' || {_KEY} END",
        "created_at": "CASE WHEN k % 23 = 0 OR k % 37 = 0 THEN NULL WHEN k % 2 = 0 THEN make_timestamp((1600000000 + k) * 1000000) ELSE TIMESTAMP '2024-03-05' END",
        "name": f"'d ' || {_KEY}",
        "currency": "CASE WHEN k % 17 = 0 OR k % 19 = 0 THEN NULL ELSE CASE k % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'JPY' WHEN 4 THEN 'KRW' END END",
        "amount_minor": "CASE WHEN k % 13 IN (0, 1, 3, 12) THEN k WHEN k % 13 IN (9, 10) THEN 12 END",
        "status": "CASE k % 4 WHEN 0 THEN 'succeeded' WHEN 1 THEN 'pending' ELSE 'unknown' END",
    }, {
        "customer": f"CASE k % 3 WHEN 0 THEN '{{\"id\":\"c\"}}' WHEN 1 THEN 'cus_' || {_KEY} END",
        "description": f"'d ' || {_KEY}",
        "raw_status": "CASE k % 4 WHEN 0 THEN 'succeeded' WHEN 1 THEN 'PENDING' WHEN 2 THEN 'disputed' END",
    }),
    "json_invoices": ("transaction", {
        "source_id": f"CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN 'True' ELSE 'in_' || {_KEY} END",
        "created_at": "CASE WHEN k % 37 <> 0 THEN TIMESTAMP '2024-01-01 04:30:00' END",
        "currency": "CASE WHEN k % 11 <> 0 THEN 'USD' END",
        "amount_minor": "CASE WHEN k % 5 < 2 THEN k END",
        "status": "CASE k % 6 WHEN 0 THEN 'paid' WHEN 1 THEN 'canceled' WHEN 2 THEN 'open' WHEN 3 THEN 'pending' WHEN 4 THEN 'failed' ELSE 'unknown' END",
    }, {
        "customer": "'sup'", "amount_paid": "CASE k % 2 WHEN 0 THEN '0' ELSE '7' END",
        "raw_status": "CASE k % 6 WHEN 0 THEN 'paid' WHEN 1 THEN 'void' WHEN 2 THEN 'open' WHEN 3 THEN 'draft' WHEN 4 THEN 'uncollectible' END",
    }),
    "json_accounts": ("customer", {
        "source_id": f"CASE WHEN k % 29 <> 0 THEN 'acc_' || {_KEY} END",
        "created_at": "CASE WHEN k % 13 <> 0 THEN TIMESTAMP '2024-01-05' END",
        "updated_at": "CASE WHEN k % 4 <> 0 THEN TIMESTAMP '2024-02-05' END",
        "name": f"CASE WHEN k % 7 = 0 THEN NULL WHEN k % 11 = 0 THEN '5' ELSE 'Acme ' || {_KEY} END",
        "status": "'active'",
    }, {
        "industry": "CASE k % 3 WHEN 1 THEN 'false' WHEN 2 THEN 'x' END", "website": "CAST(NULL AS VARCHAR)",
    }),
    "json_opportunities": ("opportunity", {
        "source_id": f"CASE WHEN k % 29 <> 0 THEN 'opp_' || {_KEY} END",
        "created_at": "CASE WHEN k % 23 <> 0 THEN make_timestamp((1700000000 + k) * 1000000) END",
        "name": f"'N ' || {_KEY}",
        "amount_minor": "CASE k % 8 WHEN 0 THEN 1234 WHEN 1 THEN 1236 WHEN 6 THEN 100000 END",
        "status": "CASE WHEN k % 9 > 2 THEN 'closed_won' ELSE 'unknown' END",
    }, {
        "close_date": "'2024-06-30'",
        "stage_name": "CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN 'closed won' WHEN k % 9 = 2 THEN '3' ELSE 'Closed Won' END",
        "raw_status": "CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN 'closed won' WHEN k % 9 = 2 THEN '3' ELSE 'Closed Won' END",
    }),
}

_BOOL_ERROR = "CASE WHEN k % 6 = 4 THEN 'bool_parsing' END"

# By field in contract order: the error type of a record that is an object, or null.
EXPECTED_CHECKED: dict[str, dict[str, str]] = {
    "json_customers": {
        "id": "CASE WHEN k % 29 = 0 THEN 'missing' END", "email": "CASE WHEN k % 5 = 0 THEN 'string_type' END",
        "name": "CASE WHEN k % 3 = 2 THEN 'string_type' END", "description": "CASE WHEN k % 4 = 0 THEN 'string_type' END",
        "created": "CASE k % 7 WHEN 0 THEN 'datetime_parsing' WHEN 1 THEN 'datetime_type' END",
        "livemode": "CASE WHEN k % 6 > 3 THEN 'bool_parsing' END",
    },
    "json_charges": {
        "id": "CASE WHEN k % 29 = 0 THEN 'missing' WHEN k % 31 = 0 OR k % 7 = 0 THEN 'string_type' END",
        "amount": "CASE k % 13 WHEN 2 THEN 'int_from_float' WHEN 5 THEN 'int_type' WHEN 6 THEN 'missing' WHEN 7 THEN 'int_type' WHEN 8 THEN 'greater_than_equal' WHEN 11 THEN 'int_parsing' END",
        "currency": "CASE WHEN k % 17 = 0 THEN 'missing' WHEN k % 19 = 0 OR k % 5 = 3 THEN 'string_type' END",
        "status": "CASE WHEN k % 4 = 3 THEN 'missing' END",
        "customer": "CASE WHEN k % 3 = 0 THEN 'string_type' END", "description": "NULL",
        "created": "CASE WHEN k % 23 = 0 THEN 'datetime_type' WHEN k % 37 = 0 THEN 'missing' END",
        "livemode": _BOOL_ERROR,
    },
    "json_invoices": {
        "id": "CASE WHEN k % 29 = 0 THEN 'missing' WHEN k % 31 = 0 THEN 'string_type' END", "customer": "NULL",
        "amount_due": "CASE k % 5 WHEN 2 THEN 'int_parsing' WHEN 3 THEN 'int_type' WHEN 4 THEN 'missing' END",
        "amount_paid": "NULL", "currency": "NULL", "status": "NULL",
        "created": "CASE WHEN k % 37 = 0 THEN 'datetime_type' END",
    },
    "json_accounts": {
        "id": "CASE WHEN k % 29 = 0 THEN 'missing' END",
        "created_date": "CASE WHEN k % 13 = 0 THEN 'datetime_parsing' END", "last_modified_date": "NULL",
        "name": "CASE WHEN k % 7 = 0 THEN 'missing' WHEN k % 11 = 0 THEN 'string_type' END",
        "industry": "CASE WHEN k % 3 = 1 THEN 'string_type' END", "website": "NULL",
    },
    "json_opportunities": {
        "id": "NULL", "created_date": "CASE WHEN k % 23 = 0 THEN 'datetime_type' END", "last_modified_date": "NULL",
        "name": "NULL",
        "amount": "CASE k % 8 WHEN 5 THEN 'float_parsing' WHEN 7 THEN 'float_type' END",
        "stage_name": "CASE WHEN k % 9 = 0 THEN 'missing' WHEN k % 9 = 2 THEN 'string_type' END", "close_date": "NULL",
    },
}
#: Coerced values of valid records, by column, as text.
EXPECTED_VALUES: dict[str, dict[str, str]] = {
    "json_customers": {"livemode": "CASE WHEN k % 6 = 3 THEN 'false' ELSE 'true' END", "email": "CASE WHEN k % 5 > 1 THEN 'A@B.C' END"},
    "json_charges": {
        "amount": "CASE k % 13 WHEN 4 THEN '1' WHEN 9 THEN '12' WHEN 10 THEN '12' ELSE CAST(k AS VARCHAR) END",
        "currency": "CASE k % 5 WHEN 0 THEN 'usd' WHEN 1 THEN 'eur' WHEN 2 THEN 'jpy' ELSE 'krw' END",
        "livemode": "CASE WHEN k % 6 < 3 THEN 'true' ELSE 'false' END",
    },
    "json_invoices": {"amount_due": "CAST(k AS VARCHAR)", "amount_paid": "CASE k % 2 WHEN 0 THEN '0' ELSE '7' END"},
    "json_accounts": {"name": "'acme ' || CAST(k AS VARCHAR)"},
    "json_opportunities": {"id": "CASE WHEN k % 29 = 0 THEN '' ELSE 'opp_' || CAST(k AS VARCHAR) END", "amount": "CASE k % 8 WHEN 0 THEN '12.345' WHEN 1 THEN '12.355' WHEN 2 THEN '-1.0' WHEN 6 THEN '1000.0' END"},
}


def mapped_sql(view: str, major, attributes: tuple[str, ...], ingested: str) -> str:
    """CTE `<view>_all`: every record with what it must become, and the reason if it is refused."""
    entity, columns, bag = EXPECTED_MAPPED[view]
    source, resource = JSON_RESOURCES[view]
    null = {"updated_at": "CAST(NULL AS TIMESTAMP)", "amount_minor": "CAST(NULL AS BIGINT)"}
    values = ", ".join(f"{columns.get(c, null.get(c, 'CAST(NULL AS VARCHAR)'))} AS {c}" for c in ("source_id", "created_at", "updated_at", "name", "email", "currency", "amount_minor", "status"))
    bags = "".join(f", {bag.get(a, 'CAST(NULL AS VARCHAR)')} AS attr_{a}" for a in attributes)
    money = "WHEN currency IS NULL THEN 'Input should be a valid string' WHEN amount_minor IS NULL THEN 'Input should be a valid integer'" if entity == "transaction" else "WHEN false THEN ''"
    id_field, created_field = ("id", "created") if source == "stripe" else ("Id", "CreatedDate")
    return f"""{view} AS ({json_sql(view)}), {view}_values AS (SELECT k, {_OBJECT} AS is_object, {values}{bags} FROM {view}),
{view}_all AS (SELECT * EXCLUDE (k, is_object), '{source}:{entity}:' || source_id AS unified_id, '{source}' AS source, '{resource}' AS source_resource,
  '{entity}' AS entity_type, {major('amount_minor', "coalesce(currency, '')")} AS amount, {ingested} AS ingested_at,
  CASE WHEN NOT is_object THEN 'record is not a JSON object' WHEN source_id IS NULL THEN 'missing id field ''{id_field}'''
       WHEN created_at IS NULL THEN 'missing or unparseable ''{created_field}''' END AS mapping_reason,
  CASE {money} END AS validation_reason FROM {view}_values)"""


def checked_sql(view: str) -> str:
    """Every record with its errors in contract order, and the coerced values of a valid one."""
    errors = EXPECTED_CHECKED[view]
    is_object = f"({_OBJECT})"
    fields = "concat_ws(',', " + ", ".join(f"CASE WHEN ({e}) IS NOT NULL THEN '{f}' END" for f, e in errors.items()) + ")"
    types = "concat_ws(',', " + ", ".join(errors.values()) + ")"
    values = "".join(f", CASE WHEN types = '' THEN {v} END AS {c}" for c, v in EXPECTED_VALUES[view].items())
    return f"""WITH {view} AS ({json_sql(view)}), e AS (SELECT k, CASE WHEN {is_object} THEN {fields} ELSE '' END AS fields,
  CASE WHEN {is_object} THEN {types} ELSE 'dict_type' END AS types FROM {view})
SELECT k, types = '' AS is_valid, fields, types{values} FROM e"""
