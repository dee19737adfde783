"""The same results in SQL for another engine, over the same tables registered by name.

What the rules say is written out here again rather than taken from the code it checks.
"""

from __future__ import annotations

from tributary.queries.inputs import RAW_VIEWS, RESOURCES, view_sql
from tributary.queries.json_inputs import JSON_RESOURCES, JSON_VIEWS, checked_sql, mapped_sql
from tributary.queries.registry import ATTRIBUTES, BATCH_FROM, STRIPE_CUTOFF, TARGET_UNTIL

_SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
# The same as in the rules, on purpose by hand.
_TOKENS = "'', 'null', 'none', 'nan', 'n/a', 'na', '-', '--'"
_ZERO_DECIMAL = (
    "'BIF', 'CLP', 'DJF', 'GNF', 'JPY', 'KMF', 'KRW', 'MGA', 'PYG', 'RWF', 'UGX', 'VND', 'VUV', 'XAF', 'XOF', 'XPF'"
)
# Entity, id field, creation field, status words, status without a word.
_RULES = {
    "raw_customers": ("customer", "id", "created", {}, "active"),
    "raw_charges": (
        "transaction", "id", "created", {"succeeded": "succeeded", "pending": "pending", "failed": "failed"}, "unknown",
    ),
    "raw_invoices": (
        "transaction", "id", "created",
        {"paid": "paid", "open": "open", "void": "canceled", "uncollectible": "failed", "draft": "pending"}, "unknown",
    ),
    "raw_accounts": ("customer", "Id", "CreatedDate", {}, "active"),
    "raw_opportunities": (
        "opportunity", "Id", "CreatedDate",
        {"Prospecting": "open", "Qualification": "open", "Needs Analysis": "open", "Proposal/Price Quote": "open",
         "Negotiation/Review": "open", "Closed Won": "closed_won", "Closed Lost": "closed_lost"}, "unknown",
    ),
}
_INGESTED = "TIMESTAMP '2024-07-01 00:00:00'"


# --- expressions ------------------------------------------------------------------------------


def collapsed(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_SPACES}', ' ', 'g'))"


def clean(x: str) -> str:
    return f"CASE WHEN lower({collapsed(x)}) NOT IN ({_TOKENS}) THEN {collapsed(x)} END"


def missing(x: str) -> str:
    return f"({x} IS NULL OR lower(trim({x})) IN ({_TOKENS}))"


def title(x: str) -> str:
    return (
        f"list_reduce(list_transform(regexp_extract_all({x}, '[A-Za-z]+|[^A-Za-z]+'), "
        "lambda w: upper(w[1]) || lower(w[2:])), lambda a, b: a || b)"
    )


def currency(x: str) -> str:
    return f"CASE WHEN regexp_full_match(upper(trim({x})), '[A-Z]{{3}}') THEN upper(trim({x})) END"


def instant(x: str) -> str:
    t = f"trim({x})"
    offset = f"regexp_extract({t}, 'T.*([+-]\\d\\d):?(\\d\\d)$', 1)"
    minutes = f"regexp_extract({t}, 'T.*([+-]\\d\\d):?(\\d\\d)$', 2)"
    local = f"TRY_CAST(replace(substr({t}, 1, 19), 'T', ' ') AS TIMESTAMP)"
    return f"""CASE WHEN regexp_full_match({t}, '\\d{{10}}') THEN make_timestamp(CAST({t} AS BIGINT) * 1000000)
  WHEN regexp_full_match({t}, '\\d{{13}}') THEN make_timestamp(CAST({t} AS BIGINT) * 1000)
  WHEN regexp_full_match({t}, '\\d{{4}}-\\d\\d-\\d\\d([T ]\\d\\d:\\d\\d:\\d\\d(\\.\\d+)?)?') THEN {local}
  WHEN regexp_full_match({t}, '\\d{{4}}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d(\\.\\d+)?[+-]\\d\\d:?\\d\\d')
  THEN {local} - to_minutes(CAST({offset} AS BIGINT) * 60 + CAST({minutes} AS BIGINT)) END"""


def coerce_minor(x: str) -> str:
    t = f"trim({x})"
    return f"""CASE WHEN regexp_full_match({t}, '[+-]?\\d+') AND TRY_CAST({t} AS BIGINT) >= 0 THEN TRY_CAST({t} AS BIGINT)
  WHEN regexp_full_match({t}, '[+-]?\\d+\\.\\d*') AND TRY_CAST({t} AS DOUBLE) >= 0
  AND TRY_CAST({t} AS DOUBLE) = floor(TRY_CAST({t} AS DOUBLE)) THEN CAST(TRY_CAST({t} AS DOUBLE) AS BIGINT) END"""


def major(minor: str, code: str) -> str:
    return (
        f"CASE WHEN {minor} >= 0 THEN CASE WHEN {code} IN ({_ZERO_DECIMAL}) THEN CAST({minor} AS DECIMAL(18,2)) "
        f"ELSE CAST(CAST({minor} AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(18,2)) END END"
    )


def minor(amount: str, digits: int) -> str:
    value = f"TRY_CAST(CASE WHEN regexp_full_match({amount}, '[0-9.]+') THEN {amount} END AS DECIMAL(30,5))"
    return f"CAST(round_even({value} * {10 ** digits}, 0) AS BIGINT)"


def status(x: str, view: str) -> str:
    _, _, _, words, otherwise = _RULES[view]
    return status_of(x, words, otherwise)


def status_of(x: str, status_map, default: str) -> str:
    exact = " ".join(f"WHEN {x} = '{k}' THEN '{v}'" for k, v in status_map.items())
    lower = " ".join(f"WHEN lower({x}) = '{k}' THEN '{v}'" for k, v in status_map.items())
    return f"CASE WHEN {x} IS NULL THEN '{default}' {exact} {lower} ELSE 'unknown' END"


# --- unified rows of each resource ------------------------------------------------------------

# Per view: id, created, updated, name, email, currency, minor amount, raw status, attributes.
_FIELDS = {
    "raw_customers": dict(
        id="id", created="created", name=title(f"({clean('name')})"), email=f"lower({clean('email')})",
        attrs={"description": clean("description"), "livemode": "CAST(livemode AS VARCHAR)"},
    ),
    "raw_charges": dict(
        id="id", created="created", name=clean("description"), currency=currency("currency"),
        minor=coerce_minor("amount"), status="status",
        attrs={"customer": clean("customer"), "description": clean("description")},
    ),
    "raw_invoices": dict(
        id="id", created="created", currency=currency("currency"),
        minor="CASE WHEN amount_due >= 0 THEN amount_due END", status="status",
        attrs={"customer": clean("customer"), "amount_paid": "CAST(amount_paid AS VARCHAR)"},
    ),
    "raw_accounts": dict(
        id='"Id"', created='"CreatedDate"', updated='"LastModifiedDate"', name=title(f"({clean(chr(34) + 'Name' + chr(34))})"),
        attrs={"industry": clean('"Industry"'), "website": clean('"Website"')},
    ),
    "raw_opportunities": dict(
        id='"Id"', created='"CreatedDate"', updated='"LastModifiedDate"', name=title(f"({clean(chr(34) + 'Name' + chr(34))})"),
        minor=minor('"Amount"', 2), status='"StageName"',
        attrs={"close_date": clean('"CloseDate"'), "stage_name": clean('"StageName"')},
    ),
}
_ORDER = {"raw_invoices": ", l_shipdate DESC, l_partkey DESC", "raw_opportunities": ", part_no DESC"}
UNIFIED = (
    "unified_id, source, source_resource, source_id, entity_type, name, email, currency, amount_minor, "
    "amount, status, created_at, updated_at, ingested_at"
)


def attributes_of(view: str) -> tuple[str, ...]:
    return (*_FIELDS[view]["attrs"], *(("raw_status",) if "status" in _FIELDS[view] else ()))


def attribute_columns(names) -> str:
    return "".join(f", attr_{name}" for name in names)


def mapped_ctes(view: str, prefix: str = "") -> str:
    """CTEs `<view>`, `<prefix>mapped_<view>` (with reject columns) and `<prefix>good_<view>`."""
    f = _FIELDS[view]
    source, resource = RESOURCES[view]
    entity, id_field, created_field, _, _ = _RULES[view]
    raw_status = clean(f["status"]) if "status" in f else "CAST(NULL AS VARCHAR)"
    attrs = {**f["attrs"], **({"raw_status": raw_status} if "status" in f else {})}
    attr_sql = "".join(f",\n  {attrs.get(a, 'CAST(NULL AS VARCHAR)')} AS attr_{a}" for a in ATTRIBUTES)
    code = f.get("currency", "CAST(NULL AS VARCHAR)")
    minor_sql = f.get("minor", "CAST(NULL AS BIGINT)")
    money = entity == "transaction"
    return f"""{view} AS ({view_sql(view)}),
{prefix}values_{view} AS (SELECT *, {clean(f['id'])} AS source_id, {instant(f['created'])} AS created_at,
  {instant(f['updated']) if 'updated' in f else 'CAST(NULL AS TIMESTAMP)'} AS updated_at,
  {f.get('name', 'CAST(NULL AS VARCHAR)')} AS name_, {f.get('email', 'CAST(NULL AS VARCHAR)')} AS email_,
  {code} AS currency_, {minor_sql} AS amount_minor, {raw_status} AS raw_status_{attr_sql} FROM {view}),
{prefix}mapped_{view} AS (SELECT * EXCLUDE (source_id, created_at, updated_at, amount_minor, raw_status_, name_, email_, currency_)
  REPLACE (attr_description AS attr_description),
  '{source}:{entity}:' || source_id AS unified_id, '{source}' AS source, '{resource}' AS source_resource,
  source_id, '{entity}' AS entity_type, name_ AS u_name, email_ AS u_email, currency_ AS u_currency,
  amount_minor, {major('amount_minor', "coalesce(currency_, '')")} AS u_amount,
  {status('raw_status_', view)} AS u_status, created_at, updated_at, {_INGESTED} AS ingested_at,
  CASE WHEN source_id IS NULL THEN 'missing id field ''{id_field}'''
       WHEN created_at IS NULL THEN 'missing or unparseable ''{created_field}''' END AS mapping_reason,
  {"CASE WHEN currency_ IS NULL THEN 'Input should be a valid string' WHEN amount_minor IS NULL THEN 'Input should be a valid integer' END" if money else "CAST(NULL AS VARCHAR)"} AS validation_reason,
  {"concat_ws(',', CASE WHEN currency_ IS NULL THEN 'currency' END, CASE WHEN amount_minor IS NULL THEN 'amount_minor' END)" if money else "''"} AS bad_fields,
  {"concat_ws(',', CASE WHEN currency_ IS NULL THEN 'string_type' END, CASE WHEN amount_minor IS NULL THEN 'int_type' END)" if money else "''"} AS bad_types
  FROM {prefix}values_{view}),
{prefix}good_{view} AS (SELECT unified_id, source, source_resource, source_id, entity_type, u_name AS name, u_email AS email,
  u_currency AS currency, amount_minor, u_amount AS amount, u_status AS status, created_at, updated_at, ingested_at
  {attribute_columns(ATTRIBUTES)}{', l_shipdate, l_partkey' if view == 'raw_invoices' else ''}{', part_no' if view == 'raw_opportunities' else ''}{', ordered_on' if view == 'raw_charges' else ''}
  FROM {prefix}mapped_{view} WHERE mapping_reason IS NULL AND validation_reason IS NULL),
{prefix}unified_{view} AS (SELECT {UNIFIED}{attribute_columns(ATTRIBUTES)} FROM {prefix}good_{view}
  QUALIFY row_number() OVER (PARTITION BY unified_id ORDER BY updated_at DESC NULLS LAST{_ORDER.get(view, '')}) = 1)"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(f"{v} AS ({view_sql(v)})" for v in views) + "\n"


def with_mapped(*views: str) -> str:
    return "WITH " + ",\n".join(mapped_ctes(v) for v in views) + "\n"


ALL = tuple(RAW_VIEWS)


def union_unified() -> str:
    return "\nUNION ALL ".join(f"SELECT * FROM unified_{v}" for v in ALL)


def map_sql(view: str, deduplicated: bool) -> str:
    table = "unified" if deduplicated else "good"
    return with_mapped(view) + f"SELECT {UNIFIED}{attribute_columns(attributes_of(view))} FROM {table}_{view}"


def all_sql() -> str:
    return with_mapped(*ALL) + f"SELECT {UNIFIED}{attribute_columns(ATTRIBUTES)} FROM ({union_unified()})"


# --- contracts --------------------------------------------------------------------------------

_INT = r"[+-]?\d+(_\d+)*(\.0+)?"
_CHARGE_INT = f"""CASE WHEN regexp_full_match(trim(amount), '{_INT}') THEN CAST(CAST(trim(amount) AS DOUBLE) AS BIGINT) END"""
_CHARGE_AMOUNT_ERROR = f"""CASE WHEN amount IS NULL THEN 'int_type' WHEN {_CHARGE_INT} IS NULL THEN 'int_parsing'
  WHEN {_CHARGE_INT} < 0 THEN 'greater_than_equal' END"""
_MESSAGE = """CASE {0} WHEN 'int_type' THEN 'Input should be a valid integer'
  WHEN 'int_parsing' THEN 'Input should be a valid integer, unable to parse string as an integer'
  WHEN 'greater_than_equal' THEN 'Input should be greater than or equal to 0'
  WHEN 'string_type' THEN 'Input should be a valid string'
  WHEN 'datetime_parsing' THEN 'Input should be a valid datetime or date' END"""
_CHECKED_CHARGES = f""", checked AS (SELECT *, {_CHARGE_INT} AS amount_int, {_CHARGE_AMOUNT_ERROR} AS amount_error,
  CASE WHEN status IS NULL THEN 'string_type' END AS status_error FROM raw_charges)
"""
_VALID_CHARGES = f"""SELECT id, amount_int AS amount, lower(trim(currency)) AS currency, trim(status) AS status,
  customer, description, {instant('created')} AS created, false AS livemode
FROM checked WHERE amount_error IS NULL AND status_error IS NULL"""
_VALID_ACCOUNTS = f"""SELECT "Id" AS id, {instant('"CreatedDate"')} AS created_date, {instant('"LastModifiedDate"')} AS last_modified_date,
  trim("Name") AS name, trim("Industry") AS industry, trim("Website") AS website FROM raw_accounts"""

_MERGE = f"""{with_mapped('raw_charges')}, target AS (SELECT * FROM good_raw_charges WHERE ordered_on < DATE '{TARGET_UNTIL}'),
incoming AS (SELECT * REPLACE ('succeeded' AS status) FROM good_raw_charges WHERE ordered_on >= DATE '{BATCH_FROM}'),
merged AS (SELECT * FROM incoming UNION ALL SELECT * FROM target WHERE unified_id NOT IN (SELECT unified_id FROM incoming))
"""
_CHARGE_ATTRS = attribute_columns(attributes_of("raw_charges"))
_UNCHECKED = f"""{with_views('raw_customers')}, given AS (SELECT 'stripe:customer:' || trim(id) AS unified_id, trim(id) AS source_id,
  name, email, {instant('created')} AS created_at FROM raw_customers)
"""
_GAP_ORDER = ("source_id", "created_at")
_GAPS = {
    "source_id": "CASE WHEN source_id = '' THEN 'source_id' END",
    "created_at": "CASE WHEN created_at IS NULL THEN 'created_at' END",
}


def _reject_counts(reason: str, condition: str) -> str:
    rows = "\nUNION ALL ".join(
        f"SELECT source, source_resource, {reason} AS reject_reason FROM mapped_{v} WHERE {condition}" for v in ALL
    )
    return with_mapped(*ALL) + (
        f"SELECT source, source_resource, reject_reason, count(*) AS n FROM ({rows}) GROUP BY ALL"
    )


ORACLES: dict[str, str] = {
    "null_tokens": with_views("raw_customers") + "SELECT id, name, email, created, "
    + ", ".join(f"{missing(c)} AS {c}_missing" for c in ("id", "name", "email", "created")) + " FROM raw_customers",
    "clean_string": with_views("raw_customers") + "SELECT email, "
    + ", ".join(f"{clean(c)} AS {c}_clean" for c in ("id", "name", "description")) + " FROM raw_customers",
    "clean_string_documents": f"SELECT doc_id, {clean('text')} AS text_clean FROM documents",
    "title_case": with_views("raw_customers")
    + f"SELECT id, email, {clean('name')} AS name, {title('(' + clean('name') + ')')} AS titled FROM raw_customers",
    "email_normalize": with_views("raw_customers")
    + f"SELECT id, name, email, lower({clean('email')}) AS email_clean FROM raw_customers",
    "currency_standardize": with_views("raw_charges")
    + f"SELECT id, currency, {currency('currency')} AS code, coalesce({currency('currency')}, 'USD') AS code_or_default FROM raw_charges",
    "currency_exponent": with_views("raw_charges")
    + f"SELECT id, currency, CASE WHEN {currency('currency')} IN ({_ZERO_DECIMAL}) THEN 0 ELSE 2 END AS exponent FROM raw_charges",
    "coerce_minor_amount": with_views("raw_charges") + f"SELECT id, amount, {coerce_minor('amount')} AS amount_minor FROM raw_charges",
    "minor_to_major": with_views("raw_charges")
    + f""", v AS (SELECT id, {currency('currency')} AS code, {coerce_minor('amount')} AS amount_minor FROM raw_charges)
SELECT *, {major('amount_minor', "coalesce(code, '')")} AS amount FROM v""",
    "major_to_minor": with_views("raw_opportunities")
    + f"""SELECT "Id", part_no, "Amount", {minor('"Amount"', 2)} AS minor_usd, {minor('"Amount"', 0)} AS minor_krw FROM raw_opportunities""",
    "standardize_datetime": with_views("raw_customers")
    + f"SELECT id, email, created, {instant('created')} AS created_at FROM raw_customers",
    "epoch_to_timestamp": with_views("raw_customers") + """SELECT id, email, created,
  CASE WHEN regexp_full_match(created, '\\d+') THEN CASE WHEN CAST(created AS BIGINT) > 100000000000
    THEN make_timestamp(CAST(created AS BIGINT) * 1000) ELSE make_timestamp(CAST(created AS BIGINT) * 1000000) END END AS created_at
FROM raw_customers""",
    "resolve_status_charges": with_views("raw_charges")
    + f"SELECT id, status, {status('(' + clean('status') + ')', 'raw_charges')} AS resolved FROM raw_charges",
    "resolve_status_opportunities": with_views("raw_opportunities")
    + f"""SELECT "Id", part_no, "StageName", {status('(' + clean('"StageName"') + ')', 'raw_opportunities')} AS resolved FROM raw_opportunities""",
    "default_status": with_mapped("raw_accounts", "raw_customers")
    + """SELECT unified_id, 'active' AS status FROM unified_raw_accounts
UNION ALL SELECT unified_id, 'active' FROM unified_raw_customers""",
    "surrogate_key": with_views("raw_customers")
    + f"SELECT id, email, 'stripe:customer:' || {clean('id')} AS unified_id FROM raw_customers",
    "attributes_bag": with_mapped(*ALL)
    + "\nUNION ALL ".join(f"SELECT unified_id, created_at{attribute_columns(ATTRIBUTES)} FROM mapped_{v}" for v in ALL),
    "attributes_decode": """SELECT event_id AS key, props ->> '$.k' AS k, CAST(NULL AS VARCHAR) AS raw_text FROM events
UNION ALL SELECT -doc_id - 1 AS key, NULL AS k, CASE WHEN NOT json_valid(text) THEN text END AS raw_text FROM documents""",
    "nested_pick": """SELECT event_id, props ->> '$.k' AS k, CAST(NULL AS VARCHAR) AS below_scalar, CAST(NULL AS VARCHAR) AS absent,
  CAST(event_id AS VARCHAR) AS top FROM events""",
    "envelope_wrap": with_views("raw_charges") + _CHECKED_CHARGES + f"""SELECT 'stripe' AS source, 'charges' AS resource, id AS external_id,
  '2024-07-01T00:00:00Z' AS extracted_at, id AS data_id, CAST(amount_int AS VARCHAR) AS data_amount,
  lower(trim(currency)) AS data_currency, strftime({instant('created')}, '%Y-%m-%dT%H:%M:%SZ') AS data_created, 'false' AS data_livemode
FROM checked WHERE amount_error IS NULL AND status_error IS NULL""",
    "envelope_unwrap": with_views("raw_charges") + """SELECT id AS key,
  CASE WHEN currency IN ('jpy', 'Krw') THEN 'outer' ELSE id END AS id,
  CASE WHEN currency NOT IN ('jpy', 'Krw') THEN amount END AS amount,
  CASE WHEN currency NOT IN ('jpy', 'Krw') THEN status END AS status FROM raw_charges""",
    "alias_resolve": with_views("raw_accounts") + f", one AS ({_VALID_ACCOUNTS}) SELECT * FROM one UNION ALL SELECT * FROM one",
    "contract_projection": with_views("raw_charges") + _CHECKED_CHARGES + _VALID_CHARGES,
    "validate_customers": with_views("raw_customers") + f"""SELECT trim(id) AS id, trim(email) AS email, trim(name) AS name,
  description, {instant('created')} AS created, livemode FROM raw_customers WHERE {instant('created')} IS NOT NULL""",
    "validate_charges": with_views("raw_charges") + _CHECKED_CHARGES + _VALID_CHARGES,
    "validate_invoices": with_views("raw_invoices")
    + f"SELECT id, customer, amount_due, amount_paid, currency, status, {instant('created')} AS created FROM raw_invoices",
    "validate_accounts": with_views("raw_accounts") + _VALID_ACCOUNTS,
    "validate_opportunities": with_views("raw_opportunities") + f"""SELECT "Id" AS id, {instant('"CreatedDate"')} AS created_date,
  {instant('"LastModifiedDate"')} AS last_modified_date, "Name" AS name,
  CASE WHEN "Amount" = 'Infinity' THEN 'Infinity' ELSE CAST(CAST("Amount" AS DOUBLE) AS VARCHAR) END AS amount,
  "StageName" AS stage_name, "CloseDate" AS close_date FROM raw_opportunities""",
    "quarantine_charges": with_views("raw_charges") + _CHECKED_CHARGES + """SELECT id,
  CAST((amount_error IS NOT NULL)::INTEGER + (status_error IS NOT NULL)::INTEGER AS INTEGER) AS n_errors,
  concat_ws(',', CASE WHEN amount_error IS NOT NULL THEN 'amount' END, CASE WHEN status_error IS NOT NULL THEN 'status' END) AS fields,
  concat_ws(',', amount_error, status_error) AS types
FROM checked WHERE amount_error IS NOT NULL OR status_error IS NOT NULL""",
    "first_error": with_views("raw_charges", "raw_customers") + _CHECKED_CHARGES + f""", bad AS (
  SELECT 'charges' AS resource, coalesce(amount_error, status_error) AS type FROM checked
  WHERE amount_error IS NOT NULL OR status_error IS NOT NULL
  UNION ALL SELECT 'customers', 'datetime_parsing' FROM raw_customers WHERE {instant('created')} IS NULL)
SELECT resource, {_MESSAGE.format('type')} AS message, count(*) AS n FROM bad GROUP BY ALL""",
    "map_customers": map_sql("raw_customers", False),
    "map_charges": map_sql("raw_charges", False),
    "map_invoices": map_sql("raw_invoices", False),
    "map_accounts": map_sql("raw_accounts", False),
    "map_opportunities": map_sql("raw_opportunities", False),
    "custom_mapping": f"""WITH v AS (SELECT *, CAST(round_even(CAST(CAST(value AS VARCHAR) AS DECIMAL(30,5)) * 100, 0) AS BIGINT) AS minor FROM events)
SELECT 'stripe:opportunity:' || event_id AS unified_id, 'stripe' AS source, 'events' AS source_resource,
  CAST(event_id AS VARCHAR) AS source_id, 'opportunity' AS entity_type, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS email,
  'USD' AS currency, CASE WHEN minor >= 0 THEN minor END AS amount_minor, {major('minor', "'USD'")} AS amount,
  {status_of('event_type', {"purchase": "succeeded", "error": "failed", "view": "open", "signup": "active"}, 'unknown')} AS status,
  ts AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at, {_INGESTED} AS ingested_at,
  props ->> '$.k' AS attr_k, CAST(user_id AS VARCHAR) AS attr_user, event_type AS attr_raw_status FROM v""",
    "mapping_rejects": _reject_counts("mapping_reason", "mapping_reason IS NOT NULL"),
    "validation_rejects": with_mapped(*ALL) + "\nUNION ALL ".join(
        f"""SELECT source_resource, source_id AS id, validation_reason AS reject_reason, bad_fields AS fields,
  bad_types AS types FROM mapped_{v} WHERE mapping_reason IS NULL AND validation_reason IS NOT NULL"""
        for v in ALL
    ),
    "warehouse_required_rejects": _UNCHECKED + f"""SELECT unified_id, source_id, name, email,
  'record missing required columns: ' || concat_ws(',', {', '.join(_GAPS[c] for c in _GAP_ORDER)}) AS reason
FROM given WHERE source_id = '' OR created_at IS NULL""",
    "coerce_records": with_views("raw_charges") + f""", v AS (SELECT *, CASE WHEN regexp_full_match(amount, '-?\\d+') THEN CAST(amount AS BIGINT) END AS minor,
  CASE WHEN regexp_full_match(amount, '-?\\d+(\\.\\d+)?') THEN CAST(amount AS DECIMAL(18,2)) END AS major FROM raw_charges),
u AS (SELECT *, concat_ws(',', CASE WHEN amount IS NOT NULL AND minor IS NULL THEN 'amount_minor' END,
  CASE WHEN amount IS NOT NULL AND major IS NULL THEN 'amount' END) AS unread FROM v)
SELECT 'stripe:transaction:' || id AS unified_id, currency, coalesce(status, 'unknown') AS status, minor AS amount_minor,
  major AS amount, unread = '' AS is_loadable, CASE WHEN unread <> '' THEN 'not a number: ' || unread END AS reason,
  {instant('created')} AS created_at, {_INGESTED} AS ingested_at, customer AS attr_customer FROM u""",
    "clean_frame": f"""SELECT doc_id, {clean('text')} AS text, {currency('lang')} AS lang,
  {clean('source')} AS source, n_chars FROM documents""",
    "clean_frame_charges": with_views("raw_charges") + f"""SELECT {clean('id')} AS id,
  CASE WHEN regexp_full_match(amount, '-?\\d+') THEN CAST(amount AS BIGINT) END AS amount, {currency('currency')} AS currency,
  {clean('status')} AS status, {instant('created')} AS created FROM raw_charges""",
    "dedupe_newest": with_views("raw_invoices") + """SELECT id, customer, amount_due, amount_paid, status, l_shipdate, l_partkey FROM raw_invoices
QUALIFY row_number() OVER (PARTITION BY id ORDER BY l_shipdate DESC, l_partkey DESC) = 1""",
    "dedupe_keep_last": with_views("raw_opportunities") + """SELECT "Id", "Name", "Amount", "StageName", part_no FROM raw_opportunities
QUALIFY row_number() OVER (PARTITION BY "Id" ORDER BY part_no DESC) = 1""",
    "dedupe_unified": map_sql("raw_opportunities", True),
    "duplicates_removed": with_mapped("raw_invoices") + """SELECT source, source_resource, CAST(count(*) AS BIGINT) AS input_rows,
  count(DISTINCT unified_id) AS output_rows, count(*) - count(DISTINCT unified_id) AS duplicates_removed
FROM good_raw_invoices GROUP BY ALL""",
    "stable_order": with_mapped("raw_opportunities") + f"SELECT {UNIFIED} FROM unified_raw_opportunities ORDER BY unified_id",
    "transform_customers": map_sql("raw_customers", True),
    "transform_charges": map_sql("raw_charges", True),
    "transform_invoices": map_sql("raw_invoices", True),
    "transform_accounts": map_sql("raw_accounts", True),
    "transform_opportunities": map_sql("raw_opportunities", True),
    "transform_all": all_sql(),
    "union_parts": map_sql("raw_opportunities", True),
    "transform_summary": with_mapped(*ALL) + "\nUNION ALL ".join(
        f"""SELECT '{s}' AS source, '{r}' AS source_resource, (SELECT count(*) FROM mapped_{v}) AS input,
  (SELECT count(*) FROM good_{v}) AS mapped, (SELECT count(*) FROM mapped_{v}) - (SELECT count(*) FROM good_{v}) AS rejected,
  (SELECT count(*) FROM good_{v}) - (SELECT count(*) FROM unified_{v}) AS duplicates_removed,
  (SELECT count(*) FROM unified_{v}) AS output"""
        for v, (s, r) in RESOURCES.items()
    ),
    "extraction_summary": "SELECT source, resource, count(*) AS fetched, count(*) FILTER (is_valid) AS valid, "
    "count(*) FILTER (NOT is_valid) AS errors, CAST(0 AS BIGINT) AS failed FROM ("
    + "\nUNION ALL ".join(
        f"SELECT '{s}' AS source, '{r}' AS resource, is_valid FROM ({checked_sql(v)})" for v, (s, r) in JSON_RESOURCES.items()
    )
    + ") GROUP BY ALL",
    "extract_failures": with_views("raw_customers", "raw_accounts") + f"""SELECT 'stripe' AS source, 'customers' AS resource,
  count(*) AS fetched, count(*) FILTER ({instant('created')} IS NOT NULL) AS valid,
  count(*) FILTER ({instant('created')} IS NULL) AS errors, CAST(0 AS BIGINT) AS failed FROM raw_customers
UNION ALL SELECT 'salesforce', 'accounts', count(*), count(*), 0, 0 FROM raw_accounts
UNION ALL SELECT 'stripe', 'charges', 0, 0, 0, 1""",
    "selected_source": map_sql("raw_accounts", True),
    "raw_array_parts": with_views("raw_charges") + "SELECT id, amount, currency, status, created FROM raw_charges",
    "minor_text_to_major": with_views("raw_charges") + f""", v AS (SELECT id, amount, {currency('currency')} AS code,
  CASE WHEN regexp_full_match(amount, '-?[0-9]+([.][0-9]+)?') THEN CAST(amount AS DECIMAL(30,5)) END AS value FROM raw_charges)
SELECT id, amount, code, CASE WHEN value >= 0 THEN CAST(CASE WHEN code IN ({_ZERO_DECIMAL}) THEN round_even(value, 0)
  ELSE round_even(value / 100, 2) END AS DECIMAL(18,2)) END AS major FROM v""",
    "clean_unified": with_mapped("raw_charges") + f"SELECT {UNIFIED} FROM unified_raw_charges",
    "json_zone_roundtrip": all_sql(),
    "json_rejects": "WITH " + ",\n".join(mapped_sql(v, major, (), _INGESTED) for v in JSON_VIEWS) + "\n"
    + "SELECT resource, reject_stage, reject_reason, count(*) AS n FROM ("
    + "\nUNION ALL ".join(
        f"""SELECT '{s}/{r}' AS resource, CASE WHEN mapping_reason IS NOT NULL THEN 'mapping' ELSE 'validation' END AS reject_stage,
  coalesce(mapping_reason, validation_reason) AS reject_reason FROM {v}_all"""
        for v, (s, r) in JSON_RESOURCES.items()
    )
    + ") WHERE reject_reason IS NOT NULL GROUP BY ALL",
    **{f"validate_{v}": checked_sql(v) for v in JSON_VIEWS},
    **{
        f"map_{v}": "WITH " + mapped_sql(v, major, attributes_of("raw_" + v[5:]), _INGESTED)
        + f"\nSELECT {UNIFIED}{attribute_columns(attributes_of('raw_' + v[5:]))} FROM {v}_all"
        + " WHERE mapping_reason IS NULL AND validation_reason IS NULL"
        for v in JSON_VIEWS
    },
    "incremental_run": with_mapped("raw_opportunities", "raw_customers") + f""", deals AS (
  SELECT * REPLACE (TIMESTAMP '2024-02-20 12:00:00' AS updated_at) FROM good_raw_opportunities WHERE part_no = 1)
SELECT {UNIFIED}, attr_stage_name, attr_description FROM deals
UNION ALL SELECT {UNIFIED.replace(' status,', " 'canceled' AS status,")}, attr_stage_name, attr_description FROM unified_raw_customers""",
    "raw_parts_scan": with_views(*ALL) + "\nUNION ALL ".join(
        f"""SELECT '{s}' AS source, '{r}' AS resource, {_FIELDS[v]['id']} AS id, true AS is_object FROM {v}"""
        for v, (s, r) in RESOURCES.items()
    ),
    "raw_landing_roundtrip": with_views("raw_charges") + _CHECKED_CHARGES + _VALID_CHARGES,
    "run_date_partition": """WITH r AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%dT%H-%M-%SZ')
  WHEN 'O' THEN strftime(o_orderdate, '%Y%m%d-nightly') ELSE 'adhoc-' || o_orderkey END AS run_id, o_orderstatus, o_orderdate FROM orders)
SELECT o_orderkey, run_id, CASE WHEN o_orderstatus IN ('F', 'O') THEN strftime(o_orderdate, '%Y%m%d') ELSE '20240701' END AS run_date FROM r""",
    "processed_zone_roundtrip": all_sql(),
    "warehouse_initial_load": _MERGE + f"SELECT {UNIFIED}{_CHARGE_ATTRS} FROM good_raw_charges",
    "warehouse_count": _MERGE + "SELECT count(*) AS row_count FROM good_raw_charges",
    "warehouse_many_merges": _MERGE + f"SELECT {UNIFIED}{_CHARGE_ATTRS} FROM merged",
    "existing_keys": _MERGE + "SELECT unified_id FROM incoming WHERE unified_id IN (SELECT unified_id FROM target)",
    "upsert_merge": _MERGE + f"SELECT {UNIFIED}{_CHARGE_ATTRS} FROM merged",
    "upsert_counts": _MERGE + """, flagged AS (SELECT *, unified_id IN (SELECT unified_id FROM target) AS known,
  unified_id LIKE '%7' AS lost FROM incoming)
SELECT source, source_resource, count(*) AS input, count(*) FILTER (NOT lost AND NOT known) AS inserted,
  count(*) FILTER (NOT lost AND known) AS updated, count(*) FILTER (lost) AS rejected FROM flagged GROUP BY ALL""",
    "upsert_idempotent": _MERGE + """SELECT source, source_resource, count(*) AS input, CAST(0 AS BIGINT) AS inserted, count(*) AS updated,
  CAST(0 AS BIGINT) AS rejected, (SELECT count(*) FROM merged) AS row_count FROM incoming GROUP BY ALL""",
    "run_load": all_sql(),
    "max_event_time": with_mapped(*ALL) + f"""SELECT source, source_resource AS resource,
  max(greatest(updated_at, created_at)) AS high_water_mark FROM ({union_unified()}) GROUP BY ALL""",
    "watermark_upsert": with_mapped("raw_opportunities", "raw_charges") + """SELECT source, source_resource AS resource,
  max(greatest(updated_at, created_at)) AS high_water_mark,
  CASE source_resource WHEN 'charges' THEN 'run-2' ELSE 'run-1' END AS last_run_id,
  CASE source_resource WHEN 'charges' THEN TIMESTAMP '2024-07-02' ELSE TIMESTAMP '2024-07-01' END AS updated_at
FROM (SELECT source, source_resource, updated_at, created_at FROM good_raw_opportunities
      UNION ALL SELECT source, source_resource, updated_at, created_at FROM good_raw_charges) GROUP BY ALL""",
    "incremental_filter": with_mapped("raw_opportunities", "raw_charges") + f"""SELECT 'opportunities' AS resource,
  "Id" || '/' || part_no AS id FROM raw_opportunities WHERE {instant('"LastModifiedDate"')} > TIMESTAMP '2024-02-05'
UNION ALL SELECT 'charges', source_id FROM unified_raw_charges WHERE created_at > TIMESTAMP '2020-09-20'""",
    "stream_upsert": with_mapped("raw_charges") + f""", target AS (SELECT * FROM good_raw_charges WHERE ordered_on < DATE '{TARGET_UNTIL}'),
incoming AS (SELECT * REPLACE ('succeeded' AS status) FROM good_raw_charges WHERE ordered_on >= DATE '{BATCH_FROM}')
SELECT {UNIFIED} FROM incoming UNION ALL SELECT {UNIFIED} FROM target WHERE unified_id NOT IN (SELECT unified_id FROM incoming)""",
}

ORACLES["run_ids"] = """SELECT event_id, strftime(ts, '%Y-%m-%dT%H-%M-%SZ') AS run_id, strftime(ts, '%Y%m%d') AS run_date FROM events"""
_MINOR, _CODE = coerce_minor("amount"), currency("currency")
ORACLES["sql_scalar_rules"] = with_views("raw_charges") + f"""SELECT id, {clean('description')} AS name, {_CODE} AS code, {_MINOR} AS minor,
  {major(_MINOR, f"coalesce({_CODE}, '')")} AS major, {instant('created')} AS created_at,
  'stripe:transaction:' || {clean('id')} AS unified_id FROM raw_charges"""
ORACLES["sql_table_rules"] = with_mapped("raw_charges") + "\nUNION ALL ".join(
    f"SELECT unified_id, '{a}' AS name, attr_{a} AS value FROM unified_raw_charges WHERE attr_{a} IS NOT NULL"
    for a in attributes_of("raw_charges")
)
ORACLES["archived_records"] = map_sql("raw_customers", True)
ORACLES["archived_since"] = with_views("raw_opportunities") + f"""SELECT "Id", "Amount", "LastModifiedDate", CAST(part_no AS VARCHAR) AS part_no
FROM raw_opportunities WHERE {instant('"LastModifiedDate"')} > TIMESTAMP '2024-02-05 00:00:00'"""
_PAGED = with_views("raw_charges") + "SELECT * EXCLUDE (ordered_on) FROM raw_charges"
ORACLES["packed_parts"] = _PAGED
ORACLES["existing_few_keys"] = _MERGE + """SELECT unified_id FROM incoming WHERE unified_id IN (SELECT unified_id FROM target)
AND CAST(regexp_extract(unified_id, '_(\\d+)$', 1) AS BIGINT) <= 300 AND CAST(regexp_extract(unified_id, '_(\\d+)$', 1) AS BIGINT) % 7 = 0"""
ORACLES["key_sketches"] = _MERGE + """SELECT 'table' AS name, (SELECT count(DISTINCT unified_id) FROM target) AS keys, true AS within_error
UNION ALL SELECT 'batch', (SELECT count(DISTINCT unified_id) FROM incoming), true
UNION ALL SELECT 'both', (SELECT count(DISTINCT unified_id) FROM incoming WHERE unified_id IN (SELECT unified_id FROM target)), true"""
ORACLES["landed_pages_stream"] = _PAGED
ORACLES["landed_pages_since"] = f"{_PAGED} WHERE CAST(created AS BIGINT) > {int(STRIPE_CUTOFF.timestamp())}"
ORACLES["raw_huge_array"] = ORACLES["raw_array_parts"]
ORACLES["stream_newest"] = map_sql("raw_opportunities", True)
ORACLES["stream_counts"] = with_mapped(*ALL) + "\nUNION ALL ".join(
    f"""SELECT '{RESOURCES[v][0]}' AS source, '{RESOURCES[v][1]}' AS source_resource, (SELECT count(*) FROM mapped_{v}) AS input,
  (SELECT count(*) FROM good_{v}) AS mapped, (SELECT count(*) FROM mapped_{v}) - (SELECT count(*) FROM good_{v}) AS rejected"""
    for v in ALL
)

# The landing checks charges and customers against their contracts before they are transformed.
ORACLES["end_to_end"] = with_mapped(*ALL) + f""", landed AS (SELECT u.* FROM ({union_unified()}) u
  WHERE NOT (source_resource = 'charges' AND source_id IN (SELECT id FROM raw_charges
    WHERE {_CHARGE_AMOUNT_ERROR} IS NOT NULL OR status IS NULL)))
SELECT source, source_resource, entity_type, status, count(*) AS n, CAST(sum(amount_minor) AS BIGINT) AS total_minor,
  CAST(sum(amount) AS DECIMAL(38,2)) AS total_amount FROM landed GROUP BY ALL"""
