"""One query per operator: name -> (spark, sf_dir) -> DataFrame, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.attributes import decode_attributes
from tributary.functions.cells import Records, in_brackets, is_object, pick_variant, strict_json
from tributary.functions.instants import epoch_to_timestamp, parse_instant
from tributary.functions.keys import run_date, run_id_of, surrogate_key, timestamp_literal
from tributary.functions.money import (
    coerce_minor_text, currency_exponent, major_to_minor, minor_text_to_major, minor_to_major,
)
from tributary.functions.sql import register_rules
from tributary.functions.status import resolve_status
from tributary.functions.text import (
    clean_email, clean_string, is_missing, standardize_currency, strip, title_case,
)
from tributary.model import OPPORTUNITY, STRIPE, TRANSACTION, UNIFIED_COLUMNS
from tributary.operators.contracts import CONTRACTS, first_message, valid_records, validate
from tributary.operators.dedupe import count_duplicates, deduplicate
from tributary.operators.envelope import unwrap, wrap
from tributary.operators.frames import UNIFIED_ROLES, clean_frame
from tributary.operators.gate import coerce_records as coerce
from tributary.operators.gate import unloadable
from tributary.operators.mapping import MAPPINGS, Money, Moments, ResourceMapping, StatusRule, accepted, map_records
from tributary.operators.sketches import ERROR, merged, overlap, sketches
from tributary.operators.summaries import event_time_marks, extraction_summary, run_summary, since, transform_summary
from tributary.plans.extract import newer_than, run_extract
from tributary.plans.load import run_load as load_zone
from tributary.plans.run import Zones, run_all
from tributary.plans.transform import newest_per_key, transform_records, union_all
from tributary.queries.json_inputs import JSON_RESOURCES, JSON_TABLES, JSON_VIEWS
from tributary.queries.inputs import RESOURCES, VERSION_ORDER, as_json, raw_records, raw_view, spread_table, table
from tributary.session import prepare, scratch_path
from tributary.sources.packing import GLOB as PACKED_GLOB
from tributary.sources.packing import pack_run
from tributary.sources.pages import land_pages, read_pages, stream_pages
from tributary.sources.processed_zone import read_unified, write_unified
from tributary.sources.raw_archive import archive, picked_since, read_archive
from tributary.sources.raw_zone import PART_RECORDS, POSITION, find_raw_parts, land_raw, read_raw
from tributary.sources.warehouse import Warehouse
from tributary.sources.watermarks import Watermarks
from tributary.streaming.incremental import stream_upsert as start_stream
from tributary.streaming.newest import StreamCounts
from tributary.streaming.newest import stream_newest as start_newest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

INGESTED_AT = datetime(2024, 7, 1, tzinfo=timezone.utc)
RUN_ID = "2024-07-01T00-00-00Z"
# Orders before TARGET_UNTIL are in the table; the batch brings everything since BATCH_FROM again.
TARGET_UNTIL = "1999-01-01"
BATCH_FROM = "1997-01-01"
STRIPE_CUTOFF = datetime(2020, 9, 20, tzinfo=timezone.utc)
SALESFORCE_CUTOFF = datetime(2024, 2, 5, tzinfo=timezone.utc)
ATTRIBUTES = (
    "raw_status", "customer", "description", "livemode", "amount_paid",
    "industry", "website", "close_date", "stage_name",
)


def query(function: Query) -> Query:
    """Register a query under its function's name; a trailing underscore sets it apart from its rule."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        prepare(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__.rstrip("_")] = run
    return run


def moment(column: Column | str) -> Column:
    """A timestamp without a zone, in UTC, so that every engine shows it alike."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def shown(unified: DataFrame, attributes: tuple[str, ...] = ()) -> DataFrame:
    """Unified rows with each attribute as a text column."""
    instants = ("created_at", "updated_at", "ingested_at")
    columns = [moment(c).alias(c) if c in instants else F.col(c) for c in UNIFIED_COLUMNS if c != "attributes"]
    if not attributes:
        return unified.select(*columns)
    # Read once for all of them.
    return unified.select(*columns, F.json_tuple("attributes", *attributes).alias(*[f"attr_{name}" for name in attributes]))


def _attributes_of(view: str) -> tuple[str, ...]:
    return MAPPINGS[RESOURCES[view]].attribute_names()


def tagged(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    return map_records(
        raw_records(spark, sf_dir, view), MAPPINGS[RESOURCES[view]], INGESTED_AT, keep=VERSION_ORDER.get(view, ())
    )


def unified(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    return transform_records(
        raw_records(spark, sf_dir, view), *RESOURCES[view], INGESTED_AT, position=VERSION_ORDER.get(view, ())
    ).unified


def checked(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    return validate(raw_records(spark, sf_dir, view), CONTRACTS[RESOURCES[view]])


def warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, "warehouse"), buckets=4, slices=2)


# --- scalar rules -----------------------------------------------------------------------------


@query
def null_tokens(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_customers")
    return raw.select("id", "name", "email", "created", *[
        F.expr(is_missing(c)).alias(f"{c}_missing") for c in ("id", "name", "email", "created")
    ])


@query
def clean_string_(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_customers")
    return raw.select("email", *[F.expr(clean_string(c)).alias(f"{c}_clean") for c in ("id", "name", "description")])


@query
def clean_string_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.expr(clean_string("text")).alias("text_clean"))


@query
def title_case_(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_customers").select("id", "email", F.expr(clean_string("name")).alias("name"))
    return raw.select("id", "email", "name", F.expr(title_case("name")).alias("titled"))


@query
def email_normalize(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_customers")
    return raw.select("id", "name", "email", F.expr(clean_email("email")).alias("email_clean"))


@query
def currency_standardize(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_charges")
    code = F.expr(standardize_currency("currency"))
    return raw.select("id", "currency", code.alias("code"), F.coalesce(code, F.lit("USD")).alias("code_or_default"))


@query
def currency_exponent_(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_charges")
    return raw.select("id", "currency", F.expr(currency_exponent(standardize_currency("currency"))).alias("exponent"))


@query
def coerce_minor_amount_(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_charges")
    return raw.select("id", "amount", F.expr(coerce_minor_text(f"({strip('amount')})")).alias("amount_minor"))


@query
def minor_text_to_major_(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_charges").select("id", "amount", F.expr(standardize_currency("currency")).alias("code"))
    return raw.withColumn("major", F.expr(minor_text_to_major("amount", "code")))


@query
def minor_to_major_(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_charges").select(
        "id", F.expr(standardize_currency("currency")).alias("code"),
        F.expr(coerce_minor_text(f"({strip('amount')})")).alias("amount_minor"),
    )
    return raw.withColumn("amount", F.expr(minor_to_major("amount_minor", "code")))


@query
def major_to_minor_(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_opportunities")
    return raw.select(
        "Id", "part_no", "Amount",
        F.expr(major_to_minor("Amount", "'USD'")).alias("minor_usd"),
        F.expr(major_to_minor("Amount", "'KRW'")).alias("minor_krw"),
    )


@query
def standardize_datetime_(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_customers")
    return raw.select("id", "email", "created", moment(F.expr(parse_instant("created"))).alias("created_at"))


@query
def epoch_to_timestamp_(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_customers")
    return raw.select(
        "id", "email", "created",
        moment(F.expr(epoch_to_timestamp("TRY_CAST(created AS DOUBLE)"))).alias("created_at"),
    )


def _status_query(spark, sf_dir, view, column, key):
    rule = MAPPINGS[RESOURCES[view]].status
    status = F.expr(resolve_status(f"({clean_string(column)})", rule.values, rule.otherwise))
    return raw_view(spark, sf_dir, view).select(*key, column, status.alias("resolved"))


@query
def resolve_status_charges(spark, sf_dir):
    return _status_query(spark, sf_dir, "raw_charges", "status", ["id"])


@query
def resolve_status_opportunities(spark, sf_dir):
    return _status_query(spark, sf_dir, "raw_opportunities", "StageName", ["Id", "part_no"])


@query
def default_status(spark, sf_dir):
    rows = [unified(spark, sf_dir, view) for view in ("raw_accounts", "raw_customers")]
    return union_all(rows).select("unified_id", "status")


@query
def surrogate_key_(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_customers")
    key = F.expr(surrogate_key("'stripe'", "'customer'", clean_string("id")))
    return raw.select("id", "email", key.alias("unified_id"))


@query
def attributes_bag(spark, sf_dir):
    bags = [
        tagged(spark, sf_dir, view).select("unified_id", "created_at", *[
            (F.get_json_object("attributes", f"$.{a}") if a in _attributes_of(view) else F.lit(None).cast("string"))
            .alias(f"attr_{a}") for a in ATTRIBUTES
        ])
        for view in RESOURCES
    ]
    return union_all(bags).withColumn("created_at", moment("created_at"))


@query
def attributes_decode(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("key"), F.col("props").alias("text"))
    documents = table(spark, sf_dir, "documents").select((-F.col("doc_id") - 1).alias("key"), "text")
    decoded = events.unionByName(documents).select("key", F.expr(decode_attributes("text")).alias("attributes"))
    return decoded.select(
        "key",
        F.get_json_object("attributes", "$.k").alias("k"),
        F.get_json_object("attributes", "$._raw").alias("raw_text"),
    )


@query
def nested_pick(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("props"))
    record = F.to_variant_object(F.struct("event_id", "props"))
    picked = events.select("event_id", record.alias("record"))
    return picked.select("event_id", *[
        F.expr(pick_variant("record", path)).cast("string").alias(name)
        for name, path in (("k", "props.k"), ("below_scalar", "props.k.x"), ("absent", "props.nope"), ("top", "event_id"))
    ])


# --- envelopes and contracts ------------------------------------------------------------------


@query
def envelope_wrap(spark, sf_dir):
    contract = CONTRACTS[RESOURCES["raw_charges"]]
    wrapped = wrap(valid_records(checked(spark, sf_dir, "raw_charges"), contract), contract, INGESTED_AT)
    return wrapped.select(
        "source", "resource", "external_id", "extracted_at",
        *[F.expr(pick_variant("data", f)).cast("string").alias(f"data_{f}") for f in ("id", "amount", "currency", "created", "livemode")],
    )


@query
def envelope_unwrap(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_charges")
    body = F.to_json(F.struct("id", "amount", "status"))
    text = (
        F.when(F.col("currency") == "usd", F.concat(F.lit('{"source":"stripe","data":'), body, F.lit("}")))
        .when(F.col("currency") == " EUR ", F.concat(F.lit('{"extracted_at":null,"data":'), body, F.lit("}")))
        .when(F.col("currency") == "jpy", F.concat(F.lit('{"id":"outer","data":'), body, F.lit("}")))
        .when(F.col("currency") == "Krw", F.concat(F.lit('{"source":"stripe","id":"outer","data":['), body, F.lit("]}")))
        .otherwise(body)
    )
    record = raw.select(F.col("id").alias("key"), F.parse_json(text).alias("raw")).selectExpr(
        "key", f"{unwrap('raw')} AS record"
    )
    return record.select("key", *[
        F.expr(pick_variant("record", f)).cast("string").alias(f) for f in ("id", "amount", "status")
    ])


@query
def alias_resolve(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_accounts")
    snake = {"Id": "id", "Name": "name", "Industry": "industry", "Website": "website",
             "CreatedDate": "created_date", "LastModifiedDate": "last_modified_date"}
    spelled = as_json(raw).unionByName(as_json(raw.withColumnsRenamed(snake)))
    contract = CONTRACTS[RESOURCES["raw_accounts"]]
    valid = valid_records(validate(Records(spelled, "record"), contract), contract)
    return valid.withColumns({c: moment(c) for c in ("created_date", "last_modified_date")})


@query
def contract_projection(spark, sf_dir):
    contract = CONTRACTS[RESOURCES["raw_charges"]]
    extra = as_json(raw_view(spark, sf_dir, "raw_charges").withColumn("unknown_field", F.lit("x")))
    valid = valid_records(validate(Records(extra, "record"), contract), contract)
    return valid.withColumn("created", moment("created"))


def _validate_query(spark, sf_dir, view, instants):
    contract = CONTRACTS[RESOURCES[view]]
    valid = valid_records(checked(spark, sf_dir, view), contract)
    return valid.withColumns({c: moment(c) for c in instants})


@query
def validate_customers(spark, sf_dir):
    return _validate_query(spark, sf_dir, "raw_customers", ["created"])


@query
def validate_charges(spark, sf_dir):
    return _validate_query(spark, sf_dir, "raw_charges", ["created"])


@query
def validate_invoices(spark, sf_dir):
    return _validate_query(spark, sf_dir, "raw_invoices", ["created"])


@query
def validate_accounts(spark, sf_dir):
    return _validate_query(spark, sf_dir, "raw_accounts", ["created_date", "last_modified_date"])


@query
def validate_opportunities(spark, sf_dir):
    valid = _validate_query(spark, sf_dir, "raw_opportunities", ["created_date", "last_modified_date"])
    return valid.withColumn("amount", F.col("amount").cast("string"))


@query
def quarantine_charges(spark, sf_dir):
    bad = checked(spark, sf_dir, "raw_charges").where("NOT is_valid")
    return bad.select(
        F.get_json_object("payload", "$.id").alias("id"),
        F.size("errors").alias("n_errors"),
        F.concat_ws(",", F.col("errors.field")).alias("fields"),
        F.concat_ws(",", F.col("errors.type")).alias("types"),
    )


@query
def first_error(spark, sf_dir):
    bad = [
        checked(spark, sf_dir, view).where("NOT is_valid")
        .select(F.lit(RESOURCES[view][1]).alias("resource"), F.expr(first_message("errors")).alias("message"))
        for view in RESOURCES
    ]
    return union_all(bad).groupBy("resource", "message").agg(F.count(F.lit(1)).alias("n"))


# --- mapping ----------------------------------------------------------------------------------


def _map_query(spark, sf_dir, view):
    keep = VERSION_ORDER.get(view, ())
    mapped = accepted(tagged(spark, sf_dir, view)).drop(*keep)
    return shown(mapped, _attributes_of(view))


@query
def map_customers(spark, sf_dir):
    return _map_query(spark, sf_dir, "raw_customers")


@query
def map_charges(spark, sf_dir):
    return _map_query(spark, sf_dir, "raw_charges")


@query
def map_invoices(spark, sf_dir):
    return _map_query(spark, sf_dir, "raw_invoices")


@query
def map_accounts(spark, sf_dir):
    return _map_query(spark, sf_dir, "raw_accounts")


@query
def map_opportunities(spark, sf_dir):
    return _map_query(spark, sf_dir, "raw_opportunities")


def json_records(spark, sf_dir, view) -> Records:
    tables = {t: spread_table(spark, sf_dir, t) for t in JSON_TABLES if f"{{{t}}}" in JSON_VIEWS[view]}
    rows = spark.sql(JSON_VIEWS[view], **tables)
    bracketed = rows.selectExpr("k", f"try_parse_json({in_brackets('text')}) AS _bracketed")
    return Records(bracketed.selectExpr("k", f"{strict_json('_bracketed')} AS record"), "record")


def json_tagged(spark, sf_dir, view) -> DataFrame:
    return map_records(json_records(spark, sf_dir, view), MAPPINGS[JSON_RESOURCES[view]], INGESTED_AT)


def json_checked(spark, sf_dir, view) -> DataFrame:
    return validate(json_records(spark, sf_dir, view), CONTRACTS[JSON_RESOURCES[view]], keep=("k",))


def _json_map(view: str) -> None:
    """Records as JSON text through a mapping."""
    def run(spark, sf_dir):
        mapped = accepted(json_tagged(spark, sf_dir, view))
        return shown(mapped, MAPPINGS[JSON_RESOURCES[view]].attribute_names())

    run.__name__ = f"map_{view}"
    query(run)


def _json_validate(view: str, columns: tuple[str, ...]) -> None:
    """Records as JSON text against a contract: the verdict, the errors, and coerced values."""
    def run(spark, sf_dir):
        rows = json_checked(spark, sf_dir, view)
        return rows.select(
            "k", "is_valid", F.coalesce(F.concat_ws(",", F.col("errors.field")), F.lit("")).alias("fields"),
            F.coalesce(F.concat_ws(",", F.col("errors.type")), F.lit("")).alias("types"),
            *[F.when(F.col("is_valid"), F.col(c).cast("string")).alias(c) for c in columns],
        )

    run.__name__ = f"validate_{view}"
    query(run)


for _view, _columns in {
    "json_customers": ("livemode", "email"), "json_charges": ("amount", "currency", "livemode"),
    "json_invoices": ("amount_due", "amount_paid"), "json_accounts": ("name",), "json_opportunities": ("id", "amount"),
}.items():
    _json_map(_view)
    _json_validate(_view, _columns)


@query
def json_rejects(spark, sf_dir):
    """All reasons a record is refused for, over all resources."""
    columns = ("reject_stage", "reject_reason")
    rows = [
        json_tagged(spark, sf_dir, view).select(F.lit("/".join(JSON_RESOURCES[view])).alias("resource"), *columns)
        for view in JSON_VIEWS
    ]
    return union_all(rows).where("reject_stage IS NOT NULL").groupBy("resource", *columns).agg(F.count(F.lit(1)).alias("n"))


EVENTS = ResourceMapping(
    (STRIPE, "events"), OPPORTUNITY, "event_id", Moments("ts"),
    StatusRule("event_type", {"purchase": "succeeded", "error": "failed", "view": "open", "signup": "active"}),
    Money("value", in_major=True, assumed="usd"),
    attributes={"k": "props.k", "user": "user_id"},
)


@query
def custom_mapping(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("props", F.try_parse_json("props"))
    mapped = accepted(map_records(Records(events), EVENTS, INGESTED_AT))
    return shown(mapped, ("k", "user", "raw_status"))


def _reject_query(spark, sf_dir, stage):
    rows = [
        tagged(spark, sf_dir, view).select("source", "source_resource", "reject_stage", "reject_reason")
        for view in RESOURCES
    ]
    return union_all(rows).where(F.col("reject_stage") == stage).groupBy(
        "source", "source_resource", "reject_reason"
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def mapping_rejects(spark, sf_dir):
    return _reject_query(spark, sf_dir, "mapping")


@query
def validation_rejects(spark, sf_dir):
    columns = ("source_resource", "source_id", "reject_stage", "reject_reason", "reject_errors")
    rejects = union_all(tagged(spark, sf_dir, view).select(*columns) for view in RESOURCES)
    return rejects.where("reject_stage = 'validation'").select(
        "source_resource", F.col("source_id").alias("id"), "reject_reason",
        F.concat_ws(",", F.col("reject_errors.field")).alias("fields"),
        F.concat_ws(",", F.col("reject_errors.type")).alias("types"),
    )


def _unchecked_customers(spark, sf_dir) -> DataFrame:
    """Customers as a caller might hand them to the warehouse: text, with blanks."""
    raw = raw_view(spark, sf_dir, "raw_customers")
    return raw.select(
        F.concat(F.lit("stripe:customer:"), F.trim("id")).alias("unified_id"),
        F.lit("stripe").alias("source"), F.lit("customers").alias("source_resource"),
        F.trim("id").alias("source_id"), F.lit("customer").alias("entity_type"),
        "name", "email", F.lit(None).cast("string").alias("status"),
        F.col("created").alias("created_at"), F.lit("2024-07-01T00:00:00Z").alias("ingested_at"),
    )


@query
def warehouse_required_rejects(spark, sf_dir):
    return unloadable(coerce(_unchecked_customers(spark, sf_dir))).select("unified_id", "source_id", "name", "email", "reason")


@query
def coerce_records(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_charges")
    rows = raw.select(
        F.concat(F.lit("stripe:transaction:"), "id").alias("unified_id"),
        F.lit("stripe").alias("source"), F.lit("charges").alias("source_resource"), F.col("id").alias("source_id"),
        F.lit(TRANSACTION).alias("entity_type"), F.col("description").alias("name"), "currency", "status",
        F.col("amount").alias("amount_minor"), F.col("amount").alias("amount"),
        F.col("created").alias("created_at"), F.lit("2024-07-01T00:00:00Z").alias("ingested_at"),
        F.to_json(F.struct("customer")).alias("attributes"),
    )
    return coerce(rows).select(
        "unified_id", "currency", "status", "amount_minor", "amount", "is_loadable", "reason",
        moment("created_at").alias("created_at"), moment("ingested_at").alias("ingested_at"),
        F.get_json_object("attributes", "$.customer").alias("attr_customer"),
    )


# --- frames and dedupe ------------------------------------------------------------------------


@query
def clean_frame_(spark, sf_dir):
    return clean_frame(
        table(spark, sf_dir, "documents"),
        string_columns=("text", "source", "not_there"), currency_columns=("lang",), numeric_columns=("n_chars",),
    )


@query
def clean_frame_charges(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_charges").select("id", "amount", "currency", "status", "created")
    cleaned = clean_frame(
        raw, string_columns=("id", "status"), datetime_columns=("created",),
        currency_columns=("currency",), numeric_columns=("amount",),
    )
    return cleaned.withColumn("created", moment("created"))


@query
def clean_unified(spark, sf_dir):
    """Unified columns taken by their roles, as a caller's own frame would be: cleaning again changes nothing
    that is clean."""
    rows = unified(spark, sf_dir, "raw_charges").drop("attributes")
    return shown(clean_frame(rows, **UNIFIED_ROLES).withColumn("attributes", F.lit(None).cast("string")))


@query
def dedupe_newest(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_invoices")
    return deduplicate(raw, ["id"], "l_shipdate", ["l_partkey"]).select(
        "id", "customer", "amount_due", "amount_paid", "status", "l_shipdate", "l_partkey"
    )


@query
def dedupe_keep_last(spark, sf_dir):
    raw = raw_view(spark, sf_dir, "raw_opportunities")
    return deduplicate(raw, ["Id"], None, ["part_no"]).select("Id", "Name", "Amount", "StageName", "part_no")


@query
def dedupe_unified(spark, sf_dir):
    return shown(unified(spark, sf_dir, "raw_opportunities"), _attributes_of("raw_opportunities"))


@query
def duplicates_removed(spark, sf_dir):
    return count_duplicates(accepted(tagged(spark, sf_dir, "raw_invoices")), "unified_id", ["source", "source_resource"])


@query
def stable_order(spark, sf_dir):
    return shown(unified(spark, sf_dir, "raw_opportunities").orderBy("unified_id"))


# --- rules in SQL ---------------------------------------------------------------------------------


#: Plain SQL over raw records; the functions are those of `register_rules`.
CHARGES_IN_SQL = """
SELECT id, rule_clean_string(description) AS name, rule_standardize_currency(currency) AS code,
       rule_minor_units(amount) AS minor, rule_minor_to_major(rule_minor_units(amount), rule_standardize_currency(currency)) AS major,
       rule_parse_instant(created) AS created_at, rule_surrogate_key('stripe', 'transaction', rule_clean_string(id)) AS unified_id
FROM {charges}"""


@query
def sql_scalar_rules(spark, sf_dir):
    """The scalar rules called from SQL text."""
    register_rules(spark, "rule_")
    rows = spark.sql(CHARGES_IN_SQL, charges=raw_view(spark, sf_dir, "raw_charges"))
    return rows.withColumn("created_at", moment("created_at"))


@query
def sql_table_rules(spark, sf_dir):
    """The attributes of unified charges as rows, by a table function called from SQL text."""
    register_rules(spark, "rule_")
    return spark.sql(
        "SELECT u.unified_id, a.name, a.value FROM {unified} u, LATERAL rule_attributes_of(u.attributes) a",
        unified=unified(spark, sf_dir, "raw_charges"),
    )


# --- whole transforms -------------------------------------------------------------------------


def _transform_query(spark, sf_dir, view):
    return shown(unified(spark, sf_dir, view), _attributes_of(view))


@query
def transform_customers(spark, sf_dir):
    return _transform_query(spark, sf_dir, "raw_customers")


@query
def transform_charges(spark, sf_dir):
    return _transform_query(spark, sf_dir, "raw_charges")


@query
def transform_invoices(spark, sf_dir):
    return _transform_query(spark, sf_dir, "raw_invoices")


@query
def transform_accounts(spark, sf_dir):
    return _transform_query(spark, sf_dir, "raw_accounts")


@query
def transform_opportunities(spark, sf_dir):
    return _transform_query(spark, sf_dir, "raw_opportunities")


def _all_unified(spark, sf_dir) -> DataFrame:
    return union_all(unified(spark, sf_dir, view) for view in RESOURCES)


def _write_all(spark, sf_dir, root: str, *, also_json: bool = False) -> None:
    """The processed zone of all resources."""
    rows = sum(raw_view(spark, sf_dir, view, spread=False).count() for view in RESOURCES)
    write_unified(_all_unified(spark, sf_dir), root, also_json=also_json, rows=rows)


@query
def transform_all(spark, sf_dir):
    return shown(_all_unified(spark, sf_dir), ATTRIBUTES)


@query
def union_parts(spark, sf_dir):
    """Two landed runs of one resource become one set of records, then one row per key."""
    root = scratch_path(spark, "raw")
    raw = raw_view(spark, sf_dir, "raw_opportunities")
    for part_no in (0, 1):
        rows = raw.where(F.col("part_no") == part_no).drop("part_no")
        land_raw(rows, root, "salesforce", "opportunities", f"2024-07-0{part_no + 1}T00-00-00Z")
    records = read_raw(spark, root, "salesforce", "opportunities")
    position = ("part", "block", "line", "item")
    out = transform_records(
        Records(records, "record"), "salesforce", "opportunities", INGESTED_AT, position=position
    ).unified
    return shown(out, _attributes_of("raw_opportunities"))


@query
def transform_summary_(spark, sf_dir):
    columns = ("source", "source_resource", "unified_id", "reject_stage")
    return transform_summary(union_all(tagged(spark, sf_dir, view).select(*columns) for view in RESOURCES))


@query
def extraction_summary_(spark, sf_dir):
    rows = [
        json_checked(spark, sf_dir, view).select(F.lit(source).alias("source"), F.lit(resource).alias("resource"), "is_valid")
        for view, (source, resource) in JSON_RESOURCES.items()
    ]
    return extraction_summary(union_all(rows))


@query
def extract_failures(spark, sf_dir):
    """Two sources are pulled; one is down, which costs the others nothing and is counted."""
    def down():
        raise OSError("the source is down")

    inputs = {RESOURCES[view]: raw_records(spark, sf_dir, view) for view in ("raw_customers", "raw_accounts")}
    inputs[STRIPE, "charges"] = down
    return run_summary(spark, run_extract(inputs, scratch_path(spark, "raw"), RUN_ID, INGESTED_AT))


@query
def selected_source(spark, sf_dir):
    """A run limited to one source loads that source only."""
    inputs = {RESOURCES[view]: raw_records(spark, sf_dir, view) for view in ("raw_customers", "raw_accounts")}
    zones = Zones(scratch_path(spark, "zones"))
    run_all(spark, inputs, zones, run_id=RUN_ID, now=INGESTED_AT, sources=["salesforce"], buckets=4, slices=2)
    return shown(Warehouse(spark, zones.warehouse).read(), _attributes_of("raw_accounts"))


@query
def raw_array_parts(spark, sf_dir):
    """Parts as other writers land them: arrays of some thousand records, on one line or over several, and
    single objects."""
    raw = raw_view(spark, sf_dir, "raw_charges").select("id", "amount", "currency", "status", "created")
    n = raw.count()
    body = F.to_json(F.struct(*raw.columns))
    grouped = raw.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(max(3, n // PART_RECORDS)))).groupBy("part").agg(
        F.collect_list(body).alias("bodies")
    )
    shape = F.col("part") % 3
    text = (
        F.when(shape == 0, F.concat(F.lit("["), F.array_join("bodies", ","), F.lit("]")))
        .when(shape == 1, F.concat(F.lit("[\n  "), F.array_join("bodies", ",\n  "), F.lit("\n]")))
    )
    root = scratch_path(spark, "raw")
    for folder, rows, most in (
        ("arrays", grouped.where(text.isNotNull()).select(text.alias("value")), 1),
        ("objects", grouped.where(text.isNull()).select(F.array_join("bodies", "\n").alias("value")), 0),
    ):
        rows.write.option("maxRecordsPerFile", most).text(f"{root}/{folder}/stripe/charges/run_date=20240701")
    landed = [
        read_raw(spark, f"{root}/{folder}", "stripe", "charges", whole_files=folder == "arrays", glob="*.txt")
        for folder in ("arrays", "objects")
    ]
    return union_all(
        rows.select(*[F.expr(pick_variant("record", c)).cast("string").alias(c) for c in raw.columns]) for rows in landed
    )


@contextmanager
def _ranges_of(spark, size: str):
    """Files read within are cut into ranges of this size, once their plan is made."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, size)
    try:
        yield
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def _in_array(batches):
    """The lines between the brackets of one array; null lines only stand for a file that has no others."""
    yield pa.RecordBatch.from_pydict({"value": ["["]})
    for batch in batches:
        yield batch.filter(batch.column(0).is_valid())
    yield pa.RecordBatch.from_pydict({"value": ["{}]"]})


@query
def raw_huge_array(spark, sf_dir):
    """All charges as one JSON array in one file, over several lines each, read by a task for every 256 kB."""
    raw = raw_view(spark, sf_dir, "raw_charges").select("id", "amount", "currency", "status", "created")
    body = F.to_json(F.struct(*raw.columns, F.array(F.struct(F.lit("a } in \"text").alias("note"))).alias("notes")), {"pretty": "true"})
    # One task streams the array to its file and sorts nothing.
    rows = raw.select(F.concat(body, F.lit(",")).alias("value")).unionByName(spark.createDataFrame([(None,)], "value string"))
    root = scratch_path(spark, "raw")
    rows.repartition(1).mapInArrow(_in_array, "value string").write.text(f"{root}/stripe/charges/run_date=20240701/{RUN_ID}")
    with _ranges_of(spark, "256k"):
        records = read_raw(spark, root, "stripe", "charges", split_files=True, glob="*.txt")
        picked = records.select("line", "item", *[F.expr(pick_variant("record", c)).cast("string").alias(c) for c in raw.columns])
        # Read here, as the ranges are cut when the plan is made.
        kept = scratch_path(spark, "split")
        picked.write.parquet(kept)
    return spark.read.schema(picked.schema).parquet(kept).where("id IS NOT NULL").drop("line", "item")


# --- zones ------------------------------------------------------------------------------------


@query
def raw_parts_scan(spark, sf_dir):
    root = scratch_path(spark, "raw")
    for view, (source, resource) in RESOURCES.items():
        land_raw(raw_view(spark, sf_dir, view).drop("l_shipdate"), root, source, resource, RUN_ID)
    unknown = raw_view(spark, sf_dir, "raw_accounts")
    land_raw(unknown, root, "other", "things", RUN_ID)
    land_raw(unknown, root, "salesforce", "contacts", RUN_ID)
    found = find_raw_parts(spark, root).where("is_mapped").select("source", "resource").distinct().collect()
    scans = [
        read_raw(spark, root, row["source"], row["resource"]).select(
            F.lit(row["source"]).alias("source"), F.lit(row["resource"]).alias("resource"),
            F.coalesce(F.expr(pick_variant("record", "id")), F.expr(pick_variant("record", "Id"))).cast("string").alias("id"),
            F.expr(is_object("record")).alias("is_object"),
        )
        for row in found
    ]
    return union_all(scans)


@query
def raw_landing_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "raw")
    contract = CONTRACTS[RESOURCES["raw_charges"]]
    wrapped = wrap(valid_records(checked(spark, sf_dir, "raw_charges"), contract), contract, INGESTED_AT)
    land_raw(wrapped, root, "stripe", "charges", RUN_ID, part_records=PART_RECORDS)
    back = read_raw(spark, root, "stripe", "charges")
    records = valid_records(validate(Records(back, "record"), contract), contract)
    return records.withColumn("created", moment("created"))


@query
def run_date_partition(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    run_id = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH-mm-ss'Z'"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyyMMdd'-nightly'"))
        .otherwise(F.concat(F.lit("adhoc-"), F.col("o_orderkey").cast("string")))
    )
    rows = orders.select("o_orderkey", run_id.alias("run_id"))
    return rows.withColumn("run_date", F.expr(run_date("run_id", timestamp_literal(INGESTED_AT))))


@query
def run_ids(spark, sf_dir):
    """The run each event would have started, and where its records would lie."""
    events = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    ids = events.select("event_id", F.expr(run_id_of("at")).alias("run_id"))
    return ids.withColumn("run_date", F.expr(run_date("run_id", timestamp_literal(INGESTED_AT))))


@query
def processed_zone_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "processed")
    _write_all(spark, sf_dir, root)
    return shown(read_unified(spark, root), ATTRIBUTES)


@query
def json_zone_roundtrip(spark, sf_dir):
    """The JSON form of the zone, final columns and attributes as an object, into the warehouse."""
    root = scratch_path(spark, "processed")
    _write_all(spark, sf_dir, root, also_json=True)
    house = warehouse(spark)
    marks = Watermarks(spark, scratch_path(spark, "watermarks"))
    load_zone(spark, f"{root}_json", house, marks, RUN_ID, INGESTED_AT, from_json=True)
    return shown(house.read(), ATTRIBUTES)


# --- warehouse --------------------------------------------------------------------------------


def _charges(spark, sf_dir, which: Column | None = None) -> DataFrame:
    """Charges chosen before they are mapped: a filter above a mapping would not reach the scan."""
    raw = raw_view(spark, sf_dir, "raw_charges")
    raw = raw if which is None else raw.where(which)
    return map_records(Records(raw), MAPPINGS[STRIPE, "charges"], INGESTED_AT)


def _all_loaded(spark, sf_dir) -> Warehouse:
    house = warehouse(spark)
    house.upsert(accepted(_charges(spark, sf_dir)))
    return house


def target_batch(spark, sf_dir) -> DataFrame:
    return accepted(_charges(spark, sf_dir, F.col("ordered_on") < TARGET_UNTIL))


def incoming_batch(spark, sf_dir) -> DataFrame:
    rows = accepted(_charges(spark, sf_dir, F.col("ordered_on") >= BATCH_FROM))
    return rows.withColumn("status", F.lit("succeeded"))


def _loaded(spark, sf_dir) -> Warehouse:
    house = warehouse(spark)
    house.upsert(target_batch(spark, sf_dir))
    return house


def _counts(stats: DataFrame) -> DataFrame:
    return stats.select("source", "source_resource", "input", "inserted", "updated", "rejected")


@query
def warehouse_initial_load(spark, sf_dir):
    return shown(_all_loaded(spark, sf_dir).read(), _attributes_of("raw_charges"))


@query
def warehouse_count(spark, sf_dir):
    return _all_loaded(spark, sf_dir).count()


@query
def existing_keys(spark, sf_dir):
    return _loaded(spark, sf_dir).existing_keys(incoming_batch(spark, sf_dir))


@query
def existing_few_keys(spark, sf_dir):
    """A handful of keys, looked up by name; those of orders 1 to 300 in steps of seven."""
    rows = incoming_batch(spark, sf_dir).select("unified_id")
    number = F.regexp_extract("unified_id", r"_(\d+)$", 1).cast("long")
    few = rows.where((number <= 300) & (number % 7 == 0))
    return _loaded(spark, sf_dir).existing_keys(few)


@query
def key_sketches(spark, sf_dir):
    """Keys of the table, of the batch and of both, by sketches of folders and resources, against their exact numbers."""
    house = _loaded(spark, sf_dir)
    table_rows, batch = house.read(), incoming_batch(spark, sf_dir)
    stored = sketches(table_rows.withColumn("bucket", house._bucket()), "unified_id", "source_resource", "bucket")
    arriving = sketches(batch, "unified_id", "source_resource")
    a, b, both = overlap(merged(stored, "source_resource"), arriving)
    exact_a, exact_b = (x.select("unified_id").distinct().count() for x in (table_rows, batch))
    exact_both = house.existing_keys(batch).count()
    union = exact_a + exact_b - exact_both
    rows = [
        (name, exact, abs(guess - exact) <= ERROR * of)
        for name, exact, guess, of in (("table", exact_a, a, exact_a), ("batch", exact_b, b, exact_b), ("both", exact_both, both, 3 * union))
    ]
    return spark.createDataFrame(rows, "name string, keys long, within_error boolean")


@query
def upsert_merge(spark, sf_dir):
    house = _loaded(spark, sf_dir)
    house.upsert(incoming_batch(spark, sf_dir))
    return shown(house.read(), _attributes_of("raw_charges"))


@query
def upsert_counts(spark, sf_dir):
    """Some rows of the batch have lost their id and are refused."""
    lost = F.col("unified_id").endswith("7")
    batch = incoming_batch(spark, sf_dir).withColumn("source_id", F.when(~lost, F.col("source_id")))
    return _counts(_loaded(spark, sf_dir).upsert(batch))


@query
def warehouse_many_merges(spark, sf_dir):
    """Twenty merges one after the other; the table stays one scan, and old folders go."""
    house = _loaded(spark, sf_dir)
    batch = incoming_batch(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("unified_id"), F.lit(20)))
    staged = scratch_path(spark, "batch")
    batch.write.partitionBy("part").parquet(staged)
    for part in range(20):
        house.upsert(spark.read.parquet(staged).where(F.col("part") == part).drop("part"), decode=False, stage=False)
    return shown(house.read(), _attributes_of("raw_charges"))


@query
def upsert_idempotent(spark, sf_dir):
    house = _loaded(spark, sf_dir)
    house.upsert(incoming_batch(spark, sf_dir))
    again = house.upsert(incoming_batch(spark, sf_dir))
    return _counts(again).withColumn("row_count", F.lit(house.count().first()["row_count"]))


@query
def run_load(spark, sf_dir):
    zone = scratch_path(spark, "processed")
    _write_all(spark, sf_dir, zone)
    house = warehouse(spark)
    marks = Watermarks(spark, scratch_path(spark, "watermarks"))
    load_zone(spark, zone, house, marks, RUN_ID, INGESTED_AT)
    return shown(house.read(), ATTRIBUTES)


def _paged_runs(spark, sf_dir) -> tuple[str, DataFrame]:
    """Charges as pages of two runs, the order of both as it comes."""
    raw = raw_view(spark, sf_dir, "raw_charges").drop("ordered_on")
    root = scratch_path(spark, "raw")
    for run in (1, 2):
        rows = raw.where(F.pmod(F.xxhash64("id"), F.lit(2)) == run - 1)
        land_pages(rows, root, "stripe", "charges", f"2024-07-0{run}T00-00-00Z")
    return root, raw


def _picked(records: DataFrame, columns: list[str]) -> DataFrame:
    return records.select(*[F.expr(pick_variant("record", c)).cast("string").alias(c) for c in columns])


@query
def packed_parts(spark, sf_dir):
    """A run that landed in thousands of parts, read again from the few it is packed into."""
    raw = raw_view(spark, sf_dir, "raw_charges").drop("ordered_on")
    root, packed = scratch_path(spark, "raw"), scratch_path(spark, "packed")
    land_raw(raw, root, "stripe", "charges", RUN_ID, part_records=10)
    pack_run(spark, root, packed, "stripe", "charges", RUN_ID, part_bytes=256 << 10)
    return _picked(read_raw(spark, packed, "stripe", "charges", glob=PACKED_GLOB), raw.columns)


@query
def landed_pages_since(spark, sf_dir):
    """Pages read from a cutoff on, which the scan applies."""
    root, raw = _paged_runs(spark, sf_dir)
    return _picked(read_pages(spark, root, "stripe", "charges", since=STRIPE_CUTOFF), raw.columns)


@query
def archived_since(spark, sf_dir):
    """Two runs parsed once into the archive; a cutoff and some fields read from its columns."""
    raw = raw_view(spark, sf_dir, "raw_opportunities")
    root, kept = scratch_path(spark, "raw"), scratch_path(spark, "archive")
    for part_no in (0, 1):
        run_id = f"2024-07-0{part_no + 1}T00-00-00Z"
        land_raw(raw.where(F.col("part_no") == part_no), root, "salesforce", "opportunities", run_id)
        archive(read_raw(spark, root, "salesforce", "opportunities", run_id=run_id), kept, "salesforce", "opportunities", run_id)
    rows = read_archive(spark, kept, "salesforce", "opportunities")
    return picked_since(rows, "salesforce", SALESFORCE_CUTOFF, {c: c for c in ("Id", "Amount", "LastModifiedDate", "part_no")}).drop(*POSITION)


@query
def archived_records(spark, sf_dir):
    """Whole records from the archive, mapped like landed ones."""
    root, kept = scratch_path(spark, "raw"), scratch_path(spark, "archive")
    land_raw(raw_view(spark, sf_dir, "raw_customers"), root, "stripe", "customers", RUN_ID)
    archive(read_raw(spark, root, "stripe", "customers"), kept, "stripe", "customers", RUN_ID)
    records = Records(read_archive(spark, kept, "stripe", "customers"), "record")
    return shown(transform_records(records, "stripe", "customers", INGESTED_AT, position=POSITION).unified, _attributes_of("raw_customers"))


@query
def landed_pages_stream(spark, sf_dir):
    """The same pages as a stream, run by run."""
    root, raw = _paged_runs(spark, sf_dir)
    path = scratch_path(spark, "streamed")
    stream = _picked(stream_pages(spark, root, "stripe", "charges"), raw.columns).writeStream.format("parquet")
    stream.option("checkpointLocation", scratch_path(spark, "checkpoint")).trigger(availableNow=True).start(path).awaitTermination()
    return spark.read.parquet(path)


# --- watermarks and increments ----------------------------------------------------------------


@query
def max_event_time(spark, sf_dir):
    marks = event_time_marks(_all_unified(spark, sf_dir))
    return marks.withColumn("high_water_mark", moment("high_water_mark"))


@query
def watermark_upsert(spark, sf_dir):
    """Newer marks move a resource forward, older ones do not move it back."""
    marks = Watermarks(spark, scratch_path(spark, "watermarks"))
    opportunities = accepted(tagged(spark, sf_dir, "raw_opportunities"))
    charges = accepted(_charges(spark, sf_dir))
    first = event_time_marks(opportunities.drop("part_no").unionByName(charges))
    marks.set(first, "run-1", datetime(2024, 7, 1, tzinfo=timezone.utc))
    older = event_time_marks(target_batch(spark, sf_dir))
    marks.set(older, "run-2", datetime(2024, 7, 2, tzinfo=timezone.utc))
    return marks.read().withColumns({c: moment(c) for c in ("high_water_mark", "updated_at")})


@query
def incremental_filter(spark, sf_dir):
    """Stored marks are the cutoffs of the next pull and of the next read of the processed zone."""
    marks = Watermarks(spark, scratch_path(spark, "watermarks"))
    cutoffs = spark.createDataFrame(
        [("stripe", "charges", STRIPE_CUTOFF), ("salesforce", "opportunities", SALESFORCE_CUTOFF)],
        "source string, resource string, high_water_mark timestamp",
    )
    marks.set(cutoffs, RUN_ID, INGESTED_AT)
    pulled = newer_than(
        raw_records(spark, sf_dir, "raw_opportunities"), "salesforce", marks.get("salesforce", "opportunities")
    ).df.select(F.lit("opportunities").alias("resource"), F.concat_ws("/", "Id", F.col("part_no").cast("string")).alias("id"))
    zone = scratch_path(spark, "processed")
    write_unified(unified(spark, sf_dir, "raw_charges"), zone)
    newer = since(read_unified(spark, zone), "created_at", marks.get("stripe", "charges"))
    return pulled.unionByName(newer.select(F.lit("charges").alias("resource"), F.col("source_id").alias("id")))


@query
def incremental_run(spark, sf_dir):
    """A run, then a later one that brings newer opportunities and no customers, with a change made to the
    table in between: what the later run has not brought keeps that change."""
    zones = Zones(scratch_path(spark, "zones"))
    deals = raw_view(spark, sf_dir, "raw_opportunities")
    customers = raw_records(spark, sf_dir, "raw_customers")
    first = {("salesforce", "opportunities"): Records(deals.where("part_no = 0").drop("part_no")), (STRIPE, "customers"): customers}
    run_all(spark, first, zones, run_id="2024-07-01T00-00-00Z", now=INGESTED_AT, buckets=4, slices=2)
    house = Warehouse(spark, zones.warehouse)
    house.upsert(house.read().where("entity_type = 'customer'").withColumn("status", F.lit("canceled")), decode=False)
    newer = F.lit("2024-02-20T12:00:00.000+0000")
    second = {
        ("salesforce", "opportunities"): Records(deals.where("part_no = 1").drop("part_no").withColumn("LastModifiedDate", newer)),
        (STRIPE, "customers"): customers,
    }
    run_all(spark, second, zones, run_id="2024-07-02T00-00-00Z", now=INGESTED_AT, incremental=True)
    return shown(house.read(), ("stage_name", "description"))


@query
def stream_upsert(spark, sf_dir):
    """The batch arrives as three landed runs and goes through a file stream, some parts per micro-batch."""
    root = scratch_path(spark, "raw")
    raw = raw_view(spark, sf_dir, "raw_charges", spread=False).where(F.col("ordered_on") >= BATCH_FROM)
    succeeded = raw.withColumn("status", F.lit("succeeded"))
    for number in range(3):
        part = succeeded.where(F.pmod(F.xxhash64("id"), F.lit(3)) == number).drop("ordered_on")
        land_raw(part, root, "stripe", "charges", f"2024-07-0{number + 1}T00-00-00Z")
    house = _loaded(spark, sf_dir)
    start_stream(
        spark, root, "stripe", "charges", house, scratch_path(spark, "checkpoint"), INGESTED_AT, files_per_batch=8
    ).awaitTermination()
    return shown(house.read())


def _state_partitions(spark: SparkSession) -> int:
    """Two for a core: what a partition costs to open is paid once more, and a late task delays little."""
    return 2 * spark.sparkContext.defaultParallelism


@query
def stream_newest(spark, sf_dir):
    """Versions arrive one run after the other, most of the second run late, and the first run comes again. The
    state of a key is dropped a day behind the newest change."""
    raw = raw_view(spark, sf_dir, "raw_opportunities", spread=False)
    root, checkpoint = scratch_path(spark, "raw"), scratch_path(spark, "checkpoint")
    house = warehouse(spark)
    for run, version in enumerate((0, 1, 0), 1):
        rows = raw.where(F.col("part_no") == version).drop("part_no")
        land_raw(rows, root, "salesforce", "opportunities", f"2024-07-0{run}T00-00-00Z")
        start_newest(
            spark, root, "salesforce", "opportunities", house, checkpoint, INGESTED_AT, delay="1 day",
            partitions=_state_partitions(spark),
        ).awaitTermination()
    return shown(house.read(), _attributes_of("raw_opportunities"))


@query
def stream_counts(spark, sf_dir):
    """What streams have observed of their micro-batches, added up for each of the five resources."""
    root = scratch_path(spark, "raw")
    counts = StreamCounts()
    spark.streams.addListener(counts)
    rows = []
    try:
        for view, (source, resource) in RESOURCES.items():
            land_raw(raw_view(spark, sf_dir, view, spread=False).drop("ordered_on"), root, source, resource, RUN_ID)
            stream = start_newest(
                spark, root, source, resource, warehouse(spark), scratch_path(spark, "checkpoint"), INGESTED_AT, files_per_batch=3,
                partitions=_state_partitions(spark),
            )
            stream.awaitTermination()
            seen = counts.of(stream).get("tagged", {})
            rows.append((source, resource, *(seen.get(c, 0) for c in ("input", "mapped", "rejected"))))
    finally:
        spark.streams.removeListener(counts)
    return spark.createDataFrame(rows, "source string, source_resource string, input long, mapped long, rejected long")


@query
def end_to_end(spark, sf_dir):
    """All stages from raw records, repeated versions included, to the warehouse, counted by source, entity
    and status."""
    inputs = {}
    for view, key in RESOURCES.items():
        # Versions land in their order, which decides where update times do not.
        order = VERSION_ORDER.get(view, ())
        records = raw_view(spark, sf_dir, view)
        inputs[key] = Records((records.orderBy(*order) if order else records).drop("ordered_on"))
    zones = Zones(scratch_path(spark, "zones"))
    run_all(spark, inputs, zones, run_id=RUN_ID, now=INGESTED_AT, buckets=4, slices=2)
    rows = Warehouse(spark, zones.warehouse).read()
    return rows.groupBy("source", "source_resource", "entity_type", "status").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("amount_minor").alias("total_minor"),
        F.sum("amount").cast("decimal(38,2)").alias("total_amount"),
    )
