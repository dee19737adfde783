"""The unified schema and the fixed vocabularies shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# Sources and entity types.
STRIPE = "stripe"
SALESFORCE = "salesforce"
SOURCES = (STRIPE, SALESFORCE)

CUSTOMER = "customer"
TRANSACTION = "transaction"
OPPORTUNITY = "opportunity"
ENTITY_TYPES = (CUSTOMER, TRANSACTION, OPPORTUNITY)

# The normalized record statuses.
STATUSES = (
    "active", "pending", "succeeded", "failed", "refunded", "canceled",
    "paid", "open", "closed_won", "closed_lost", "unknown",
)
UNKNOWN_STATUS = "unknown"

# Text that stands for a missing value, compared trimmed and in lower case.
NULL_TOKENS = ("", "null", "none", "nan", "n/a", "na", "-", "--")

# Currencies without a minor unit.
ZERO_DECIMAL_CURRENCIES = (
    "BIF", "CLP", "DJF", "GNF", "JPY", "KMF", "KRW", "MGA",
    "PYG", "RWF", "UGX", "VND", "VUV", "XAF", "XOF", "XPF",
)

# Keys that mark an object as an envelope around a payload.
ENVELOPE_MARKERS = ("source", "resource", "external_id", "extracted_at")

AMOUNT_TYPE = T.DecimalType(18, 2)

# The unified schema.
UNIFIED_SCHEMA = T.StructType([
    T.StructField("unified_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("source_resource", T.StringType(), False),
    T.StructField("source_id", T.StringType(), False),
    T.StructField("entity_type", T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("amount_minor", T.LongType()),
    T.StructField("amount", AMOUNT_TYPE),
    T.StructField("status", T.StringType(), False),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("ingested_at", T.TimestampType(), False),
    T.StructField("attributes", T.StringType()),
])
UNIFIED_COLUMNS = UNIFIED_SCHEMA.fieldNames()

# Columns the warehouse refuses to leave empty. Text columns must also be non-blank.
REQUIRED_KEYS = ("unified_id", "source", "source_resource", "source_id")
REQUIRED_COLUMNS = (*REQUIRED_KEYS, "entity_type", "status", "created_at", "ingested_at")
