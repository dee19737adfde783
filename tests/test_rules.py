"""Each rule against literal cases and against plain Python."""

import random
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.functions import instants, money, text
from tributary.functions.attributes import decode_attributes
from tributary.functions.cells import Records
from tributary.functions.keys import run_date
from tributary.functions.status import resolve_status
from tributary.model import NULL_TOKENS
from tributary.operators.mapping import MAPPINGS


def apply(spark, rule, values):
    """The rule over each value, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, x string").selectExpr("i", f"{rule} AS y")
    return [r["y"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def micros(spark, rule, values):
    return apply(spark, f"unix_micros({rule})", values)


def python_clean(value):
    collapsed = " ".join(value.split())
    return None if collapsed.lower() in NULL_TOKENS else collapsed


def test_null_tokens(spark):
    gone = ["", " N/A ", None, "nan", "-", "--", "null", "na", "None"]
    kept = ["0", "n.a.", "x"]
    assert apply(spark, text.is_missing("x"), gone + kept) == [True] * 9 + [False] * 3


def test_whitespace(spark):
    given_ = ["a  b", "a\x1cb", " a", "a\x85b", "a​b", "  a \t\n b  ", "plain", "a　 b"]
    assert apply(spark, text.clean_string("x"), given_) == [
        "a b", "a b", "a", "a b", "a​b", "a b", "plain", "a b",
    ]


def test_title_case(spark):
    given_ = ["o'brien", "acme-corp llc", "3rd st", "MCDONALD'S", "ǆ straße", None]
    assert apply(spark, text.title_case("x"), given_) == [
        "O'Brien", "Acme-Corp Llc", "3Rd St", "Mcdonald'S", "ǅ Straße", None,
    ]


def test_clean_and_title_match_python(spark):
    rng = random.Random(7)
    alphabet = "aZ'- 3ßǆÉéªº \x1c\x85\t\n.ʰⓐ中/N_"
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 10))) for _ in range(3000)]
    cleaned = apply(spark, text.clean_string("x"), values)
    assert cleaned == [python_clean(v) for v in values]
    titled = apply(spark, text.title_case(f"({text.clean_string('x')})"), values)
    assert titled == [c.title() if c is not None else None for c in cleaned]


@settings(max_examples=15, deadline=None)
@given(values=st.lists(st.text(max_size=12).filter(lambda v: "\x00" not in v and v.isprintable()), min_size=1, max_size=60))
def test_clean_string_on_any_text(spark, values):
    assert apply(spark, text.clean_string("x"), values) == [python_clean(v) for v in values]


def test_currency(spark):
    assert apply(spark, text.standardize_currency("x"), ["usd", " EUR ", "US", "USDX", "u1d", "nan", None]) == [
        "USD", "EUR", None, None, None, None, None,
    ]


def test_minor_to_major(spark):
    for minor, code, expected in (
        ("1299", "USD", "12.99"), ("500", "JPY", "500.00"), ("-1", "USD", None), ("abc", "USD", None),
        ("12.5", "USD", "0.12"), ("1299", "", "12.99"), ("Infinity", "USD", None),
    ):
        (got,) = apply(spark, money.minor_text_to_major("x", f"'{code}'"), [minor])
        assert got == (Decimal(expected) if expected else None), minor


def test_major_to_minor(spark):
    for amount, code, expected in (
        ("0.125", "'USD'", 12), ("0.135", "'USD'", 14), ("900.105", "NULL", 90010), ("5", "'KRW'", 5),
        ("2.5", "'KRW'", 2), ("Infinity", "'USD'", None), ("-1", "'USD'", None), ("1e3", "'USD'", 100000),
        (" 12 ", "'USD'", 1200), ("nan", "'USD'", None), ("1_000", "'USD'", 100000), ("9" * 30, "'USD'", None),
    ):
        assert apply(spark, money.major_to_minor("x", code), [amount]) == [expected], amount


def test_coerce_minor_amount(spark):
    given_ = ["12.0", "12.5", " 12 ", "1e3", "1.0e3", "-5", "", None, "1_000", "abc", "9" * 25, ".5", "12.", "-0"]
    rule = money.coerce_minor_text(f"({text.strip('x')})")
    assert apply(spark, rule, given_) == [12, None, 12, None, 1000, None, None, None, 1000, None, None, None, 12, 0]


def test_coerce_minor_amount_by_json_kind(spark):
    payloads = ["12", "12.0", "12.5", "1e3", "true", '"12"', "-3", "null", "[1]"]
    df = spark.createDataFrame(list(enumerate(payloads)), "i int, j string").selectExpr(
        "i", """parse_json(concat('{"amount":', j, '}')) AS record"""
    )
    picked, cells = Records(df, "record").cells({"amount": ("amount",)})
    rows = picked.selectExpr("i", f"{money.coerce_minor_amount(cells['amount'])} AS y").collect()
    assert [r["y"] for r in sorted(rows)] == [12, 12, None, 1000, None, 12, None, None, None]


EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def python_instant(value):
    """The expected instant in microseconds."""
    t = value.strip()
    if t.replace(".", "", 1).isdigit() and len(t.split(".")[0]) in (10, 13):
        number = float(t)
        moment = datetime.fromtimestamp(number / 1000 if number > 1e11 else number, tz=timezone.utc)
    else:
        try:
            moment = datetime.fromisoformat(t[:-1] + "+00:00" if t[-1:] in ("Z", "z") else t)
        except ValueError:
            return None
        moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    delta = moment - EPOCH
    return (delta.days * 86400 + delta.seconds) * 10**6 + delta.microseconds


def test_instants_match_python(spark):
    dates = ["2024-01-01", "20240101", "2024-02-30", "2024", "2024-1-1", "0000-01-01", "2024-0101"]
    clocks = ["", "T10", "T10:00", " 1000", "t10:00:05", "_100005", "T10:00:05.5", "T10:00:05,123456789",
              "T24:00:00", "T10:60", "T1:00", "T10:0000", "T23:59:59.999999"]
    zones = ["", "Z", "z", "+00:00", "+0530", "-05", "+05:30:15", " UTC", "+5", "-053015"]
    values = [d + c + z for d in dates for c in clocks for z in zones]
    values += ["10:00", "T10:00", "today", "", "1700000000", "1700000000000", "1700000000.5", "17000000000",
               "0000000000123", " 2024-01-01 ", "2024-01-01 10:00:00 UTC", "true"]
    got = micros(spark, instants.parse_instant("x"), values)
    wrong = [(v, g, python_instant(v)) for v, g in zip(values, got) if g != python_instant(v)]
    assert not wrong, wrong[:10]


def test_epoch_range(spark):
    given_ = ["1700000000", "1700000000000", "1e20", "-62135596801", "-1e11", "253402300799", "0", "nan"]
    got = micros(spark, instants.epoch_to_timestamp("TRY_CAST(x AS DOUBLE)"), given_)
    assert got == [1700000000000000, 1700000000000000, None, None, None, 253402300799000, 0, None]


def test_status(spark):
    charges = MAPPINGS["stripe", "charges"]
    deals = MAPPINGS["salesforce", "opportunities"]
    rule = resolve_status(f"({text.clean_string('x')})", charges.status.values, charges.status.otherwise)
    assert apply(spark, rule, [" PENDING ", None, "disputed", "n/a"]) == ["pending", "unknown", "unknown", "unknown"]
    rule = resolve_status("x", deals.status.values, deals.status.otherwise)
    assert apply(spark, rule, ["closed won", "Closed Won", "Mystery"]) == ["unknown", "closed_won", "unknown"]
    assert apply(spark, resolve_status("x", {}, "active"), [None, "odd"]) == ["active", "unknown"]


def test_decode_attributes(spark):
    given_ = ['{"a":1}', "not json", "12 apples", "[1]", None, '{"a":1} {"b":2}', "12"]
    assert apply(spark, decode_attributes("x"), given_) == [
        '{"a":1}', '{"_raw":"not json"}', '{"_raw":"12 apples"}', None, None, '{"_raw":"{\\"a\\":1} {\\"b\\":2}"}', None,
    ]


def test_run_date(spark):
    given_ = ["2024-07-01T00-00-00Z", "20240702-x", "nightly"]
    assert apply(spark, run_date("x", "TIMESTAMP '2025-02-03 00:00:00'"), given_) == ["20240701", "20240702", "20250203"]


@pytest.mark.parametrize("rule", [text.clean_string("x"), instants.parse_instant("x"), text.standardize_currency("x")])
def test_rules_stay_in_generated_code(spark, rule):
    plan = spark.range(10).selectExpr("CAST(id AS STRING) AS x").selectExpr(f"{rule} AS y")
    text_plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "*(1) Project" in text_plan and "Python" not in text_plan
