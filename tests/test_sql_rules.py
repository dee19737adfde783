"""The rules as SQL functions."""

from tributary.functions.instants import parse_instant
from tributary.functions.keys import new_run_id
from tributary.functions.sql import RULES, register_rules
from tributary.functions.text import clean_string, standardize_currency


def same_plan(a, b):
    plans = [df._jdf.queryExecution().optimizedPlan() for df in (a, b)]
    return plans[0].sameResult(plans[1])


def test_calls_plan_as_the_rules_do(spark):
    assert set(register_rules(spark, "r_")) == {f"r_{name}" for name in RULES}
    rows = spark.createDataFrame([(" N/A ", "usd"), (" a  b ", " eur "), (None, "us"), ("2024-03-01T00:00:00+01:00", None)], "x string, y string")
    for name, rule in (("clean_string", clean_string), ("parse_instant", parse_instant), ("standardize_currency", standardize_currency)):
        called = spark.sql(f"SELECT r_{name}(x) AS v, y FROM {{rows}}", rows=rows)
        assert same_plan(called, rows.selectExpr(f"{rule('x')} AS v", "y")), name
    found = spark.sql("SELECT r_clean_string(x) AS c, r_standardize_currency(y) AS k, r_run_id_of(r_parse_instant(x)) AS i FROM {rows}", rows=rows)
    assert [tuple(r) for r in found.collect()] == [
        (None, "USD", None), ("a b", "EUR", None), (None, None, None), ("2024-03-01T00:00:00+01:00", None, "2024-02-29T23-00-00Z"),
    ]


def test_values_of_each_kind(spark):
    register_rules(spark)
    row = spark.sql("""SELECT is_missing('-') AS a, title_case(' mc  donald ') AS b, currency_exponent('jpy') AS c, minor_units(' 12.0 ') AS d,
        minor_to_major(1250, 'USD') AS e, major_to_minor('12.345', 'USD') AS f, surrogate_key('s', 'e', NULL) AS g,
        run_date('2024-07-01T00-00-00Z', TIMESTAMP '2020-01-01 00:00:00') AS h, decode_attributes('{"b":1') AS i, epoch_to_timestamp(0) AS j""").first()
    assert (row["a"], row["b"], row["c"], row["d"], str(row["e"]), row["f"], row["g"], row["h"]) == (
        True, "Mc Donald", 0, 12, "12.50", 1234, None, "20240701"
    )
    assert row["i"] == '{"_raw":"{\\"b\\":1"}' and row["j"] is not None
    table = spark.sql("SELECT * FROM attributes_of('{\"a\":\"x\",\"b\":2}') ORDER BY name")
    assert [tuple(r) for r in table.collect()] == [("a", "x"), ("b", "2")]
    assert spark.sql("SELECT * FROM attributes_of('no json')").count() == 0


def test_run_ids_agree(spark):
    from datetime import datetime, timezone

    moments = [datetime(2024, 7, 1, 3, 4, 5, 999999, timezone.utc), datetime(2000, 1, 1, tzinfo=timezone.utc)]
    rows = spark.createDataFrame([(m.isoformat(),) for m in moments], "x string")
    register_rules(spark)
    assert [r["i"] for r in rows.selectExpr("run_id_of(parse_instant(x)) AS i").collect()] == [new_run_id(moments[0]), "2000-01-01T00-00-00Z"]
