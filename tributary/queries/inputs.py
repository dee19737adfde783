"""Raw records of the five resources, laid over the given tables.

The text is read by Spark and by the checking SQL engine alike. Dirt is a function of the key, so
results never vary. Every view reads its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.cells import Records

RAW_VIEWS: dict[str, str] = {
    "raw_customers": """
SELECT CASE WHEN c_custkey % 97 = 5 THEN ' ' ELSE 'cus_' || CAST(c_custkey AS STRING) END AS id,
       CASE c_custkey % 11 WHEN 0 THEN ' N/A ' WHEN 1 THEN '  o''brien   ' || lower(c_mktsegment) || '-co ' ELSE lower(c_name) END AS name,
       CASE c_custkey % 13 WHEN 0 THEN ' -- ' ELSE '  User' || CAST(c_custkey AS STRING) || '@Example.COM ' END AS email,
       CASE c_custkey % 7 WHEN 0 THEN CAST(1700000000 + c_custkey * 3600 AS STRING)
                          WHEN 1 THEN CAST((1700000000 + c_custkey * 3600) * 1000 AS STRING)
                          WHEN 2 THEN '2024-03-0' || CAST(1 + c_custkey % 9 AS STRING) || 'T08:30:00.000+0000'
                          WHEN 3 THEN '2024-03-0' || CAST(1 + c_custkey % 9 AS STRING)
                          WHEN 4 THEN '2024-03-0' || CAST(1 + c_custkey % 9 AS STRING) || ' 08:30:00'
                          WHEN 5 THEN '2024-03-0' || CAST(1 + c_custkey % 9 AS STRING) || 'T08:30:00+05:30'
                          ELSE CASE WHEN c_custkey % 2 = 0 THEN 'not-a-date' ELSE '2024' END END AS created,
       c_mktsegment AS description, c_custkey % 2 = 0 AS livemode
FROM {customer}""",
    "raw_charges": """
SELECT 'ch_' || CAST(o_orderkey AS STRING) AS id,
       CASE o_orderkey % 17 WHEN 0 THEN '-5' WHEN 1 THEN '12.0' WHEN 2 THEN '12.5' WHEN 3 THEN 'abc' WHEN 4 THEN NULL
            ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS STRING) END AS amount,
       CASE o_orderkey % 5 WHEN 0 THEN 'usd' WHEN 1 THEN ' EUR ' WHEN 2 THEN 'jpy' WHEN 3 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'US' ELSE 'gbp' END ELSE 'Krw' END AS currency,
       CASE WHEN o_orderkey % 19 = 0 THEN 'disputed' WHEN o_orderkey % 23 = 0 THEN NULL
            WHEN o_orderstatus = 'F' THEN 'succeeded' WHEN o_orderstatus = 'O' THEN ' PENDING ' ELSE 'failed' END AS status,
       'cus_' || CAST(o_custkey AS STRING) AS customer, o_orderpriority AS description,
       CAST(1600000000 + o_orderkey * 60 AS STRING) AS created,
       CAST(o_orderdate AS DATE) AS ordered_on
FROM {orders}""",
    "raw_invoices": """
SELECT 'in_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) AS id,
       'sup_' || CAST(l_suppkey AS STRING) AS customer,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_due,
       CASE WHEN l_linestatus = 'F' THEN CAST(round(l_extendedprice * 100) AS BIGINT) ELSE 0 END AS amount_paid,
       'usd' AS currency,
       CASE l_returnflag WHEN 'A' THEN 'paid' WHEN 'R' THEN 'void' ELSE CASE WHEN l_linestatus = 'O' THEN 'open' ELSE 'draft' END END AS status,
       CAST(CAST(l_shipdate AS DATE) AS STRING) AS created,
       l_shipdate, l_partkey, l_suppkey, l_quantity
FROM {lineitem}""",
    "raw_accounts": """
SELECT 'acc_' || CAST(s_suppkey AS STRING) AS "Id", s_name AS "Name",
       CASE s_suppkey % 4 WHEN 0 THEN 'n/a' ELSE n_name END AS "Industry",
       CASE s_suppkey % 3 WHEN 0 THEN NULL ELSE ' https://s' || CAST(s_suppkey AS STRING) || '.example.org ' END AS "Website",
       '2024-01-0' || CAST(1 + s_suppkey % 9 AS STRING) || 'T00:00:00.000+0000' AS "CreatedDate",
       CASE s_suppkey % 5 WHEN 0 THEN NULL ELSE '2024-02-0' || CAST(1 + s_suppkey % 9 AS STRING) || 'T12:00:00.000+0000' END AS "LastModifiedDate"
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "raw_opportunities": """
SELECT 'opp_' || CAST(p_partkey AS STRING) AS "Id", p_name AS "Name",
       CASE p_partkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '-1' WHEN 2 THEN 'Infinity'
            ELSE CAST(CAST(CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS DECIMAL(18,0)) * 0.010 + 0.005 * v AS DECIMAL(18,3)) AS STRING) END AS "Amount",
       CASE p_partkey % 9 WHEN 0 THEN 'Prospecting' WHEN 1 THEN 'Qualification' WHEN 2 THEN 'Needs Analysis' WHEN 3 THEN 'Proposal/Price Quote'
            WHEN 4 THEN 'Negotiation/Review' WHEN 5 THEN 'Closed Won' WHEN 6 THEN 'Closed Lost' WHEN 7 THEN 'closed won' ELSE 'Mystery' END AS "StageName",
       '2024-06-30' AS "CloseDate", '2024-01-01T00:00:00.000+0000' AS "CreatedDate",
       CASE WHEN v = 1 AND p_partkey % 4 = 0 THEN NULL ELSE '2024-02-0' || CAST(1 + (p_partkey + 4 * v) % 9 AS STRING) || 'T12:00:00.000+0000' END AS "LastModifiedDate",
       v AS part_no
FROM (SELECT p_partkey, p_name, p_retailprice, 0 AS v FROM {part}
      UNION ALL SELECT p_partkey, p_name, p_retailprice, 1 AS v FROM {part}) versions""",
}

# What tells two versions of a record apart besides their update time: later ones win.
VERSION_ORDER = {
    "raw_invoices": ("l_shipdate", "l_partkey"),
    "raw_opportunities": ("part_no",),
}
RESOURCES = {
    "raw_customers": ("stripe", "customers"),
    "raw_charges": ("stripe", "charges"),
    "raw_invoices": ("stripe", "invoices"),
    "raw_accounts": ("salesforce", "accounts"),
    "raw_opportunities": ("salesforce", "opportunities"),
}
_TABLES = ("customer", "orders", "lineitem", "supplier", "nation", "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table a task takes at most, about, and rows that are not worth dealing.
TASK_ROWS, FEW_ROWS = 125_000, 50_000


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table, dealt to all cores by its key. A scan cannot cut a row group, and a file may hold all rows in one,
    while the rules cost far more than the shuffle."""
    rows = table(spark, sf_dir, name)
    n = rows.count()
    if n <= FEW_ROWS:
        return rows
    return rows.repartition(max(spark.sparkContext.defaultParallelism, -(-n // TASK_ROWS)), rows.columns[0])


def raw_view(spark: SparkSession, sf_dir: str, name: str, *, spread: bool = True) -> DataFrame:
    """`spread=False` leaves the rows in the tasks of the scan, so that what is landed of them makes as few parts."""
    sql, read = RAW_VIEWS[name], spread_table if spread else table
    tables = {t: read(spark, sf_dir, t) for t in _TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql.replace('"', "`"), **tables)


def raw_records(spark: SparkSession, sf_dir: str, name: str) -> Records:
    return Records(raw_view(spark, sf_dir, name))


def as_json(df: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each row as one JSON record in a VARIANT column; `keep` passes columns through beside it."""
    fields = [F.col(f"`{c}`") for c in df.columns]
    return df.select(*keep, F.to_variant_object(F.struct(*fields)).alias("record"))


def view_sql(name: str) -> str:
    """The view as the checking engine reads it, where the tables are registered by name."""
    return RAW_VIEWS[name].format(**{t: t for t in _TABLES})
