"""The driver's tables seen as campaign-finance tables.

Each adapter is one SELECT that Spark and DuckDB both accept. No source row is left out; the
awkward cases (later versions, unknown and empty committees, missing values, negative amounts,
changed dates) are derived from the row's own key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tributary.options import Options

# The driver's amounts are whole cents and its times carry no zone.
OPTIONS = Options(amount_type="decimal(18,2)", average_type="double",
                  loaded_at_type="timestamp_ntz")

# Fixed "today" for rules about future dates; the order dates run to 2001-08-01.
AS_OF = dt.date(2001, 6, 30)
NOW = dt.datetime(2001, 8, 5, 12, 45)

# Raw facts from orders: every order, plus a later version of the pending ones.
CONTRIBUTIONS = """
SELECT CASE WHEN o_orderkey % 907 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS sub_id,
       CASE WHEN o_orderkey % 23 = 0 THEN concat('X', CAST(o_custkey AS STRING))
            WHEN o_orderkey % 301 = 0 THEN ''
            ELSE CAST(o_custkey AS STRING) END AS committee_id,
       concat('Donor#', CAST(o_orderkey % 997 AS STRING)) AS contributor_name,
       concat('City', CAST(o_custkey % 50 AS STRING)) AS contributor_city,
       CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE o_orderpriority END AS contributor_state,
       CAST(10000 + o_orderkey % 9000 AS STRING) AS contributor_zip,
       o_orderstatus AS contributor_employer,
       concat('Clerk ', o_orderstatus) AS contributor_occupation,
       CASE WHEN o_orderkey % 911 = 0 THEN NULL
            WHEN o_orderkey % 41 = 0 THEN -o_totalprice
            ELSE o_totalprice END AS contribution_receipt_amount,
       CAST(o_orderdate AS DATE) AS contribution_receipt_date,
       '15' AS receipt_type,
       o_orderpriority AS memo_text,
       o_orderkey % 13 <> 0 AS is_individual,
       CAST(year(o_orderdate) + year(o_orderdate) % 2 AS BIGINT) AS two_year_transaction_period,
       'IND' AS entity_type,
       o_orderdate + INTERVAL 1 DAY AS _loaded_at
FROM {orders}
UNION ALL
SELECT CAST(o_orderkey AS STRING),
       CAST(o_custkey AS STRING),
       concat('Donor#', CAST(o_orderkey % 997 AS STRING)),
       concat('City', CAST(o_custkey % 50 AS STRING)),
       o_orderpriority,
       CAST(10000 + o_orderkey % 9000 AS STRING),
       o_orderstatus,
       concat('Clerk ', o_orderstatus),
       o_totalprice + 10,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL
            WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate + INTERVAL 1 DAY AS DATE)
            ELSE CAST(o_orderdate AS DATE) END,
       '15',
       'amended',
       true,
       CAST(year(o_orderdate) + year(o_orderdate) % 2 AS BIGINT),
       'IND',
       o_orderdate + INTERVAL 3 DAY
FROM {orders} WHERE o_orderstatus = 'P'
"""

# Raw dimension from customer and nation: every customer, plus a later version of those in debt.
COMMITTEES = """
SELECT CAST(c_custkey AS STRING) AS committee_id,
       c_name AS name,
       CASE WHEN c_custkey % 10 = 3 THEN substring(c_mktsegment, 1, 3)
            WHEN c_custkey % 10 = 4 THEN ' dfl '
            WHEN c_custkey % 10 = 5 THEN 'lib'
            WHEN c_custkey % 10 = 6 THEN NULL
            ELSE substring(c_mktsegment, 1, 3) END AS party,
       CASE WHEN c_custkey % 10 IN (3, 4, 5) THEN ''
            WHEN c_custkey % 10 = 6 THEN NULL
            WHEN c_mktsegment = 'AUTOMOBILE' THEN 'DEMOCRATIC PARTY'
            WHEN c_mktsegment = 'BUILDING' THEN ' REPUBLICAN PARTY'
            WHEN c_mktsegment = 'FURNITURE' THEN 'GREEN PARTY'
            ELSE c_mktsegment END AS party_full,
       n_name AS state,
       'U' AS designation,
       'Unauthorized' AS designation_full,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE 'Q' END AS committee_type,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE 'PAC - Qualified' END AS committee_type_full,
       CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE concat('Treasurer of ', c_name) END
         AS treasurer_name,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE DATE '1990-01-01' END AS first_file_date,
       TIMESTAMP '2001-08-01 00:00:00' + INTERVAL 1 HOUR AS _loaded_at
FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL
SELECT CAST(c_custkey AS STRING),
       CASE WHEN c_custkey % 2 = 0 THEN '' ELSE concat(c_name, ' amended') END,
       substring(c_mktsegment, 1, 3), c_mktsegment, n_name, 'U', 'Unauthorized', 'Q',
       'PAC - Qualified', NULL, DATE '1991-02-03',
       TIMESTAMP '2001-08-02 00:00:00' + INTERVAL 2 HOUR
FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey
WHERE c_acctbal < 0
"""

# Load time that separates the first load from the second in the event feed.
FIRST_LOAD_END = dt.datetime(2024, 1, 20)

# Raw facts from events: every event, plus late versions of early errors; some change their date.
FEED = """
SELECT CAST(event_id AS STRING) AS sub_id,
       CAST(user_id AS STRING) AS committee_id,
       props AS contributor_name,
       event_type AS contributor_state,
       value AS contribution_receipt_amount,
       CAST(ts AS DATE) AS contribution_receipt_date,
       ts AS _loaded_at
FROM {events}
UNION ALL
SELECT CAST(event_id AS STRING), CAST(user_id AS STRING), props, event_type, value + 1,
       CASE WHEN event_id % 5 = 0 THEN CAST(ts + INTERVAL 1 DAY AS DATE)
            ELSE CAST(ts AS DATE) END,
       ts + INTERVAL 20 DAY
FROM {events} WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-20 00:00:00'
"""

# Shipped lines as facts of a supplier dimension.
SHIPMENTS = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_returnflag,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_shipdate AS DATE) AS ship_date,
       l_shipdate
FROM {lineitem}
"""


# Columns of the driver's tables; declared, so that opening a table starts no inference job.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CONTRIBUTIONS, orders=table(spark, sf_dir, "orders"))


def committees(spark: SparkSession, sf_dir: str) -> DataFrame:
    ntz = COMMITTEES.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    return spark.sql(ntz, customer=table(spark, sf_dir, "customer"),
                     nation=table(spark, sf_dir, "nation"))


# Staging columns the event feed does not carry.
FEED_BLANKS = ["contributor_city", "contributor_zip", "contributor_employer",
               "contributor_occupation", "receipt_type", "entity_type"]


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ntz = FEED.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    rows = spark.sql(ntz, events=table(spark, sf_dir, "events"))
    return rows.selectExpr(
        "*", *[f"'' AS {c}" for c in FEED_BLANKS],
        "true AS is_individual", "2024L AS two_year_transaction_period",
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SHIPMENTS, lineitem=table(spark, sf_dir, "lineitem"))


def for_sql(adapter: str) -> str:
    """Adapter text with plain table names, for the SQL side."""
    return adapter.format(orders="orders", customer="customer", nation="nation",
                          events="events", lineitem="lineitem")
