"""Loosely typed JSON records built by Spark from the driver's tables.

Every document (or supplier) becomes one record line. Which fields are missing, null, quoted,
empty or unreadable follows from its key; ``oracles.py`` states the expected rows in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.registry.adapters import table

FACT_LINES = """
SELECT CASE WHEN doc_id % 97 = 5 THEN concat('{{', line) ELSE line END AS value
FROM (
  SELECT doc_id, concat(
    '{{"sub_id":', CASE doc_id % 50 WHEN 10 THEN 'null' WHEN 11 THEN '0' WHEN 12 THEN '""'
        WHEN 13 THEN '"0"' ELSE CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id AS STRING)
        ELSE concat('"', CAST(doc_id AS STRING), '"') END END,
    CASE doc_id % 31 WHEN 0 THEN '' WHEN 1 THEN ',"contribution_receipt_amount":null'
        WHEN 2 THEN ',"contribution_receipt_amount":"12.5"'
        WHEN 3 THEN ',"contribution_receipt_amount":0'
        WHEN 4 THEN ',"contribution_receipt_amount":"abc"'
        ELSE concat(',"contribution_receipt_amount":', CAST(n_chars AS STRING), '.25') END,
    CASE doc_id % 37 WHEN 0 THEN ',"contribution_receipt_date":null'
        WHEN 1 THEN ',"contribution_receipt_date":""'
        WHEN 2 THEN ',"contribution_receipt_date":"2024-13-45"'
        ELSE concat(',"contribution_receipt_date":"',
             CAST(date_add(DATE '2024-01-01', CAST(doc_id % 300 AS INT)) AS STRING), '"') END,
    CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN ',"is_individual":null'
        WHEN 2 THEN ',"is_individual":false' WHEN 3 THEN ',"is_individual":"false"'
        WHEN 4 THEN ',"is_individual":""' WHEN 5 THEN ',"is_individual":0'
        ELSE ',"is_individual":true' END,
    CASE doc_id % 11 WHEN 0 THEN '' WHEN 1 THEN ',"two_year_transaction_period":null'
        WHEN 2 THEN ',"two_year_transaction_period":"2024"'
        ELSE ',"two_year_transaction_period":2024' END,
    CASE doc_id % 13 WHEN 0 THEN '' WHEN 1 THEN ',"contributor_state":0'
        WHEN 2 THEN ',"contributor_state":"0"' WHEN 3 THEN ',"contributor_state":null'
        ELSE concat(',"contributor_state":"', lang, '"') END,
    ',"unknown_field":[1,{{"a":2}}],',
    substring(to_json(named_struct('committee_id', source, 'memo_text', text)), 2)
  ) AS line
  FROM {documents}
)
"""

COMMITTEE_LINES = """
SELECT concat(
  '{{', CASE s_suppkey % 9 WHEN 0 THEN '' WHEN 1 THEN '"committee_id":null,'
       WHEN 2 THEN '"committee_id":"",'
       ELSE concat('"committee_id":"', CAST(s_suppkey AS STRING), '",') END,
  CASE s_suppkey % 5 WHEN 0 THEN '"party":null,' WHEN 1 THEN '"party":"DFL",'
       WHEN 2 THEN '' ELSE '"party":"XYZ",' END,
  CASE s_suppkey % 4 WHEN 0 THEN '"first_file_date":"",' WHEN 1 THEN '"first_file_date":null,'
       WHEN 2 THEN '' ELSE '"first_file_date":"1999-12-31",' END,
  substring(to_json(named_struct('name', s_name, 'state', CAST(s_nationkey AS STRING))), 2)
) AS value
FROM {supplier}
"""


def fact_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FACT_LINES, documents=table(spark, sf_dir, "documents"))


def committee_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(COMMITTEE_LINES, supplier=table(spark, sf_dir, "supplier"))
