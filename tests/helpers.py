"""Small hand-made tables."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tributary.schemas import RAW_COMMITTEES, RAW_FACTS, ddl

DAY = dt.date(2024, 3, 1)
T0 = dt.datetime(2024, 3, 2)


def fact(sub_id, committee="C1", amount=10.0, day=DAY, loaded=T0, state="OR", name="A", **more):
    row = {c: "" for c in RAW_FACTS}
    row |= {"sub_id": sub_id, "committee_id": committee, "contribution_receipt_amount": amount,
            "contribution_receipt_date": day, "_loaded_at": loaded, "contributor_state": state,
            "contributor_name": name, "is_individual": True, "two_year_transaction_period": 2024}
    return row | more


def committee(cid, name="Name", party="DEM", party_full="DEMOCRATIC PARTY", loaded=T0, **more):
    row = {c: "" for c in RAW_COMMITTEES}
    row |= {"committee_id": cid, "name": name, "party": party, "party_full": party_full,
            "first_file_date": None, "_loaded_at": loaded}
    return row | more


def facts(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in RAW_FACTS) for r in rows], ddl(RAW_FACTS))


def committees(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in RAW_COMMITTEES) for r in rows],
                                 ddl(RAW_COMMITTEES))


def lines(spark, records):
    texts = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(texts, "value string")


def summary(spark, rows):
    """(committee_id, name, party, party_full, contributions, raised)."""
    return spark.createDataFrame(
        rows, "committee_id string, committee_name string, party string, party_full string, "
              "total_contributions bigint, total_raised decimal(18,2)")


def dicts(df):
    return [r.asDict() for r in df.collect()]


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def lit_time(value):
    return F.lit(value)
