"""Claim tables derived from the TPC-H-like test tables.

An order is an invoice, a line item a claim item, a part a provider, a customer a
member and a region a partner. Amounts are fixed-point, so sums are exact. Rows are created
when they ship, ingested up to 18 hours before or six after, and updated within an hour of
midnight or of ten; one in some eighty has no item, invoice, provider, member or agent.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgauge.functions.expressions import money
from claimgauge.schemas import PENDING, SHARED_INVOICE, SUBMITTED_OK

# Event time of the single-run queries, and the look-back that gives them data.
AS_OF = "2001-06-15 10:30:00"
RUN_ID = "20012"
LOOKBACK_DAYS = 30
BATCH_DAYS = 7


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def claims(spark: SparkSession, sf_dir: str, orders: bool = False, partner: bool = False,
           agent: bool = False) -> DataFrame:
    """Claim items; the flags join the columns that come from other tables."""
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
        F.col("l_orderkey").alias("invoice_id"),
        F.col("l_partkey").alias("provider_id"),
        money("l_extendedprice").alias("paid_value"),
        (money("l_extendedprice") * (1 + F.col("l_tax").cast("decimal(4,2)")))
        .cast("decimal(18,4)").alias("reported_value"),
        (money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)"))
        .cast("decimal(18,4)").alias("saving_value"),
        (F.col("l_shipdate") + F.make_dt_interval(hours=(F.col("l_orderkey") % 5 - 3) * 6)
         ).alias("ingested_at"),
        F.col("l_shipdate").alias("created_at"),
        (F.col("l_shipdate") + F.make_dt_interval(
            hours=F.col("l_suppkey") % 2 * 10, mins=F.col("l_partkey") % 60)).alias("updated_at"),
        (F.col("l_linestatus") == "F").alias("processable"),
        "l_returnflag", "l_linenumber", "l_suppkey", "l_tax",
    )
    if agent:
        part = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("provider_id"), F.col("p_brand").alias("agent_id"))
        rows = rows.join(part, "provider_id")
    if orders or partner:
        heads = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("invoice_id"), F.col("o_custkey").alias("member_id"),
            "o_orderstatus")
        if partner:
            heads = heads.join(partners(spark, sf_dir), "member_id")
        rows = rows.join(heads, "invoice_id")
    invoice, provider = F.col("invoice_id"), F.col("provider_id")
    given = {"item_id": F.col("item_id") % 97 != 0, "invoice_id": invoice % 89 != 0,
             "provider_id": provider % 83 != 0, "member_id": F.col("member_id") % 79 != 0,
             "agent_id": provider % 71 != 0}
    return rows.withColumn("order_id", invoice).withColumns({
        c: F.when(holds, F.col(c)) for c, holds in given.items() if c in rows.columns})


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partner of each member."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    where = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("partner"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return customer.join(where, "c_nationkey").select(
        F.col("c_custkey").alias("member_id"), "partner")


STATUS_BY_LINE = {
    1: "SENT_FOR_VALIDATION", 2: "NOT_SENT_FOR_VALIDATION", 3: "APPROVED",
    4: "SUBMITTED_SUCCESS", 5: "EXPIRED", 6: "DENIED",
}


def validation(rows: DataFrame) -> DataFrame:
    """Claims as validation rows: status by line number, reason by return flag."""
    status = reduce(
        lambda done, item: done.when(F.col("l_linenumber") == item[0], item[1]),
        list(STATUS_BY_LINE.items())[1:], F.when(F.col("l_linenumber") == 1, PENDING),
    ).otherwise(F.when(F.col("l_suppkey") % 4 != 0, "EXCLUDED"))
    reason = F.when(F.col("l_returnflag") == "R", SHARED_INVOICE).when(
        F.col("l_returnflag") == "N", "OTHER")
    return rows.withColumn("status", status).withColumn("filtered_reason", reason)


def submitted(rows: DataFrame) -> DataFrame:
    """Claims with tax of 4 % or more as submitted rows, one run per quarter; some have no
    status."""
    status = (F.when(F.col("order_id") % 53 == 0, None)
              .when(F.col("o_orderstatus") == "F", SUBMITTED_OK)
              .when(F.col("o_orderstatus") == "O", "SUBMITTED_ERROR").otherwise("RETRY"))
    quarter = F.year("created_at") * 10 + F.quarter("created_at")
    return rows.where(F.col("l_tax") >= 0.04).withColumn("status", status).withColumn(
        "submission_run_id", quarter.cast("string"))


def selected(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("l_suppkey") % 3 == 0)


def batch(rows: DataFrame) -> DataFrame:
    """The rows of the week before the event."""
    end = as_of()
    start = end - F.make_dt_interval(days=F.lit(BATCH_DAYS))
    return rows.where((F.col("created_at") > start) & (F.col("created_at") <= end))
