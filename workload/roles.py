"""The screening's input tables, derived from the test tables.

| input | from |
|---|---|
| facilities, questionnaire | customer |
| new_spills, old_spills | orders, from / before 1998-07-01 |
| annual_reports | finished or open orders of the highest priority |
| monthly_counts | events, one period per day |
| enforcement | lineitem, one order per line |
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.config import ScreeningConfig

FEED_START = dt.date(1998, 7, 1)

CONFIG = ScreeningConfig(
    analysis_start=dt.date(1996, 1, 1),
    analysis_end=dt.date(2001, 1, 1),
    reporting_start=dt.date(2024, 1, 30),
    reporting_end=dt.date(2024, 1, 31),
    baseline_start=dt.date(2024, 1, 29),
    baseline_end=dt.date(2024, 1, 30),
    excluded_pattern="low",
    order_sequence=("effective_date", "amount", "action_type"),
)


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _category(prefix: str, suffix: str = "") -> Column:
    status = F.col("o_orderstatus")
    number = F.when(status == "F", "1").when(status == "O", "2").otherwise("3")
    return F.concat(F.lit(prefix), number, F.lit(suffix))


def facilities(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    return read(spark, sf, "customer").select(
        key.alias("wdid"),
        F.concat(F.lit("F"), key).alias("facility_id"),
        F.col("c_name").alias("facility_name"),
        F.col("c_nationkey").cast("string").alias("program_category"),
        F.col("c_mktsegment").alias("community_type"),
        F.when(F.col("c_acctbal") < 0, "Y").otherwise("N").alias("federal_facility"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "No").otherwise("Yes").alias("cs_assessment"),
    )


def _spills(orders: DataFrame, category: Column) -> DataFrame:
    return orders.select(
        F.col("o_custkey").cast("string").alias("wdid"),
        F.to_date("o_orderdate").alias("spill_date"),
        category.alias("spill_type"),
        F.col("o_orderpriority").alias("location"),
        F.col("o_orderpriority").alias("status"),
        F.col("o_orderkey").alias("row_no"),
    )


def new_spills(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").where(F.col("o_orderdate") >= F.lit(FEED_START))
    return _spills(orders, _category("Category ", " Spill"))


def old_spills(spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").where(F.col("o_orderdate") < F.lit(FEED_START))
    return _spills(orders, _category("Category "))


def annual_reports(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice")
    gravity = F.when(price < 400000, price / 600)
    return (
        read(spark, sf, "orders")
        .where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") != "P"))
        .select(
            F.col("o_custkey").cast("string").alias("wdid"),
            F.year("o_orderdate").alias("report_year"),
            F.when(price < 450000, price).alias("population"),
            (price / 5000 + gravity).alias("length"),
            F.when(price >= 2000, F.to_date("o_orderdate")).alias("updated"),
            F.col("o_orderkey").alias("row_no"),
        )
    )


def questionnaire(spark: SparkSession, sf: str) -> DataFrame:
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    return read(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("wdid"),
        (balance * 15).alias("population"),
        (balance / 50 + balance / 25).alias("length"),
        F.col("c_custkey").alias("row_no"),
    )


def monthly_counts(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("wdid"),
        F.concat(F.lit("System "), F.expr("user_id div 2").cast("string")).alias("system_name"),
        F.to_date("ts").alias("month"),
        (F.col("event_type") == "error").cast("int").alias("spill_count"),
        (F.col("event_type") == "signup").cast("int").alias("no_spill_cert"),
    )


def enforcement(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("l_partkey").cast("string")
    flag = F.col("l_returnflag")
    kind = F.when(flag == "A", "Notice of Violation").when(flag == "R", "Time Schedule Order")
    return read(spark, sf, "lineitem").select(
        F.concat(F.lit("F"), key).alias("facility_id"),
        key.alias("wdid"),
        F.concat(F.lit("Customer#"), F.lpad(key, 9, "0")).alias("facility_name"),
        F.when(F.col("l_linenumber") == 1, "SSO").otherwise("Other").alias("program_category"),
        F.when(F.col("l_linestatus") == "O", "Active").otherwise("Closed").alias("status"),
        F.when(F.col("l_quantity") >= 25, "Active").otherwise("Closed").alias("status_1"),
        kind.otherwise("Staff Letter").alias("action_type"),
        F.to_date("l_shipdate").alias("effective_date"),
        F.col("l_extendedprice").alias("amount"),
    )


def tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All staged input tables of a screening."""
    return {
        f.__name__: f(spark, sf)
        for f in (
            facilities,
            new_spills,
            old_spills,
            annual_reports,
            questionnaire,
            monthly_counts,
            enforcement,
        )
    }
