"""Panels of the anomaly contract from order data: customers by year or month, and users by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions.numeric import rounded

#: Features of the order panels: two levels of ratios over its measures.
FORMULAS = {
    "bank_risk_to_assets": "bank_total_risk / toplam_varlik_ttr",
    "memzuc_limit_utilization": "memzuc_total_risk / memzuc_total_limit",
    "l1y_debt_to_sales": "bank_total_risk / fs_net_sales_cumulative_l1y",
    "internal_returns_to_sales": "returned_amount / fs_net_sales_cumulative_l1y",
    "memzuc_to_bank_risk_ratio": "memzuc_total_risk / bank_total_risk",
}
MEASURES = ("bank_total_risk", "toplam_varlik_ttr", "fs_net_sales_cumulative_l1y", "memzuc_total_limit", "memzuc_total_risk", "returned_amount", "quantity", "n_orders", "rating_group")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customer_panel(spark: SparkSession, sf_dir: str, period: Column) -> DataFrame:
    """Lines are summed by order, and orders by customer and period, before anything is joined to them: what is shuffled are
    numbers, and customers and nations meet one row for each period. A customer who is there twice counts twice."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.sum(net).alias("net"),
            F.sum("l_extendedprice").alias("gross"),
            F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("tax"),
            F.sum("l_quantity").alias("quantity"),
            F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("returned"),
        )
    )
    rating = F.substring("o_orderpriority", 1, 1).cast("double")
    orders = table(spark, sf_dir, "orders").where("o_custkey IS NOT NULL").select("o_orderkey", "o_custkey", period.alias("cohort_dt"), "o_totalprice", rating.alias("rating"))
    sums = ("o_totalprice", "net", "gross", "tax", "returned", "quantity")
    spent = orders.join(lines, "o_orderkey", "left").groupBy("o_custkey", "cohort_dt").agg(*(F.sum(c).alias(c) for c in sums), F.count("*").alias("n"), F.max("rating").alias("rating"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").cast("string").alias("region"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment").join(nations, "c_nationkey")
    customers = customers.groupBy("o_custkey").agg(F.max("c_mktsegment").alias("segment"), F.max("region").alias("region"), F.max("c_acctbal").alias("c_acctbal"), F.count("*").alias("copies"))
    total = lambda c: rounded(F.col(c) * F.col("copies"), 4)
    return spent.join(customers, "o_custkey").select(
        F.col("o_custkey").cast("string").alias("mono_id"),
        "cohort_dt",
        F.col("segment").alias("musteri_segment"),
        F.col("region").alias("cst_nace_code_id"),
        total("o_totalprice").alias("bank_total_risk"),
        F.col("c_acctbal").alias("toplam_varlik_ttr"),
        total("net").alias("fs_net_sales_cumulative_l1y"),
        total("gross").alias("memzuc_total_limit"),
        total("tax").alias("memzuc_total_risk"),
        total("returned").alias("returned_amount"),
        total("quantity").alias("quantity"),
        (F.col("n") * F.col("copies")).cast("double").alias("n_orders"),
        F.col("rating").alias("rating_group"),
    )


def customer_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_panel(spark, sf_dir, F.make_date(F.year("o_orderdate"), F.lit(12), F.lit(31)))


def customer_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_panel(spark, sf_dir, F.last_day(F.to_date("o_orderdate")))


def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by user and day, with what their JSON properties say."""
    k = F.get_json_object("props", "$.k").try_cast("double")
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("mono_id"), F.to_date("ts").alias("cohort_dt")).agg(
        F.count("*").alias("n_events"), rounded(F.sum("value"), 4).alias("total_value"), rounded(F.avg(k), 6).alias("mean_k")
    )
