"""Reports, symptoms and vaccines derived from order tables.

Order keys play the report id: an order line gives one symptom row (its part's name) and
one dose row (its part's brand and type). Order lines repeat order keys, so the joins fan
out as they do in the real extracts. NULL flags and ages come from CASE expressions,
because the tables themselves hold none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import Rules

ANALOGUE_RULES = Rules(
    id_col="report_id",
    died_col="died",
    hospital_col="hospital",
    age_cols=("age_given", "age_computed"),
    symptom_col="p_name",
    type_col="p_type",
    maker_col="p_brand",
    target_type_pattern="PROMO",
    target_makers=("BRAND#1", "BRAND#2", "BRAND#3"),
    maker_rules=(
        ("BRAND#1$|BRAND#11", "M1"),
        ("BRAND#2", "M2"),
        ("BRAND#3|BRAND#4|BRAND#5", "M3"),
    ),
    makers=("M1", "M2", "M3"),
    symptom_min_length=7,
    symptom_deny_pattern="ANVIL|ROD",
    symptom_deny_terms=("BLUE RING", "HOT PLATE"),
    curated_deny_pattern="ANVIL|ROD",
)


def tables(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_parts(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Order lines with their part's texts, and further columns of the part if named."""
    table = tables(spark, sf_dir)
    lines = table("lineitem").select(F.col("l_orderkey").alias("report_id"), "l_partkey")
    parts = table("part").select("p_partkey", "p_name", "p_type", "p_brand", *extra)
    return lines.join(parts, lines.l_partkey == parts.p_partkey)


def vaccines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_parts(spark, sf_dir).select("report_id", "p_type", "p_brand")


def symptoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_parts(spark, sf_dir).select("report_id", "p_name")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = tables(spark, sf_dir)
    balance, nation_key = F.col("c_acctbal"), F.col("c_nationkey")
    return (
        table("orders")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table("nation"), nation_key == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("report_id"),
            F.when(F.col("o_orderstatus") == "F", "Y")
            .when(F.col("o_orderstatus") == "O", "N")
            .alias("died"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "Y").alias("hospital"),
            F.when((balance >= 0) & (balance < 9000), balance / 100).alias("age_given"),
            F.when(nation_key < 20, nation_key * F.lit(4.0)).alias("age_computed"),
            F.col("n_name").alias("state"),
            F.date_trunc("month", "o_orderdate").cast("date").alias("report_month"),
        )
    )


def inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Report, symptom and vaccine tables, in the order the operators take them."""
    return reports(spark, sf_dir), symptoms(spark, sf_dir), vaccines(spark, sf_dir)
