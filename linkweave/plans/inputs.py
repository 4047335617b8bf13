"""The given tables, seen as action logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.operators import prefs

# Roles of the two logs.
EVENT_ROLES = ("purchase", "view")
ORDER_ROLES = ("N", "R")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense log: (user_id, action, item_id, event_id, ts, value)."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "user_id",
        F.col("event_type").alias("action"),
        F.get_json_object("props", "$.k").cast("int").alias("item_id"),
        "event_id",
        "ts",
        "value",
    )


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse log (user_id, action, item_id, ts, quantity), from order lines and customers."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_returnflag").alias("action"),
        F.col("l_partkey").alias("item_id"),
        F.col("o_orderdate").alias("ts"),
        F.col("l_quantity").alias("quantity"),
    )


def part_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("category")
    )


def event_history(spark: SparkSession, sf_dir: str, action: str = EVENT_ROLES[0]) -> DataFrame:
    return prefs.history_matrix(prefs.primary_prefs(event_log(spark, sf_dir), action))


def order_history(spark: SparkSession, sf_dir: str, action: str = ORDER_ROLES[0]) -> DataFrame:
    return prefs.history_matrix(prefs.primary_prefs(order_log(spark, sf_dir), action))


def order_values(spark: SparkSession, sf_dir: str, action: str = ORDER_ROLES[0]) -> DataFrame:
    """Valued preferences: the greatest quantity of an item that a user has ordered."""
    chosen = order_log(spark, sf_dir).where(F.col("action") == action)
    return prefs.valued_matrix(chosen, "quantity")
