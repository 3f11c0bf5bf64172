"""Transaction tables over the provided star schema and event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import SnapshotSettings
from tidemark.functions.scalars import round_half_even

# Monthly cutoffs inside the order history; the last two are the holdout.
ORDER_CUTOFFS = (
    "2000-11-01", "2000-12-01", "2001-01-01", "2001-02-01", "2001-03-01",
    "2001-04-01", "2001-05-01", "2001-06-01", "2001-07-01",
)
ORDER_DEV, ORDER_HOLDOUT = ORDER_CUTOFFS[:7], ORDER_CUTOFFS[7:]
HOME = "NATION_0"
ORDER_SETTINGS = SnapshotSettings(ORDER_CUTOFFS, horizon_days=30, min_history_days=30,
                                  home_market=HOME)
EVENT_SETTINGS = SnapshotSettings(("2024-01-15", "2024-01-22T09:30:00"), horizon_days=1,
                                  min_history_days=3, home_market=HOME)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line, order, customer and nation joined; small sides are left to the size-based choice.
    Orders meet their customers first, so that lines travel once."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = (
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        .join(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
              F.col("c_nationkey") == F.col("n_nationkey")))
    placed_orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return lines.join(placed_orders, F.col("l_orderkey") == F.col("o_orderkey"))


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transaction table of the order schema."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return order_lines(spark, sf_dir).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").cast("string").alias("invoice_no"),
        F.col("o_orderdate").alias("invoice_date"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        price.alias("unit_price"),
        F.col("n_name").alias("country"),
        round_half_even(F.col("l_quantity") * price, 2).alias("line_revenue"))


def dirty_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw extract with cancellations, copies, fee lines, unknown customers and padded codes."""
    lines = order_lines(spark, sf_dir).join(
        table(spark, sf_dir, "part").select("p_partkey", "p_type"),
        F.col("l_partkey") == F.col("p_partkey"))
    code = F.when(F.col("p_type") == "ECONOMY", F.lit("POST")) \
        .otherwise(F.col("l_partkey").cast("string"))
    # Read from the lines once: a first line comes with its copy.
    line = F.concat(F.lit("line "), F.col("l_linenumber").cast("string"))
    named = F.when(F.col("l_linenumber") == 1, F.array(line, F.lit("copy"))) \
        .otherwise(F.array(line))
    return lines.select(
        F.concat(F.when(F.col("l_returnflag") == "R", "C").otherwise(""),
                 F.col("o_orderkey").cast("string")).alias("InvoiceNo"),
        F.when(F.col("l_linenumber") == 2, F.concat(F.lit("\t"), code, F.lit(" ")))
        .otherwise(code).alias("StockCode"),
        F.explode(named).alias("Description"),
        F.col("l_quantity").cast("bigint").alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("UnitPrice"),
        F.when(F.col("o_orderkey") % 20 != 0, F.col("o_custkey")).alias("CustomerID"),
        F.col("n_name").alias("Country"))


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of the event stream: sub-second times, one line per invoice."""
    return (
        table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
        .select(F.col("user_id").alias("customer_id"),
                F.col("event_id").cast("string").alias("invoice_no"),
                F.col("ts").alias("invoice_date"),
                F.col("event_type").alias("stock_code"),
                F.lit(1).cast("bigint").alias("quantity"),
                F.col("value").alias("unit_price"),
                F.lit(HOME).alias("country"),
                round_half_even("value", 2).alias("line_revenue")))


def session_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as lines of one invoice per user and five-day spell, so that invoices straddle
    cutoffs; every 17th event has no invoice, and the market changes with the event type."""
    events = table(spark, sf_dir, "events")
    spell = F.floor(F.dayofyear("ts") / 5).cast("string")
    return events.select(
        F.col("user_id").alias("customer_id"),
        F.when(F.col("event_id") % 17 != 0,
               F.concat_ws("-", F.col("user_id").cast("string"), spell)).alias("invoice_no"),
        F.col("ts").alias("invoice_date"),
        F.concat_ws("-", F.col("event_type"), (F.col("event_id") % 4).cast("string"))
        .alias("stock_code"),
        (F.col("event_id") % 5 + 1).alias("quantity"),
        F.col("value").alias("unit_price"),
        F.when(F.col("event_type") == "click", F.lit(HOME))
        .otherwise(F.concat(F.lit("NATION_"), (F.col("event_id") % 3).cast("string")))
        .alias("country"),
        round_half_even((F.col("event_id") % 5 + 1) * F.col("value"), 2).alias("line_revenue"))
