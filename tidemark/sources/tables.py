"""Declared schemas, scans, sinks and the table pin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The column names of the raw sales extract and of the transaction table.
RAW_SCHEMA = T.StructType([
    T.StructField("InvoiceNo", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.LongType()),
    T.StructField("InvoiceDate", T.TimestampNTZType()),
    T.StructField("UnitPrice", T.DoubleType()),
    T.StructField("CustomerID", T.LongType()),
    T.StructField("Country", T.StringType()),
])

TRANSACTION_COLUMNS = [
    "customer_id", "invoice_no", "invoice_date", "stock_code",
    "quantity", "unit_price", "country", "line_revenue",
]


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet",
             schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Scan the raw extract with its declared schema; malformed CSV lines raise, never vanish."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    return reader.format(fmt).load(path)


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite a Parquet table, optionally partitioned (snapshots go by cutoff)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_transactions(df: DataFrame, path: str) -> None:
    """Store transactions clustered by customer, in date order within each file.

    The rebalance hint lets adaptive execution split a customer too large for one task, which
    a plain repartition by customer could not; the clustering makes every later map-side
    combine by customer nearly complete.
    """
    clustered = df.hint("rebalance", "customer_id").sortWithinPartitions(
        "customer_id", "invoice_date")
    write_table(clustered, path)


def write_report(df: DataFrame, path: str) -> None:
    """CSV sink with a header, for result tables."""
    (df.write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def table_exists(spark: SparkSession, path: str) -> bool:
    """True once a write has committed at ``path``."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def load_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                  force: bool = False, schema=None,
                  write: Callable[[DataFrame, str], None] = write_table) -> DataFrame:
    """Read the stored table, or build and store it. Staleness is not checked; use ``force``."""
    if force or not table_exists(spark, path):
        write(build(), path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row ``(n_rows, hash_sum)`` that does not depend on row order or partitioning."""
    columns = columns or df.columns
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns])
    row_hash = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.coalesce(F.sum(row_hash), F.lit(0)).alias("hash_sum"))


def require_fingerprint(df: DataFrame, n_rows: int, hash_sum: int,
                        columns: list[str] | None = None) -> DataFrame:
    """Return ``df`` if it is the pinned version, else raise."""
    actual = fingerprint(df, columns).first()
    if (actual["n_rows"], actual["hash_sum"]) != (n_rows, hash_sum):
        raise RuntimeError(
            f"fingerprint mismatch: expected {(n_rows, hash_sum)}, "
            f"got {(actual['n_rows'], actual['hash_sum'])}")
    return df
