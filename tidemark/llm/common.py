"""Reading, hold-out and clean-up shared by the text operators."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a missing doc_id where ids are ordered: before every other id.
NULL_ID = -(1 << 63)
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def return_freed_memory() -> None:
    """Make this process give freed blocks of a megabyte and more back to the system at once.

    Workers are used again by later stages; what one stage held for its batches would otherwise
    stay with them. Where the C library has no such switch, nothing changes.
    """
    try:
        library = ctypes.CDLL("libc.so.6")
        trim_from, map_from = -1, -3               # M_TRIM_THRESHOLD, M_MMAP_THRESHOLD
        library.mallopt(map_from, 1 << 20)
        library.mallopt(trim_from, 1 << 20)
    except (OSError, AttributeError):
        return
    pa.set_memory_pool(pa.system_memory_pool())


# Operators import this module in every worker.
return_freed_memory()


#: Bytes of rows that go to a Python worker at once, unless the session asks for fewer.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From now on, batches between executors and Python workers hold ``BATCH_BYTES`` at most.

    Spark's own bound is 64 MB. For each task an executor needs buffers of up to twice that outside
    its heap, and the worker holds batches of that size as well. No result depends on it. A row
    that is larger makes a batch of its own.
    """
    jvm = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
    now = spark.conf.get(_BATCH, None)
    if now is None or not 0 < jvm.byteStringAsBytes(now) <= BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns every text operator needs; a null text is the empty text."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows whose labels must not be learned: crc32 of the id as text leaves 2 modulo 4."""
    if isinstance(doc_id, str):
        doc_id = F.col(doc_id)
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_labels(labels: DataFrame, column: str, rows: int, seed: int) -> DataFrame:
    """At most ``rows`` labelled ids per class that may be learned from.

    Ids with several different labels count with the smallest. The choice is by a hash of the
    id, so it is the same in every run and on every cluster.
    """
    from pyspark.sql import Window

    usable = (labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
              .where(~held_out("doc_id"))
              .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
              .agg(F.min(column).cast("int").alias("label"))
              .withColumn("_order", F.xxhash64(F.lit(seed), "doc_id")))
    classes = [usable.where(F.col("label") == k).orderBy("_order", "doc_id").limit(rows)
               for k in (0, 1)]
    return classes[0].unionByName(classes[1]).select("doc_id", "label")
