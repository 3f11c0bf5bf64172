"""Digests per partition: what changed in a table, and rebuilding no more than that.

A digest is a row count and two sums of row hashes, so digests of disjoint rows add up: lines that
are appended need no look at the lines before them. Comparing two sets of digests names the
partitions that differ, and a table derived partition by partition is rebuilt only there.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Digest(NamedTuple):
    rows: int = 0
    low: int = 0
    high: int = 0

    def __add__(self, other: Digest) -> Digest:
        return Digest(*(a + b for a, b in zip(self, other)))


def partition_digests(df: DataFrame, part: Column, columns: list[str] | None = None) -> DataFrame:
    """(part, n_rows, low_sum, high_sum) per value of ``part``, whatever the order of rows.

    The sums are over the two halves of a row's md5, in decimals that no number of rows fills.
    """
    columns = columns or df.columns
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns])

    def total(start: int) -> Column:
        half = F.conv(F.substring("_hash", start, 8), 16, 10).cast("decimal(20,0)")
        return F.sum(half).cast("decimal(38,0)")

    return (df.select(part.cast("string").alias("part"), F.md5(text).alias("_hash"))
            .groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"),
                                 total(1).alias("low_sum"), total(9).alias("high_sum")))


def collected(digests: DataFrame) -> dict[str, Digest]:
    """The digests on the driver: one small row per partition of the table."""
    return {r["part"]: Digest(r["n_rows"], int(r["low_sum"]), int(r["high_sum"]))
            for r in digests.collect()}


def changed_parts(before: DataFrame, after: DataFrame) -> DataFrame:
    """(part, change) of the partitions that were added, removed or changed."""
    old, new = before.alias("old"), after.alias("new")
    joined = old.join(new, F.col("old.part").eqNullSafe(F.col("new.part")), "full_outer")
    same = [F.col(f"old.{c}") == F.col(f"new.{c}") for c in ("n_rows", "low_sum", "high_sum")]
    change = (F.when(F.col("old.n_rows").isNull(), "added")
              .when(F.col("new.n_rows").isNull(), "removed")
              .when(~(same[0] & same[1] & same[2]), "changed"))
    return (joined.select(F.coalesce("new.part", "old.part").alias("part"),
                          change.alias("change"))
            .filter(F.col("change").isNotNull()))


# ---------------------------------------------------------------------------------------------
# Notes: small numbered records beside a table; the last complete one counts
# ---------------------------------------------------------------------------------------------
def _folder(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def delete_path(spark: SparkSession, path: str) -> None:
    system, place = _folder(spark, path)
    system.delete(place, True)


def read_note(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Number and content of the last note, or (0, {})."""
    system, place = _folder(spark, path)
    if not system.exists(place):
        return 0, {}
    numbers = [int(f.getPath().getName()) for f in system.listStatus(place)
               if system.exists(_folder(spark, f"{path}/{f.getPath().getName()}/_SUCCESS")[1])]
    if not numbers:
        return 0, {}
    lines = spark.read.text(f"{path}/{max(numbers)}").collect()
    return max(numbers), json.loads(lines[0]["value"])


def write_note(spark: SparkSession, path: str, content: dict) -> None:
    number, _ = read_note(spark, path)
    text = spark.createDataFrame([(json.dumps(content),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{path}/{number + 1}")


# ---------------------------------------------------------------------------------------------
# Read, or rebuild what changed
# ---------------------------------------------------------------------------------------------
class Refreshed(NamedTuple):
    table: DataFrame
    rebuilt: list[str]          # names of the partitions that were built


def _directory(part: str | None) -> str:
    return f"part={part}"


def refresh_table(spark: SparkSession, path: str, source: DataFrame, source_part: Column,
                  build: Callable[[DataFrame], DataFrame], table_part: Column,
                  columns: list[str] | None = None) -> Refreshed:
    """Bring the table at ``path`` up to date with ``source`` and read it.

    ``source_part`` names the partition of a source row and ``table_part`` that of a row of the
    table; ``build`` derives the rows of a partition from the source rows of the same one alone.
    Names are text without a slash; rows without one belong to the partition ``none``. Only
    partitions whose digest differs from the stored one are rebuilt, the others keep their
    files. A run that breaks off leaves the partitions it was at without a stored digest, so
    the next run builds them.
    """
    name = F.coalesce(source_part.cast("string"), F.lit("none"))
    now = collected(partition_digests(source, name, columns))
    _, stored = read_note(spark, f"{path}/notes")
    before = {part: Digest(*values) for part, values in stored.items()}
    rebuilt = sorted(p for p in before.keys() | now.keys() if before.get(p) != now.get(p))
    if rebuilt or not stored:
        kept = {p: d for p, d in before.items() if p not in rebuilt}
        write_note(spark, f"{path}/notes", kept)
        for part in rebuilt:
            delete_path(spark, f"{path}/rows/{_directory(part)}")
        rows = build(source.filter(name.isin(rebuilt))).withColumn(
            "part", F.coalesce(table_part.cast("string"), F.lit("none")))
        rows.write.mode("append").partitionBy("part").parquet(f"{path}/rows")
        write_note(spark, f"{path}/notes", now)
    schema = build(source.limit(0)).withColumn("part", F.lit("")).schema
    return Refreshed(spark.read.schema(schema).parquet(f"{path}/rows"), rebuilt)


def total(digests: Iterable[Digest]) -> Digest:
    return sum(digests, Digest())
