"""Session helpers: local sessions for tests, and lineage cuts that survive executor loss."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app: str = "tidemark", **conf: str) -> SparkSession:
    """A small local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "12g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A session that runs in one process may leave it unset and gets one temporary folder of its
    own per application. On a cluster an unset folder is an error: every executor would write to
    its own disk, and later reads would miss rows without noticing.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                         f"executors share; master is {master!r}")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_DIRS[app]


def cut_lineages(spark: SparkSession) -> None:
    """Give boosting a folder to cut the lineage of its rounds in, if the session names none.

    Without one MLlib keeps all rounds in the lineage, and some hundreds of them end in a stack
    overflow.
    """
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark).rstrip('/')}/tidemark/rounds")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, never used before."""
    return f"{shared_dir(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and carry on from the written table.

    Used where the same rows feed many later jobs. The copy lives in shared storage, so a lost
    executor costs a re-read and never a recomputation.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rewritten(df: DataFrame, before: str | None = None) -> tuple[DataFrame, str]:
    """``materialise`` for a table that replaces itself: with its path, which the next call takes
    as ``before`` and removes once the new copy lies there."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    if before is not None:
        old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before)
        old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    return spark.read.schema(df.schema).parquet(path), path


def materialise_by(df: DataFrame, column: str) -> DataFrame:
    """Like ``materialise``, in as many buckets of a column as a shuffle has partitions.

    Joins by that column read the buckets as they lie and shuffle the other side alone.
    """
    spark = df.sparkSession
    name = f"tidemark_{uuid.uuid4().hex}"
    (df.repartition(column).write.format("parquet")
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column)
     .option("path", scratch_path(spark, "table")).saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")                    # the name alone, the files stay
    return table


#: Rows that a task is given where their number decides how many tasks there are.
TASK_ROWS = 1 << 18


def tasks_for(spark: SparkSession, rows: int) -> int:
    """As many tasks as keep each at ``TASK_ROWS``; with few rows, no more than there are cores."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, -(-rows // TASK_ROWS), min(cores, -(-rows * 16 // TASK_ROWS)))
