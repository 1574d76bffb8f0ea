"""Shared helpers: batch bounds, table access, the cluster's shared folder, cut points."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}
_own_dir: dict[str, str] = {}


def bound_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of at most 500 rows, and of one row beyond 16 MiB."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the one named by ``spark.checkpoint.dir``. Only a local session
    without that setting (tests) gets a folder of its own.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        _own_dir[app] = "file://" + tempfile.mkdtemp(prefix="tessella-")
    return _own_dir[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The lineage ends at the written table: a lost executor costs the tasks it
    was running, never the stages before the cut.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_text(col: Column) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(col.cast("string"), F.lit(""))


def partitions_for(rows: int, rows_each: int) -> int:
    return max(1, -(-rows // rows_each))
