"""Derived tables as Parquet snapshots: written once, then only read.

A snapshot is never overwritten in place: a new one goes to a new folder, and readers
take the path they were given. What was read to build it stays readable meanwhile.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.session import require_utc, shared_dir


def write_snapshot(df: DataFrame, root: str, name: str) -> DataFrame:
    """Write `df` to a fresh folder under `root` and read it back."""
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_plays(plays: DataFrame, root: str, name: str = "unified_plays") -> DataFrame:
    """A snapshot of plays partitioned by month, so that recent windows read recent months.

    The rebalance hint lets AQE split a month that holds most of the plays and join up
    months that hold few: files of even size, without a chosen number of partitions.
    """
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    dated = plays.withColumn("month", F.date_format("played_at", "yyyy-MM"))
    dated.hint("rebalance", "month").write.mode("errorifexists").partitionBy("month").parquet(path)
    return plays.sparkSession.read.schema(dated.schema).parquet(path)


def settle_plays(plays: DataFrame) -> DataFrame:
    spark = plays.sparkSession
    require_utc(spark)
    return write_plays(plays, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A folder of its own in the cluster's shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


_SCOPES: list[list[str]] = []


def settle(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of `df` through a snapshot in the cluster's shared folder."""
    path = fresh_path(df.sparkSession, name)
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stages(spark: SparkSession):
    """What is settled inside is deleted at the end: write the result elsewhere before."""
    _SCOPES.append([])
    try:
        yield
    finally:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        for path in _SCOPES.pop():
            folder = hadoop(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_metrics(document: DataFrame, path: str) -> None:
    """Replace the day's document: one Parquet partition per snapshot date."""
    (
        document.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date").parquet(path)
    )


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("data string, snapshot_date date").parquet(path)


def latest_metrics(snapshots: DataFrame) -> DataFrame:
    return snapshots.agg(F.max("snapshot_date").alias("snapshot_date"), F.max_by("data", "snapshot_date").alias("data")).filter(
        F.col("snapshot_date").isNotNull()
    )
