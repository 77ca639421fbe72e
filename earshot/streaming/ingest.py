"""Continuous play ingest: overlapping polls in, one row per (track_id, played_at) out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from earshot.operators.merge import missing_rows
from earshot.session import require_utc
from earshot.sources.monthly import MonthlyPlays
from earshot.sources.pages import PAGE_SCHEMAS, play_fields

KEY = ["track_id", "played_at"]
STORED = (
    "track_id string, played_at timestamp_ntz, track_name string, artist_id string, duration_ms int, artist_name string, "
    "album_id string, album_name string, album_type string, day date, batch bigint"
)


def polled_pages(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Landed poll results as a stream of plays: one JSON page per line. A page that cannot
    be read, and a play without track or time, stays as a row with `problem` and the
    text it came from."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    parsed = lines.select(F.col("value").alias("page"), F.from_json("value", PAGE_SCHEMAS["plays"])["items"].alias("items"))
    broken = F.col("items").isNull()
    rows = parsed.select("page", broken.alias("broken"), F.explode(F.when(broken, F.array(F.get("items", F.lit(0)))).otherwise(F.col("items"))).alias("i"))
    plays = rows.select("page", "broken", F.to_json("i").alias("item"), *play_fields())
    problem = F.when(F.col("broken"), "page").when(F.col("track_id").isNull(), "track").when(F.col("played_at").isNull(), "time")
    return plays.withColumns({"problem": problem, "text": F.when(problem == "page", F.col("page")).when(problem.isNotNull(), F.col("item"))}).drop("page", "broken", "item")


def readable(plays: DataFrame) -> DataFrame:
    """The plays of `polled_pages` that can be stored."""
    return plays.filter("problem IS NULL").drop("problem", "text")


def distinct_within(plays: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop repeats that arrive within `delay` of each other, with bounded state. Polls
    overlap by minutes, so a short delay is enough; a replay of old pages needs
    `append_plays`, which checks the table itself."""
    timed = plays.withColumn("played_at", F.col("played_at").cast("timestamp"))
    return timed.withWatermark("played_at", delay).dropDuplicatesWithinWatermark(KEY)


def append_plays(plays: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append plays the table lacks, however late they come: start a run over what is
    available. Each batch is compared only with stored plays of its own days, and reads
    only the folders of these days. Rows of `polled_pages` with a problem go to
    `<table>_unreadable`.

    The batch number is a partition, and a batch run again overwrites what its first
    attempt wrote and ignores it when looking for repeats: the result is the same.
    """
    spark = plays.sparkSession
    require_utc(spark)
    spark.createDataFrame([], STORED).write.mode("ignore").partitionBy("day", "batch").parquet(table)

    def one_batch(polled: DataFrame, batch: int) -> None:
        polled = polled.persist()  # read for its problems, its days and its rows
        try:
            if "problem" in polled.columns:
                broken = polled.filter("problem IS NOT NULL").select("problem", "text").withColumn("batch", F.lit(batch).cast("bigint"))
                if not broken.isEmpty():
                    broken.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{table}_unreadable")
                polled = readable(polled)
            rows = polled.withColumn("day", F.to_date("played_at"))
            days = [r.day for r in rows.select("day").distinct().collect()]  # calendar days of one poll
            if not days:
                return
            near = _days_of(rows.sparkSession, table, days).filter(F.col("batch") != batch)
            added = missing_rows(near.select(*KEY), rows, KEY).withColumn("batch", F.lit(batch).cast("bigint"))
            added.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(table)
        finally:
            polled.unpersist()

    return plays.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_months(plays: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Append plays to a table stored by month (`MonthlyPlays`): each batch is one merge, which reads and
    writes the batch's months only. A batch run again finds its plays stored and adds none. One stream or job
    at a time writes a table; a second one fails and can be run again."""

    def one_batch(polled: DataFrame, _: int) -> None:
        MonthlyPlays(polled.sparkSession, root).merge(readable(polled) if "problem" in polled.columns else polled)

    return plays.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _days_of(spark: SparkSession, table: str, days: list) -> DataFrame:
    """Stored plays of these days, from the days' own folders."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    paths = [f"{table}/day={d.isoformat()}" for d in sorted(days)]
    there = [p for p in paths if hadoop(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop(p))]
    if not there:
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).option("basePath", table).parquet(*there)


def compact_plays(spark: SparkSession, table: str, into: str) -> None:
    """A copy of the table with one folder per day, under batch -1, for the next run to go
    on with (a state is never written over what is being read). A batch that was cut off
    finds its plays stored and adds none."""
    stored = spark.read.schema(STORED).parquet(table).withColumn("batch", F.lit(-1).cast("bigint"))
    stored.hint("rebalance", "day").write.mode("errorifexists").partitionBy("day", "batch").parquet(into)


def stored_plays(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(table).drop("day", "batch")
