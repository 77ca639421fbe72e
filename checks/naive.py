"""The direct forms the operators replace, to measure against: python -m checks.naive SF_DIR.

One global window for the next play, all play x track pairs for the fuzzy match, and an OR
inside EXISTS for the excluded flag.
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from checks.context import Context
from checks.registry import registered
from earshot.functions.times import micros
from earshot.operators.plays import usable
from earshot.session import local_session


def skip_resume(c) -> DataFrame:
    build = c.fresh_build()
    plays = usable(c.up).withColumn("us", micros(F.col("played_at"))).join(build.library_ms, "track_id", "left")
    every, own = W.orderBy("us", "track_id", "duration_ms"), W.partitionBy("track_id").orderBy("us", "duration_ms")
    marks = plays.select(
        "track_id", F.coalesce("library_ms", "duration_ms").alias("ms"), (F.col("us") - F.lag("us").over(own)).alias("back"),
        F.lead("track_id").over(every).alias("next_id"), (F.lead("us").over(every) - F.col("us")).alias("ahead"),
    )
    return marks.groupBy("track_id").agg(
        F.count_if(F.col("back") < F.col("ms") * 1000).alias("resume_play_count"),
        F.count_if((F.col("next_id") != F.col("track_id")) & (F.col("ahead") < F.col("ms") * 300)).alias("skip_play_count"),
    )


def fuzzy_stats(c) -> DataFrame:
    build = c.fresh_build()
    plays = usable(c.up).join(build.tracks_canon.select(F.col("canonical_track_id").alias("track_id")), "track_id", "left_anti").join(
        build.likes_canon.select(F.col("canonical_track_id").alias("track_id")), "track_id", "left_anti")
    t = c.lib.tracks.select(F.col("id").alias("matched_id"), F.lower("name").alias("n"), F.lower("artist").alias("a"), F.coalesce("duration_ms", F.lit(0)).alias("d"))
    near = F.abs(F.coalesce("duration_ms", F.lit(0)) - F.col("d")) <= 1000
    pairs = plays.join(t, (F.lower("track_name") == F.col("n")) & (F.lower("artist_name") == F.col("a")) & near)
    return pairs.groupBy("matched_id").agg(F.count(F.lit(1)).alias("n"), F.min("played_at"), F.max("played_at"))


def excluded_flag(c) -> DataFrame:
    c.build.tracks_canon.createOrReplaceTempView("naive_tracks")
    c.lib.excluded_tracks.createOrReplaceTempView("naive_excluded")
    return c.spark.sql(
        "SELECT t.id, EXISTS (SELECT 1 FROM naive_excluded x WHERE x.track_id = t.canonical_track_id OR x.track_id = t.id) AS excluded FROM naive_tracks t")


def main(sf_dir: str) -> None:
    spark = local_session()
    c, found, took = Context.of(spark, sf_dir), registered(), {}
    for table in ("plays", "stream_history", "import_history"):
        c.kept(table)
    c.lib, c.up, c.build.tracks_canon, c.build.likes_canon  # noqa: B018
    designed = {"skip_resume": found["skip_resume"][0], "fuzzy_stats": lambda c: c.fresh_build().stray.fuzzy, "excluded_flag": found["excluded_flag"][0]}
    for name, direct in {"skip_resume": skip_resume, "fuzzy_stats": fuzzy_stats, "excluded_flag": excluded_flag}.items():
        for form, fn in (("direct", direct), ("designed", designed[name])):
            best = []
            for _ in range(3):
                start = time.perf_counter()
                fn(c).write.format("noop").mode("overwrite").save()
                best.append(time.perf_counter() - start)
            took[f"{name} {form}"] = round(min(best), 2)
    print(json.dumps(took))


if __name__ == "__main__":
    main(sys.argv[1])
