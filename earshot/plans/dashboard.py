"""All metrics as one JSON document per day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators import metrics as M
from earshot.sources.snapshots import settle


def _rows(frame: DataFrame, key: str) -> DataFrame:
    """A metric as (key, position, JSON object). Frames are bounded: top tens, calendar
    days or months, histogram buckets."""
    numbered = frame.coalesce(1).withColumn("_at", F.monotonically_increasing_id())
    return numbered.select(F.lit(key).alias("key"), F.col("_at").alias("at"), F.to_json(F.struct(*frame.columns), {"ignoreNullFields": "false"}).alias("item"))


def list_metrics(ut: DataFrame, groups: M.Groups, up: DataFrame, as_of) -> dict[str, DataFrame]:
    clock = settle(M.play_clock(up, as_of), "play_clock")  # at most 96 rows per day
    return {
        "top_artists": M.top_artists(groups), "top_tracks": M.top_tracks(ut), "daily_plays": M.daily_plays(clock, as_of),
        "top_albums": M.top_albums(groups), "plays_by_day": M.plays_by_weekday(groups), "plays_by_hour": M.plays_by_hour(clock),
        "plays_by_month": M.plays_by_month(clock), "tracks_added": M.tracks_added(groups), "top_liked_artists": M.top_liked_artists(groups),
        "top_genres": M.top_genres(groups), "popularity_distribution": M.popularity_histogram(groups),
        "release_to_play": M.release_to_play(groups), "monthly_library_growth": M.library_growth(groups),
        "top_artist_by_month": M.top_artist_by_month(up, as_of),
    }


def _summary(groups: M.Groups, playlists: DataFrame) -> DataFrame:
    """The scalar figures as one JSON object; each part is a single aggregated row."""
    parts = [
        M.summary_stats(groups).drop("total_ms"), M.album_type_counts(groups), M.dynamic_playlists(playlists),
        M.listening_streak(groups), M.listens_rate(groups),
    ]
    fields = F.regexp_replace(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}), r"^\{|\}$", "")
    rows = reduce(DataFrame.unionByName, [p.select(F.lit(i).alias("at"), fields.alias("text")) for i, p in enumerate(parts)])
    body = F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]))
    return rows.agg(F.concat(F.lit("{"), body, F.lit("}")).alias("json")).select(F.lit("summary_stats").alias("key"), "json")


def metrics_document(ut: DataFrame, up: DataFrame, playlists: DataFrame, as_of) -> DataFrame:
    """(snapshot_date, data): every metric in one JSON object. Tracks are scanned twice (all groupings, and the top
    tracks), plays twice (the clock, and artists by month); hand in snapshots."""
    groups = M.Groups(ut)
    lists = list_metrics(ut, groups, up, as_of)
    # bounded: top tens, calendar days or months, histogram buckets
    items = settle(reduce(DataFrame.unionByName, [_rows(frame, key) for key, frame in lists.items()]), "metric_items")
    arrays = items.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "item"))).alias("xs"))
    text = F.concat(F.lit("["), F.concat_ws(",", F.transform("xs", lambda x: x["item"])), F.lit("]"))
    fields = arrays.select("key", text.alias("json"))
    average = M.avg_popularity(groups).select(F.lit("avg_popularity_score").alias("key"), F.col("avg_popularity").cast("string").alias("json"))
    empty = ut.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, lists))).alias("key"), F.lit("[]").alias("json"))
    every = fields.unionByName(_summary(groups, playlists)).unionByName(average)
    every = empty.join(fields, "key", "left_anti").unionByName(every)
    entry = F.concat(F.lit('"'), F.col("key"), F.lit('":'), F.col("json"))
    body = F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("key", entry.alias("e")))), lambda x: x["e"]))
    return every.agg(F.concat(F.lit("{"), body, F.lit("}")).alias("data")).select(F.to_date(F.lit(as_of)).alias("snapshot_date"), "data")
