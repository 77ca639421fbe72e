"""Data-quality reports and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.order import asc, desc
from earshot.operators.ordered import cell
from earshot.operators.skew import lookup_join
from earshot.operators.tracks import FUZZY_MS


def _tracks_per_album(tracks: DataFrame) -> DataFrame:
    return tracks.groupBy("album_id").agg(F.count("id").alias("n"))


def surplus_tracks(albums: DataFrame, tracks: DataFrame) -> DataFrame:
    """Albums with more tracks than they declare."""
    counted = albums.join(_tracks_per_album(tracks).withColumnRenamed("album_id", "id"), "id")
    extra = F.col("n") - F.col("total_tracks")
    return counted.filter(extra > 0).select(
        F.col("id").alias("album_id"), F.col("name").alias("album_name"), "total_tracks", F.col("n").alias("track_count"), extra.alias("extra_tracks")
    ).orderBy(desc("extra_tracks"), asc("album_id"))


def track_count_mismatch(albums: DataFrame, tracks: DataFrame, artists: DataFrame) -> DataFrame:
    """Saved and synced albums whose track count is not the declared one."""
    synced = albums.filter(F.col("is_saved") & F.col("tracks_synced"))
    counted = synced.join(_tracks_per_album(tracks).withColumnRenamed("album_id", "id"), "id", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    named = lookup_join(counted.filter(F.col("n") != F.col("total_tracks")), artists.select(F.col("id").alias("artist_id"), F.col("name").alias("artist_name")), ["artist_id"])
    return named.select(
        F.col("id").alias("album_id"), F.col("name").alias("album_name"), "artist_name", F.col("total_tracks").alias("expected_track_count"),
        F.col("n").alias("actual_track_count"), (F.col("total_tracks") - F.col("n")).alias("track_count_difference"),
    ).orderBy(desc("track_count_difference"), asc("album_id"))


def fuzzy_report(plays: DataFrame, tracks: DataFrame, albums: DataFrame, resolved: DataFrame) -> DataFrame:
    """Plays that match a track of another id by title, artist and duration, except tracks
    already reviewed; newest play first.

    The duration is part of the join key as a bucket of the tolerance, so a popular title
    meets only tracks of about its length; tracks go to their bucket and both neighbours.
    """
    bucket = cell(F.coalesce("duration_ms", F.lit(0)), FUZZY_MS)
    heard = plays.select(
        F.col("track_id").alias("original_track_id"), F.col("track_name").alias("original_track_name"), F.col("artist_name").alias("original_artist_name"),
        "played_at", F.coalesce("duration_ms", F.lit(0)).alias("ms"), F.lower("track_name").alias("title_key"), F.lower("artist_name").alias("artist_key"), bucket.alias("cell"),
    ).filter(F.col("title_key").isNotNull() & F.col("artist_key").isNotNull() & F.col("original_track_id").isNotNull())
    open_tracks = tracks.join(resolved.select(F.col("track_id").alias("id")).distinct(), "id", "left_anti")
    named = lookup_join(open_tracks, albums.select(F.col("id").alias("album_id"), F.col("name").alias("library_album_name")), ["album_id"])
    stored = named.select(
        F.col("id").alias("library_track_id"), F.col("name").alias("library_track_name"), F.col("artist").alias("library_artist_name"),
        F.col("album_id").alias("library_album_id"), "library_album_name", F.coalesce("duration_ms", F.lit(0)).alias("library_ms"),
        F.lower("name").alias("title_key"), F.lower("artist").alias("artist_key"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("cell"),
    )
    met = lookup_join(heard, stored, ["title_key", "artist_key", "cell"], "inner")
    fits = (F.abs(F.col("ms") - F.col("library_ms")) <= FUZZY_MS) & (F.col("original_track_id") != F.col("library_track_id"))
    found = met.filter(fits).drop("title_key", "artist_key", "cell", "ms", "library_ms")
    return newest_first(found, "played_at", "original_track_id", "library_track_id")


def newest_first(rows: DataFrame, when: str, *ties: str) -> DataFrame:
    return rows.orderBy(desc(when), *[asc(t) for t in ties])


def pending_playlists(playlists: DataFrame) -> DataFrame:
    return newest_first(playlists.filter("pending_delete").select("name", "slug", "missing_count", "last_missing_at"), "last_missing_at", "slug")


def log_page(logs: DataFrame, source: str | None = None, level: str | None = None, newest: bool = True, page: int = 1, size: int = 50) -> DataFrame:
    """One page of the log. Offset and limit stay in one distributed top-k."""
    rows = logs
    if source:
        rows = rows.filter(F.col("source") == source)
    if level:
        rows = rows.filter(F.col("level") == level)
    way = desc if newest else asc
    return rows.orderBy(way("timestamp"), way("id")).offset((page - 1) * size).limit(size).select("timestamp", "source", "level", "message")


def count_gate(rows: DataFrame, remote_total: int) -> DataFrame:
    """Whether a sync is needed: any rows at all, and as many as upstream has."""
    return rows.agg(F.count(F.lit(1)).alias("local_total")).select(
        (F.col("local_total") > 0).alias("has_rows"), "local_total", F.lit(remote_total).cast("bigint").alias("remote_total"),
        (F.col("local_total") == remote_total).alias("up_to_date"),
    )


def repeated_keys(rows: DataFrame, keys: list[str], check: str) -> DataFrame:
    """How many keys occur more than once, and how many rows are too many."""
    known = rows.filter(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    counted = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return counted.agg(F.count(F.lit(1)).alias("violations"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows")).select(
        F.lit(check).alias("check"), "violations", "surplus_rows"
    )


def self_aliases(equivalents: DataFrame) -> DataFrame:
    bad = F.count_if(F.col("alias_track_id") == F.col("canonical_track_id"))
    return equivalents.agg(bad.alias("violations")).select(F.lit("alias_is_canonical").alias("check"), "violations", F.col("violations").alias("surplus_rows"))
