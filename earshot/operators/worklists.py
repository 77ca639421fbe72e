"""What a sync run should look at next: everything new, and the stalest of the rest.

The limits are the size of one run (a top-k), not a cut of the data: a row left out now
is older, and so nearer the front, next time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.order import asc
from earshot.functions.times import as_ts

NEVER = "2000-01-01 00:00:00"


def known_track_ids(likes: DataFrame, tracks: DataFrame) -> DataFrame:
    return likes.select("track_id").union(tracks.select("id")).distinct()


def known_artist_ids(*holders: DataFrame) -> DataFrame:
    ids = reduce(DataFrame.union, [h.select("artist_id").filter(F.col("artist_id").isNotNull()) for h in holders])
    return ids.distinct()


def availability_worklist(likes: DataFrame, tracks: DataFrame, availability: DataFrame, oldest: int = 100) -> DataFrame:
    known = known_track_ids(likes, tracks).join(availability.select("track_id", "checked_at"), "track_id", "left")
    never = known.filter(F.col("checked_at").isNull()).select("track_id")
    stale = known.filter(F.col("checked_at").isNotNull()).orderBy(asc("checked_at"), asc("track_id")).limit(oldest).select("track_id")
    return never.union(stale).distinct()


def _stalest(artists: DataFrame, when: str, n: int) -> DataFrame:
    return artists.orderBy(asc(F.coalesce(when, as_ts(NEVER))), asc("id")).limit(n)


def artist_worklist(artists: DataFrame, holders: list[DataFrame], oldest: int = 100) -> DataFrame:
    unknown = known_artist_ids(*holders).select(F.col("artist_id").alias("id")).join(artists.select("id"), "id", "left_anti")
    return unknown.union(_stalest(artists, "last_checked_at", oldest).select("id")).distinct()


def edition_worklist(artists: DataFrame, outdated: DataFrame, oldest: int = 30) -> DataFrame:
    reported = artists.join(outdated.select(F.col("artist_id").alias("id")).distinct(), "id", "left_semi")
    return reported.select("id", "name").union(_stalest(artists, "last_album_checked_at", oldest).select("id", "name")).distinct()


def integrity_worklist(albums: DataFrame, oldest: int = 50) -> DataFrame:
    saved = albums.filter("is_saved")
    return saved.orderBy(F.col("tracks_checked_at").asc_nulls_first(), asc("added_at"), asc("id")).limit(oldest).select("id", "name", "added_at")


def backfill_worklist(history: DataFrame, batch: int = 500) -> DataFrame:
    lacking = F.col("artist_id").isNull() | F.col("album_id").isNull() | F.col("album_type").isNull() | F.col("duration_ms").isNull()
    ids = history.filter(F.col("track_id").isNotNull() & lacking).groupBy("track_id").agg(F.min("checked_at").alias("c"), F.min("played_at").alias("p"))
    return ids.orderBy(F.col("c").asc_nulls_first(), asc("p"), asc("track_id")).limit(batch).select("track_id")


def unsynced_albums(albums: DataFrame) -> DataFrame:
    return albums.filter(F.col("is_saved") & ~F.coalesce("tracks_synced", F.lit(False))).select("id", "name", "added_at")


def unsaved_albums(albums: DataFrame) -> DataFrame:
    return albums.filter(~F.col("is_saved")).select("id")


def link_worklist(catalog: DataFrame, batch: int | None = None) -> DataFrame:
    """Rows with no link that were never tried; all of them, or the first `batch` by id."""
    open_rows = catalog.filter(
        F.col("matched_track_id").isNull() & F.col("match_checked_at").isNull() & F.col("name").isNotNull() & F.col("artist_name").isNotNull()
    )
    return open_rows if batch is None else open_rows.orderBy(asc("import_id")).limit(batch)


def link_metadata_worklist(catalog: DataFrame) -> DataFrame:
    """Rows whose link is known but whose metadata was never fetched."""
    return catalog.filter(F.col("matched_track_id").isNotNull() & F.col("matched_name").isNull() & F.col("match_checked_at").isNull())
