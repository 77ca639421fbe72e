"""One fact row per track: library, likes, stray plays, and their counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.times import to_local
from earshot.operators import plays as P
from earshot.operators.band import band_aggregate
from earshot.operators.skew import drop_listed, lookup_join

FUZZY_MS = 1000
MATCH_KEYS = ["title_key", "artist_key", "ms"]

BASE_COLUMNS = (
    "track_id", "track_name", "artist", "artist_id", "album_id", "album_name", "album_type", "album_image_url",
    "release_date", "genres", "artist_image", "track_number", "disc_number", "added_at", "duration_ms", "popularity",
    "liked_at", "liked_at_est", "last_checked_at", "is_playable", "is_liked", "excluded", "track_source", "library_origin",
)


@dataclass
class LibraryTables:
    tracks: DataFrame
    liked_tracks: DataFrame
    albums: DataFrame
    artists: DataFrame
    track_availability: DataFrame
    excluded_tracks: DataFrame
    track_id_equivalents: DataFrame


def one_per_canonical(df: DataFrame, equivalents: DataFrame, id_col: str, when_col: str) -> DataFrame:
    """The row that stands for each canonical id: its own row if there is one, else the
    newest by `when_col` (null is oldest), ties to the greatest id."""
    resolved = P.canonical(df, equivalents, id_col, "canonical_track_id")
    rank = F.struct((F.col(id_col) == F.col("canonical_track_id")).alias("own"), F.col(when_col).alias("at"), F.col(id_col).alias("id"))
    best = F.max_by(F.struct(*df.columns), rank).alias("_row")
    return resolved.groupBy("canonical_track_id").agg(best).select("canonical_track_id", "_row.*")


def with_excluded(df: DataFrame, excluded: DataFrame, canonical_col: str, own_col: str) -> DataFrame:
    """Flag rows whose canonical or own id is listed: two equi-joins, not an OR."""
    listed = excluded.select("track_id").distinct()
    for flag, col in (("_by_canonical", canonical_col), ("_by_own", own_col)):
        side = listed.select(F.col("track_id").alias(col), F.lit(True).alias(flag))
        df = lookup_join(df, side, [col])
    return df.withColumn("excluded", F.col("_by_canonical").isNotNull() | F.col("_by_own").isNotNull()).drop("_by_canonical", "_by_own")


def _artist_columns(artists: DataFrame, key: str) -> DataFrame:
    return artists.select(F.col("id").alias(key), "genres", F.col("image_url").alias("artist_image"))


def library_ms(tracks_canon: DataFrame, likes_canon: DataFrame) -> DataFrame:
    """Duration of a track as the library knows it: tracks first, then likes."""
    both = tracks_canon.select(F.col("canonical_track_id").alias("track_id"), F.col("duration_ms").alias("t"), F.lit(None).cast("int").alias("l")).unionByName(
        likes_canon.select(F.col("canonical_track_id").alias("track_id"), F.lit(None).cast("int").alias("t"), F.col("duration_ms").alias("l"))
    )
    return both.groupBy("track_id").agg(F.coalesce(F.max("t"), F.max("l")).alias("library_ms"))


def known_ids(tracks_canon: DataFrame, likes_canon: DataFrame) -> DataFrame:
    ids = tracks_canon.select("canonical_track_id").union(likes_canon.select("canonical_track_id")).distinct()
    return ids.select(F.col("canonical_track_id").alias("track_id"))


def base_tracks(lib: LibraryTables, tracks_canon: DataFrame, likes_canon: DataFrame) -> DataFrame:
    """Tracks of saved albums with their likes, plus likes that have no track row."""
    availability = lib.track_availability.select("track_id", "is_playable")
    albums = lib.albums.filter("is_saved").select(
        F.col("id").alias("album_id"), F.col("name").alias("album_name"), F.col("artist").alias("album_artist"),
        F.col("artist_id").alias("album_artist_id"), "album_type", "album_image_url", "release_date",
    )
    likes = likes_canon.select(
        F.col("canonical_track_id"), "liked_at", "last_checked_at",
        F.col("track_artist").alias("like_artist"), F.col("artist_id").alias("like_artist_id"), F.col("popularity").alias("like_popularity"),
    )
    owned = lookup_join(tracks_canon, albums, ["album_id"], "inner").join(likes, "canonical_track_id", "left")
    owned = with_excluded(owned, lib.excluded_tracks, "canonical_track_id", "id")
    owned = owned.withColumn("artist_id", F.coalesce("album_artist_id", "like_artist_id"))
    owned = lookup_join(owned, _artist_columns(lib.artists, "artist_id"), ["artist_id"])
    owned = owned.withColumnRenamed("canonical_track_id", "track_id").join(availability, "track_id", "left")
    owned = owned.select(
        "track_id", F.col("name").alias("track_name"), F.coalesce("album_artist", "like_artist").alias("artist"), "artist_id",
        "album_id", "album_name", "album_type", "album_image_url", "release_date", "genres", "artist_image", "track_number",
        F.coalesce("disc_number", F.lit(1)).alias("disc_number"), "added_at", "duration_ms",
        F.coalesce("like_popularity", "popularity").alias("popularity"), "liked_at", to_local(F.col("liked_at")).alias("liked_at_est"),
        "last_checked_at", "is_playable", F.col("liked_at").isNotNull().alias("is_liked"), "excluded",
        F.lit("library").alias("track_source"), F.lit("album").alias("library_origin"),
    )
    return owned.unionByName(liked_only(lib, tracks_canon, likes_canon))


def liked_only(lib: LibraryTables, tracks_canon: DataFrame, likes_canon: DataFrame) -> DataFrame:
    only = likes_canon.join(tracks_canon.select("canonical_track_id"), "canonical_track_id", "left_anti")
    only = with_excluded(only, lib.excluded_tracks, "canonical_track_id", "track_id").drop("track_id")
    only = lookup_join(only, _artist_columns(lib.artists, "artist_id"), ["artist_id"])
    only = only.withColumnRenamed("canonical_track_id", "track_id").join(lib.track_availability.select("track_id", "is_playable"), "track_id", "left")
    none = F.lit(None)
    return only.select(
        "track_id", "track_name", F.col("track_artist").alias("artist"), "artist_id", "album_id",
        none.cast("string").alias("album_name"), none.cast("string").alias("album_type"), none.cast("string").alias("album_image_url"),
        none.cast("string").alias("release_date"), "genres", "artist_image", none.cast("int").alias("track_number"),
        F.lit(1).alias("disc_number"), "added_at", "duration_ms", "popularity", "liked_at",
        to_local(F.col("liked_at")).alias("liked_at_est"), "last_checked_at", "is_playable", F.lit(True).alias("is_liked"),
        "excluded", F.lit("library").alias("track_source"), F.lit("liked_only").alias("library_origin"),
    )


def match_key(df: DataFrame, title: str, artist: str, *more: str) -> DataFrame:
    return df.select(
        F.lower(title).alias("title_key"), F.lower(artist).alias("artist_key"), F.coalesce("duration_ms", F.lit(0)).alias("ms"), *more
    ).filter(F.col("title_key").isNotNull() & F.col("artist_key").isNotNull())


@dataclass
class StrayPlays:
    """Plays whose id is neither a track nor a like, matched by title, artist and duration."""

    variants: DataFrame  # track_id, title_key, artist_key, ms, n, first_at, last_at
    fuzzy: DataFrame  # per matched raw track id: count, first, last
    unmatched_ids: DataFrame  # track_id of stray plays with no match


def stray_keys(variants: DataFrame) -> DataFrame:
    named = variants.filter(F.col("title_key").isNotNull() & F.col("artist_key").isNotNull())
    return named.groupBy(*MATCH_KEYS).agg(F.sum("n").alias("n"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))


def fuzzy_by_key(track_keys: DataFrame, keys: DataFrame) -> DataFrame:
    """For each (title, artist, duration) of the library: the stray plays within a second."""
    measures = {"n": F.sum("n"), "first_at": F.min("first_at"), "last_at": F.max("last_at")}
    return band_aggregate(track_keys, keys, ["title_key", "artist_key"], "ms", FUZZY_MS, measures).filter(F.col("n") > 0)


def matched_keys(track_keys: DataFrame, keys: DataFrame) -> DataFrame:
    """The stray (title, artist, duration) keys that some library track matches."""
    counted = track_keys.withColumn("hits", F.lit(1).cast("bigint"))
    near = band_aggregate(keys.select(*MATCH_KEYS), counted, ["title_key", "artist_key"], "ms", FUZZY_MS, {"hits": F.sum("hits")})
    return near.filter(F.col("hits") > 0)


def stray_plays(stray: DataFrame, tracks: DataFrame) -> StrayPlays:
    """Match `stray`, the play variants of unknown ids (read several times: hand in a snapshot)."""
    keys = stray_keys(stray)
    rows = match_key(tracks, "name", "artist", F.col("id").alias("track_id"))
    track_keys = rows.select(*MATCH_KEYS).distinct()
    fuzzy = lookup_join(rows, fuzzy_by_key(track_keys, keys), MATCH_KEYS, "inner").select(
        "track_id", F.col("n").alias("fuzz_play_count"),
        F.col("first_at").alias("fuzz_play_count_first_played"), F.col("last_at").alias("fuzz_play_count_last_played"),
    )
    unmatched = drop_listed(stray, matched_keys(track_keys, keys).select(*MATCH_KEYS), MATCH_KEYS).select("track_id").distinct()
    return StrayPlays(stray, fuzzy, unmatched)


def non_library_base(lib: LibraryTables, unmatched_ids: DataFrame, latest: DataFrame) -> DataFrame:
    """One row per unmatched id from its newest play. It counts as playable whatever the
    availability table says."""
    albums = lib.albums.select(
        F.col("id").alias("album_id"), F.col("name").alias("_album_name"), F.col("album_type").alias("_album_type"), "album_image_url", "release_date"
    )
    rows = latest.join(unmatched_ids, "track_id", "left_semi")
    rows = lookup_join(rows, _artist_columns(lib.artists, "artist_id"), ["artist_id"])
    rows = lookup_join(rows, albums, ["album_id"])
    listed = lib.excluded_tracks.select("track_id").distinct().withColumn("_listed", F.lit(True))
    rows = rows.join(listed, "track_id", "left")
    none = F.lit(None)
    return rows.select(
        "track_id", "track_name", F.col("artist_name").alias("artist"), "artist_id", "album_id",
        F.coalesce("_album_name", "album_name").alias("album_name"), F.coalesce("_album_type", "album_type").alias("album_type"),
        "album_image_url", "release_date", "genres", "artist_image", none.cast("int").alias("track_number"), F.lit(1).alias("disc_number"),
        none.cast("timestamp_ntz").alias("added_at"), "duration_ms", none.cast("int").alias("popularity"),
        none.cast("timestamp_ntz").alias("liked_at"), none.cast("timestamp_ntz").alias("liked_at_est"),
        none.cast("timestamp_ntz").alias("last_checked_at"), F.lit(True).alias("is_playable"), F.lit(False).alias("is_liked"),
        F.col("_listed").isNotNull().alias("excluded"), F.lit("non_library").alias("track_source"), F.lit("non_library").alias("library_origin"),
    )


def play_count(exact: Column, fuzzy: Column, resumes: Column) -> Column:
    return F.greatest(exact + fuzzy - resumes, F.lit(0))


def attach_stats(base: DataFrame, stats: DataFrame, acts: DataFrame, fuzzy: DataFrame) -> DataFrame:
    """Join the per-track counts and derive the combined columns. Least and greatest skip
    nulls, so a date is null only when every candidate is."""
    joined = base.join(stats, "track_id", "left").join(acts, "track_id", "left").join(fuzzy, "track_id", "left")
    counts = ["library_play_count", "resume_play_count", "skip_play_count", "fuzz_play_count"]
    zeroed = joined.fillna(0, counts)
    first = F.least("library_play_count_first_played", "fuzz_play_count_first_played")
    last = F.greatest("library_play_count_last_played", "fuzz_play_count_last_played")
    added = F.least("added_at", "liked_at", first)
    return zeroed.select(
        *[c for c in BASE_COLUMNS if c != "added_at"],
        added.alias("added_at"), to_local(added).alias("added_at_est"),
        "library_play_count", "library_play_count_first_played", "library_play_count_last_played",
        "resume_play_count", "skip_play_count",
        "fuzz_play_count", "fuzz_play_count_first_played", "fuzz_play_count_last_played",
        play_count(F.col("library_play_count"), F.col("fuzz_play_count"), F.col("resume_play_count")).alias("play_count"),
        first.alias("first_played_at"), to_local(first).alias("first_played_at_est"),
        last.alias("last_played_at"), to_local(last).alias("last_played_at_est"),
    )
