"""Registered queries of the library build."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.oracle import oracle
from earshot.functions.times import to_local
from earshot.operators import plays as P
from earshot.operators import tracks as K
from earshot.sources.schemas import conform

Q: dict = {}


def flat(df):
    """Arrays as text, so that every result column is a plain value."""
    return df.withColumn("genres", F.array_join("genres", "|"))


def add(name, fn, sql=None):
    Q[name] = (fn, oracle(sql) if sql else None)


UT = "SELECT * REPLACE (array_to_string(genres, '|') AS genres) FROM {ut}"

add("scan_library_defaults",
    lambda c: conform(c.t["playlist_mappings"].drop("pending_delete"), "playlist_mappings").select("slug", "is_dynamic", "pending_delete", "missing_count", "last_seen_at"),
    "SELECT slug, is_dynamic, false AS pending_delete, coalesce(missing_count, 0) AS missing_count, last_seen_at FROM {playlist_mappings}")

add("unified_plays", lambda c: c.unified_plays(), "SELECT * FROM {up}")

add("canonical_ids", lambda c: P.canonical(c.kept("tracks"), c.lib.track_id_equivalents, "id", "canonical_track_id").select("id", "canonical_track_id"),
    "SELECT t.id, coalesce(e.canonical_track_id, t.id) AS canonical_track_id FROM {tracks} t LEFT JOIN {track_id_equivalents} e ON e.alias_track_id = t.id")

add("canonical_dedup",
    lambda c: c.build.tracks_canon.select("canonical_track_id", "id", "added_at", F.lit("track").alias("kind")).unionByName(
        c.build.likes_canon.select("canonical_track_id", F.col("track_id").alias("id"), F.col("liked_at").alias("added_at"), F.lit("like").alias("kind"))),
    "SELECT cid AS canonical_track_id, id, added_at, 'track' AS kind FROM {tc} UNION ALL SELECT cid, track_id, liked_at, 'like' FROM {lc}")

add("play_stats", lambda c: P.play_stats(c.up), "SELECT * FROM {st}")
add("latest_play", lambda c: P.latest_play(c.up).select("track_id", "played_at", "duration_ms", "track_name", "artist_name", "artist_id", "album_id", "album_name", "album_type"),
    "SELECT track_id, played_at, duration_ms, track_name, artist_name, artist_id, album_id, album_name, album_type FROM {latest}")
add("skip_resume", lambda c: c.fresh_build().behaviour, "SELECT * FROM {acts}")
add("base_tracks", lambda c: flat(c.build.base), "SELECT * REPLACE (array_to_string(genres, '|') AS genres) FROM {base}")
add("liked_only", lambda c: flat(K.liked_only(c.lib, c.build.tracks_canon, c.build.likes_canon)),
    "SELECT * REPLACE (array_to_string(genres, '|') AS genres) FROM {base} WHERE library_origin = 'liked_only'")
add("excluded_flag", lambda c: K.with_excluded(c.build.tracks_canon, c.lib.excluded_tracks, "canonical_track_id", "id").select("canonical_track_id", "id", "excluded"),
    "SELECT cid AS canonical_track_id, id, EXISTS (SELECT 1 FROM {excluded_tracks} x WHERE x.track_id = cid OR x.track_id = id) AS excluded FROM {tc}")
add("fuzzy_candidates", lambda c: c.fresh_build().stray_variants,
    """SELECT track_id, lower(track_name) AS title_key, lower(artist_name) AS artist_key, coalesce(duration_ms, 0) AS ms, count(*) AS n,
              min(played_at) AS first_at, max(played_at) AS last_at FROM {stray} GROUP BY ALL""")


def _fuzzy_match(c):
    keys = K.stray_keys(c.fresh_build().stray_variants)
    track_keys = K.match_key(c.lib.tracks, "name", "artist").distinct()
    return K.matched_keys(track_keys, keys)


add("fuzzy_match", _fuzzy_match,
    """SELECT s.title_key, s.artist_key, s.ms, count(DISTINCT coalesce(t.duration_ms, 0)) AS hits
       FROM (SELECT DISTINCT title_key, artist_key, ms FROM {pairs}) s
       JOIN {tracks} t ON lower(t.name) = s.title_key AND lower(t.artist) = s.artist_key AND abs(s.ms - coalesce(t.duration_ms, 0)) <= 1000
       GROUP BY s.title_key, s.artist_key, s.ms""")
add("fuzzy_stats", lambda c: c.build.stray.fuzzy, "SELECT * FROM {fz}")
add("non_library_ids", lambda c: c.build.stray.unmatched_ids, "SELECT * FROM {nolib}")
add("non_library_base", lambda c: flat(c.build.non_library), "SELECT * REPLACE (array_to_string(genres, '|') AS genres) FROM {nobase}")
add("unified_tracks", lambda c: flat(c.fresh_build().unified_tracks), UT)
add("play_counts", lambda c: c.ut.select("track_id", "library_play_count", "fuzz_play_count", "resume_play_count", "play_count"),
    "SELECT track_id, library_play_count, fuzz_play_count, resume_play_count, play_count FROM {ut}")
add("earliest_dates", lambda c: c.ut.select("track_id", "added_at", "first_played_at", "last_played_at"),
    "SELECT track_id, added_at, first_played_at, last_played_at FROM {ut}")
add("local_times", lambda c: c.up.select("track_id", "played_at", to_local(F.col("played_at")).alias("played_local")),
    "SELECT track_id, played_at, timezone('America/New_York', timezone('UTC', played_at)) AS played_local FROM {up}")
