"""Stages of the library build in DuckDB SQL: direct formulations to check against.

They use one global window, nested EXISTS and pairwise joins on purpose, so that they
share no shape with the Spark operators.
"""

from __future__ import annotations

from checks.fixture import prelude

PLAY_COLS = "track_name, artist_id, artist_name, album_id, album_name, album_type, duration_ms, played_at"


def local(x: str) -> str:
    return f"timezone('America/New_York', timezone('UTC', {x}))"


PLAY_ORDER = "played_at, track_id, coalesce(duration_ms, 0), coalesce(album_id, ''), coalesce(track_name, ''), coalesce(artist_name, '')"

STAGES: dict[str, str] = {
    "up": f"""
        SELECT coalesce(e.canonical_track_id, x.track_id) AS track_id, {PLAY_COLS}
        FROM (SELECT track_id, {PLAY_COLS} FROM {{plays}} UNION ALL SELECT track_id, {PLAY_COLS} FROM {{stream_history}}
              UNION ALL SELECT track_id, {PLAY_COLS} FROM {{import_history}}) x
        LEFT JOIN {{track_id_equivalents}} e ON e.alias_track_id = x.track_id WHERE played_at IS NOT NULL""",
    "ap": f"SELECT *, row_number() OVER (ORDER BY {PLAY_ORDER}) AS rid FROM {{up}} WHERE track_id IS NOT NULL",
    "tc": """
        SELECT t.*, coalesce(e.canonical_track_id, t.id) AS cid FROM {tracks} t LEFT JOIN {track_id_equivalents} e ON e.alias_track_id = t.id
        QUALIFY row_number() OVER (PARTITION BY cid ORDER BY (t.id = cid) DESC, added_at DESC NULLS LAST, t.id DESC) = 1""",
    "lc": """
        SELECT t.*, coalesce(e.canonical_track_id, t.track_id) AS cid FROM {liked_tracks} t LEFT JOIN {track_id_equivalents} e ON e.alias_track_id = t.track_id
        QUALIFY row_number() OVER (PARTITION BY cid ORDER BY (t.track_id = cid) DESC, liked_at DESC NULLS LAST, t.track_id DESC) = 1""",
    "base": f"""
        SELECT tc.cid AS track_id, tc.name AS track_name, coalesce(al.artist, lc.track_artist) AS artist, coalesce(al.artist_id, lc.artist_id) AS artist_id,
               tc.album_id, al.name AS album_name, al.album_type, al.album_image_url, al.release_date, ar.genres, ar.image_url AS artist_image,
               tc.track_number, coalesce(tc.disc_number, 1) AS disc_number, tc.added_at, tc.duration_ms, coalesce(lc.popularity, tc.popularity) AS popularity,
               lc.liked_at, {local('lc.liked_at')} AS liked_at_est, lc.last_checked_at, av.is_playable, lc.liked_at IS NOT NULL AS is_liked,
               EXISTS (SELECT 1 FROM {{excluded_tracks}} x WHERE x.track_id IN (tc.cid, tc.id)) AS excluded,
               'library' AS track_source, 'album' AS library_origin
        FROM {{tc}} tc JOIN {{albums}} al ON al.id = tc.album_id AND al.is_saved LEFT JOIN {{lc}} lc ON lc.cid = tc.cid
        LEFT JOIN {{track_availability}} av ON av.track_id = tc.cid LEFT JOIN {{artists}} ar ON ar.id = coalesce(al.artist_id, lc.artist_id)
        UNION ALL
        SELECT lc.cid, lc.track_name, lc.track_artist, lc.artist_id, lc.album_id, NULL, NULL, NULL, NULL, ar.genres, ar.image_url, NULL, 1, lc.added_at,
               lc.duration_ms, lc.popularity, lc.liked_at, {local('lc.liked_at')}, lc.last_checked_at, av.is_playable, true,
               EXISTS (SELECT 1 FROM {{excluded_tracks}} x WHERE x.track_id IN (lc.cid, lc.track_id)), 'library', 'liked_only'
        FROM {{lc}} lc LEFT JOIN {{track_availability}} av ON av.track_id = lc.cid LEFT JOIN {{artists}} ar ON ar.id = lc.artist_id
        WHERE lc.cid NOT IN (SELECT cid FROM {{tc}})""",
    "st": """SELECT track_id, count(*) AS library_play_count, min(played_at) AS library_play_count_first_played,
                    max(played_at) AS library_play_count_last_played FROM {ap} GROUP BY track_id""",
    "marks": f"""
        SELECT a.track_id, coalesce(tc.duration_ms, lc.duration_ms, a.duration_ms) AS ms,
               epoch_us(played_at) - epoch_us(lag(played_at) OVER (PARTITION BY a.track_id ORDER BY a.rid)) AS back_us,
               lead(a.track_id) OVER (ORDER BY a.rid) AS next_id,
               epoch_us(lead(played_at) OVER (ORDER BY a.rid)) - epoch_us(played_at) AS ahead_us
        FROM {{ap}} a LEFT JOIN {{tc}} tc ON tc.cid = a.track_id LEFT JOIN {{lc}} lc ON lc.cid = a.track_id""",
    "acts": """SELECT track_id, count(*) FILTER (back_us < ms * 1000::BIGINT) AS resume_play_count,
                      count(*) FILTER (next_id <> track_id AND ahead_us < ms * 300::BIGINT) AS skip_play_count FROM {marks} GROUP BY track_id""",
    "stray": "SELECT * FROM {ap} WHERE track_id NOT IN (SELECT cid FROM {tc}) AND track_id NOT IN (SELECT cid FROM {lc})",
    "pairs": """SELECT s.rid, s.played_at, t.id AS matched_id, lower(s.track_name) AS title_key, lower(s.artist_name) AS artist_key, coalesce(s.duration_ms, 0) AS ms
                FROM {stray} s JOIN {tracks} t ON lower(t.name) = lower(s.track_name) AND lower(t.artist) = lower(s.artist_name)
                 AND abs(coalesce(s.duration_ms, 0) - coalesce(t.duration_ms, 0)) <= 1000""",
    "fz": """SELECT matched_id AS track_id, count(*) AS fuzz_play_count, min(played_at) AS fuzz_play_count_first_played,
                    max(played_at) AS fuzz_play_count_last_played FROM {pairs} GROUP BY matched_id""",
    "nolib": "SELECT DISTINCT track_id FROM {stray} WHERE rid NOT IN (SELECT rid FROM {pairs})",
    "latest": """SELECT * FROM {ap} QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY played_at DESC, duration_ms DESC NULLS LAST,
                 album_id DESC NULLS LAST, track_name DESC NULLS LAST, artist_name DESC NULLS LAST, artist_id DESC NULLS LAST,
                 album_name DESC NULLS LAST, album_type DESC NULLS LAST) = 1""",
    "nobase": """
        SELECT p.track_id, p.track_name, p.artist_name AS artist, p.artist_id, p.album_id, coalesce(al.name, p.album_name) AS album_name,
               coalesce(al.album_type, p.album_type) AS album_type, al.album_image_url, al.release_date, ar.genres, ar.image_url AS artist_image,
               CAST(NULL AS INT) AS track_number, 1 AS disc_number, CAST(NULL AS TIMESTAMP) AS added_at, p.duration_ms, CAST(NULL AS INT) AS popularity,
               CAST(NULL AS TIMESTAMP) AS liked_at, CAST(NULL AS TIMESTAMP) AS liked_at_est, CAST(NULL AS TIMESTAMP) AS last_checked_at,
               true AS is_playable, false AS is_liked, p.track_id IN (SELECT track_id FROM {excluded_tracks}) AS excluded,
               'non_library' AS track_source, 'non_library' AS library_origin
        FROM {nolib} n JOIN {latest} p ON p.track_id = n.track_id LEFT JOIN {artists} ar ON ar.id = p.artist_id LEFT JOIN {albums} al ON al.id = p.album_id""",
    "ut0": """
        SELECT b.*, coalesce(library_play_count, 0) AS library_play_count, library_play_count_first_played, library_play_count_last_played,
               coalesce(resume_play_count, 0) AS resume_play_count, coalesce(skip_play_count, 0) AS skip_play_count, coalesce(fuzz_play_count, 0) AS fuzz_play_count,
               fuzz_play_count_first_played, fuzz_play_count_last_played,
               least(library_play_count_first_played, fuzz_play_count_first_played) AS first_played_at,
               greatest(library_play_count_last_played, fuzz_play_count_last_played) AS last_played_at
        FROM (SELECT * FROM {base} UNION ALL SELECT * FROM {nobase}) b LEFT JOIN {st} USING (track_id) LEFT JOIN {acts} USING (track_id) LEFT JOIN {fz} USING (track_id)""",
    "ut": f"""
        SELECT * EXCLUDE (added_at), least(added_at, liked_at, first_played_at) AS added_at, {local('least(added_at, liked_at, first_played_at)')} AS added_at_est,
               greatest(library_play_count + fuzz_play_count - resume_play_count, 0) AS play_count,
               {local('first_played_at')} AS first_played_at_est, {local('last_played_at')} AS last_played_at_est
        FROM {{ut0}}""",
}


def oracle(query: str) -> str:
    return prelude(query, STAGES)
