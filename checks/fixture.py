"""The listening library seen through the driver's tables.

Every table below is a projection of whole driver tables, so it grows with them:
`part` gives tracks, `supplier` albums and artists, `events` and `lineitem` plays,
`customer` playlists. Membership (library, liked, excluded, ...) follows the
attributes of a row, never its id.

Each body is SQL that Spark and DuckDB both read. `{name}` is a driver table or an
earlier body; LIST, TIMESTAMP and PACK are spelled per engine by `spark_sql` and
`duck_sql`.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
AS_OF = "2024-01-31 00:00:00"

BODIES: dict[str, str] = {
    # one home album per part: the supplier of its first order line
    "home": """
        SELECT l_partkey AS pk, min(PACK(o, l_orderkey, n, l_linenumber, s, l_suppkey)).s AS sk
        FROM {lineitem} GROUP BY l_partkey""",
    "label": """
        SELECT s_suppkey AS sk, s_name, s_acctbal, s_nationkey, n_name, r_name, n_regionkey
        FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey JOIN {region} ON r_regionkey = n_regionkey""",
    "song": """
        SELECT p_partkey AS pk, CAST(p_partkey AS STRING) AS ks, p_name, p_brand, p_type, p_size,
               CAST(round(p_retailprice * 1000) AS INT) AS dur,
               'AL' || CAST(h.sk AS STRING) AS album_id, 'Album ' || l.n_name AS album_name,
               CASE l.n_regionkey WHEN 0 THEN 'album' WHEN 1 THEN 'single' WHEN 2 THEN 'compilation' WHEN 3 THEN 'album' END AS album_type
        FROM {part} JOIN {home} h ON h.pk = p_partkey JOIN {label} l ON l.sk = h.sk""",
    "raw_play": """
        SELECT CASE WHEN event_type = 'error' THEN 'import' WHEN event_type IN ('purchase', 'signup') THEN 'stream' ELSE 'live' END AS feed,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS pk, ts AS played_at, value AS amount
        FROM {events}
        UNION ALL
        SELECT CASE l_returnflag WHEN 'R' THEN 'import' WHEN 'A' THEN 'stream' ELSE 'live' END,
               l_partkey, l_shipdate + INTERVAL '1' SECOND * CAST((l_orderkey * 7919 + l_linenumber * 104729) % 86400 AS INT), l_quantity
        FROM {lineitem}""",
    "any_play": """
        SELECT feed,
               CASE WHEN feed = 'stream' AND amount = 49 THEN NULL WHEN feed = 'import' THEN 'A' || ks ELSE 'T' || ks END AS track_id,
               CASE WHEN feed = 'import' AND amount = 50 THEN NULL ELSE played_at END AS played_at,
               CASE WHEN feed = 'import' THEN upper(p_name) ELSE p_name END AS track_name,
               CASE WHEN feed = 'stream' AND p_size < 6 THEN NULL ELSE 'AR' || p_brand END AS artist_id,
               CASE WHEN feed = 'import' THEN (CASE WHEN p_size = 25 THEN NULL ELSE dur + p_size * 25 END)
                    WHEN feed = 'stream' AND p_size < 4 THEN NULL ELSE dur END AS duration_ms,
               p_brand AS artist_name, album_id, album_name,
               CASE WHEN feed = 'stream' AND p_size < 8 THEN NULL ELSE album_type END AS album_type,
               CASE WHEN p_size < 3 THEN TIMESTAMP '2023-10-01 00:00:00' + INTERVAL '1' DAY * p_size END AS checked_at
        FROM {raw_play} r JOIN {song} s ON s.pk = r.pk""",
    "plays": "SELECT track_id, played_at, track_name, artist_id, duration_ms, artist_name, album_id, album_name, album_type, checked_at FROM {any_play} WHERE feed = 'live'",
    "stream_history": "SELECT track_id, played_at, track_name, artist_id, duration_ms, artist_name, album_id, album_name, album_type, checked_at FROM {any_play} WHERE feed = 'stream'",
    "import_history": "SELECT track_id, played_at, track_name, artist_id, duration_ms, artist_name, album_id, album_name, album_type, checked_at FROM {any_play} WHERE feed = 'import'",
    "albums": """
        SELECT 'AL' || CAST(sk AS STRING) AS id, 'Album ' || n_name AS name, s_name AS artist,
               CASE WHEN s_acctbal >= 1000 THEN 'AR' || s_name END AS artist_id,
               CASE r_name WHEN 'AFRICA' THEN '1994' WHEN 'AMERICA' THEN '1995-06' WHEN 'ASIA' THEN '1993-02-17'
                    WHEN 'EUROPE' THEN (CASE WHEN s_acctbal > 5000 THEN '2001-03' ELSE '' END) END AS release_date,
               CASE WHEN s_acctbal > 5000 THEN 13 ELSE 15 END AS total_tracks,
               s_acctbal > 1500 AS is_saved,
               TIMESTAMP '2000-01-01 00:00:00' + INTERVAL '1' DAY * s_nationkey AS added_at,
               CASE r_name WHEN 'EUROPE' THEN false WHEN 'MIDDLE EAST' THEN NULL ELSE true END AS tracks_synced,
               CASE n_regionkey WHEN 0 THEN 'album' WHEN 1 THEN 'single' WHEN 2 THEN (CASE WHEN s_acctbal <= 7000 THEN 'compilation' END) WHEN 3 THEN 'album' END AS album_type,
               CASE WHEN s_acctbal > 3000 THEN 'http://img/al' || CAST(sk AS STRING) END AS album_image_url,
               CASE WHEN s_acctbal > 6000 THEN TIMESTAMP '2023-12-01 00:00:00' + INTERVAL '1' DAY * s_nationkey END AS tracks_checked_at
        FROM {label}""",
    "tracks": """
        SELECT 'T' || ks AS id, p_name AS name, p_brand AS artist, album_name AS album, album_id, p_type <> 'SMALL' AS from_album,
               p_size AS track_number, CASE WHEN p_size <= 40 THEN 1 END AS disc_number,
               TIMESTAMP '1999-01-01 00:00:00' + INTERVAL '1' DAY * p_size AS added_at, dur AS duration_ms,
               CASE WHEN p_type <> 'MEDIUM' THEN p_size * 2 END AS popularity
        FROM {song} WHERE p_type NOT IN ('PROMO', 'LARGE')
        UNION ALL
        SELECT 'A' || ks, p_name, p_brand, album_name, album_id, true, p_size, 1,
               TIMESTAMP '1999-06-01 00:00:00' + INTERVAL '1' DAY * p_size, dur, p_size
        FROM {song} WHERE p_type = 'ECONOMY' AND p_size <= 20""",
    "liked_tracks": """
        SELECT CASE WHEN p_type = 'LARGE' AND p_size > 46 THEN 'A' ELSE 'T' END || ks AS track_id,
               TIMESTAMP '1998-07-01 00:00:00' + INTERVAL '1' DAY * p_size AS liked_at,
               TIMESTAMP '1998-07-01 00:00:00' + INTERVAL '1' DAY * p_size AS added_at,
               TIMESTAMP '2024-01-20 00:00:00' AS last_checked_at, p_name AS track_name, p_brand AS track_artist,
               'AR' || p_brand AS artist_id, album_id, p_type <> 'LARGE' AS album_in_library, dur AS duration_ms,
               CASE WHEN p_size < 49 THEN p_size END AS popularity
        FROM {song} WHERE p_size >= 42
        UNION ALL
        SELECT 'A' || ks, TIMESTAMP '2024-01-10 00:00:00' + INTERVAL '1' HOUR * p_size, TIMESTAMP '2024-01-10 00:00:00',
               TIMESTAMP '2024-01-20 00:00:00', p_name, p_brand, 'AR' || p_brand, album_id, true, dur, p_size
        FROM {song} WHERE p_type = 'ECONOMY' AND p_size >= 40""",
    "artists": """
        SELECT 'AR' || s_name AS id, s_name AS name,
               CASE WHEN n_regionkey = 3 THEN NULL WHEN s_acctbal > 8000 THEN CAST(LIST() AS GENRES) ELSE LIST(' ' || r_name, n_name) END AS genres,
               CASE WHEN s_acctbal > 2000 THEN 'http://img/ar' || CAST(sk AS STRING) END AS image_url,
               CASE WHEN n_regionkey <> 1 THEN TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' DAY * s_nationkey END AS last_checked_at,
               CASE WHEN n_regionkey <> 2 THEN TIMESTAMP '2023-06-01 00:00:00' + INTERVAL '1' DAY * s_nationkey END AS last_album_checked_at
        FROM {label} WHERE s_acctbal < 9000
        UNION ALL
        SELECT 'AR' || p_brand, p_brand, LIST(min(p_type) || ' ', max(p_type)), 'http://img/' || p_brand,
               TIMESTAMP '2023-12-01 00:00:00' + INTERVAL '1' DAY * min(p_size), NULL
        FROM {part} WHERE p_type <> 'LARGE' GROUP BY p_brand""",
    "track_availability": """
        SELECT 'T' || ks AS track_id, CASE WHEN p_size <> 22 THEN p_size <> 21 END AS is_playable,
               CASE WHEN p_size <> 9 THEN TIMESTAMP '2023-01-01 00:00:00' + INTERVAL '1' DAY * p_size END AS checked_at
        FROM {song} WHERE p_size <> 7
        UNION ALL
        SELECT 'X' || ks, true, TIMESTAMP '2022-01-01 00:00:00' FROM {song} WHERE p_size = 3""",
    "excluded_tracks": """
        SELECT 'T' || ks AS track_id FROM {song} WHERE p_size = 13
        UNION ALL SELECT 'A' || ks FROM {song} WHERE p_size = 14""",
    "track_id_equivalents": """
        SELECT 'A' || ks AS alias_track_id, 'T' || ks AS canonical_track_id, p_type AS reason, p_brand AS created_by,
               TIMESTAMP '2023-03-01 00:00:00' + INTERVAL '1' DAY * p_size AS created_at
        FROM {song} WHERE p_type IN ('ECONOMY', 'LARGE')""",
    "resolved_fuzzy_matches": "SELECT 'T' || ks AS track_id, TIMESTAMP '2023-05-05 00:00:00' AS resolved_at FROM {song} WHERE p_size = 17",
    "outdated_albums": """
        SELECT 'AR' || s_name AS artist_id, s_name AS artist_name, 'Album ' || n_name AS album_name,
               'AL' || CAST(sk AS STRING) AS saved_album_id,
               CASE WHEN s_acctbal > 8000 THEN 'AL' WHEN s_acctbal > 7000 THEN 'ALR' ELSE 'ALN' END || CAST(sk AS STRING) AS newer_album_id,
               TIMESTAMP '2023-02-01 00:00:00' AS first_detected_at,
               TIMESTAMP '2023-02-01 00:00:00' + INTERVAL '1' DAY * s_nationkey AS last_checked_at
        FROM {label} WHERE s_acctbal > 5000""",
    "playlist_mappings": """
        SELECT 'list_' || CAST(c_custkey AS STRING) AS slug, 'List ' || CAST(c_custkey AS STRING) AS name,
               'http://host/playlist/P' || CAST(c_custkey AS STRING) || '?si=1' AS playlist_id,
               CAST(NULL AS TIMESTAMP) AS last_synced_at, 'active' AS status, 0 AS track_count, c_mktsegment AS rules,
               c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE') AS is_dynamic,
               'S' || CAST(c_nationkey AS STRING) AS snapshot_id, CAST(NULL AS STRING) AS last_synced_hash,
               c_acctbal < 0 AS pending_delete,
               CASE WHEN c_acctbal < 0 THEN c_nationkey + 1 WHEN c_nationkey = 3 THEN NULL ELSE 0 END AS missing_count,
               CASE WHEN c_acctbal < 0 AND c_nationkey <> 5 THEN TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' DAY * c_nationkey END AS last_missing_at,
               CASE WHEN c_acctbal < 0 THEN 'gone' END AS last_missing_reason,
               CAST(NULL AS TIMESTAMP) AS last_seen_at
        FROM {customer}""",
    "logs": """
        SELECT event_id AS id, ts AS "timestamp", event_type AS source, CASE WHEN event_type = 'error' THEN 'error' ELSE 'info' END AS level, props AS message
        FROM {events}""",
    "import_catalog": """
        SELECT pk AS import_id,
               upper(p_name) || CASE p_type WHEN 'ECONOMY' THEN ' (2011 Remaster)' WHEN 'STANDARD' THEN ' - Live' WHEN 'MEDIUM' THEN ' Acoustic'
                                            WHEN 'SMALL' THEN ' (Deluxe Edition)' ELSE '' END
               || CASE WHEN p_size = 7 THEN ' Άλφα Йод Ｗｉｄｅ ﬁn' ELSE '' END AS name,
               CASE WHEN p_size <> 44 THEN p_brand END AS artist_name,
               CASE WHEN p_size <> 45 THEN album_name || CASE WHEN p_size > 30 THEN ' (Deluxe)' ELSE '' END END AS album_name,
               CASE WHEN p_size <> 46 THEN dur + (p_size - 25) * 900 END AS duration_ms,
               CASE WHEN p_size < 5 THEN 'T' || ks END AS matched_track_id,
               CASE WHEN p_size < 3 THEN p_name END AS matched_name,
               CASE WHEN p_size IN (4, 10) THEN TIMESTAMP '2023-08-08 00:00:00' END AS match_checked_at
        FROM {song}""",
    "catalog": """
        SELECT 'T' || ks AS id, p_name AS name, p_brand AS artist, 'AR' || p_brand AS artist_id, album_id, album_name, album_type, dur AS duration_ms
        FROM {song}""",
}

# What the sync jobs fetch: overlaps the stored tables, with new keys, changed values and gaps.
BODIES.update({
    "polled": "SELECT track_id, played_at, track_name, artist_id, duration_ms, artist_name, album_id, album_name, album_type, checked_at FROM {any_play} WHERE feed IN ('live', 'stream') AND track_id IS NOT NULL",
    "fresh_albums": """
        SELECT CASE WHEN r_name = 'EUROPE' THEN 'ALN' ELSE 'AL' END || CAST(sk AS STRING) AS id, 'Album ' || n_name AS name, s_name AS artist, 'AR' || s_name AS artist_id,
               '2020' AS release_date, 12 AS total_tracks, TIMESTAMP '2024-01-15 00:00:00' + INTERVAL '1' DAY * s_nationkey AS added_at, 'album' AS album_type,
               CASE WHEN s_acctbal < 7000 THEN 'http://img/new' || CAST(sk AS STRING) END AS album_image_url
        FROM {label} WHERE s_acctbal > 2500""",
    "fresh_likes": """
        SELECT CASE WHEN p_type = 'PROMO' THEN 'N' ELSE 'T' END || ks AS track_id, TIMESTAMP '2024-01-30 00:00:00' - INTERVAL '1' DAY * ((p_size - 36) * 5) AS liked_at,
               CAST(NULL AS TIMESTAMP) AS added_at, TIMESTAMP '2024-01-31 00:00:00' AS last_checked_at, upper(p_name) AS track_name, p_brand AS track_artist,
               'AR' || p_brand AS artist_id, CASE WHEN p_size = 40 THEN 'ALX' ELSE album_id END AS album_id, CAST(NULL AS BOOLEAN) AS album_in_library, dur + 1 AS duration_ms,
               CASE WHEN p_size <> 41 THEN p_size END AS popularity, 1 AS seq
        FROM {song} WHERE p_size > 36
        UNION ALL
        SELECT 'T' || ks, TIMESTAMP '2024-01-29 00:00:00', NULL, TIMESTAMP '2024-01-31 00:00:00', p_name, p_brand, 'AR' || p_brand, album_id, NULL, dur, 99, 2
        FROM {song} WHERE p_size = 45 AND p_type <> 'PROMO'""",
    "fresh_tracks": """
        SELECT 'T' || ks AS id, upper(p_name) AS name, p_brand AS artist, album_name AS album, album_id, p_size + 1 AS track_number, 1 AS disc_number,
               TIMESTAMP '2024-01-01 00:00:00' AS added_at, dur + 1 AS duration_ms, CASE WHEN p_size > 25 THEN p_size END AS popularity
        FROM {song} WHERE p_type IN ('ECONOMY', 'PROMO', 'SMALL') AND p_size <> 12""",
    "fresh_artists": """
        SELECT 'AR' || s_name AS id, CASE WHEN s_acctbal < 6000 THEN upper(s_name) END AS name, LIST(n_name) AS genres, 'http://img/new' AS image_url,
               TIMESTAMP '2024-01-31 00:00:00' AS last_checked_at
        FROM {label} WHERE s_acctbal > 500""",
    "fresh_availability": """
        SELECT 'T' || ks AS track_id, p_size <> 30 AS is_playable, TIMESTAMP '2024-01-31 00:00:00' AS checked_at FROM {song} WHERE p_type <> 'MEDIUM'
        UNION ALL SELECT 'N' || ks, true, TIMESTAMP '2024-01-31 00:00:00' FROM {song} WHERE p_type = 'PROMO'""",
    "remote_albums": """
        SELECT 'AR' || s_name AS artist_id, s_name AS artist_name, e.prefix || CAST(sk AS STRING) AS id, 'Album ' || n_name AS name,
               CASE n_regionkey WHEN 0 THEN 'album' WHEN 1 THEN 'single' WHEN 2 THEN (CASE WHEN s_acctbal <= 7000 THEN 'compilation' END) WHEN 3 THEN 'album' END AS album_type,
               CASE r_name WHEN 'AFRICA' THEN '1994' WHEN 'AMERICA' THEN '1995' WHEN 'ASIA' THEN '1993' WHEN 'EUROPE' THEN '2001' END || '-12-31' AS release_date,
               e.seq AS position
        FROM {label} JOIN (SELECT 'AL' AS prefix, 1 AS seq, 1500 AS floor_bal UNION ALL SELECT 'ALR', 2, 4000 UNION ALL SELECT 'ALS', 3, 9000) e ON s_acctbal > e.floor_bal""",
    "reported_albums": "SELECT artist_id, artist_name, name AS album_name, 'AL' || substr(id, 4) AS saved_album_id, id AS newer_album_id FROM {remote_albums} WHERE position = 2",
    # a fetch that failed, or a search that found nothing, is a row of nulls
    "fetched_names": "SELECT id AS matched_track_id, CASE WHEN duration_ms > 900000 THEN name END AS matched_name FROM {catalog}",
    "search_results": """
        SELECT import_id, CASE WHEN duration_ms > 940000 THEN 'T' || CAST(import_id AS STRING) END AS matched_track_id,
               CASE WHEN duration_ms > 940000 THEN lower(name) END AS matched_name
        FROM {import_catalog}""",
    "history_meta": """
        SELECT 'T' || ks AS track_id, CASE WHEN p_size <> 2 THEN 'AR' || p_brand END AS artist_id, album_id, album_type, CASE WHEN p_size <> 3 THEN dur END AS duration_ms
        FROM {song} WHERE p_type <> 'LARGE'""",
    "entered": """
        SELECT CASE WHEN p_size = 1 THEN ' ' ELSE ' A' || ks END AS alias_track_id, CASE WHEN p_size = 2 THEN 'A' ELSE 'T' END || ks || ' ' AS canonical_track_id,
               CASE WHEN p_size > 25 THEN ' checked ' ELSE '' END AS reason, 'me' AS created_by
        FROM {song} WHERE p_type IN ('LARGE', 'PROMO')""",
})


def references(text: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", text)


def closure(names) -> list[str]:
    """Bodies needed for `names`, in definition order."""
    wanted, todo = set(), [n for n in names if n in BODIES]
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += [n for n in references(BODIES[name]) if n in BODIES]
    return [n for n in BODIES if n in wanted]


def _pack(text: str, spell) -> str:
    return re.sub(r"PACK\(([^()]*)\)", lambda m: spell([p.strip() for p in m.group(1).split(",")]), text)


def duck_sql(text: str) -> str:
    text = _pack(text, lambda p: "struct_pack(" + ", ".join(f"{a} := {b}" for a, b in zip(p[::2], p[1::2])) + ")")
    text = text.replace("LIST(", "list_value(").replace("GENRES", "VARCHAR[]")
    return re.sub(r"\{(\w+)\}", r"\1", text)


def spark_sql(text: str) -> str:
    text = _pack(text, lambda p: "named_struct(" + ", ".join(f"'{a}', {b}" for a, b in zip(p[::2], p[1::2])) + ")")
    text = text.replace("LIST(", "array(").replace("GENRES", "ARRAY<STRING>")
    text = text.replace('"timestamp"', "`timestamp`")
    return text.replace("TIMESTAMP '", "TIMESTAMP_NTZ '").replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")


class Tables:
    """Lazy DataFrames of the fixture over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._made = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in BODIES:
                body = BODIES[name]
                self._made[name] = self.spark.sql(spark_sql(body), **{n: self[n] for n in set(references(body))})
            else:
                self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._made[name]


def prelude(query: str, extra: dict[str, str] | None = None) -> str:
    """`query` for DuckDB with the common table expressions it (transitively) names."""
    bodies = {**BODIES, **(extra or {})}
    used, todo = set(), references(query)
    while todo:
        name = todo.pop()
        if name in bodies and name not in used:
            used.add(name)
            todo += references(bodies[name])
    ctes = ",\n".join(f"{n} AS ({duck_sql(bodies[n])})" for n in bodies if n in used)
    return (f"WITH {ctes}\n" if ctes else "") + duck_sql(query)
