"""Registered queries of table upkeep: merges, reconciliation, worklists, data quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.fixture import AS_OF
from checks.oracle import oracle
from earshot.functions.order import asc, desc
from earshot.operators import quality as D
from earshot.operators import upkeep as X
from earshot.operators import worklists as T
from earshot.operators.merge import last_per_key, stamp
from earshot.operators.ordered import number_rows, positions
from earshot.sources.monthly import MonthlyPlays
from earshot.sources.snapshots import fresh_path

Q: dict = {}
NOW = f"TIMESTAMP '{AS_OF}'"


def add(name, fn, sql=None):
    Q[name] = (fn, oracle(sql) if sql else None)


def genres_text(df):
    return df.withColumn("genres", F.array_join("genres", "|"))


def full(target, source, key, columns, matched, inserted, where="true"):
    """FULL JOIN merge in SQL; columns map to expressions over t and s."""
    out = []
    for c in columns:
        if c == key:
            out.append(f"coalesce(t.{key}, s.{key}) AS {key}")
        else:
            out.append(f"CASE WHEN t.{key} IS NULL THEN {inserted.get(c, f's.{c}')} WHEN s.{key} IS NOT NULL THEN {matched.get(c, f't.{c}')} ELSE t.{c} END AS {c}")
    return f"SELECT {', '.join(out)} FROM {{{target}}} t FULL JOIN (SELECT * FROM {source} WHERE {where}) s ON s.{key} = t.{key}"


ALBUM = ["id", "name", "artist", "artist_id", "release_date", "total_tracks", "is_saved", "added_at", "tracks_synced", "album_type", "album_image_url", "tracks_checked_at"]
TRACK = ["id", "name", "artist", "album", "album_id", "from_album", "track_number", "disc_number", "added_at", "duration_ms", "popularity"]
LIKE = ["track_id", "liked_at", "added_at", "last_checked_at", "track_name", "track_artist", "artist_id", "album_id", "album_in_library", "duration_ms", "popularity"]

# plays
add("merge_plays", lambda c: X.new_plays(c.live, c.t["polled"]).select("track_id", "played_at", "track_name"),
    "SELECT DISTINCT track_id, played_at, track_name FROM {polled} p WHERE NOT EXISTS (SELECT 1 FROM {plays} q WHERE q.track_id = p.track_id AND q.played_at = p.played_at)")



def _merged_by_month(c):
    """The live plays as a table by month, after the poll was merged into it."""
    table = MonthlyPlays.create(c.spark, fresh_path(c.spark, "plays_by_month"), c.kept("plays"))
    table.merge(c.t["polled"])
    return table.read().select("track_id", "played_at", "track_name", "month")


add("merge_plays_by_month", _merged_by_month,
    """SELECT track_id, played_at, track_name, coalesce(strftime(played_at, '%Y-%m'), 'none') AS month FROM (SELECT track_id, played_at, track_name FROM {plays}
       UNION ALL SELECT DISTINCT track_id, played_at, track_name FROM {polled} p WHERE NOT EXISTS (SELECT 1 FROM {plays} q WHERE q.track_id = p.track_id AND q.played_at = p.played_at))""")
add("play_row_ids", lambda c: number_rows(c.up.filter("track_id IS NOT NULL").select(
        "played_at", "track_id", F.coalesce("duration_ms", F.lit(0)).alias("ms"), F.coalesce("album_id", F.lit("")).alias("album_id"),
        F.coalesce("track_name", F.lit("")).alias("track_name"), F.coalesce("artist_name", F.lit("")).alias("artist_name")),
        ["played_at", "track_id", "ms", "album_id", "track_name", "artist_name"]),
    """SELECT played_at, track_id, coalesce(duration_ms, 0) AS ms, coalesce(album_id, '') AS album_id, coalesce(track_name, '') AS track_name,
       coalesce(artist_name, '') AS artist_name, min(rid) AS first_id, count(*) AS n FROM {ap} GROUP BY ALL""")
FILL = " OR ".join(f"h.{c} IS NULL" for c in ("artist_id", "album_id", "album_type", "duration_ms"))
add("fill_history", lambda c: X.fill_history(c.kept("stream_history"), c.t["history_meta"], c.as_of),
    f"""SELECT h.track_id, played_at, track_name, artist_name, album_name,
        CASE WHEN m.track_id IS NOT NULL AND ({FILL}) THEN coalesce(m.artist_id, h.artist_id) ELSE h.artist_id END AS artist_id,
        CASE WHEN m.track_id IS NOT NULL AND ({FILL}) THEN coalesce(m.album_id, h.album_id) ELSE h.album_id END AS album_id,
        CASE WHEN m.track_id IS NOT NULL AND ({FILL}) THEN coalesce(m.album_type, h.album_type) ELSE h.album_type END AS album_type,
        CASE WHEN m.track_id IS NOT NULL AND ({FILL}) THEN coalesce(m.duration_ms, h.duration_ms) ELSE h.duration_ms END AS duration_ms,
        CASE WHEN m.track_id IS NOT NULL AND ({FILL}) THEN {NOW} ELSE checked_at END AS checked_at
        FROM {{stream_history}} h LEFT JOIN {{history_meta}} m ON m.track_id = h.track_id""")

# albums
add("merge_albums", lambda c: X.merge_albums(c.kept("albums"), c.t["fresh_albums"]),
    full("albums", "{fresh_albums}", "id", ALBUM,
         {"is_saved": "true", **{n: f"s.{n}" for n in ("added_at", "artist_id", "album_type", "album_image_url")}},
         {"is_saved": "true", "tracks_synced": "false", "tracks_checked_at": "NULL"}))
add("insert_missing_albums", lambda c: X.insert_missing_albums(c.kept("albums"), c.t["fresh_albums"].orderBy(F.desc("added_at"), "id").limit(50)),
    full("albums", "(SELECT * FROM {fresh_albums} ORDER BY added_at DESC, id LIMIT 50)", "id", ALBUM, {}, {"is_saved": "true", "tracks_synced": "false", "tracks_checked_at": "NULL"}))
add("unsave_missing", lambda c: X.unsave_missing(c.kept("albums"), c.t["fresh_albums"]).select("id", "is_saved", "tracks_synced"),
    """SELECT id, is_saved AND id IN (SELECT id FROM {fresh_albums}) AS is_saved, CASE WHEN id IN (SELECT id FROM {fresh_albums}) THEN tracks_synced ELSE false END AS tracks_synced
       FROM {albums}""")


def _prune(c):
    albums, left = X.prune_albums(c.kept("albums"), c.kept("tracks"))
    return albums.select("id", F.lit("album").alias("kind")).unionByName(left.select("id", F.lit("track").alias("kind")))


DOOMED = f"(SELECT id FROM {{albums}} WHERE NOT is_saved AND id NOT IN (SELECT album_id FROM {{tracks}} WHERE from_album))"
add("prune_albums", _prune,
    f"""SELECT id, 'album' AS kind FROM {{albums}} WHERE id NOT IN {DOOMED}
        UNION ALL SELECT id, 'track' FROM {{tracks}} WHERE NOT (from_album AND album_id IN {DOOMED})""")
META = ("name", "artist", "artist_id", "release_date", "album_type", "album_image_url")
add("merge_album_meta", lambda c: X.merge_album_meta(c.kept("albums"), c.t["fresh_albums"].drop("total_tracks", "added_at")),
    full("albums", "{fresh_albums}", "id", ALBUM, {n: f"coalesce(s.{n}, t.{n})" for n in META},
         {"is_saved": "true", "tracks_synced": "false", "tracks_checked_at": "NULL", "total_tracks": "NULL", "added_at": "NULL"}))
add("flag_resync", lambda c: X.flag_resync(c.kept("albums"), D.track_count_mismatch(c.kept("albums"), c.kept("tracks"), c.kept("artists")).select(F.col("album_id").alias("id"))).select("id", "tracks_synced"),
    """SELECT id, CASE WHEN is_saved AND tracks_synced AND total_tracks <> (SELECT count(*) FROM {tracks} t WHERE t.album_id = a.id) THEN false ELSE tracks_synced END AS tracks_synced FROM {albums} a""")
add("stamp_checked", lambda c: X.stamp_synced(c.kept("albums"), T.unsynced_albums(c.kept("albums")).select("id"), c.as_of).select("id", "tracks_synced", "tracks_checked_at"),
    f"""SELECT id, CASE WHEN is_saved AND coalesce(tracks_synced, false) = false THEN true ELSE tracks_synced END AS tracks_synced,
        CASE WHEN is_saved AND coalesce(tracks_synced, false) = false THEN {NOW} ELSE tracks_checked_at END AS tracks_checked_at FROM {{albums}}""")

# tracks and likes
TAKE = {n: f"s.{n}" for n in ("name", "artist", "album", "album_id", "track_number", "disc_number", "duration_ms")}
add("merge_tracks", lambda c: X.merge_tracks(c.kept("tracks").withColumn("added_at", F.when(F.col("track_number") != 5, F.col("added_at"))), c.t["fresh_tracks"]),
    full("tracks", "{fresh_tracks}", "id", TRACK, {**TAKE, "from_album": "true", "popularity": "coalesce(s.popularity, t.popularity)", "added_at": "coalesce(t.added_at, s.added_at)"},
         {"from_album": "true"}).replace("{tracks} t", "(SELECT * REPLACE (CASE WHEN track_number <> 5 THEN added_at END AS added_at) FROM {tracks}) t"))
add("merge_tracks_check", lambda c: X.merge_tracks(c.kept("tracks"), c.t["fresh_tracks"], keep_added=False),
    full("tracks", "{fresh_tracks}", "id", TRACK, {**TAKE, "from_album": "true", "popularity": "coalesce(s.popularity, t.popularity)"}, {"from_album": "true"}))


def _reconcile(c):
    tracks, likes = X.reconcile(c.kept("tracks"), c.kept("liked_tracks"), c.t["fresh_tracks"])
    return tracks.select("id", F.lit("track").alias("kind")).unionByName(likes.select(F.col("track_id").alias("id"), F.lit("like").alias("kind")))


GONE = """(SELECT id FROM {tracks} t WHERE from_album AND album_id IN (SELECT album_id FROM {fresh_tracks})
           AND NOT EXISTS (SELECT 1 FROM {fresh_tracks} f WHERE f.id = t.id AND f.album_id = t.album_id))"""
add("reconcile_remove", _reconcile,
    f"SELECT id, 'track' AS kind FROM {{tracks}} WHERE id NOT IN {GONE} UNION ALL SELECT track_id, 'like' FROM {{liked_tracks}} WHERE track_id NOT IN {GONE}")


def _cascade(c):
    parts = X.cascade_delete(c.kept("albums"), c.kept("tracks"), c.kept("liked_tracks"))
    one = F.lit(1).cast("bigint").alias("n")
    return (parts["albums"].select("id", F.lit("album").alias("kind"), one)
            .unionByName(parts["tracks"].select("id", F.lit("track").alias("kind"), one))
            .unionByName(parts["likes"].select(F.col("track_id").alias("id"), F.lit("like").alias("kind"), one))
            .unionByName(parts["removed_likes"].select(F.col("album_id").alias("id"), F.lit("removed").alias("kind"), F.col("removed").alias("n"))))


UNSAVED = "(SELECT id FROM {albums} WHERE NOT is_saved)"
add("cascade_delete", _cascade,
    f"""SELECT id, 'album' AS kind, 1::BIGINT AS n FROM {{albums}} WHERE is_saved
        UNION ALL SELECT id, 'track', 1 FROM {{tracks}} WHERE album_id NOT IN {UNSAVED}
        UNION ALL SELECT track_id, 'like', 1 FROM {{liked_tracks}} WHERE track_id NOT IN (SELECT id FROM {{tracks}} WHERE album_id IN {UNSAVED})
        UNION ALL SELECT t.album_id, 'removed', count(*) FROM {{liked_tracks}} l JOIN {{tracks}} t ON t.id = l.track_id WHERE t.album_id IN {UNSAVED} GROUP BY t.album_id""")
add("like_enrich", lambda c: X.enrich_likes(c.t["fresh_likes"], c.kept("albums")).select("track_id", "seq", "liked_at", "added_at", "album_in_library"),
    """SELECT track_id, seq, liked_at, coalesce(a.added_at, liked_at) AS added_at, a.id IS NOT NULL AS album_in_library
       FROM {fresh_likes} l LEFT JOIN {albums} a ON a.id = l.album_id""")
add("fresh_likes", lambda c: X.fresh_likes(c.t["fresh_likes"], c.as_of).select("track_id", "seq", "liked_at"),
    f"SELECT track_id, seq, liked_at FROM {{fresh_likes}} WHERE liked_at >= {NOW} - INTERVAL 30 DAY")
LAST = "(SELECT * EXCLUDE (seq) FROM {fresh_likes} QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY seq DESC) = 1)"
add("merge_likes", lambda c: X.merge_likes(c.kept("liked_tracks"), last_per_key(c.t["fresh_likes"], ["track_id"], ["seq"]).drop("seq")),
    full("liked_tracks", LAST, "track_id", LIKE, {n: f"s.{n}" for n in LIKE[1:]}, {}))
add("replace_likes", lambda c: X.replace_likes(c.t["fresh_likes"], ["seq"]), "SELECT * FROM {fresh_likes} QUALIFY row_number() OVER (PARTITION BY track_id ORDER BY seq DESC) = 1")

# artists, availability, exclusions
ARTIST = ["id", "name", "genres", "image_url", "last_checked_at", "last_album_checked_at"]
add("merge_artists", lambda c: genres_text(X.merge_artists(c.kept("artists"), c.t["fresh_artists"])),
    "SELECT * REPLACE (array_to_string(genres, '|') AS genres) FROM (" +
    full("artists", "{fresh_artists}", "id", ARTIST, {n: f"s.{n}" for n in ("name", "genres", "image_url", "last_checked_at")}, {"last_album_checked_at": "NULL"}) + ")")
add("merge_artist_names", lambda c: X.merge_artist_names(c.kept("artists"), c.t["fresh_artists"].select("id", "name")).select("id", "name", "image_url"),
    full("artists", "{fresh_artists}", "id", ["id", "name", "image_url"], {"name": "coalesce(s.name, t.name)"}, {"image_url": "NULL"}))
add("merge_availability", lambda c: X.merge_availability(c.kept("track_availability"), c.t["fresh_availability"]),
    full("track_availability", "{fresh_availability}", "track_id", ["track_id", "is_playable", "checked_at"], {"is_playable": "s.is_playable", "checked_at": "s.checked_at"}, {}))
add("prune_availability", lambda c: X.prune_availability(c.kept("track_availability"), c.kept("liked_tracks"), c.kept("tracks")),
    "SELECT * FROM {track_availability} WHERE track_id IN (SELECT track_id FROM {liked_tracks} UNION SELECT id FROM {tracks})")
add("replace_exclusions", lambda c: X.replace_exclusions(c.kept("excluded_tracks"), c.t["fresh_likes"].select("track_id"), "v1", "v2"), "SELECT DISTINCT track_id FROM {fresh_likes}")

# outdated albums
NEWER = """SELECT DISTINCT a.artist_id, r.artist_name, a.name AS album_name, a.id AS saved_album_id, r.id AS newer_album_id
    FROM {albums} a JOIN (SELECT *, left(release_date, 4) AS y FROM {remote_albums} WHERE release_date IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY artist_id, name, album_type, y ORDER BY position DESC) = 1) r
      ON r.artist_id = a.artist_id AND r.name = a.name AND r.album_type IS NOT DISTINCT FROM a.album_type AND r.y = left(a.release_date, 4)
    WHERE a.is_saved AND NOT EXISTS (SELECT 1 FROM {albums} b WHERE b.is_saved AND b.artist_id = a.artist_id AND b.name = a.name AND b.id = r.id)
      AND NOT EXISTS (SELECT 1 FROM {outdated_albums} o WHERE o.artist_id = a.artist_id AND o.album_name = a.name AND o.newer_album_id = r.id)"""
add("outdated_albums", lambda c: X.newer_editions(c.kept("albums"), c.t["remote_albums"], c.kept("outdated_albums")), NEWER)
SOLVED = "EXISTS (SELECT 1 FROM {albums} a WHERE a.is_saved AND a.artist_id = o.artist_id AND a.name = o.album_name AND a.id = o.newer_album_id)"
add("outdated_resolved", lambda c: X.drop_resolved(c.kept("albums"), c.kept("outdated_albums")), f"SELECT * FROM {{outdated_albums}} o WHERE NOT {SOLVED}")
add("merge_outdated", lambda c: X.merge_outdated(c.kept("outdated_albums"), c.t["reported_albums"], c.as_of),
    f"""SELECT coalesce(t.artist_id, s.artist_id) AS artist_id, coalesce(t.artist_name, s.artist_name) AS artist_name, coalesce(t.album_name, s.album_name) AS album_name,
        coalesce(t.saved_album_id, s.saved_album_id) AS saved_album_id, coalesce(t.newer_album_id, s.newer_album_id) AS newer_album_id,
        CASE WHEN t.saved_album_id IS NULL THEN {NOW} ELSE first_detected_at END AS first_detected_at, CASE WHEN s.newer_album_id IS NULL THEN last_checked_at ELSE {NOW} END AS last_checked_at
        FROM {{outdated_albums}} t FULL JOIN {{reported_albums}} s ON t.saved_album_id = s.saved_album_id AND t.newer_album_id = s.newer_album_id""")
add("stale_artists", lambda c: T.edition_worklist(c.kept("artists"), c.kept("outdated_albums")),
    """SELECT id, name FROM {artists} WHERE id IN (SELECT artist_id FROM {outdated_albums})
       UNION (SELECT id, name FROM {artists} ORDER BY coalesce(last_album_checked_at, TIMESTAMP '2000-01-01'), id LIMIT 30)""")

# equivalents, resolved matches
OKPAIR = "(SELECT trim(alias_track_id) AS alias_track_id, trim(canonical_track_id) AS canonical_track_id, nullif(trim(reason), '') AS reason, created_by FROM {entered} WHERE trim(alias_track_id) <> '' AND trim(alias_track_id) <> trim(canonical_track_id))"
add("merge_equivalents", lambda c: X.merge_equivalents(c.kept("track_id_equivalents"), c.t["entered"], c.as_of),
    full("track_id_equivalents", OKPAIR, "alias_track_id", ["alias_track_id", "canonical_track_id", "reason", "created_by", "created_at"],
         {n: f"s.{n}" for n in ("canonical_track_id", "reason", "created_by")}, {"created_at": NOW}))
add("delete_equivalents", lambda c: X.delete_equivalents(c.kept("track_id_equivalents"), X.valid_equivalents(c.t["entered"])),
    f"SELECT * FROM {{track_id_equivalents}} WHERE alias_track_id NOT IN (SELECT alias_track_id FROM {OKPAIR})")
add("merge_resolved", lambda c: X.merge_resolved(c.kept("resolved_fuzzy_matches"), c.build.stray.fuzzy.filter("fuzz_play_count > 30").select("track_id"), c.as_of),
    f"SELECT * FROM {{resolved_fuzzy_matches}} UNION ALL SELECT track_id, {NOW} FROM {{fz}} WHERE fuzz_play_count > 30 AND track_id NOT IN (SELECT track_id FROM {{resolved_fuzzy_matches}})")

# worklists
add("known_track_ids", lambda c: T.known_track_ids(c.kept("liked_tracks"), c.kept("tracks")), "SELECT track_id FROM {liked_tracks} UNION SELECT id FROM {tracks}")
HOLDERS = ("albums", "liked_tracks", "stream_history", "import_history", "plays")
KNOWN = " UNION ".join(f"SELECT artist_id FROM {{{h}}} WHERE artist_id IS NOT NULL" for h in HOLDERS)
add("known_artist_ids", lambda c: T.known_artist_ids(*[c.kept(h) for h in HOLDERS]), KNOWN)
CHECKED = """(SELECT u.track_id, checked_at FROM (SELECT track_id FROM {liked_tracks} UNION SELECT id FROM {tracks}) u
    LEFT JOIN {track_availability} v ON v.track_id = u.track_id)"""
add("worklist_availability", lambda c: T.availability_worklist(c.kept("liked_tracks"), c.kept("tracks"), c.kept("track_availability")),
    f"""SELECT track_id FROM {CHECKED} WHERE checked_at IS NULL UNION (SELECT track_id FROM {CHECKED} WHERE checked_at IS NOT NULL ORDER BY checked_at, track_id LIMIT 100)""")
add("worklist_artists", lambda c: T.artist_worklist(c.kept("artists"), [c.kept(h) for h in HOLDERS]),
    f"""SELECT artist_id AS id FROM ({KNOWN}) WHERE artist_id NOT IN (SELECT id FROM {{artists}})
        UNION (SELECT id FROM {{artists}} ORDER BY coalesce(last_checked_at, TIMESTAMP '2000-01-01'), id LIMIT 100)""")
add("worklist_albums", lambda c: T.integrity_worklist(c.kept("albums")), "SELECT id, name, added_at FROM {albums} WHERE is_saved ORDER BY tracks_checked_at NULLS FIRST, added_at, id LIMIT 50")
add("worklist_backfill", lambda c: T.backfill_worklist(c.kept("stream_history")),
    f"SELECT track_id FROM {{stream_history}} h WHERE track_id IS NOT NULL AND ({FILL}) GROUP BY track_id ORDER BY min(checked_at) NULLS FIRST, min(played_at), track_id LIMIT 500")
add("worklist_unsynced", lambda c: T.unsynced_albums(c.kept("albums")).select("id", F.lit("unsynced").alias("kind")).unionByName(T.unsaved_albums(c.kept("albums")).select("id", F.lit("unsaved").alias("kind"))),
    "SELECT id, 'unsynced' AS kind FROM {albums} WHERE is_saved AND (tracks_synced = false OR tracks_synced IS NULL) UNION ALL SELECT id, 'unsaved' FROM {albums} WHERE is_saved = false")
OPEN = "matched_track_id IS NULL AND match_checked_at IS NULL AND name IS NOT NULL AND artist_name IS NOT NULL"
add("worklist_link", lambda c: T.link_worklist(c.kept("import_catalog"), 200).select("import_id", F.lit("link").alias("kind")).unionByName(
        T.link_metadata_worklist(c.kept("import_catalog")).select("import_id", F.lit("meta").alias("kind"))),
    f"""(SELECT import_id, 'link' AS kind FROM {{import_catalog}} WHERE {OPEN} ORDER BY import_id LIMIT 200)
        UNION ALL SELECT import_id, 'meta' FROM {{import_catalog}} WHERE matched_track_id IS NOT NULL AND matched_name IS NULL AND match_checked_at IS NULL""")
add("mark_unmatched", lambda c: stamp(c.kept("import_catalog"), "import_id", T.link_worklist(c.kept("import_catalog")).select("import_id"), {"match_checked_at": F.lit(c.as_of).cast("timestamp_ntz")}).select("import_id", "match_checked_at"),
    f"SELECT import_id, CASE WHEN {OPEN} THEN {NOW} ELSE match_checked_at END AS match_checked_at FROM {{import_catalog}}")


def _link_meta(c):
    stored = c.kept("import_catalog")
    return X.fill_link_metadata(stored, T.link_metadata_worklist(stored), c.t["fetched_names"], c.as_of).select("import_id", "matched_track_id", "matched_name", "match_checked_at")


PEND = "(i.matched_track_id IS NOT NULL AND i.matched_name IS NULL AND i.match_checked_at IS NULL)"
add("fill_link_meta", _link_meta,
    f"""SELECT import_id, matched_track_id, CASE WHEN {PEND} AND k.id IS NOT NULL THEN k.name ELSE matched_name END AS matched_name,
        CASE WHEN {PEND} THEN {NOW} ELSE match_checked_at END AS match_checked_at
        FROM {{import_catalog}} i LEFT JOIN {{catalog}} k ON k.id = i.matched_track_id AND k.duration_ms > 900000""")

# data quality
add("dup_album_tracks", lambda c: D.surplus_tracks(c.kept("albums"), c.kept("tracks")),
    """SELECT a.id AS album_id, a.name AS album_name, total_tracks, count(*) AS track_count, count(*) - total_tracks AS extra_tracks
       FROM {albums} a JOIN {tracks} t ON t.album_id = a.id GROUP BY a.id, a.name, total_tracks HAVING count(*) > total_tracks""")
add("track_count_mismatch", lambda c: D.track_count_mismatch(c.kept("albums"), c.kept("tracks"), c.kept("artists")),
    """SELECT a.id AS album_id, a.name AS album_name, r.name AS artist_name, total_tracks AS expected_track_count, count(t.id) AS actual_track_count,
              total_tracks - count(t.id) AS track_count_difference
       FROM {albums} a LEFT JOIN {tracks} t ON t.album_id = a.id LEFT JOIN {artists} r ON r.id = a.artist_id WHERE is_saved AND tracks_synced
       GROUP BY a.id, a.name, r.name, total_tracks HAVING count(t.id) <> total_tracks""")
add("fuzzy_report", lambda c: D.fuzzy_report(c.every_play, c.kept("tracks"), c.kept("albums"), c.kept("resolved_fuzzy_matches")),
    """SELECT p.track_id AS original_track_id, p.track_name AS original_track_name, p.artist_name AS original_artist_name, p.played_at, t.id AS library_track_id,
              t.name AS library_track_name, t.artist AS library_artist_name, t.album_id AS library_album_id, a.name AS library_album_name
       FROM (SELECT track_id, track_name, artist_name, played_at, duration_ms FROM {plays} UNION ALL SELECT track_id, track_name, artist_name, played_at, duration_ms FROM {stream_history}
             UNION ALL SELECT track_id, track_name, artist_name, played_at, duration_ms FROM {import_history}) p JOIN {tracks} t ON lower(p.track_name) = lower(t.name) AND lower(p.artist_name) = lower(t.artist)
            AND abs(coalesce(p.duration_ms, 0) - coalesce(t.duration_ms, 0)) <= 1000 AND p.track_id <> t.id
       LEFT JOIN {albums} a ON a.id = t.album_id WHERE t.id NOT IN (SELECT track_id FROM {resolved_fuzzy_matches})""")


def _listings(c):
    """Each listing with the place of its rows."""
    def listing(df, kind, order, *cols):
        placed = positions(df, [], order)
        return placed.select(F.lit(kind).alias("listing"), "position", *[F.col(x).cast("string").alias(f"c{i}") for i, x in enumerate(cols)])

    return reduce(DataFrame.unionByName, [
        listing(c.kept("outdated_albums"), "outdated", [desc("last_checked_at"), asc("saved_album_id"), asc("newer_album_id")], "saved_album_id", "newer_album_id"),
        listing(D.pending_playlists(c.t["playlist_mappings"]), "pending", [desc("last_missing_at"), asc("slug")], "slug", "missing_count"),
        listing(c.kept("track_id_equivalents"), "equivalent", [desc("created_at"), asc("alias_track_id")], "alias_track_id", "reason"),
        listing(c.t["playlist_mappings"], "playlist", [asc("name"), asc("slug")], "slug", "name"),
    ])


add("dq_listings", _listings,
    """SELECT 'outdated' AS listing, row_number() OVER (ORDER BY last_checked_at DESC NULLS FIRST, saved_album_id, newer_album_id) AS position, saved_album_id AS c0, newer_album_id AS c1 FROM {outdated_albums}
       UNION ALL SELECT 'pending', row_number() OVER (ORDER BY last_missing_at DESC NULLS FIRST, slug), slug, CAST(missing_count AS VARCHAR) FROM {playlist_mappings} WHERE pending_delete
       UNION ALL SELECT 'equivalent', row_number() OVER (ORDER BY created_at DESC NULLS FIRST, alias_track_id), alias_track_id, reason FROM {track_id_equivalents}
       UNION ALL SELECT 'playlist', row_number() OVER (ORDER BY name NULLS LAST, slug), slug, name FROM {playlist_mappings}""")
add("exclusions_version", lambda c: X.exclusions_version(c.t["playlist_mappings"], "v2", "list_1").select("slug", "snapshot_id"),
    "SELECT slug, CASE WHEN slug = 'list_1' THEN 'v2' ELSE snapshot_id END AS snapshot_id FROM {playlist_mappings}")
add("count_gate", lambda c: D.count_gate(c.kept("albums").filter("is_saved"), 77),
    "SELECT count(*) > 0 AS has_rows, count(*) AS local_total, 77::BIGINT AS remote_total, count(*) = 77 AS up_to_date FROM {albums} WHERE is_saved")
add("dq_constraints", lambda c: D.repeated_keys(c.kept("plays"), ["track_id", "played_at"], "plays").unionByName(
        D.repeated_keys(c.kept("stream_history"), ["track_id", "played_at"], "stream_history")).unionByName(
        D.repeated_keys(c.kept("outdated_albums"), ["saved_album_id", "newer_album_id"], "outdated_albums")).unionByName(D.self_aliases(c.kept("track_id_equivalents"))),
    " UNION ALL ".join(f"SELECT '{t}' AS check, count(*) AS violations, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows FROM (SELECT count(*) AS n FROM {{{t}}} WHERE {k[0]} IS NOT NULL GROUP BY {', '.join(k)} HAVING count(*) > 1)"
                       for t, k in (("plays", ("track_id", "played_at")), ("stream_history", ("track_id", "played_at")), ("outdated_albums", ("saved_album_id", "newer_album_id"))))
    + " UNION ALL SELECT 'alias_is_canonical', count(*), count(*) FROM {track_id_equivalents} WHERE alias_track_id = canonical_track_id")
add("log_page", lambda c: D.log_page(c.t["logs"], "error", "error", newest=True, page=3),
    """SELECT "timestamp", source, level, message FROM {logs} WHERE source = 'error' AND level = 'error' ORDER BY "timestamp" DESC, id DESC LIMIT 50 OFFSET 100""")
