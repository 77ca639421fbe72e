"""Registered queries of the rule selector and the playlists."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from checks.fixture import AS_OF
from checks.oracle import oracle
from earshot.functions.text import slug, url_tail
from earshot.operators.rules import compile_rule, select_by_rule, uri
from earshot.plans import playlists as L
from earshot.sources.snapshots import fresh_path

Q: dict = {}
NOW = f"TIMESTAMP '{AS_OF}'"
PLAYS_FIRST = "play_count DESC NULLS FIRST, track_id"


def add(name, fn, sql=None):
    Q[name] = (fn, oracle(sql) if sql else None)


def cond(field, value, operator=None, unit=None):
    return {"field": field, "operator": operator, "value": value, **({"unit": unit} if unit else {})}


def rule(name, document, where, order=PLAYS_FIRST, limit=9000, guard="is_playable AND NOT excluded"):
    document = {"limit": limit, **document} if limit != 100 else document
    add(name,
        lambda c: L.ranked_members(c.ut, {name: compile_rule(document, c.as_of)}).select("position", "uri"),
        f"""SELECT CAST(row_number() OVER (ORDER BY {order}) AS INT) AS position, 'spotify:track:' || track_id AS uri FROM {{ut}}
            WHERE ({where}) AND {guard} ORDER BY position LIMIT {limit}""")


def all_of(*conditions):
    return {"match": "all", "conditions": list(conditions)}


def any_of(*conditions):
    return {"match": "any", "conditions": list(conditions)}


rule("rule_min_plays", all_of(cond("min_plays", "30")), "play_count >= 30")
rule("rule_max_plays", all_of(cond("max_plays", 12)), "play_count <= 12")
rule("rule_plays", any_of(cond("plays", 30, "is"), cond("plays", 31, "eq"), cond("plays", 60, "gt"), cond("plays", 5, "lt"),
                          all_of(cond("plays", 20, "gte"), cond("plays", 24, "lte"), cond("plays", 22, "is_not"))),
     "play_count IN (30, 31) OR play_count > 60 OR play_count < 5 OR (play_count BETWEEN 20 AND 24 AND play_count <> 22)")
rule("rule_added_range", all_of(cond("added_after", "1995-03-01"), cond("added_before", "1998-07-20")),
     "added_at >= TIMESTAMP '1995-03-01' AND added_at <= TIMESTAMP '1998-07-20'")
rule("rule_date_added", all_of(cond("date_added", "1995-01-20", "gt"), cond("date_added", "1995-06-30T12:00:00", "lte"),
                               any_of(cond("date_added", "1995-02-01", "lt"), cond("date_added", "1995-03-01", "gte"), cond("date_added", "1995-02-14", "eq"))),
     """added_at > TIMESTAMP '1995-01-20' AND added_at <= TIMESTAMP '1995-06-30 12:00:00' AND
        (added_at < TIMESTAMP '1995-02-01' OR added_at >= TIMESTAMP '1995-03-01' OR added_at = TIMESTAMP '1995-02-14')""")
rule("rule_added_in_last", all_of(cond("added_in_last", "345", "eq", "months")), f"added_at >= {NOW} - INTERVAL 345 MONTH")
rule("rule_played_in_last", any_of(cond("last_played_in_last", 3, "eq", "weeks"), cond("last_played_in_last", 8200, "is_not", "days")),
     f"last_played_at >= {NOW} - INTERVAL 21 DAY OR last_played_at < {NOW} - INTERVAL 8200 DAY")
rule("rule_played_since", all_of(cond("last_played", "2001-07-01"), cond("first_played", "1995-02-01")),
     "last_played_at >= TIMESTAMP '2001-07-01' AND first_played_at >= TIMESTAMP '1995-02-01'")
rule("rule_flags", all_of(cond("is_liked", False), cond("is_playable", "false")), "NOT is_liked AND NOT is_playable", guard="NOT excluded")
rule("rule_text", any_of(cond("artist", "brand#_5"), cond("album", "nation_1%"), cond("track", "GE\\AR")),
     "lower(artist) LIKE '%brand#_5%' OR lower(album_name) LIKE '%nation_1%%' OR lower(track_name) LIKE '%gear%'")
rule("rule_source", all_of(cond("track_source", "non_library", "eq"), cond("track_source", "both", "is_not")), "track_source = 'non_library'")
rule("rule_origin", any_of(cond("library_origin", "liked_only", "eq"), all_of(cond("library_origin", "album", "is_not"), cond("min_plays", 20))),
     "library_origin = 'liked_only' OR (library_origin <> 'album' AND play_count >= 20)")
rule("rule_nested", any_of(all_of(cond("is_liked", True), any_of(cond("track", "ring"), cond("track", "bolt"))), all_of(cond("min_plays", 40), any_of())),
     "(is_liked AND (track_name ILIKE '%ring%' OR track_name ILIKE '%bolt%')) OR play_count >= 40")
rule("rule_invalid", all_of(cond("tempo", 120, "eq"), cond("plays", "many", "gt"), cond("plays", 3, "near"), cond("added_in_last", 3, "eq", "years"),
                            cond("track_source", "moon", "eq"), cond("is_liked", "perhaps")), "true")
rule("rule_guards", any_of(cond("min_plays", 50), cond("is_liked", True)), "play_count >= 50 OR is_liked")
rule("rule_sort", {**all_of(cond("min_plays", 1)), "sort": [{"by": "artist", "direction": "asc"}, {"by": "last_played", "direction": "desc"}, {"by": "album", "direction": "sideways"},
                                                           {"by": "track", "direction": "asc"}]},
     "play_count >= 1", order="artist ASC NULLS LAST, last_played_at DESC NULLS FIRST, track_name ASC NULLS LAST, track_id")
rule("rule_sort_fact", {**all_of(cond("min_plays", 1)), "sort": [{"by": "skip_play_count", "direction": "desc"}]}, "play_count >= 1",
     order="skip_play_count DESC NULLS FIRST, track_id")
rule("rule_limit_long", all_of(cond("max_plays", 10_000)), "play_count <= 10000", limit=12_000)
rule("rule_limit", all_of(cond("track_source", "library", "eq")), "track_source = 'library'", limit=100)
add("rule_uri", lambda c: select_by_rule(c.ut, all_of(cond("min_plays", 25)), c.as_of).select(uri().alias("uri")),
    f"SELECT 'spotify:track:' || track_id AS uri FROM {{ut}} WHERE play_count >= 25 AND is_playable AND NOT excluded ORDER BY {PLAYS_FIRST} LIMIT 100")

# the rule documents of the fixture's playlists, by what their `rules` column names
DOCUMENTS = {
    "BUILDING": {**all_of(cond("min_plays", 30)), "limit": 150},
    "MACHINERY": {**any_of(cond("is_liked", True), cond("track_source", "non_library", "eq")), "sort": [{"by": "added", "direction": "asc"}], "limit": 120},
    "HOUSEHOLD": {**all_of(cond("artist", "Brand#1"), cond("max_plays", 0)), "limit": 50},
    "FURNITURE": [],
    "AUTOMOBILE": {"limit": 7},
}
MEMBERS = f"""(SELECT 'BUILDING' AS segment, row_number() OVER (ORDER BY {PLAYS_FIRST}) AS pos, track_id FROM {{ut}} WHERE is_playable AND NOT excluded AND play_count >= 30 ORDER BY pos LIMIT 150)
    UNION ALL (SELECT 'MACHINERY', row_number() OVER (ORDER BY added_at ASC NULLS LAST, track_id) AS pos, track_id FROM {{ut}}
               WHERE is_playable AND NOT excluded AND (is_liked OR track_source = 'non_library') ORDER BY pos LIMIT 120)
    UNION ALL (SELECT 'HOUSEHOLD', row_number() OVER (ORDER BY {PLAYS_FIRST}) AS pos, track_id FROM {{ut}}
               WHERE is_playable AND NOT excluded AND lower(artist) LIKE '%brand#1%' AND play_count <= 0 ORDER BY pos LIMIT 50)"""


def lists(c):
    """The fixture's playlists with their rule documents and some stored hashes."""
    doc = F.coalesce(*[F.when(F.col("rules") == k, F.lit(json.dumps(v))) for k, v in DOCUMENTS.items()])
    return c.t["playlist_mappings"].withColumn("rules", doc)


def stored(c):
    """Playlists of even nations were synced before, with the hash of what they select now."""
    members = L.all_playlists(c.ut, lists(c), c.as_of)
    hashes = L.tracklist_hashes(members, "slug")
    return lists(c).join(hashes, "slug", "left").withColumn(
        "last_synced_hash", F.when(F.col("snapshot_id").isin("S0", "S2", "S4", "S6", "S8"), F.col("new_hash")).when(F.col("snapshot_id") == "S1", "old")
    ).drop("new_hash", "new_count")


add("all_playlists", lambda c: L.all_playlists(c.ut, lists(c), c.as_of).select("slug", "position", "uri"),
    f"SELECT p.slug, CAST(pos AS INT) AS position, 'spotify:track:' || track_id AS uri FROM {{playlist_mappings}} p JOIN ({MEMBERS}) m ON m.segment = p.rules")
add("playlist_members", lambda c: L.all_playlists(c.ut, lists(c), c.as_of).groupBy("slug", "batch").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("from_position"), F.max("position").alias("to_position")),
    f"""SELECT p.slug, CAST((pos - 1) // 100 AS INT) AS batch, count(*) AS n, CAST(min(pos) AS INT) AS from_position, CAST(max(pos) AS INT) AS to_position
        FROM {{playlist_mappings}} p JOIN ({MEMBERS}) m ON m.segment = p.rules GROUP BY ALL""")


def written(c):
    """The members table after two runs: first every playlist holds itself, then those with usable rules get what they select,
    which may be nothing. Playlists that are not dynamic, or whose rules cannot be read, keep what they hold."""
    path = fresh_path(c.spark, "members")
    L.write_members(c.t["playlist_mappings"].select("slug", F.lit(1).alias("position"), F.lit(0).alias("batch"), F.col("playlist_id").alias("uri")), path)
    usable = c.t["playlist_mappings"].filter("is_dynamic AND rules <> 'FURNITURE'")
    return L.write_members(L.all_playlists(c.ut, lists(c), c.as_of), path, usable).read()


add("stored_members", lambda c: written(c).select("slug", "position", "uri"),
    f"""SELECT p.slug, CAST(pos AS INT) AS position, 'spotify:track:' || track_id AS uri FROM {{playlist_mappings}} p JOIN ({MEMBERS}) m ON m.segment = p.rules
        UNION ALL SELECT slug, 1, playlist_id FROM {{playlist_mappings}} WHERE NOT is_dynamic OR rules = 'FURNITURE'""")
HASHES = f"SELECT p.slug, sha256(string_agg('spotify:track:' || track_id, ',' ORDER BY pos)) AS new_hash, CAST(count(*) AS INT) AS new_count FROM {{playlist_mappings}} p JOIN ({MEMBERS}) m ON m.segment = p.rules GROUP BY p.slug"
add("tracklist_hash", lambda c: L.tracklist_hashes(L.all_playlists(c.ut, lists(c), c.as_of), "slug"), HASHES)
add("change_gate", lambda c: L.change_gate(c.ut, stored(c), c.as_of).select("slug", "last_synced_at", "track_count", "last_synced_hash", "outcome"),
    f"""SELECT slug, CASE WHEN ran THEN {NOW} END AS last_synced_at,
            CASE WHEN ran AND old_hash IS DISTINCT FROM new_hash THEN new_count ELSE track_count END AS track_count,
            CASE WHEN ran AND old_hash IS DISTINCT FROM new_hash AND new_count > 0 THEN new_hash ELSE old_hash END AS last_synced_hash,
            CASE WHEN ran THEN CASE WHEN old_hash IS NOT DISTINCT FROM new_hash THEN 'unchanged' WHEN new_count = 0 THEN 'emptied' ELSE 'changed' END END AS outcome
        FROM (SELECT p.slug, p.is_dynamic AND p.rules <> 'FURNITURE' AS ran, p.track_count, coalesce(h.new_hash, sha256('')) AS new_hash, coalesce(h.new_count, 0) AS new_count,
                     CASE WHEN p.snapshot_id IN ('S0', 'S2', 'S4', 'S6', 'S8') THEN h.new_hash WHEN p.snapshot_id = 'S1' THEN 'old' END AS old_hash
              FROM {{playlist_mappings}} p LEFT JOIN ({HASHES}) h ON h.slug = p.slug) s""")


def upstream(c):
    return c.t["customer"].filter("c_mktsegment <> 'FURNITURE'").select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("id"))


add("soft_delete", lambda c: L.soft_delete(c.t["playlist_mappings"], upstream(c), c.as_of).select(
        "slug", "pending_delete", "missing_count", "last_missing_at", "last_missing_reason", "last_seen_at"),
    f"""SELECT slug, gone AS pending_delete, CASE WHEN gone THEN coalesce(missing_count, 0) + 1 ELSE 0 END AS missing_count, CASE WHEN gone THEN {NOW} END AS last_missing_at,
        CASE WHEN gone THEN 'playlist not found in user''s library' END AS last_missing_reason, CASE WHEN gone THEN {NOW} ELSE last_seen_at END AS last_seen_at
        FROM (SELECT *, rules = 'FURNITURE' AS gone FROM {{playlist_mappings}})""")
add("ignore_missing", lambda c: L.ignore_missing(c.t["playlist_mappings"], c.t["playlist_mappings"].filter("missing_count > 10")).select(
        "slug", "pending_delete", "missing_count", "last_missing_at", "last_missing_reason"),
    """SELECT slug, CASE WHEN missing_count > 10 THEN false ELSE pending_delete END AS pending_delete, CASE WHEN missing_count > 10 THEN 0 ELSE missing_count END AS missing_count,
       CASE WHEN missing_count > 10 THEN NULL ELSE last_missing_at END AS last_missing_at, CASE WHEN missing_count > 10 THEN NULL ELSE last_missing_reason END AS last_missing_reason
       FROM {playlist_mappings}""")
add("delete_candidates", lambda c: L.delete_candidates(c.t["playlist_mappings"]),
    """SELECT CAST((place - 1) // 1000 AS INT) AS line, count(*) AS flagged, string_agg(slug || '(misses=' || coalesce(CAST(missing_count AS VARCHAR), 'None') || ')', ', ' ORDER BY place) AS summary
       FROM (SELECT *, row_number() OVER (ORDER BY last_missing_at DESC NULLS LAST, slug) AS place FROM {playlist_mappings} WHERE pending_delete) GROUP BY ALL""")
add("rule_problems", lambda c: L.run_rules(c.ut, lists(c), c.as_of).problems.select("rule", "fatal").distinct(),
    "SELECT DISTINCT CASE rules WHEN 'FURNITURE' THEN '[]' END AS rule, true AS fatal FROM {playlist_mappings} WHERE rules = 'FURNITURE' AND is_dynamic")
add("slugify", lambda c: c.t["playlist_mappings"].select("name", slug(F.col("name")).alias("slug")), "SELECT name, replace(lower(name), ' ', '_') AS slug FROM {playlist_mappings}")
add("url_tail", lambda c: c.t["pages"].select("page_id", url_tail(F.col("url")).alias("tail")).unionByName(
        c.t["playlist_mappings"].select(F.lit(None).cast("bigint").alias("page_id"), url_tail(F.col("playlist_id")).alias("tail"))),
    """SELECT page_id, split_part(split_part(url, '/', -1), '?', 1) AS tail FROM {pages}
       UNION ALL SELECT NULL, split_part(split_part(playlist_id, '/', -1), '?', 1) FROM {playlist_mappings}""")
add("json_roundtrip", lambda c: lists(c).select("slug", F.from_json("rules", "match string, limit int, conditions array<struct<field string, value string>>").alias("r")).select(
        "slug", "r.match", F.coalesce("r.limit", F.lit(100)).alias("limit"), F.get("r.conditions", F.lit(0))["field"].alias("first_field")),
    """SELECT slug, CASE rules WHEN 'MACHINERY' THEN 'any' WHEN 'FURNITURE' THEN NULL WHEN 'AUTOMOBILE' THEN NULL ELSE 'all' END AS match,
       CASE rules WHEN 'BUILDING' THEN 150 WHEN 'MACHINERY' THEN 120 WHEN 'HOUSEHOLD' THEN 50 WHEN 'FURNITURE' THEN 100 ELSE 7 END AS "limit",
       CASE rules WHEN 'BUILDING' THEN 'min_plays' WHEN 'MACHINERY' THEN 'is_liked' WHEN 'HOUSEHOLD' THEN 'artist' END AS first_field FROM {playlist_mappings}""")
