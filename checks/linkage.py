"""Registered queries of record linkage."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixture import AS_OF
from checks.oracle import oracle
from earshot.functions.text import norm_album, norm_title
from earshot.operators import link as L
from earshot.operators import upkeep as X
from earshot.operators import worklists as T

Q: dict = {}
NOW = f"TIMESTAMP '{AS_OF}'"


def add(name, fn, sql=None):
    Q[name] = (fn, oracle(sql) if sql else None)


def title_sql(x):
    folded = f"replace(lower({x}), 'άλφα йод ｗｉｄｅ ﬁn', 'αλφα иод wide fin')"
    return f"trim(regexp_replace({folded}, ' \\(2011 remaster\\)| - live| \\(deluxe edition\\)', ''))"


def album_sql(x):
    return f"coalesce(trim(regexp_replace(lower({x}), ' \\(deluxe\\)', '')), '')"


def keyed(c):
    return L.with_keys(c.kept("import_catalog"), "name", "artist_name", "album_name"), L.with_keys(c.kept("catalog"), "name", "artist", "album_name")


def results(c):
    source, catalogue = keyed(c)
    return L.search(source, catalogue)


ASKED = f"(SELECT import_id, {title_sql('name')} AS title_key, lower(artist_name) AS artist_key, {album_sql('album_name')} AS album_key, duration_ms FROM {{import_catalog}})"
OFFERED = "(SELECT id, name, artist, artist_id, album_id, album_name, album_type, duration_ms, lower(name) AS found_key, lower(artist) AS artist_key, lower(album_name) AS found_album FROM {catalog})"
def sim_sql(a, b):
    return f"CASE WHEN length({a}) > 0 AND length({b}) > 0 THEN 1 - levenshtein({a}, {b}) / greatest(length({a}), length({b})) ELSE 0.0 END"


RESULTS = f"""(SELECT * EXCLUDE (same), row_number() OVER (PARTITION BY artist_key, title_key, album_key ORDER BY title_sim DESC, same DESC, id) AS position
    FROM (SELECT a.artist_key, a.title_key, a.album_key, o.*, {sim_sql('a.title_key', 'o.found_key')} AS title_sim, a.album_key = o.found_album AND a.album_key <> '' AS same
          FROM (SELECT DISTINCT artist_key, title_key, album_key FROM {ASKED}) a JOIN (SELECT * EXCLUDE (artist_key), artist_key AS ak FROM {OFFERED}) o ON o.ak = a.artist_key)
    WHERE title_sim >= 0.7 QUALIFY position <= 10)"""


SCORED = f"""(SELECT s.import_id, r.*, abs(r.duration_ms - s.duration_ms) AS gap, {sim_sql('r.album_key', 'r.found_album')} AS album_sim
    FROM {ASKED} s JOIN {RESULTS} r ON r.artist_key = s.artist_key AND r.title_key = s.title_key AND r.album_key = s.album_key)"""
DSCORE = "CASE WHEN {g} IS NULL OR {g} >= 20000 THEN 0.0 WHEN {g} <= 5000 THEN 1.0 ELSE 1.0 - ({g} - 5000) / 15000.0 END"
GATED = f"""(SELECT *, round(CAST(title_sim * 0.75 + album_sim * 0.2 + ({DSCORE.format(g='gap')}) * 0.05 AS DOUBLE), 9) AS score FROM {SCORED}
    WHERE title_sim >= 0.7 AND coalesce(gap <= 20000, true) AND (album_key = '' OR found_album = '' OR album_sim >= 0.35 OR coalesce(gap <= 5000, false)))"""
# the same arithmetic in doubles, unrounded: what decides near ties
EXACT = GATED.replace("round(CAST(title_sim * 0.75 + album_sim * 0.2 + (", "(title_sim * 0.75::DOUBLE + album_sim * 0.2::DOUBLE + CAST((").replace(") * 0.05 AS DOUBLE), 9) AS score", ") AS DOUBLE) * 0.05::DOUBLE) AS score").replace("1.0 - (gap - 5000) / 15000.0", "1.0::DOUBLE - (gap - 5000) / 15000.0::DOUBLE")
BEST_EXACT = f"(SELECT * FROM {EXACT} QUALIFY row_number() OVER (PARTITION BY import_id ORDER BY score DESC, position) = 1)"
BEST = f"(SELECT * FROM {GATED} QUALIFY row_number() OVER (PARTITION BY import_id ORDER BY score DESC, position) = 1)"


def edit_scored(c):
    source, _ = keyed(c)
    wanted = source.select("import_id", "duration_ms", *L.QUERY)
    return L.scored(wanted, results(c))


add("norm_title", lambda c: c.kept("import_catalog").select("import_id", norm_title(F.col("name")).alias("title")), f"SELECT import_id, {title_sql('name')} AS title FROM {{import_catalog}}")
add("norm_album", lambda c: c.kept("import_catalog").select("import_id", norm_album(F.col("album_name")).alias("album")), f"SELECT import_id, {album_sql('album_name')} AS album FROM {{import_catalog}}")
add("link_candidates", lambda c: results(c).select(*L.QUERY, "id", F.round("title_sim", 9).alias("title_sim"), F.col("position").cast("bigint").alias("position")),
    f"SELECT artist_key, title_key, album_key, id, round(CAST(title_sim AS DOUBLE), 9) AS title_sim, position FROM {RESULTS}")
add("text_similarity", lambda c: results(c).select("title_key", "found_key", "album_key", "found_album").distinct().select(
        "title_key", "found_key", "album_key", "found_album", F.round(L.edit_share(F.col("title_key"), F.col("found_key")), 9).alias("title_sim"),
        F.round(L.edit_share(F.col("album_key"), F.col("found_album")), 9).alias("album_sim")),
    f"""SELECT DISTINCT title_key, found_key, album_key, found_album, round(CAST({sim_sql('title_key', 'found_key')} AS DOUBLE), 9) AS title_sim,
        round(CAST({sim_sql('album_key', 'found_album')} AS DOUBLE), 9) AS album_sim FROM {RESULTS}""")
add("duration_score", lambda c: c.kept("import_catalog").join(c.kept("catalog").select(F.substring("id", 2, 20).cast("bigint").alias("import_id"), F.col("duration_ms").alias("ms")), "import_id").select(
        "import_id", F.round(L.duration_score(F.abs(F.col("duration_ms") - F.col("ms"))), 9).alias("score")),
    f"SELECT import_id, round(CAST({DSCORE.format(g='g')} AS DOUBLE), 9) AS score FROM (SELECT import_id, abs(i.duration_ms - k.duration_ms) AS g FROM {{import_catalog}} i JOIN {{catalog}} k ON k.id = 'T' || CAST(import_id AS VARCHAR))")
add("link_gates", lambda c: edit_scored(c).select("import_id", "id", F.round("score", 9).alias("score")), f"SELECT import_id, id, score FROM {GATED}")
add("link_best_edit", lambda c: L.best(edit_scored(c).withColumn("score", F.round("score", 9))).select("import_id", "id", "score"), f"SELECT import_id, id, score FROM {BEST}")
ROUNDED = ("score", "title_sim", "album_sim")
add("link_best", lambda c: L.link(c.kept("import_catalog").filter("artist_name IS NOT NULL"), c.kept("catalog")).withColumns({x: F.round(x, 9) for x in ROUNDED}),
    f"""SELECT import_id, id AS matched_track_id, name AS matched_name, artist_id AS matched_artist_id, duration_ms AS matched_duration_ms, artist AS matched_artist_name,
        album_id AS matched_album_id, album_name AS matched_album_name, album_type AS matched_album_type,
        {', '.join(f'round(CAST({x} AS DOUBLE), 9) AS {x}' for x in ROUNDED)} FROM {BEST_EXACT}""")


def _link_catalog(c):
    stored = c.kept("import_catalog")
    todo = T.link_worklist(stored)
    links = L.link(todo, c.kept("catalog"))
    return X.merge_links(stored, links, todo, c.as_of).select("import_id", "matched_track_id", "matched_name", "match_checked_at")


OPEN = "(i.matched_track_id IS NULL AND i.match_checked_at IS NULL AND i.name IS NOT NULL AND i.artist_name IS NOT NULL)"
add("link_catalog", _link_catalog,
    f"""SELECT i.import_id, CASE WHEN {OPEN} THEN b.id ELSE i.matched_track_id END AS matched_track_id, CASE WHEN {OPEN} THEN b.name ELSE i.matched_name END AS matched_name,
        CASE WHEN {OPEN} THEN {NOW} ELSE i.match_checked_at END AS match_checked_at FROM {{import_catalog}} i LEFT JOIN {BEST_EXACT} b ON b.import_id = i.import_id""")


def _merge_links(c):
    """What a run found for every row it tried: part of them stay unmatched."""
    stored = c.kept("import_catalog")
    tried = T.link_worklist(stored)
    links = tried.select("import_id").join(c.t["search_results"], "import_id")
    return X.merge_links(stored, links, tried, c.as_of).select("import_id", "matched_track_id", "matched_name", "match_checked_at")


add("merge_links", _merge_links,
    f"""SELECT import_id, CASE WHEN {OPEN} AND duration_ms > 940000 THEN 'T' || CAST(import_id AS VARCHAR) ELSE matched_track_id END AS matched_track_id,
        CASE WHEN {OPEN} AND duration_ms > 940000 THEN lower(name) ELSE matched_name END AS matched_name,
        CASE WHEN {OPEN} THEN {NOW} ELSE match_checked_at END AS match_checked_at FROM {{import_catalog}} i""")
