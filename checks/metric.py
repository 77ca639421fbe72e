"""Registered queries of the dashboard."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.fixture import AS_OF
from checks.oracle import oracle
from earshot.functions.numbers import half_even, half_up, ratio
from earshot.functions.times import ago, micros, partial_date, span_text
from earshot.operators import metrics as M
from earshot.operators.ordered import above, hour_sizes, neighbour
from earshot.plans import dashboard as D
from earshot.sources.snapshots import latest_metrics, read_metrics, write_metrics
from earshot.session import shared_dir

Q: dict = {}


def add(name, fn, sql=None):
    Q[name] = (fn, oracle(sql) if sql else None)


NOW = f"TIMESTAMP '{AS_OF}'"
IMG = "'/app/static/img/no_image.png'"

TOP_ARTISTS = f"""SELECT artist, coalesce(artist_image, {IMG}) AS image_url, CAST(sum(play_count) AS BIGINT) AS count FROM {{ut}} WHERE play_count > 0
    GROUP BY artist, artist_image ORDER BY count DESC, artist NULLS LAST, image_url LIMIT 10"""
TOP_TRACKS = f"""SELECT track_name, artist, coalesce(album_image_url, artist_image, {IMG}) AS image_url, play_count AS count FROM {{ut}}
    WHERE play_count > 0 ORDER BY play_count DESC, track_id LIMIT 10"""
DAILY = f"SELECT CAST(played_at AS DATE) AS date, count(*) AS count FROM {{up}} WHERE played_at >= {NOW} - INTERVAL 30 DAY GROUP BY 1"
TOP_ALBUMS = f"""SELECT album_name, artist, coalesce(min(album_image_url), {IMG}) AS image_url, CAST(sum(play_count) AS BIGINT) AS count FROM {{ut}}
    WHERE play_count > 0 AND track_source = 'library' AND album_type IN ('album', 'compilation')
    GROUP BY album_name, artist ORDER BY count DESC, album_name NULLS LAST, artist NULLS LAST LIMIT 10"""
WEEKDAY = """SELECT dayname(last_played_at) AS day,
    CAST(round_even(CAST(sum(play_count) AS DECIMAL(20,0)) * 100 / sum(sum(play_count)) OVER (), 1) AS DOUBLE) AS percentage
    FROM {ut} WHERE last_played_at IS NOT NULL GROUP BY 1"""
HOUR = """SELECT CAST(hour(timezone('America/New_York', timezone('UTC', played_at))) AS INT) AS hour,
    CAST(round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS DOUBLE) AS percentage FROM {up} GROUP BY 1"""
POP = """SELECT CASE WHEN popularity >= 90 THEN '90–100' WHEN popularity < 10 THEN '0–9'
    ELSE CAST(popularity // 10 * 10 AS VARCHAR) || '–' || CAST(popularity // 10 * 10 + 9 AS VARCHAR) END AS range, count(*) AS count
    FROM {ut} WHERE popularity IS NOT NULL GROUP BY 1"""
DATE = """CASE length(release_date) WHEN 4 THEN CAST(release_date || '-01-01' AS DATE) WHEN 7 THEN CAST(release_date || '-01' AS DATE)
    WHEN 10 THEN CAST(release_date AS DATE) END"""
WAIT = f"""SELECT bucket, CAST(round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS DOUBLE) AS percentage FROM (
      SELECT CASE WHEN d <= 1 THEN '0–1 days' WHEN d <= 7 THEN '2–7 days' WHEN d <= 30 THEN '8–30 days' WHEN d <= 90 THEN '31–90 days'
                  WHEN d <= 180 THEN '91–180 days' WHEN d <= 365 THEN '181–365 days' WHEN d <= 730 THEN '1–2 years' ELSE '2+ years' END AS bucket
      FROM (SELECT date_diff('day', {DATE}, CAST(min(last_played_at) AS DATE)) AS d, min(last_played_at) >= {DATE} AS after
            FROM {{ut}} WHERE last_played_at IS NOT NULL AND release_date IS NOT NULL AND play_count > 0 GROUP BY track_name, artist, release_date)
      WHERE after) GROUP BY bucket"""

add("top_artists", lambda c: M.top_artists(c.ut), TOP_ARTISTS)
add("top_tracks", lambda c: M.top_tracks(c.ut), TOP_TRACKS)
add("daily_plays", lambda c: M.daily_plays(c.up, c.as_of), DAILY)
add("top_albums", lambda c: M.top_albums(c.ut), TOP_ALBUMS)
add("plays_by_weekday", lambda c: M.plays_by_weekday(c.ut), WEEKDAY)
add("plays_by_weekday_dense", lambda c: M.plays_by_weekday_dense(c.ut),
    f"""SELECT d.day, coalesce(percentage, 0.0::DOUBLE) AS percentage
        FROM (SELECT unnest(['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday']) AS day) d LEFT JOIN ({WEEKDAY}) w USING (day)""")
add("plays_by_hour", lambda c: M.plays_by_hour(c.up), HOUR)
add("plays_by_month", lambda c: M.plays_by_month(c.up), "SELECT strftime(played_at, '%Y-%m') AS month, count(*) AS count FROM {up} GROUP BY 1")
add("tracks_added", lambda c: M.tracks_added(c.ut), "SELECT CAST(added_at AS DATE) AS date, count(*) AS count FROM {ut} WHERE added_at IS NOT NULL GROUP BY 1")
add("top_liked_artists", lambda c: M.top_liked_artists(c.ut),
    """SELECT artist, artist_image AS image_url, count(*) AS count FROM {ut} WHERE is_liked AND artist_image IS NOT NULL
       GROUP BY 1, 2 ORDER BY count DESC, artist NULLS LAST, image_url LIMIT 10""")
add("top_genres", lambda c: M.top_genres(c.ut),
    """SELECT trim(genres[1]) AS genre, CAST(sum(play_count) AS BIGINT) AS count FROM {ut} WHERE play_count > 0 AND len(genres) > 0
       GROUP BY 1 ORDER BY count DESC, genre LIMIT 10""")
add("popularity_histogram", lambda c: M.popularity_histogram(c.ut), POP)
add("avg_popularity", lambda c: M.avg_popularity(c.ut),
    "SELECT CAST(coalesce(round(CAST(sum(popularity) AS DECIMAL(20,6)) / count(popularity), 1), 0) AS DOUBLE) AS avg_popularity FROM {ut}")
add("release_to_play", lambda c: M.release_to_play(c.ut), WAIT)
add("library_growth", lambda c: M.library_growth(c.ut),
    "SELECT CAST(date_trunc('month', added_at) AS TIMESTAMP) AS month, count(*) AS count FROM {ut} WHERE added_at IS NOT NULL GROUP BY 1")
add("top_artist_by_month", lambda c: M.top_artist_by_month(c.up, c.as_of),
    f"""SELECT artist_name AS artist, strftime(played_at, '%Y-%m') AS month, count(*) AS count FROM {{up}}
        WHERE played_at >= {NOW} - INTERVAL 24 MONTH AND artist_name IS NOT NULL GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY month ORDER BY count DESC, artist) = 1""")
add("top_artist_all_months", lambda c: M.top_artist_by_month(c.up, c.as_of, months=600),
    """SELECT artist_name AS artist, strftime(played_at, '%Y-%m') AS month, count(*) AS count FROM {up} WHERE artist_name IS NOT NULL GROUP BY 1, 2
       QUALIFY row_number() OVER (PARTITION BY month ORDER BY count DESC, artist) = 1""")
SPAN = """CASE WHEN s >= 31536000 THEN CAST(s // 31536000 AS VARCHAR) || 'y ' ELSE '' END ||
    CASE WHEN s >= 86400 THEN CAST(s % 31536000 // 86400 AS VARCHAR) || 'd ' ELSE '' END ||
    CAST(s % 86400 // 3600 AS VARCHAR) || 'h ' || CAST(s % 3600 // 60 AS VARCHAR) || 'm ' || CAST(s % 60 AS VARCHAR) || 's'"""
add("summary_stats", lambda c: M.summary_stats(c.ut),
    f"""SELECT * EXCLUDE (s), {SPAN} AS total_time_spent FROM (SELECT count(DISTINCT artist) AS total_artists, count(*) AS total_tracks, count(*) FILTER (is_liked) AS total_liked,
        CAST(sum(play_count) AS BIGINT) AS total_plays, count(*) FILTER (play_count > 0) AS total_unique_plays,
        CAST(sum(duration_ms::BIGINT * play_count) AS BIGINT) AS total_ms, CAST(sum(duration_ms::BIGINT * play_count) AS BIGINT) // 1000 AS s FROM {{ut}})""")
add("time_spent_text", lambda c: c.ut.select("track_id", span_text(F.col("duration_ms") * F.col("play_count") * F.col("play_count")).alias("time_spent")),
    f"SELECT track_id, {SPAN} AS time_spent FROM (SELECT track_id, duration_ms::BIGINT * play_count * play_count // 1000 AS s FROM {{ut}})")
add("album_type_counts", lambda c: M.album_type_counts(c.ut),
    """SELECT count(DISTINCT album_id) FILTER (k = 'album') AS total_albums, count(DISTINCT album_id) FILTER (k = 'single') AS total_singles,
       count(DISTINCT album_id) FILTER (k = 'compilation') AS total_compilations
       FROM (SELECT album_id, coalesce(album_type, 'single') AS k FROM {ut} WHERE track_source = 'library')""")
add("active_days_per_week", lambda c: M.active_days_per_week(c.ut),
    "SELECT CAST(date_trunc('week', last_played_at) AS DATE) AS week, count(DISTINCT CAST(last_played_at AS DATE)) AS active_days FROM {ut} WHERE last_played_at IS NOT NULL GROUP BY 1")
add("avg_active_days", lambda c: M.avg_active_days(c.ut),
    """SELECT CAST(round_even(CAST(sum(n) AS DECIMAL(20,6)) / count(*), 1) AS DOUBLE) AS avg_active_days_per_week FROM (
       SELECT count(DISTINCT CAST(last_played_at AS DATE)) AS n FROM {ut} WHERE last_played_at IS NOT NULL GROUP BY date_trunc('week', last_played_at))""")
STREAK = """SELECT max(n) AS longest_listening_streak FROM (SELECT count(*) AS n FROM (
    SELECT d - CAST(row_number() OVER (ORDER BY d) AS INT) AS run FROM (SELECT DISTINCT CAST({ts} AS DATE) AS d FROM {{{tab}}} WHERE {ts} IS NOT NULL)) GROUP BY run)"""
add("listening_streak", lambda c: M.listening_streak(c.ut), STREAK.format(ts="last_played_at", tab="ut"))
add("listening_streak_by_plays", lambda c: M.listening_streak(c.up, "played_at"), STREAK.format(ts="played_at", tab="up"))
add("listens_rate", lambda c: M.listens_rate(c.ut),
    """SELECT CAST(round_even(CAST(n AS DECIMAL(20,6)) / (date_diff('day', lo, hi) + 1), 1) AS DOUBLE) AS avg_listens_per_day,
              CAST(round_even(CAST(n AS DECIMAL(20,6)) / (date_diff('month', lo, hi) + 1), 1) AS DOUBLE) AS avg_listens_per_month
       FROM (SELECT count(last_played_at) AS n, CAST(min(last_played_at) AS DATE) AS lo, CAST(max(last_played_at) AS DATE) AS hi FROM {ut})""")
add("dynamic_playlists", lambda c: M.dynamic_playlists(c.t["playlist_mappings"]), "SELECT count(slug) AS total_dynamic_playlists FROM {playlist_mappings} WHERE is_dynamic")


def _snapshot(c):
    """Write the day's document, read the latest back, and look inside it."""
    path = f"{shared_dir(c.spark)}/metrics-{c.spark.sparkContext.applicationId}"
    write_metrics(D.metrics_document(c.ut, c.up, c.t["playlist_mappings"], c.as_of), path)
    return latest_metrics(read_metrics(c.spark, path))


def _document_parts(c):
    doc = D.metrics_document(c.ut, c.up, c.t["playlist_mappings"], c.as_of)
    parsed = doc.select("snapshot_date", F.from_json("data", "plays_by_month array<struct<month string, count bigint>>, top_tracks array<struct<track_name string, count bigint>>, "
                        "popularity_distribution array<struct<range string, count bigint>>").alias("d"))

    def part(key, label):
        return parsed.select("snapshot_date", F.lit(key).alias("metric"), F.posexplode(f"d.{key}").alias("at", "x")).select(
            "snapshot_date", "metric", "at", F.col(f"x.{label}").alias("label"), F.col("x.count").alias("count"))

    return part("plays_by_month", "month").unionByName(part("top_tracks", "track_name")).unionByName(part("popularity_distribution", "range"))


DOC_PARTS = f"""SELECT DATE '{AS_OF[:10]}' AS snapshot_date, metric, CAST(pos - 1 AS INT) AS "at", label, count FROM (
    SELECT 'plays_by_month' AS metric, row_number() OVER (ORDER BY month) AS pos, month AS label, count FROM (SELECT strftime(played_at, '%Y-%m') AS month, count(*) AS count FROM {{up}} GROUP BY 1)
    UNION ALL SELECT 'top_tracks', row_number() OVER (ORDER BY play_count DESC, track_id), track_name, play_count FROM (SELECT * FROM {{ut}} WHERE play_count > 0 ORDER BY play_count DESC, track_id LIMIT 10)
    UNION ALL SELECT 'popularity_distribution', row_number() OVER (ORDER BY range), range, count FROM ({POP}))"""
add("metrics_snapshot", _document_parts, DOC_PARTS)


def _latest(c):
    doc = _snapshot(c)
    return doc.select("snapshot_date", F.get_json_object("data", "$.summary_stats.total_tracks").cast("bigint").alias("total_tracks"),
                      F.get_json_object("data", "$.summary_stats.total_plays").cast("bigint").alias("total_plays"),
                      F.size(F.json_object_keys("data")).alias("sections"))


add("latest_snapshot", _latest,
    f"SELECT DATE '{AS_OF[:10]}' AS snapshot_date, count(*) AS total_tracks, CAST(sum(play_count) AS BIGINT) AS total_plays, 16 AS sections FROM {{ut}}")

# scalar functions over whole tables
add("scalar_null_logic",
    lambda c: c.ut.select("track_id", F.coalesce("popularity", F.lit(-1)).alias("c"), F.nullif("disc_number", F.lit(1)).alias("n"),
                          F.greatest("liked_at", "last_played_at").alias("g"), F.least("liked_at", "first_played_at").alias("l"),
                          F.abs(F.col("track_number") - 20).alias("a"), F.when(F.col("is_liked"), "yes").otherwise("no").alias("w")),
    """SELECT track_id, coalesce(popularity, -1) AS c, nullif(disc_number, 1) AS n, greatest(liked_at, last_played_at) AS g, least(liked_at, first_played_at) AS l,
       abs(track_number - 20) AS a, CASE WHEN is_liked THEN 'yes' ELSE 'no' END AS w FROM {ut}""")
add("scalar_string",
    lambda c: c.ut.select("track_id", F.lower("artist").alias("lo"), F.lower("artist").like("%#1%").alias("lk"), F.concat(F.lit("u:"), "track_id").alias("cc"),
                          F.trim(F.concat(F.lit("  "), "track_name")).alias("tr"), F.length("release_date").alias("ln"),
                          F.substring("release_date", 1, 4).alias("yr"), F.left(F.repeat("track_name", F.lit(80)), F.lit(500)).alias("clip")),
    """SELECT track_id, lower(artist) AS lo, lower(artist) LIKE '%#1%' AS lk, 'u:' || track_id AS cc, trim('  ' || track_name) AS tr,
       CAST(length(release_date) AS INT) AS ln, left(release_date, 4) AS yr, left(repeat(track_name, 80), 500) AS clip FROM {ut}""")


def _epoch_gap(c):
    """Gap from every instant to the next one, over all plays."""
    moments = c.up.filter("track_id IS NOT NULL").select(micros(F.col("played_at")).alias("us")).distinct()
    return neighbour(moments, "us", [], above(hour_sizes(moments), "n")).select("us", (F.col("near_us") - F.col("us")).alias("gap_us"))


add("epoch_gap", _epoch_gap, "SELECT us, lead(us) OVER (ORDER BY us) - us AS gap_us FROM (SELECT DISTINCT epoch_us(played_at) AS us FROM {ap})")
add("scalar_date",
    lambda c: c.up.groupBy(F.to_date("played_at").alias("d"), F.hour("played_at").alias("h"), F.date_trunc("week", "played_at").cast("timestamp_ntz").alias("w"),
                           F.date_trunc("month", "played_at").cast("timestamp_ntz").alias("m"), F.date_format("played_at", "EEEE").alias("dow"),
                           F.date_format("played_at", "yyyy-MM").alias("ym")).agg(F.count(F.lit(1)).alias("n")),
    """SELECT CAST(played_at AS DATE) AS d, CAST(hour(played_at) AS INT) AS h, CAST(date_trunc('week', played_at) AS TIMESTAMP) AS w,
       CAST(date_trunc('month', played_at) AS TIMESTAMP) AS m, dayname(played_at) AS dow, strftime(played_at, '%Y-%m') AS ym, count(*) AS n FROM {up} GROUP BY ALL""")
add("partial_dates", lambda c: c.kept("albums").select("id", "release_date", partial_date(F.col("release_date")).alias("released")),
    f"SELECT id, release_date, {DATE} AS released FROM {{albums}}")
add("relative_window",
    lambda c: c.up.agg(*[F.count_if(F.col("played_at") >= ago(c.as_of, n, u)).alias(f"last_{n}_{u}") for n, u in ((7, "days"), (2, "weeks"), (300, "months"))]),
    f"""SELECT count(*) FILTER (played_at >= {NOW} - INTERVAL 7 DAY) AS last_7_days, count(*) FILTER (played_at >= {NOW} - INTERVAL 14 DAY) AS last_2_weeks,
        count(*) FILTER (played_at >= {NOW} - INTERVAL 300 MONTH) AS last_300_months FROM {{up}}""")
add("scalar_math",
    lambda c: c.ut.groupBy("artist").agg(half_up(ratio(F.sum("duration_ms"), F.count("duration_ms"))).alias("up"), half_even(ratio(F.sum("play_count"), F.lit(20))).alias("even"),
                                         F.call_function("div", F.sum("duration_ms"), F.lit(1000).cast("bigint")).alias("secs")),
    """SELECT artist, CAST(round(CAST(sum(duration_ms) AS DECIMAL(20,6)) / count(duration_ms), 1) AS DOUBLE) AS up,
       CAST(round_even(CAST(sum(play_count) AS DECIMAL(20,6)) / 20, 1) AS DOUBLE) AS even, CAST(sum(duration_ms) // 1000 AS BIGINT) AS secs FROM {ut} GROUP BY artist""")
add("scalar_array", lambda c: c.kept("artists").select("id", F.get("genres", F.lit(0)).alias("first_genre"), F.when(F.size("genres") > 0, F.size("genres")).alias("n_genres")),
    "SELECT id, genres[1] AS first_genre, CASE WHEN len(genres) > 0 THEN CAST(len(genres) AS INT) END AS n_genres FROM {artists}")
