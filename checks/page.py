"""Registered queries of landed pages and the play stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.oracle import oracle
from earshot.session import shared_dir
from earshot.sources import pages as P
from earshot.streaming import ingest as S

Q: dict = {}
PAGE = 50  # items on a page


def add(name, fn, sql=None):
    Q[name] = (fn, oracle(sql) if sql else None)


def iso(col):
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def artists(id_col, name_col, when):
    """One artist, or an empty list where `when` fails."""
    one = F.array(F.struct(F.col(id_col).alias("id"), F.col(name_col).alias("name")))
    return F.when(when, one).otherwise(F.array().cast("array<struct<id:string,name:string>>"))


def images(url, when):
    return F.when(when, F.array(F.struct(url.alias("url")))).otherwise(F.array().cast("array<struct<url:string>>"))


def paged(items, number, array="items", **extra):
    """Rows (number, item) as JSON pages of PAGE items, null items too."""
    places = F.transform(F.collect_list(F.struct("item")), lambda x: x["item"])  # a list of the items alone has no nulls
    grouped = items.groupBy(F.floor(F.col(number) / PAGE).alias("_p")).agg(places.alias(array))
    return grouped.select(F.to_json(F.struct(array, *[F.lit(v).alias(k) for k, v in extra.items()]), {"ignoreNullFields": "false"}).alias("page"))


def song(c):
    return c.t["song"].withColumn("artist_id", F.concat(F.lit("AR"), "p_brand")).withColumn("id", F.concat(F.lit("T"), "ks"))


def track(album_when=None):
    album_when = F.lit(True) if album_when is None else album_when
    album = F.when(album_when, F.struct(F.col("album_id").alias("id"), F.col("album_name").alias("name"), "album_type"))
    return F.struct("id", F.col("p_name").alias("name"), F.col("dur").alias("duration_ms"), F.col("p_size").alias("popularity"),
                    artists("artist_id", "p_brand", F.col("p_size") != 50).alias("artists"), album.alias("album"))


def play_items(c):
    events = c.t["events"].withColumn("pk", F.regexp_extract("props", "([0-9]+)", 1).cast("bigint"))
    return events.join(song(c), "pk").select("event_id", F.struct(iso(F.col("ts")).alias("played_at"), track(F.col("p_size") != 49).alias("track")).alias("item"))


PLAYS = """SELECT 'T' || ks AS track_id, ts AS played_at, p_name AS track_name, CASE WHEN p_size <> 50 THEN 'AR' || p_brand END AS artist_id, dur AS duration_ms,
    CASE WHEN p_size <> 50 THEN p_brand END AS artist_name, CASE WHEN p_size <> 49 THEN album_id END AS album_id, CASE WHEN p_size <> 49 THEN album_name END AS album_name,
    CASE WHEN p_size <> 49 THEN album_type END AS album_type FROM {events} JOIN {song} ON pk = CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"""
add("flatten_plays", lambda c: P.flatten_plays(paged(play_items(c), "event_id")), PLAYS)
add("iso_times", lambda c: c.t["events"].select("event_id", P.iso_ts(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'")).alias("zoned"),
                                                P.iso_ts(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("naive")),
    "SELECT event_id, ts - INTERVAL 2 HOUR AS zoned, date_trunc('second', ts) AS naive FROM {events}")


def _albums(c):
    a = c.t["albums"].join(c.t["label"].select(F.concat(F.lit("AL"), F.col("sk").cast("string")).alias("id"), "sk"), "id")
    album = F.struct("id", "name", "release_date", "total_tracks", "album_type", images(F.col("album_image_url"), F.col("album_image_url").isNotNull()).alias("images"),
                     artists("artist_id", "artist", F.col("artist_id").isNotNull()).alias("artists"))
    return P.flatten_albums(paged(a.select("sk", F.struct(iso(F.col("added_at")).alias("added_at"), album.alias("album")).alias("item")), "sk", total=1))


add("flatten_albums", _albums,
    "SELECT id, name, CASE WHEN artist_id IS NOT NULL THEN artist END AS artist, artist_id, release_date, total_tracks, added_at, album_type, album_image_url FROM {albums}")


def _likes(c):
    liked = F.when(F.col("p_type") != "PROMO", track())
    items = song(c).select("pk", F.struct(F.concat(F.lit("2023-05-05T10:11:"), F.lpad(F.col("p_size").cast("string"), 2, "0"), F.when(F.col("p_size") > 25, "Z").otherwise("")).alias("added_at"), liked.alias("track")).alias("item"))
    return P.flatten_likes(paged(items, "pk", total=1))


add("flatten_likes", _likes,
    """SELECT 'T' || ks AS track_id, TIMESTAMP '2023-05-05 10:11:00' + INTERVAL '1' SECOND * p_size AS liked_at, p_name AS track_name, CASE WHEN p_size <> 50 THEN p_brand END AS track_artist,
       CASE WHEN p_size <> 50 THEN 'AR' || p_brand END AS artist_id, album_id, dur AS duration_ms, p_size AS popularity FROM {song} WHERE p_type <> 'PROMO'""")


def meta_pages(c):
    """A place for every track; one the service does not know is a null on its page."""
    return paged(song(c).select("pk", F.when(F.col("p_size") != 30, track()).alias("item")), "pk", "tracks")


def _album_tracks(c):
    item = F.struct("id", F.col("p_name").alias("name"), F.when(F.col("p_size") > 10, F.col("p_size")).otherwise(0).alias("track_number"),
                    F.when(F.col("p_size") > 40, 2).alias("disc_number"), F.col("dur").alias("duration_ms"), artists("artist_id", "p_brand", F.lit(True)).alias("artists"))
    listings = song(c).groupBy("album_id", "album_name", F.floor(F.col("pk") / 1000)).agg(F.collect_list(item).alias("items")).select(
        F.to_json(F.struct(F.struct(F.col("album_id").alias("id"), F.col("album_name").alias("name"), F.lit("2020-02-02T00:00:00Z").alias("added_at")).alias("album"), "items")).alias("page"))
    return P.flatten_album_tracks(listings, meta_pages(c))


add("flatten_album_tracks", _album_tracks,
    """SELECT 'T' || ks AS id, p_name AS name, p_brand AS artist, album_name AS album, album_id, true AS from_album, CASE WHEN p_size > 10 THEN p_size ELSE 1 END AS track_number,
       CASE WHEN p_size > 40 THEN 2 ELSE 1 END AS disc_number, TIMESTAMP '2020-02-02 00:00:00' AS added_at, dur AS duration_ms, CASE WHEN p_size <> 30 THEN p_size END AS popularity FROM {song}""")
add("flatten_track_meta", lambda c: P.flatten_track_meta(meta_pages(c)).select("track_id", "track_name", "artist_id", "artist_name", "album_id", "album_name", "album_type", "duration_ms", "popularity"),
    """SELECT 'T' || ks AS track_id, p_name AS track_name, CASE WHEN p_size <> 50 THEN 'AR' || p_brand END AS artist_id, CASE WHEN p_size <> 50 THEN p_brand END AS artist_name, album_id, album_name,
       album_type, dur AS duration_ms, p_size AS popularity FROM {song} WHERE p_size <> 30""")


def _artists(c):
    a = c.t["label"].select("sk", F.struct(F.concat(F.lit("AR"), "s_name").alias("id"), F.col("s_name").alias("name"),
                                           F.when(F.col("s_acctbal") > 2000, F.array("r_name", "n_name")).alias("genres"),
                                           images(F.concat(F.lit("http://img/"), "s_name"), F.col("s_acctbal") > 4000).alias("images")).alias("item"))
    return P.flatten_artists(paged(a, "sk", "artists")).withColumn("genres", F.array_join("genres", "|"))


add("flatten_artists", _artists,
    """SELECT 'AR' || s_name AS id, s_name AS name, CASE WHEN s_acctbal > 2000 THEN r_name || '|' || n_name ELSE '' END AS genres,
       CASE WHEN s_acctbal > 4000 THEN 'http://img/' || s_name END AS image_url FROM {label}""")
add("flatten_exclusions", lambda c: P.flatten_exclusions(paged(song(c).select("pk", F.struct(F.when(F.col("p_size") > 10, F.struct("id")).alias("track")).alias("item")), "pk", snapshot_id="s1")),
    "SELECT 'T' || ks AS track_id FROM {song} WHERE p_size > 10")


def _playable(c):
    """An answer for every track, of some that they are not found."""
    found = F.to_json(F.struct(
        "id", F.when(F.col("p_size") > 30, F.col("p_size") < 45).alias("is_playable"),
        F.when(F.col("p_size") > 15, F.when(F.col("p_size") > 20, F.array(F.lit("US"), F.lit("DE"))).otherwise(F.array(F.lit("FR")))).alias("available_markets")))
    answers = song(c).select(F.when(F.col("p_size") != 8, found).otherwise('{"error": {"status": 404}}').alias("page"))
    return P.playability(song(c).select(F.col("id").alias("track_id")), answers, "US")


add("playability", _playable, "SELECT 'T' || ks AS track_id, p_size > 20 AND p_size < 45 AS is_playable FROM {song}")


def _stream(c):
    """Land every page twice, the second time shifted by half a page, as overlapping polls do."""
    root = f"{shared_dir(c.spark)}/polls-{uuid.uuid4().hex[:12]}"
    items = play_items(c)
    pages = paged(items, "event_id").unionByName(paged(items.withColumn("event_id", F.col("event_id") + PAGE // 2), "event_id"))
    pages.write.text(f"{root}/landed")
    S.append_plays(S.polled_pages(c.spark, f"{root}/landed", files_per_trigger=4), f"{root}/plays", f"{root}/state").awaitTermination()
    return S.stored_plays(c.spark, f"{root}/plays")


add("stream_plays", _stream, PLAYS.replace("SELECT", "SELECT DISTINCT", 1))
