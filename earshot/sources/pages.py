"""Landed API pages (one JSON document per row) flattened to table rows.

Schemas are explicit: a page is read the same way whatever it happens to hold. The first
artist and the first image are the ones that count, as in the player itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.times import iso_ts

_NAMED = "struct<id:string,name:string>"
_IMAGES = "array<struct<url:string>>"
_TRACK_ALBUM = f"struct<id:string,name:string,album_type:string,release_date:string,images:{_IMAGES}>"
_TRACK = f"struct<id:string,name:string,duration_ms:int,popularity:int,artists:array<{_NAMED}>,album:{_TRACK_ALBUM}>"
_SAVED_ALBUM = (
    f"struct<id:string,name:string,release_date:string,total_tracks:int,album_type:string,images:{_IMAGES},artists:array<{_NAMED}>>"
)

PAGE_SCHEMAS = {
    "plays": f"items array<struct<played_at:string,track:{_TRACK}>>",
    "albums": f"items array<struct<added_at:string,album:{_SAVED_ALBUM}>>, total int",
    "likes": f"items array<struct<added_at:string,track:{_TRACK}>>, total int",
    "album_tracks": f"album struct<id:string,name:string,added_at:string>, "
                    f"items array<struct<id:string,name:string,track_number:int,disc_number:int,duration_ms:int,artists:array<{_NAMED}>>>",
    "track_meta": f"tracks array<{_TRACK}>",
    "artists": f"artists array<struct<id:string,name:string,genres:array<string>,images:{_IMAGES}>>",
    "exclusions": "snapshot_id string, items array<struct<track:struct<id:string>>>",
    "playable": "id string, is_playable boolean, available_markets array<string>",
}


def parsed(pages: DataFrame, shape: str, column: str = "page") -> DataFrame:
    return pages.select(F.from_json(column, PAGE_SCHEMAS[shape]).alias("p"))


def _items(pages: DataFrame, shape: str, array: str = "items") -> DataFrame:
    return parsed(pages, shape).select(F.explode(f"p.{array}").alias("i"))


def _first(array: str, name: str) -> Column:
    return F.get(F.col(array), F.lit(0))[name]


def play_fields(item: str = "i") -> list[Column]:
    track = f"{item}.track"
    return [
        F.col(f"{track}.id").alias("track_id"), iso_ts(F.col(f"{item}.played_at")).alias("played_at"), F.col(f"{track}.name").alias("track_name"),
        _first(f"{track}.artists", "id").alias("artist_id"), F.col(f"{track}.duration_ms").alias("duration_ms"),
        _first(f"{track}.artists", "name").alias("artist_name"), F.col(f"{track}.album.id").alias("album_id"),
        F.col(f"{track}.album.name").alias("album_name"), F.col(f"{track}.album.album_type").alias("album_type"),
    ]


def flatten_plays(pages: DataFrame) -> DataFrame:
    return _items(pages, "plays").select(*play_fields())


def unreadable(pages: DataFrame, shape: str, array: str = "items", column: str = "page") -> DataFrame:
    """The pages that are no document of this shape, whole, for quarantine: flattening
    passes over them. A page with an empty list is readable."""
    document = F.from_json(column, PAGE_SCHEMAS[shape])
    return pages.filter(document[array].isNull())


def flatten_albums(pages: DataFrame) -> DataFrame:
    """Saved albums; an item without an album id is passed over."""
    return _items(pages, "albums").filter(F.col("i.album.id").isNotNull()).select(
        F.col("i.album.id").alias("id"), F.col("i.album.name").alias("name"), _first("i.album.artists", "name").alias("artist"),
        _first("i.album.artists", "id").alias("artist_id"), F.col("i.album.release_date").alias("release_date"),
        F.col("i.album.total_tracks").alias("total_tracks"), iso_ts(F.col("i.added_at")).alias("added_at"),
        F.col("i.album.album_type").alias("album_type"), _first("i.album.images", "url").alias("album_image_url"),
    )


def flatten_likes(pages: DataFrame) -> DataFrame:
    """Liked tracks; items whose track is gone are passed over, times without a zone are UTC."""
    return _items(pages, "likes").filter(F.col("i.track").isNotNull()).select(
        F.col("i.track.id").alias("track_id"), iso_ts(F.col("i.added_at")).alias("liked_at"), F.col("i.track.name").alias("track_name"),
        _first("i.track.artists", "name").alias("track_artist"), _first("i.track.artists", "id").alias("artist_id"),
        F.col("i.track.album.id").alias("album_id"), F.col("i.track.duration_ms").alias("duration_ms"), F.col("i.track.popularity").alias("popularity"),
    )


def flatten_track_meta(pages: DataFrame) -> DataFrame:
    return _items(pages, "track_meta", "tracks").filter(F.col("i.id").isNotNull()).select(
        F.col("i.id").alias("track_id"), F.col("i.name").alias("track_name"), _first("i.artists", "id").alias("artist_id"),
        _first("i.artists", "name").alias("artist_name"), F.col("i.album.id").alias("album_id"), F.col("i.album.name").alias("album_name"),
        F.col("i.album.album_type").alias("album_type"), F.col("i.album.release_date").alias("release_date"),
        _first("i.album.images", "url").alias("album_image_url"), F.col("i.duration_ms").alias("duration_ms"), F.col("i.popularity").alias("popularity"),
    )


def _or_one(number: Column) -> Column:
    """A missing or zero position counts as 1."""
    return F.coalesce(F.nullif(number, F.lit(0)), F.lit(1))


def flatten_album_tracks(listings: DataFrame, metadata: DataFrame) -> DataFrame:
    """Album listings, with the popularity found for each id in the metadata pages."""
    rows = parsed(listings, "album_tracks").select(F.col("p.album").alias("a"), F.explode("p.items").alias("i"))
    popularity = flatten_track_meta(metadata).groupBy(F.col("track_id").alias("id")).agg(F.max("popularity").alias("popularity"))
    flat = rows.select(
        F.col("i.id").alias("id"), F.col("i.name").alias("name"), _first("i.artists", "name").alias("artist"), F.col("a.name").alias("album"),
        F.col("a.id").alias("album_id"), F.lit(True).alias("from_album"), _or_one(F.col("i.track_number")).alias("track_number"),
        _or_one(F.col("i.disc_number")).alias("disc_number"), iso_ts(F.col("a.added_at")).alias("added_at"), F.col("i.duration_ms").alias("duration_ms"),
    )
    return flat.join(popularity, "id", "left")


def flatten_artists(pages: DataFrame) -> DataFrame:
    return _items(pages, "artists", "artists").select(
        F.col("i.id").alias("id"), F.col("i.name").alias("name"), F.coalesce("i.genres", F.array().cast("array<string>")).alias("genres"),
        _first("i.images", "url").alias("image_url"),
    )


def flatten_exclusions(pages: DataFrame) -> DataFrame:
    return _items(pages, "exclusions").filter(F.col("i.track.id").isNotNull()).select(F.col("i.track.id").alias("track_id"))


def playability(requested: DataFrame, pages: DataFrame, country: str) -> DataFrame:
    """For every requested track id: the payload's own flag, else whether the country is
    among its markets; a track that could not be fetched is not playable."""
    got = parsed(pages, "playable").select(
        F.col("p.id").alias("track_id"), F.coalesce("p.is_playable", F.array_contains("p.available_markets", country)).alias("_ok")
    )
    return requested.select("track_id").join(got, "track_id", "left").select("track_id", F.coalesce("_ok", F.lit(False)).alias("is_playable"))
