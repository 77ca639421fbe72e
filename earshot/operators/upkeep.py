"""Keeping the library tables current: the sync jobs as merges of fetched rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.times import ago, as_ts
from earshot.operators.merge import keep_known, lacking_rows, last_per_key, merge_rows, missing_rows, new, not_in, old, one_per_key, stamp
from earshot.operators.skew import drop_listed, lookup_join
from earshot.sources.snapshots import settle

PLAY_KEY = ["track_id", "played_at"]


def _take(*names: str) -> dict:
    return {n: new(n) for n in names}


# plays -----------------------------------------------------------------------------

def new_plays(plays: DataFrame, polled: DataFrame) -> DataFrame:
    """Polled plays not stored yet: what to append. The poll is evaluated once, and only the polled months of
    the table are read: as partitions if it is stored by month, else by the range of times."""
    once = settle(one_per_key(polled, PLAY_KEY).withColumn("_month", F.date_format("played_at", "yyyy-MM")), "polled")
    found = once.agg(F.min("played_at").alias("low"), F.max("played_at").alias("high"), F.collect_set("_month").alias("months")).first()  # calendar months
    near = plays.filter(F.col("played_at").between(F.lit(found.low), F.lit(found.high)))
    if "month" in plays.columns:
        near = near.filter(F.col("month").isin(found.months))
    return lacking_rows(near, once.drop("_month"), PLAY_KEY)


def fill_history(history: DataFrame, metadata: DataFrame, as_of) -> DataFrame:
    """Complete plays that lack an attribute from track metadata (track_id, artist_id,
    album_id, album_type, duration_ms), and note when. A play's own values that are
    present give way to known metadata, as in an upsert of the whole group."""
    wanted = ["artist_id", "album_id", "album_type", "duration_ms"]
    lacking = F.col("artist_id").isNull() | F.col("album_id").isNull() | F.col("album_type").isNull() | F.col("duration_ms").isNull()
    known = metadata.select("track_id", F.struct(*wanted).alias("_m"))
    joined = lookup_join(history, known, ["track_id"])
    fill = lacking & F.col("_m").isNotNull()
    changed = {c: F.when(fill, F.coalesce(F.col(f"_m.{c}"), F.col(c))).otherwise(F.col(c)) for c in wanted}
    changed["checked_at"] = F.when(fill, as_ts(as_of)).otherwise(F.col("checked_at"))
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in history.columns])


# albums ----------------------------------------------------------------------------

def merge_albums(albums: DataFrame, fetched: DataFrame) -> DataFrame:
    """Saved albums as fetched: known ones are saved again with fresh date, artist, type
    and image and keep their other fields; new ones wait for their tracks."""
    return merge_rows(
        albums, fetched, ["id"],
        matched={"is_saved": F.lit(True), **_take("added_at", "artist_id", "album_type", "album_image_url")},
        inserted={"is_saved": F.lit(True), "tracks_synced": F.lit(False)},
    )


def insert_missing_albums(albums: DataFrame, recent: DataFrame) -> DataFrame:
    """Only add albums not stored; stored ones stay as they are."""
    return merge_rows(albums, recent, ["id"], inserted={"is_saved": F.lit(True), "tracks_synced": F.lit(False)})


def unsave_missing(albums: DataFrame, fetched: DataFrame) -> DataFrame:
    """Albums absent from the fetched list (all of them, if it is empty) are no longer saved."""
    seen = albums.join(fetched.select("id").distinct().withColumn("_seen", F.lit(True)), "id", "left")
    gone = F.col("_seen").isNull()
    changed = {c: F.when(gone, F.lit(False)).otherwise(F.col(c)).alias(c) for c in ("is_saved", "tracks_synced")}
    return seen.select(*[changed.get(c, F.col(c)) for c in albums.columns])


def prune_albums(albums: DataFrame, tracks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop unsaved albums that no album track refers to, with their tracks."""
    from_albums = tracks.filter("from_album")
    doomed = not_in(albums.filter(~F.col("is_saved")).select("id"), "id", from_albums, "album_id")
    kept = albums.join(doomed, "id", "left_anti")
    loose = F.coalesce("from_album", F.lit(False))
    return kept, tracks.filter(~loose).unionByName(drop_listed(tracks.filter(loose), doomed.select(F.col("id").alias("album_id")), ["album_id"]))


def merge_album_meta(albums: DataFrame, fetched: DataFrame, saved_by_default: bool = True) -> DataFrame:
    """Album facts from play history: known values are only replaced by known values. New
    albums take the table's default for `is_saved`, given here in the open."""
    names = ("name", "artist", "artist_id", "release_date", "album_type", "album_image_url")
    return merge_rows(
        albums, fetched.filter(F.col("id").isNotNull()), ["id"], matched={n: keep_known(n) for n in names},
        inserted={"is_saved": F.lit(saved_by_default), "tracks_synced": F.lit(False)},
    )


def flag_resync(albums: DataFrame, selected: DataFrame) -> DataFrame:
    return stamp(albums, "id", selected, {"tracks_synced": F.lit(False)})


# tracks and likes ------------------------------------------------------------------

def merge_tracks(tracks: DataFrame, listed: DataFrame, keep_added: bool = True) -> DataFrame:
    """Album listings into tracks. The first sync fills a missing added date, the later
    integrity pass (`keep_added=False`) leaves it alone; neither loses a popularity."""
    changes = {
        **_take("name", "artist", "album", "album_id", "track_number", "disc_number", "duration_ms"),
        "from_album": F.lit(True), "popularity": keep_known("popularity"),
    }
    if keep_added:
        changes["added_at"] = F.coalesce(old("added_at"), new("added_at"))
    return merge_rows(tracks, listed.filter(F.col("id").isNotNull()), ["id"], changes, {"from_album": F.lit(True)})


def unlisted(tracks: DataFrame, listed: DataFrame) -> DataFrame:
    """Album tracks (id, album_id) of the listed albums that the listing no longer names."""
    albums = listed.select("album_id").distinct()
    stored = lookup_join(tracks.filter("from_album").select("id", "album_id"), albums.withColumn("_listed", F.lit(True)), ["album_id"], "inner")
    return stored.drop("_listed").join(listed.filter(F.col("id").isNotNull()).select("id", "album_id").distinct(), ["id", "album_id"], "left_anti")


def reconcile(tracks: DataFrame, likes: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remove tracks a listing dropped, and the likes of those tracks."""
    removed = unlisted(tracks, listed)
    return (
        tracks.join(removed.select("id"), "id", "left_anti"),
        likes.join(removed.select(F.col("id").alias("track_id")), "track_id", "left_anti"),
    )


def cascade_delete(albums: DataFrame, tracks: DataFrame, likes: DataFrame) -> dict[str, DataFrame]:
    """Unsaved albums go, then their tracks, then the likes of those tracks; with the
    number of likes removed per album."""
    doomed = albums.filter(~F.col("is_saved")).select(F.col("id").alias("album_id"))
    marked = lookup_join(tracks, doomed.withColumn("_doomed", F.lit(True)), ["album_id"])
    gone = marked.filter("_doomed").select(F.col("id").alias("track_id"), "album_id")
    return {
        "albums": albums.filter(F.coalesce("is_saved", F.lit(True))),
        "tracks": marked.filter(F.col("_doomed").isNull()).select(*tracks.columns),
        "likes": likes.join(gone, "track_id", "left_anti"),
        "removed_likes": likes.select("track_id").join(gone, "track_id").groupBy("album_id").agg(F.count(F.lit(1)).alias("removed")),
    }


def enrich_likes(fetched: DataFrame, albums: DataFrame) -> DataFrame:
    """Added date from the album where it is stored, and whether it is stored at all."""
    known = albums.select(F.col("id").alias("album_id"), F.col("added_at").alias("_added"), F.lit(True).alias("_known"))
    joined = lookup_join(fetched, known, ["album_id"])
    return joined.select(
        *[c for c in fetched.columns if c not in ("added_at", "album_in_library")],
        F.coalesce("_added", "liked_at").alias("added_at"), F.col("_known").isNotNull().alias("album_in_library"),
    )


def fresh_likes(fetched: DataFrame, as_of, days: int = 30) -> DataFrame:
    return fetched.filter(F.col("liked_at") >= ago(as_of, days, "days"))


def merge_likes(likes: DataFrame, fetched: DataFrame) -> DataFrame:
    names = [c for c in likes.columns if c != "track_id"]
    return merge_rows(likes, fetched, ["track_id"], _take(*names))


def replace_likes(fetched: DataFrame, order: list[str]) -> DataFrame:
    """A full resync: the fetched rows are the table; the last of repeated ids wins."""
    return last_per_key(fetched, ["track_id"], order).drop(*[o for o in order if o.startswith("_")])


def stamp_synced(albums: DataFrame, processed: DataFrame, as_of) -> DataFrame:
    return stamp(albums, "id", processed, {"tracks_synced": F.lit(True), "tracks_checked_at": as_ts(as_of)})


# artists, availability, exclusions --------------------------------------------------

def merge_artists(artists: DataFrame, fetched: DataFrame) -> DataFrame:
    return merge_rows(artists, fetched, ["id"], _take("name", "genres", "image_url", "last_checked_at"))


def merge_artist_names(artists: DataFrame, fetched: DataFrame) -> DataFrame:
    return merge_rows(artists, fetched.filter(F.col("id").isNotNull()), ["id"], {"name": keep_known("name")})


def merge_availability(availability: DataFrame, checked: DataFrame) -> DataFrame:
    return merge_rows(availability, checked, ["track_id"], _take("is_playable", "checked_at"))


def prune_availability(availability: DataFrame, likes: DataFrame, tracks: DataFrame) -> DataFrame:
    """Drop rows of unknown tracks; a null id among the known drops nothing."""
    known = likes.select("track_id").union(tracks.select("id")).distinct()
    doomed = not_in(availability.select("track_id"), "track_id", known, "track_id")
    return availability.join(doomed, "track_id", "left_anti")


def replace_exclusions(excluded: DataFrame, fetched: DataFrame, stored_version: str | None, version: str) -> DataFrame:
    """The fetched list replaces the stored one, unless the version has not changed."""
    if stored_version == version:
        return excluded
    return fetched.filter(F.col("track_id").isNotNull()).select("track_id").distinct()


def exclusions_version(playlists: DataFrame, version: str, slug: str = "exclusions") -> DataFrame:
    """The playlists with the version of the exclusion list that was taken over, so that the
    next run can tell whether it has changed."""
    return playlists.withColumn("snapshot_id", F.when(F.col("slug") == slug, F.lit(version)).otherwise(F.col("snapshot_id")))


# outdated albums --------------------------------------------------------------------

def newer_editions(albums: DataFrame, remote: DataFrame, outdated: DataFrame) -> DataFrame:
    """Saved albums whose artist offers the same name, type and release year under an id
    that is neither saved for that name nor reported yet. `remote` is (artist_id,
    artist_name, id, name, album_type, release_date, position); of equal editions the
    last position counts."""
    edition = ["artist_id", "name", "album_type", "year"]
    year = F.substring("release_date", 1, 4)
    offered = remote.filter(F.col("release_date").isNotNull()).withColumn("year", year)
    offered = offered.groupBy(*edition).agg(
        F.max_by("id", "position").alias("newer_album_id"), F.max_by("artist_name", "position").alias("artist_name")
    )
    saved = albums.filter(F.col("is_saved") & (F.length(year) > 0)).withColumn("year", year).select(*edition, F.col("id").alias("saved_album_id"))
    # a null type is a type of its own, so the keys are compared as texts that tell null from any value
    alike = F.to_json(F.struct(*edition), {"ignoreNullFields": "false"})
    new = offered.select(alike.alias("edition"), "newer_album_id", "artist_name")
    found = lookup_join(saved.withColumn("edition", alike), new, ["edition"], "inner").drop("edition")
    found = found.filter(F.col("artist_id").isNotNull() & F.col("name").isNotNull())
    owned = albums.filter("is_saved").select("artist_id", "name", F.col("id").alias("newer_album_id"))
    found = found.join(owned, ["artist_id", "name", "newer_album_id"], "left_anti")
    reported = outdated.select("artist_id", F.col("album_name").alias("name"), "newer_album_id")
    found = found.join(reported, ["artist_id", "name", "newer_album_id"], "left_anti")
    return found.select("artist_id", "artist_name", F.col("name").alias("album_name"), "saved_album_id", "newer_album_id").distinct()


def resolved_editions(albums: DataFrame, outdated: DataFrame) -> DataFrame:
    """Reports whose newer album is now saved under the same artist and name."""
    owned = albums.filter("is_saved").select("artist_id", F.col("name").alias("album_name"), F.col("id").alias("newer_album_id"))
    return outdated.join(owned, ["artist_id", "album_name", "newer_album_id"], "left_semi").select(*outdated.columns)


def drop_resolved(albums: DataFrame, outdated: DataFrame) -> DataFrame:
    done = resolved_editions(albums, outdated).select("saved_album_id", "newer_album_id")
    return outdated.join(done, ["saved_album_id", "newer_album_id"], "left_anti").select(*outdated.columns)


def merge_outdated(outdated: DataFrame, reported: DataFrame, as_of) -> DataFrame:
    """Reports by hand, keyed on (saved, newer): a known pair only moves its check time."""
    now = as_ts(as_of)
    return merge_rows(outdated, reported, ["saved_album_id", "newer_album_id"], {"last_checked_at": now}, {"first_detected_at": now, "last_checked_at": now})


# equivalents, resolved matches ------------------------------------------------------

def valid_equivalents(entered: DataFrame) -> DataFrame:
    """Trimmed pairs, without blank ids and pairs of an id with itself."""
    alias, target = F.trim("alias_track_id"), F.trim("canonical_track_id")
    rows = entered.withColumns({"alias_track_id": alias, "canonical_track_id": target, "reason": F.nullif(F.trim("reason"), F.lit(""))})
    return rows.filter(
        (F.length("alias_track_id") > 0) & (F.length("canonical_track_id") > 0) & (F.col("alias_track_id") != F.col("canonical_track_id"))
    )


def merge_equivalents(equivalents: DataFrame, entered: DataFrame, as_of) -> DataFrame:
    return merge_rows(
        equivalents, valid_equivalents(entered), ["alias_track_id"], _take("canonical_track_id", "reason", "created_by"), {"created_at": as_ts(as_of)}
    )


def delete_equivalents(equivalents: DataFrame, aliases: DataFrame) -> DataFrame:
    return equivalents.join(aliases.select("alias_track_id").distinct(), "alias_track_id", "left_anti").select(*equivalents.columns)


def merge_resolved(resolved: DataFrame, selected: DataFrame, as_of) -> DataFrame:
    added = missing_rows(resolved, selected.select("track_id"), ["track_id"])
    return resolved.unionByName(added.select("track_id", as_ts(as_of).alias("resolved_at")))


# linkage results --------------------------------------------------------------------

LINK_COLUMNS = ("matched_track_id", "matched_name", "matched_artist_id", "matched_duration_ms", "matched_artist_name",
                "matched_album_id", "matched_album_name", "matched_album_type")


def merge_links(catalog: DataFrame, links: DataFrame, tried: DataFrame, as_of) -> DataFrame:
    """Write found links; stamp every tried row, found or not, so it is not tried again. A row of `links` without a
    track is one not found."""
    names = [c for c in LINK_COLUMNS if c in catalog.columns and c in links.columns]
    filled = merge_rows(catalog, links.filter(F.col("matched_track_id").isNotNull()), ["import_id"], _take(*names), insert=False)
    stamps = {c: as_ts(as_of) for c in ("matched_at", "match_checked_at") if c in catalog.columns}
    return stamp(filled, "import_id", tried.select("import_id"), stamps)


def fill_link_metadata(catalog: DataFrame, pending: DataFrame, metadata: DataFrame, as_of) -> DataFrame:
    """Metadata of rows whose link is known: found ones are filled and stamped on both
    columns, the others only noted as checked. A row of `metadata` without any value is a fetch that failed."""
    names = [c for c in LINK_COLUMNS if c in metadata.columns and c in catalog.columns and c != "matched_track_id"]
    known = metadata.filter(F.coalesce(*[F.col(c).cast("string") for c in names]).isNotNull()) if names else metadata
    found = lookup_join(pending.select("import_id", "matched_track_id"), known, ["matched_track_id"], "inner")
    changes = {**_take(*names), **({"matched_at": as_ts(as_of)} if "matched_at" in catalog.columns else {})}
    filled = merge_rows(catalog, found, ["import_id"], changes, insert=False)
    return stamp(filled, "import_id", pending.select("import_id"), {"match_checked_at": as_ts(as_of)})
