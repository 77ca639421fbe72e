"""Plays: union of the feeds under canonical ids, and what is counted from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.times import HOUR, SECOND, micros
from earshot.operators.ordered import above, cell, neighbour, neighbour_in_group
from earshot.operators.skew import lookup_join, small

PLAY_COLUMNS = (
    "track_id", "track_name", "artist_id", "artist_name", "album_id", "album_name", "album_type", "duration_ms", "played_at",
)


def canonical(df: DataFrame, equivalents: DataFrame, id_col: str, out: str) -> DataFrame:
    """Add `out`: the canonical id of `id_col`, itself when it has no alias entry."""
    known = equivalents.select(F.col("alias_track_id").alias(id_col), F.col("canonical_track_id").alias("_canonical"))
    joined = lookup_join(df, known, [id_col])
    return joined.withColumn(out, F.coalesce("_canonical", id_col)).drop("_canonical")


def unified_plays(feeds: list[DataFrame], equivalents: DataFrame) -> DataFrame:
    """All timed plays of all feeds. A play present in two feeds stays twice: the second
    counts as a resume later and is subtracted there."""
    timed = [f.filter(F.col("played_at").isNotNull()).select(*PLAY_COLUMNS) for f in feeds]
    union = reduce(DataFrame.unionByName, timed)
    return canonical(union, equivalents, "track_id", "track_id").select(*PLAY_COLUMNS)


def usable(plays: DataFrame) -> DataFrame:
    return plays.filter(F.col("played_at").isNotNull() & F.col("track_id").isNotNull())


def play_stats(plays: DataFrame) -> DataFrame:
    return usable(plays).groupBy("track_id").agg(
        F.count(F.lit(1)).alias("library_play_count"),
        F.min("played_at").alias("library_play_count_first_played"),
        F.max("played_at").alias("library_play_count_last_played"),
    )


def latest_play(plays: DataFrame) -> DataFrame:
    """One representative play per track: the newest, ties to the greatest remaining values.

    A max over structs, so a hot track is reduced on the map side instead of sorted.
    """
    rest = ["duration_ms", "album_id", "track_name", "artist_name", "artist_id", "album_name", "album_type"]
    best = F.max(F.struct("played_at", *rest)).alias("_p")
    return usable(plays).groupBy("track_id").agg(best).select("track_id", *[F.col(f"_p.{c}").alias(c) for c in ["played_at", *rest]])


def instants(plays: DataFrame, library_ms: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """One row per (track, microsecond), with what the plays inside it contribute.

    Plays of one track at one instant are adjacent in time order, so within the row only
    counts matter: each play after the first is a resume if its duration is positive. A
    missing duration behaves like 0: neither a resume nor a skip can come from it.
    """
    ms = F.coalesce(F.col("duration_ms"), F.lit(0))
    grouped = usable(plays).withColumn("us", micros(F.col("played_at"))).groupBy("track_id", "us").agg(
        F.count(F.lit(1)).alias("n"), F.min(ms).alias("lo"), F.max(ms).alias("hi"), F.count_if(ms > 0).alias("positive")
    )
    lib = F.col("library_ms")
    return lookup_join(grouped, library_ms, ["track_id"], spread=F.xxhash64("us"), hot=hot).select(
        "track_id", "us",
        F.coalesce(lib, "lo").alias("first_ms"),
        F.coalesce(lib, "hi").alias("last_ms"),
        F.when(lib.isNotNull(), F.when(lib > 0, F.col("n") - 1).otherwise(0))
        .otherwise(F.col("positive") - (F.col("lo") > 0).cast("int")).alias("repeats"),
    )


def resumed(gap_us: Column, ms: Column) -> Column:
    """The same track again within its own duration."""
    return F.coalesce(gap_us < ms * 1000, F.lit(False))


def skipped(gap_us: Column, ms: Column) -> Column:
    """Another track before 30 % of the duration: gap < ms * 1000 * 0.3, in integers."""
    return F.coalesce(gap_us < ms * 300, F.lit(False))


def behaviour(
    rows: DataFrame, heavy_tracks: DataFrame | None = None, heavy_hours: DataFrame | None = None, crowded: bool = False
) -> DataFrame:
    """Resumes and skips per track from `instants`, which is read twice: hand in a snapshot.

    Resumes look back within the track, skips ahead over all plays. `crowded` says that a
    single second holds more rows than a task should sort (see `crowded_seconds`).
    """
    back = neighbour_in_group(rows, ["track_id"], "us", [], heavy_tracks, ahead=False)
    again = resumed(F.col("us") - F.col("near_us"), F.col("first_ms")).cast("int")
    resumes = back.groupBy("track_id").agg(F.sum(F.col("repeats") + again).alias("resumes"))
    skips = (_skips_by_moment if crowded else _skips)(rows, heavy_hours)
    both = resumes.withColumn("skips", F.lit(0).cast("bigint")).unionByName(skips.withColumn("resumes", F.lit(0).cast("bigint")))
    return both.groupBy("track_id").agg(F.sum("resumes").alias("resume_play_count"), F.sum("skips").alias("skip_play_count"))


def _skips(rows: DataFrame, heavy_hours: DataFrame | None) -> DataFrame:
    ahead = neighbour(rows.select("us", "track_id", "last_ms"), "us", ["track_id"], heavy_hours)
    quick = skipped(F.col("near_us") - F.col("us"), F.col("last_ms"))
    return ahead.groupBy("track_id").agg(F.count_if((F.col("near_track_id") != F.col("track_id")) & quick).alias("skips"))


def _skips_by_moment(rows: DataFrame, heavy_hours: DataFrame | None) -> DataFrame:
    """The same where very many tracks share a microsecond. All but the last of them are
    followed, at once, by another track, so they are skips if their duration is positive;
    only one row per distinct microsecond needs its real successor."""
    assumed = rows.groupBy("track_id").agg(F.count_if(F.col("last_ms") > 0).alias("skips"))
    moments = rows.groupBy("us").agg(F.min("track_id").alias("opens"), F.max(F.struct("track_id", "last_ms")).alias("closes"))
    ahead = neighbour(moments, "us", ["opens"], heavy_hours, outline=rows.select("us", F.col("track_id").alias("opens")))
    track, ms = F.col("closes.track_id"), F.col("closes.last_ms")
    real = (F.col("near_opens") != track) & skipped(F.col("near_us") - F.col("us"), ms)
    corrections = ahead.select(
        track.alias("track_id"), (F.coalesce(real, F.lit(False)).cast("bigint") - (ms > 0).cast("bigint")).alias("skips")
    )
    return assumed.unionByName(corrections).groupBy("track_id").agg(F.sum("skips").alias("skips"))


def crowded_seconds(rows: DataFrame, heavy_hours: DataFrame | None, limit: int) -> bool:
    """Whether a second of a heavy hour holds more than `limit` rows of `instants`."""
    if heavy_hours is None:
        return False
    inside = rows.select("us", cell("us", HOUR).alias("hour")).join(small(heavy_hours), "hour")
    return above(inside.groupBy(cell("us", SECOND).alias("second")).agg(F.count(F.lit(1)).alias("n")), "n", limit) is not None


def play_variants(plays: DataFrame) -> DataFrame:
    """Plays collapsed to (track, lowered title, lowered artist, duration)."""
    return usable(plays).groupBy(
        "track_id",
        F.lower("track_name").alias("title_key"),
        F.lower("artist_name").alias("artist_key"),
        F.coalesce("duration_ms", F.lit(0)).alias("ms"),
    ).agg(F.count(F.lit(1)).alias("n"), F.min("played_at").alias("first_at"), F.max("played_at").alias("last_at"))
