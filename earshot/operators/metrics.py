"""Dashboard metrics over unified tracks and unified plays.

Each function returns a small DataFrame. Aggregates are partial-then-final, shares are
taken over already aggregated frames, and every top list has a full tie-break.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.functions.numbers import half_even, half_up, percent, ratio
from earshot.functions.order import asc, desc
from earshot.functions.times import ago, partial_date, span_text, to_local
from earshot.sources.snapshots import fresh_path

# Labels the dashboard shows.
NO_IMAGE = "/app/static/img/no_image.png"
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
POPULARITY_BUCKETS = (
    (90, "90–100"), (80, "80–89"), (70, "70–79"), (60, "60–69"), (50, "50–59"),
    (40, "40–49"), (30, "30–39"), (20, "20–29"), (10, "10–19"), (None, "0–9"),
)
WAIT_BUCKETS = (
    (1, "0–1 days"), (7, "2–7 days"), (30, "8–30 days"), (90, "31–90 days"),
    (180, "91–180 days"), (365, "181–365 days"), (730, "1–2 years"), (None, "2+ years"),
)
TOP = 10


def _labelled(value: Column, buckets, fits) -> Column:
    label = F
    for bound, text in buckets:
        label = label.otherwise(F.lit(text)) if bound is None else label.when(fits(value, bound), F.lit(text))
    return label


@dataclass(frozen=True)
class Grouping:
    """How metrics group tracks: which tracks, by what, and what is measured of a group."""

    keys: dict[str, Callable[[], Column]]
    measures: tuple[str, ...]
    where: Callable[[], Column] = lambda: F.lit(True)


#: What can be measured of a group: of a track, and how tracks are put together.
MEASURES = {
    "n": (lambda: F.lit(1).cast("bigint"), F.sum), "liked": (lambda: F.col("is_liked").cast("bigint"), F.sum),
    "played": (lambda: (F.col("play_count") > 0).cast("bigint"), F.sum), "plays": (lambda: F.col("play_count").cast("bigint"), F.sum),
    "heard": (lambda: F.when(F.col("play_count") > 0, F.col("play_count")).cast("bigint"), F.sum),
    "ms": (lambda: (F.col("duration_ms") * F.col("play_count")).cast("bigint"), F.sum),
    "image": (lambda: F.col("album_image_url"), F.min), "moment": (lambda: F.col("last_played_at"), F.min),
}


def _has_played() -> Column:
    return F.col("play_count") > 0


GROUPINGS = {
    "artist": Grouping({"artist": lambda: F.col("artist"), "artist_image": lambda: F.col("artist_image")}, ("n", "liked", "played", "plays", "heard", "ms")),
    "album": Grouping({"album_name": lambda: F.col("album_name"), "artist": lambda: F.col("artist")}, ("image", "heard"),
                      lambda: _has_played() & (F.col("track_source") == "library") & F.col("album_type").isin("album", "compilation")),
    "played_day": Grouping({"date": lambda: F.to_date("last_played_at")}, ("n", "plays"), lambda: F.col("last_played_at").isNotNull()),
    "added_day": Grouping({"date": lambda: F.to_date("added_at")}, ("n",), lambda: F.col("added_at").isNotNull()),
    "genre": Grouping({"genre": lambda: F.trim(F.get("genres", F.lit(0)))}, ("heard",), lambda: _has_played() & (F.size("genres") > 0)),
    "popularity": Grouping({"popularity": lambda: F.col("popularity")}, ("n",), lambda: F.col("popularity").isNotNull()),
    "song": Grouping({"track_name": lambda: F.col("track_name"), "artist": lambda: F.col("artist"), "release_date": lambda: F.col("release_date")}, ("moment",),
                     lambda: _has_played() & F.col("last_played_at").isNotNull() & F.col("release_date").isNotNull()),
    "album_kind": Grouping({"album_id": lambda: F.col("album_id"), "kind": lambda: F.coalesce("album_type", F.lit("single"))}, ("n",),
                           lambda: F.col("album_id").isNotNull() & (F.col("track_source") == "library")),
}


class Groups:
    """Every grouping of the tracks, from one pass over them.

    A track becomes one row per grouping it belongs to, as in grouping sets but with filters of their own; one
    aggregation, with partial sums before its shuffle, makes the groups of all. They are written by
    grouping, so that a metric reads its own.
    """

    def __init__(self, ut: DataFrame):
        given = ut.select(*[c().alias(f"m_{m}") for m, (c, _) in MEASURES.items()], F.array(*[self._member(n, g) for n, g in GROUPINGS.items()]).alias("_sets"))
        rows = given.withColumn("_set", F.explode(F.filter("_sets", lambda x: x.isNotNull()))).drop("_sets")
        widest = max(len(g.keys) for g in GROUPINGS.values())
        of = lambda m: [n for n, g in GROUPINGS.items() if m in g.measures]
        measured = [put(F.when(F.col("_set.name").isin(of(m)), F.col(f"m_{m}"))).alias(m) for m, (_, put) in MEASURES.items()]
        cells = rows.groupBy(F.col("_set.name").alias("grouping"), *[F.col(f"_set.k{i}").alias(f"k{i}") for i in range(widest)]).agg(*measured)
        path = fresh_path(ut.sparkSession, "groups")
        cells.hint("rebalance", "grouping").write.partitionBy("grouping").parquet(path)
        self.cells = ut.sparkSession.read.schema(cells.schema).parquet(path)
        self.types = {n: dict(ut.limit(0).select(*[c().alias(k) for k, c in g.keys.items()]).dtypes) for n, g in GROUPINGS.items()}

    @staticmethod
    def _member(name: str, g: Grouping) -> Column:
        keys = [*[c().cast("string") for c in g.keys.values()], *[F.lit(None).cast("string")] * 3][:3]
        return F.when(g.where(), F.struct(F.lit(name).alias("name"), *[k.alias(f"k{i}") for i, k in enumerate(keys)]))

    def __getitem__(self, name: str) -> DataFrame:
        keys = [F.col(f"k{i}").cast(t).alias(k) for i, (k, t) in enumerate(self.types[name].items())]
        return self.cells.filter(F.col("grouping") == name).select(*keys, *GROUPINGS[name].measures)


def of(source: DataFrame | Groups, name: str, *measures: str) -> DataFrame:
    """A grouping of the tracks with these measures: out of those made in one pass, or made for it alone."""
    g = GROUPINGS[name]
    if isinstance(source, Groups):
        return source[name].select(*g.keys, *measures)
    measured = [MEASURES[m][1](MEASURES[m][0]()).alias(m) for m in measures]
    return source.filter(g.where()).groupBy(*[c().alias(k) for k, c in g.keys.items()]).agg(*measured)


def _in_order(frame: DataFrame, *keys) -> DataFrame:
    """A frame of a bounded number of groups (buckets, days, months), sorted in one small
    partition after it was aggregated in many: no sampling pass as a global sort needs."""
    return frame.repartition(1).sortWithinPartitions(*keys)


def _total(name: str) -> Column:
    """Grand total over an aggregated frame of a bounded number of rows."""
    return F.sum(name).over(W.partitionBy())


def top_artists(ut: DataFrame) -> DataFrame:
    return (
        of(ut, "artist", "played", "heard").filter("played > 0").select("artist", F.coalesce("artist_image", F.lit(NO_IMAGE)).alias("image_url"), F.col("heard").alias("count"))
        .orderBy(desc("count"), asc("artist"), asc("image_url")).limit(TOP)
    )


def top_tracks(ut: DataFrame) -> DataFrame:
    image = F.coalesce("album_image_url", "artist_image", F.lit(NO_IMAGE))
    return (
        ut.filter(_has_played()).select("track_id", "track_name", "artist", image.alias("image_url"), F.col("play_count").alias("count"))
        .orderBy(desc("count"), asc("track_id")).limit(TOP).drop("track_id")
    )


def plays_since(up: DataFrame, moment: Column) -> DataFrame:
    """Plays from `moment` on; of plays stored by month only the months needed are read."""
    recent = up.filter(F.col("played_at") >= moment)
    return recent.filter(F.col("month") >= F.date_format(moment, "yyyy-MM")) if "month" in up.columns else recent


def play_clock(up: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Plays counted by quarter of an hour, split at `as_of` minus `days`: one pass over the
    plays from which the daily, hourly and monthly counts follow. Every zone in use is a
    whole number of quarters from UTC."""
    quarter = F.timestamp_seconds(F.lit(900) * F.floor(F.unix_seconds(F.col("played_at").cast("timestamp")) / 900)).cast("timestamp_ntz")
    recent = F.col("played_at") >= ago(as_of, days, "days")
    return up.groupBy(quarter.alias("played_at"), recent.alias("recent")).agg(F.count(F.lit(1)).alias("n"))


def _counted(up: DataFrame) -> DataFrame:
    """Plays, or a `play_clock`, as rows with a weight `n`."""
    return up if "n" in up.columns else up.withColumn("n", F.lit(1).cast("bigint"))


def daily_plays(up: DataFrame, as_of, days: int = 30) -> DataFrame:
    recent = up.filter("recent") if "recent" in up.columns else _counted(plays_since(up, ago(as_of, days, "days")))
    return _in_order(recent.groupBy(F.to_date("played_at").alias("date")).agg(F.sum("n").alias("count")), "date")


def top_albums(ut: DataFrame) -> DataFrame:
    return (
        of(ut, "album", "image", "heard").select("album_name", "artist", F.coalesce("image", F.lit(NO_IMAGE)).alias("image_url"), F.col("heard").alias("count"))
        .orderBy(desc("count"), asc("album_name"), asc("artist")).limit(TOP)
    )


def weekday_rank(day: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, WEEKDAYS)), day)


def plays_by_weekday(ut: DataFrame) -> DataFrame:
    """Share of plays by the weekday of a track's last play, rounded half to even."""
    sums = of(ut, "played_day", "plays").groupBy(F.date_format("date", "EEEE").alias("day")).agg(F.sum("plays").alias("_n"))
    share = half_even(ratio(F.col("_n"), _total("_n")) * 100)
    return _in_order(sums.select("day", share.alias("percentage")), weekday_rank(F.col("day")))


def plays_by_weekday_dense(ut: DataFrame) -> DataFrame:
    spark = ut.sparkSession
    axis = spark.range(1).select(F.posexplode(F.array(*map(F.lit, WEEKDAYS))).alias("rank", "day"))
    shares = axis.join(plays_by_weekday(ut), "day", "left")
    return _in_order(shares.select("day", F.coalesce("percentage", F.lit(0.0)).alias("percentage"), "rank"), "rank").drop("rank")


def plays_by_hour(up: DataFrame) -> DataFrame:
    hours = _counted(up).groupBy(F.hour(to_local(F.col("played_at"))).alias("hour")).agg(F.sum("n").alias("_n"))
    return _in_order(hours.select("hour", half_up(percent(F.col("_n"), _total("_n"))).alias("percentage")), "hour")


def _month(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM")


def plays_by_month(up: DataFrame) -> DataFrame:
    return _in_order(_counted(up).groupBy(_month("played_at").alias("month")).agg(F.sum("n").alias("count")), "month")


def tracks_added(ut: DataFrame) -> DataFrame:
    return _in_order(of(ut, "added_day", "n").select("date", F.col("n").alias("count")), "date")


def top_liked_artists(ut: DataFrame) -> DataFrame:
    liked = of(ut, "artist", "liked").filter("liked > 0 AND artist_image IS NOT NULL")
    return (
        liked.select("artist", F.col("artist_image").alias("image_url"), F.col("liked").alias("count"))
        .orderBy(desc("count"), asc("artist"), asc("image_url")).limit(TOP)
    )


def top_genres(ut: DataFrame) -> DataFrame:
    return of(ut, "genre", "heard").select("genre", F.col("heard").alias("count")).orderBy(desc("count"), asc("genre")).limit(TOP)


def popularity_histogram(ut: DataFrame) -> DataFrame:
    label = _labelled(F.col("popularity"), POPULARITY_BUCKETS, lambda v, b: v >= b)
    return _in_order(of(ut, "popularity", "n").groupBy(label.alias("range")).agg(F.sum("n").alias("count")), "range")


def avg_popularity(ut: DataFrame) -> DataFrame:
    mean = ratio(F.sum(F.col("popularity") * F.col("n")), F.sum("n"))
    return of(ut, "popularity", "n").agg(F.coalesce(half_up(mean), F.lit(0.0)).alias("avg_popularity"))


def release_to_play(ut: DataFrame) -> DataFrame:
    """Share of (title, artist, release) by days from release to the earliest last play."""
    songs = of(ut, "song", "moment").withColumnRenamed("moment", "heard")
    released = partial_date(F.col("release_date"))
    known = songs.withColumn("_out", released).filter(F.col("heard") >= F.col("_out"))
    waits = known.select(_labelled(F.datediff("heard", "_out"), WAIT_BUCKETS, lambda v, b: v <= b).alias("bucket"))
    counts = waits.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"))
    rank = F.array_position(F.array(*[F.lit(text) for _, text in WAIT_BUCKETS]), F.col("bucket"))
    return _in_order(counts.select("bucket", half_up(percent(F.col("_n"), _total("_n"))).alias("percentage")), rank)


def library_growth(ut: DataFrame) -> DataFrame:
    month = F.date_trunc("month", "date").cast("timestamp_ntz")
    return _in_order(of(ut, "added_day", "n").groupBy(month.alias("month")).agg(F.sum("n").alias("count")), "month")


def top_artist_by_month(up: DataFrame, as_of, months: int = 24) -> DataFrame:
    """Most played artist of each month, ties to the first name. A min over structs, so a
    month with very many artists is reduced before the shuffle rather than sorted."""
    recent = plays_since(up, ago(as_of, months, "months")).filter(F.col("artist_name").isNotNull())
    counts = recent.groupBy("artist_name", _month("played_at").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("month").agg(F.min(F.struct((-F.col("n")).alias("less"), F.col("artist_name").alias("artist"))).alias("_b"))
    return _in_order(best.select(F.col("_b.artist").alias("artist"), "month", (-F.col("_b.less")).alias("count")), "month")


def summary_stats(ut: DataFrame) -> DataFrame:
    """Counts over all tracks. Distinct artists are counted from a per-artist frame, so one
    pass with partial sums serves every figure."""
    measures = ("n", "liked", "plays", "played", "ms")
    per_artist = of(ut, "artist", *measures).groupBy("artist").agg(*[F.sum(m).alias(m) for m in measures])
    return per_artist.agg(
        F.count("artist").alias("total_artists"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_tracks"),
        F.coalesce(F.sum("liked"), F.lit(0)).alias("total_liked"), F.sum("plays").alias("total_plays"),
        F.coalesce(F.sum("played"), F.lit(0)).alias("total_unique_plays"), F.coalesce(F.sum("ms"), F.lit(0)).alias("total_ms"),
    ).withColumn("total_time_spent", span_text(F.col("total_ms")))


def album_type_counts(ut: DataFrame) -> DataFrame:
    """Distinct albums by type; a missing type counts as single."""
    return of(ut, "album_kind", "n").agg(
        F.count_if(F.col("kind") == "album").alias("total_albums"), F.count_if(F.col("kind") == "single").alias("total_singles"),
        F.count_if(F.col("kind") == "compilation").alias("total_compilations"),
    )


def active_dates(ut: DataFrame, ts: str = "last_played_at") -> DataFrame:
    if isinstance(ut, Groups):
        return ut["played_day"].select("date")
    return ut.filter(F.col(ts).isNotNull()).select(F.to_date(ts).alias("date")).distinct()


def active_days_per_week(ut: DataFrame) -> DataFrame:
    weeks = active_dates(ut).groupBy(F.to_date(F.date_trunc("week", "date")).alias("week")).agg(F.count(F.lit(1)).alias("active_days"))
    return _in_order(weeks, "week")


def avg_active_days(ut: DataFrame) -> DataFrame:
    weeks = active_days_per_week(ut)
    mean = ratio(F.sum("active_days"), F.count("active_days"))
    return weeks.agg(F.coalesce(half_even(mean), F.lit(0.0)).alias("avg_active_days_per_week"))


def listening_streak(ut: DataFrame, ts: str = "last_played_at") -> DataFrame:
    """Longest run of consecutive days. The window sees one row per calendar day."""
    runs = active_dates(ut, ts).select(F.date_sub("date", F.row_number().over(W.orderBy("date"))).alias("run"))
    lengths = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    return lengths.agg(F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("longest_listening_streak"))


def listens_rate(ut: DataFrame) -> DataFrame:
    """Tracks heard, per day and per month of the observed span."""
    seen = of(ut, "played_day", "n").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi"))
    days = F.coalesce(F.datediff("hi", "lo") + 1, F.lit(1))
    months = F.coalesce((F.year("hi") - F.year("lo")) * 12 + F.month("hi") - F.month("lo") + 1, F.lit(1))
    return seen.select(
        half_even(ratio(F.col("n"), days)).alias("avg_listens_per_day"),
        half_even(ratio(F.col("n"), months)).alias("avg_listens_per_month"),
    )


def dynamic_playlists(playlists: DataFrame) -> DataFrame:
    return playlists.filter("is_dynamic").agg(F.count("slug").alias("total_dynamic_playlists"))
