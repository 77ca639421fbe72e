import datetime

import pytest
from pyspark.sql import functions as F

from earshot.functions.times import iso_ts, partial_date, span_text
from earshot.operators import metrics as M
from earshot.operators import upkeep as X
from earshot.operators.merge import keep_known, last_per_key, merge_rows, missing_rows, new, not_in
from earshot.sources.schemas import SCHEMAS, conform, read_table
from earshot.sources.snapshots import latest_metrics, read_metrics, settle, write_metrics
from tests.helpers import at, rows


@pytest.fixture(params=["10485760", "-1"], ids=["small-source", "large-source"])
def either_join(request, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


T = "id int, v string, w string"


def test_merge_updates_inserts_and_keeps(spark, either_join):
    target = spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "c", "z")], T)
    source = spark.createDataFrame([(2, "B", "q"), (3, None, "q"), (4, "D", "q")], T)
    got = merge_rows(target, source, ["id"], {"v": keep_known("v")}, {"w": F.lit("new")})
    assert rows(got) == [(1, "a", "x"), (2, "B", "y"), (3, "c", "z"), (4, "D", "new")]
    assert rows(merge_rows(got, source, ["id"], {"v": keep_known("v")}, {"w": F.lit("new")})) == rows(got)  # idempotent
    assert rows(merge_rows(target, source, ["id"], {"v": new("v")}, insert=False)) == [(1, "a", "x"), (2, "B", "y"), (3, None, "z")]


def test_missing_rows_adds_each_new_key_once(spark, either_join):
    target = spark.createDataFrame([(1, "a", "x")], T)
    source = spark.createDataFrame([(1, "b", "x"), (2, "q", "x"), (2, "p", "x"), (3, "r", "x")], T)
    assert rows(missing_rows(target, source, ["id"])) == [(2, "p", "x"), (3, "r", "x")]


def test_last_write_wins(spark):
    source = spark.createDataFrame([(1, "a", "1"), (1, "b", "2"), (2, "c", "1")], T)
    assert rows(last_per_key(source, ["id"], ["w"]), "id", "v") == [(1, "b"), (2, "c")]


def test_not_in_with_a_null_selects_nothing(spark):
    left = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(not_in(left, "id", spark.createDataFrame([(2,)], "k int"), "k")) == [(1,)]
    assert rows(not_in(left, "id", spark.createDataFrame([(2,), (None,)], "k int"), "k")) == []
    assert rows(not_in(left, "id", spark.createDataFrame([], "k int"), "k")) == [(1,), (2,)]


def test_unsave_with_nothing_fetched_unsaves_all(spark):
    albums = spark.createDataFrame([("a", True, True), ("b", False, None)], "id string, is_saved boolean, tracks_synced boolean")
    assert rows(X.unsave_missing(albums, albums.limit(0))) == [("a", False, False), ("b", False, False)]


def test_history_albums_take_an_open_default(spark):
    albums = conform(spark.createDataFrame([("a", "A")], "id string, name string"), "albums")
    fetched = spark.createDataFrame([("a", None, None, None, "1999", None, "u"), ("n", "N", None, None, None, None, None), (None, "x", None, None, None, None, None)],
                                    "id string, name string, artist string, artist_id string, release_date string, album_type string, album_image_url string")
    for default in (True, False):
        got = X.merge_album_meta(albums, fetched, saved_by_default=default)
        assert rows(got, "id", "name", "release_date", "is_saved") == [("a", "A", "1999", True), ("n", "N", None, default)]


def test_exclusions_only_change_with_the_version(spark):
    stored, fetched = spark.createDataFrame([("a",)], "track_id string"), spark.createDataFrame([("b",), ("b",), (None,)], "track_id string")
    assert rows(X.replace_exclusions(stored, fetched, "v1", "v1")) == [("a",)]
    assert rows(X.replace_exclusions(stored, fetched, "v1", "v2")) == rows(X.replace_exclusions(stored, fetched, None, "v2")) == [("b",)]


def test_newer_edition_needs_artist_name_type_and_year(spark):
    albums = conform(spark.createDataFrame(
        [("s1", "N", "R", "2001-05-05", "album", True), ("s2", "M", "R", "1990", "album", True), ("s3", "K", "R", None, "album", True), ("s4", "J", "R", "1990", "album", False)],
        "id string, name string, artist_id string, release_date string, album_type string, is_saved boolean"), "albums")
    remote = spark.createDataFrame([
        ("R", "Rn", "old", "N", "album", "2001", 1), ("R", "Rn", "newest", "N", "album", "2001-01", 2), ("R", "Rn", "single", "N", "single", "2001", 3),
        ("R", "Rn", "s2", "M", "album", "1990", 1), ("R", "Rn", "k", "K", "album", None, 1), ("R", "Rn", "j", "J", "album", "1990", 1)],
        "artist_id string, artist_name string, id string, name string, album_type string, release_date string, position int")
    none = spark.createDataFrame([], SCHEMAS["outdated_albums"])
    assert rows(X.newer_editions(albums, remote, none), "saved_album_id", "newer_album_id") == [("s1", "newest")]


def test_conform_adds_columns_and_defaults(spark, tmp_path):
    spark.createDataFrame([("a", None)], "id string, is_saved boolean").write.parquet(str(tmp_path / "old"))
    got = read_table(spark, str(tmp_path / "old"), "albums")
    assert got.schema == conform(got, "albums").schema and [f.name for f in got.schema] == [f.name for f in SCHEMAS["albums"]]
    assert rows(got, "id", "is_saved", "tracks_synced", "name") == [("a", True, False, None)]


def test_partial_dates(spark):
    df = spark.createDataFrame([("2023",), ("2023-11",), ("2024-01-05",), ("",), (None,), ("20x3",), ("2023-1",)], "d string")
    got = [r.p for r in df.select(partial_date(F.col("d")).alias("p")).collect()]
    assert got == [datetime.date(2023, 1, 1), datetime.date(2023, 11, 1), datetime.date(2024, 1, 5), None, None, None, None]


def test_iso_times(spark):
    df = spark.createDataFrame([("2024-01-01T02:00:00Z",), ("2024-01-01T04:00:00+02:00",), ("2024-01-01T02:00:00.000",), ("never",)], "s string")
    assert [r.t for r in df.select(iso_ts(F.col("s")).alias("t")).collect()] == [at(7200)] * 3 + [None]


def test_span_text(spark):
    year, day = 365 * 86400, 86400
    df = spark.createDataFrame([(0,), (59_999,), ((day + 3600) * 1000,), ((year + 61) * 1000,), (None,)], "ms long")
    assert [r.t for r in df.select(span_text(F.col("ms")).alias("t")).collect()] == ["0h 0m 0s", "0h 0m 59s", "1d 1h 0m 0s", "1y 0d 0h 1m 1s", None]


def test_streak_and_rates_of_nothing(spark):
    empty = spark.createDataFrame([], "last_played_at timestamp_ntz")
    assert M.listening_streak(empty).first()[0] == 0
    assert tuple(M.listens_rate(empty).first()) == (0.0, 0.0)
    days = spark.createDataFrame([(at(0, d),) for d in (1, 2, 2, 4, 5, 6, 9)], "last_played_at timestamp_ntz")
    assert M.listening_streak(days).first()[0] == 3


def test_weekday_share_rounds_half_to_even(spark):
    df = spark.createDataFrame([(at(0, 1), 1), (at(0, 2), 799)], "last_played_at timestamp_ntz, play_count long")
    assert [(r.day, r.percentage) for r in M.plays_by_weekday(df).collect()] == [("Monday", 0.1), ("Tuesday", 99.9)]
    df = spark.createDataFrame([(at(0, 1), 1), (at(0, 2), 1999)], "last_played_at timestamp_ntz, play_count long")
    assert M.plays_by_weekday(df).first().percentage == 0.0  # 0.05
    dense = M.plays_by_weekday_dense(df).collect()
    assert [r.day for r in dense] == list(M.WEEKDAYS) and dense[0].percentage == 0.0


def test_metrics_document_replaces_its_day_only(spark, tmp_path):
    path = str(tmp_path / "metrics")

    def doc(day, text):
        return spark.createDataFrame([(datetime.date(2024, 1, day), text)], "snapshot_date date, data string")

    for day, text in ((1, "a"), (2, "b"), (2, "c"), (1, "d")):
        write_metrics(doc(day, text), path)
    assert rows(read_metrics(spark, path), "snapshot_date", "data") == [(datetime.date(2024, 1, 1), "d"), (datetime.date(2024, 1, 2), "c")]
    assert latest_metrics(read_metrics(spark, path)).first().data == "c"
    assert latest_metrics(read_metrics(spark, path).limit(0)).count() == 0


def test_settle_reads_back_the_same_rows(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    kept = settle(df, "numbers")
    assert rows(kept) == rows(df) and "FileScan" in kept._jdf.queryExecution().executedPlan().toString()


def test_the_document_scans_the_tracks_twice(spark, tmp_path):
    """And every metric over all groupings is what it is alone."""
    one = "track_id string, track_name string, artist string, artist_image string, album_name string, album_image_url string, album_type string, album_id string, track_source string, genres array<string>, popularity int, release_date string, is_liked boolean, duration_ms int, play_count long, last_played_at timestamp_ntz, added_at timestamp_ntz"
    drawn = [
        (f"t{i}", f"n{i % 17}", [None, "Ann", "Bob", "Cy"][i % 4], [None, "img"][i % 2], f"al{i % 9}", [None, "u", "v"][i % 3], [None, "album", "single", "compilation"][i % 4], [None, f"A{i % 11}"][i % 5 > 0],
         ["library", "liked"][i % 6 == 0], [None, [], [" rock "], ["pop", "x"]][i % 4], [None, i % 100][i % 7 > 0], [None, "1999", "2023-05", "2023-12-30"][i % 4], i % 3 == 0, [None, 1000][i % 9 > 0],
         [None, 0, 3, i][i % 4], [None, at(i * 90_000)][i % 5 > 0], [None, at(i * 40_000, 3)][i % 6 > 0]) for i in range(300)
    ]
    spark.createDataFrame(drawn, one).write.parquet(f"{tmp_path}/ut")
    ut = spark.read.parquet(f"{tmp_path}/ut")
    groups = M.Groups(ut)
    assert groups.cells._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    alone = (M.top_artists, M.top_albums, M.plays_by_weekday, M.tracks_added, M.top_liked_artists, M.top_genres, M.popularity_histogram, M.avg_popularity, M.release_to_play,
             M.library_growth, M.summary_stats, M.album_type_counts, M.listening_streak, M.listens_rate, M.active_days_per_week)
    for metric in alone:
        got = metric(groups)
        assert f"{tmp_path}/ut" not in str(got.inputFiles()) and got.collect() == metric(ut).collect(), metric
    none = M.Groups(ut.limit(0))
    for metric in alone:
        assert metric(none).collect() == metric(ut.limit(0)).collect(), metric
