import pytest
from pyspark.sql import functions as F

from earshot.operators import plays as P
from earshot.operators import tracks as K
from earshot.plans.library import LibraryBuild
from earshot.sources.schemas import SCHEMAS
from earshot.sources.snapshots import settle
from tests.helpers import at, play, plays, rows


def table(spark, name, *dicts):
    schema = SCHEMAS[name]
    return spark.createDataFrame([tuple(d.get(f.name) for f in schema) for d in dicts], schema)


def library(spark, **tables):
    names = ("tracks", "liked_tracks", "albums", "artists", "track_availability", "excluded_tracks", "track_id_equivalents")
    return K.LibraryTables(**{n: settle(table(spark, n, *tables.get(n, [])).coalesce(1), n) for n in names})


SAVED = {"id": "AL", "name": "Saved", "artist": "Album Artist", "is_saved": True}


def song(id, **more):
    return {"id": id, "name": f"song {id}", "artist": "X", "album_id": "AL", "duration_ms": 200_000, **more}


def build(spark, lib, data):
    return LibraryBuild(lib, settle(plays(spark, data).coalesce(1), "plays"))


def by_id(build):
    return {r.track_id: r for r in build.unified_tracks.collect()}


def test_one_row_per_canonical_prefers_its_own_row_then_the_newest(spark):
    lib = library(
        spark,
        tracks=[song("C", added_at=at(0)), song("A", added_at=at(9)), song("B1", added_at=None), song("B2", added_at=at(5))],
        track_id_equivalents=[{"alias_track_id": a, "canonical_track_id": c} for a, c in (("A", "C"), ("B1", "D"), ("B2", "D"))],
    )
    got = K.one_per_canonical(lib.tracks, lib.track_id_equivalents, "id", "added_at")
    assert rows(got, "canonical_track_id", "id") == [("C", "C"), ("D", "B2")]


def test_sources_flags_and_the_like_on_an_unsaved_album(spark):
    lib = library(
        spark,
        albums=[SAVED, {"id": "OUT", "name": "Out", "is_saved": False}],
        tracks=[song("T1"), song("T2", album_id="OUT")],
        liked_tracks=[{"track_id": t, "track_name": t, "track_artist": "X", "liked_at": at(0)} for t in ("T1", "T2", "L1")],
        track_availability=[{"track_id": "N1", "is_playable": False}, {"track_id": "T1", "is_playable": False}],
    )
    got = by_id(build(spark, lib, [play("N1", at(0)), play("T1", at(500))]))
    assert {k: (r.track_source, r.library_origin, r.is_liked, r.is_playable) for k, r in got.items()} == {
        "T1": ("library", "album", True, False),
        "L1": ("library", "liked_only", True, None),
        "N1": ("non_library", "non_library", False, True),  # playable whatever the table says
    }  # T2 has a row on an unsaved album and so is in no branch


def test_excluded_by_canonical_or_own_id(spark):
    lib = library(
        spark, albums=[SAVED], tracks=[song("A"), song("T2"), song("T3")],
        track_id_equivalents=[{"alias_track_id": "A", "canonical_track_id": "C"}],
        excluded_tracks=[{"track_id": "A"}, {"track_id": "T2"}],
    )
    assert {k: r.excluded for k, r in by_id(build(spark, lib, [])).items()} == {"C": True, "T2": True, "T3": False}


def test_fuzzy_plays_count_for_every_matching_track(spark):
    lib = library(spark, albums=[SAVED], tracks=[song("T1", name="Same"), song("T2", name="same", duration_ms=200_900), song("T3", name="Same", duration_ms=202_000)])
    data = [play("Z", at(0), 200_400, "SAME", "x"), play("Z", at(900), 200_400, "SAME", "x"), play("Y", at(2000), None, "Other", "x")]
    got = by_id(build(spark, lib, data))
    assert {k: r.fuzz_play_count for k, r in got.items()} == {"T1": 2, "T2": 2, "T3": 0, "Y": 0}  # Z matched, so it is no track
    assert got["T1"].last_played_at == at(900) and got["T1"].play_count == 2


def test_a_missing_duration_matches_a_missing_duration(spark):
    lib = library(spark, albums=[SAVED], tracks=[song("T1", name="n", duration_ms=None), song("T2", name="n", duration_ms=1001)])
    got = by_id(build(spark, lib, [play("Z", at(0), None, "N", "X")]))
    assert {k: r.fuzz_play_count for k, r in got.items()} == {"T1": 1, "T2": 0}


def test_play_count_has_a_floor_and_dates_are_the_earliest(spark):
    lib = library(
        spark, albums=[SAVED], tracks=[song("T1", added_at=at(50)), song("T2")],
        liked_tracks=[{"track_id": "T1", "track_name": "t", "liked_at": at(20)}],
    )
    got = by_id(build(spark, lib, [play("T1", at(30)), play("T1", at(31))]))
    assert (got["T1"].play_count, got["T1"].resume_play_count) == (1, 1)
    assert got["T1"].added_at == at(20) and got["T1"].first_played_at == at(30)
    assert got["T2"].added_at is None and got["T2"].play_count == 0 and got["T2"].last_played_at is None


def test_local_times_shift_back_from_utc(spark):
    lib = library(spark, albums=[SAVED], tracks=[song("T1", added_at=at(0, 2))])
    assert by_id(build(spark, lib, []))["T1"].added_at_est == at(19 * 3600, 1)


def test_library_duration_wins_over_the_play(spark):
    lib = library(spark, albums=[SAVED], tracks=[song("T1", duration_ms=1000)])
    got = by_id(build(spark, lib, [play("T1", at(0), 900_000), play("T1", at(60), 900_000)]))
    assert got["T1"].resume_play_count == 0


def test_salted_build_equals_the_broadcast_build(spark, no_broadcast):
    lib = library(
        spark, albums=[SAVED], artists=[{"id": "AR", "name": "X", "genres": ["g"]}], tracks=[song(f"T{i}", name=f"n{i % 3}") for i in range(20)],
        liked_tracks=[{"track_id": "T1", "track_name": "t", "liked_at": at(20), "artist_id": "AR"}],
    )
    data = [play(f"T{i % 4}", at(i * 50)) for i in range(60)] + [play(f"Z{i % 5}", at(i * 70), 200_000, f"N{i % 4}") for i in range(30)]
    salted = sorted(map(str, build(spark, lib, data).unified_tracks.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert salted == sorted(map(str, build(spark, lib, data).unified_tracks.collect()))


def test_unified_tracks_has_one_row_per_track_and_no_nested_loop(spark):
    lib = library(spark, albums=[SAVED], tracks=[song("T1"), song("T2")])
    b = build(spark, lib, [play("T1", at(0)), play("Q", at(1)), play("Q", at(2))])
    frame = b.unified_tracks
    assert frame.count() == frame.select("track_id").distinct().count() == 3
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct [" not in plan and "+- BroadcastNestedLoopJoin" not in plan and ":- BroadcastNestedLoopJoin" not in plan


def test_variants_collapse_a_hot_track(spark):
    got = P.play_variants(plays(spark, [play("h", at(i)) for i in range(500)]))
    assert rows(got, "track_id", "n") == [("h", 500)]


@pytest.mark.parametrize("ms,hit", [(199_000, True), (201_000, True), (201_001, False), (198_999, False)])
def test_fuzzy_tolerance_is_inclusive(spark, ms, hit):
    key = "title_key string, artist_key string, ms int"
    tracks = spark.createDataFrame([("s", "x", 200_000)], key)
    keys = spark.createDataFrame([("s", "x", ms)], key)
    assert (K.matched_keys(tracks, keys).count() == 1) == hit
    counted = keys.withColumns({"n": F.lit(1).cast("bigint"), "first_at": F.lit(at(0)), "last_at": F.lit(at(0))})
    assert (K.fuzzy_by_key(tracks, counted).count() == 1) == hit


def test_base_tracks_plan_each_table_once_without_broadcast(spark, no_broadcast):
    from checks.context import Context

    c = Context.of(spark, "/root/testdata/sf0.001")
    build = c.fresh_build()
    plan = build.base._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 14 and plan.count("Exchange") <= 24
