import json

from earshot.sources import pages as P
from earshot.streaming import ingest as S
from tests.helpers import at, rows


def item(track, when, **more):
    return {"played_at": f"2024-01-0{when}T00:00:00Z", "track": {"id": track, "name": "n", "duration_ms": 1, "artists": [{"id": "a", "name": "A"}], "album": None, **more}}


def page(*items):
    return json.dumps({"items": list(items)})


def land(folder, name, *pages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(pages) + "\n")


def run(spark, root):
    S.append_plays(S.polled_pages(spark, str(root / "in"), files_per_trigger=1), str(root / "plays"), str(root / "state")).awaitTermination()
    return rows(S.stored_plays(spark, str(root / "plays")), "track_id", "played_at")


def test_overlapping_polls_store_each_play_once(spark, tmp_path):
    land(tmp_path / "in", "p1", page(item("a", 1), item("b", 2)), page(item("b", 2), item("c", 3)))
    land(tmp_path / "in", "p2", page(item("c", 3), item("d", 4), item(None, 4)))
    want = [("a", at(0, 1)), ("b", at(0, 2)), ("c", at(0, 3)), ("d", at(0, 4))]
    assert run(spark, tmp_path) == want
    land(tmp_path / "in", "p3", page(item("a", 1), item("e", 5)))  # a replay long after its time
    assert run(spark, tmp_path) == [*want, ("e", at(0, 5))]


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    land(tmp_path / "in", "p1", page(item("a", 1), item("b", 2)))
    first = run(spark, tmp_path)
    again = S.append_plays(S.polled_pages(spark, str(tmp_path / "in")), str(tmp_path / "plays"), str(tmp_path / "lost-state"))
    again.awaitTermination()  # the state was lost: batch 0 runs again over the same table
    assert rows(S.stored_plays(spark, str(tmp_path / "plays")), "track_id", "played_at") == first


def test_distinct_within_the_watermark(spark, tmp_path):
    land(tmp_path / "in", "p1", page(item("a", 1), item("a", 1), item("b", 1)))
    stream = S.distinct_within(S.readable(S.polled_pages(spark, str(tmp_path / "in"))))
    query = stream.writeStream.format("memory").queryName("polled").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    assert rows(spark.table("polled"), "track_id") == [("a",), ("b",)]


def pages(spark, *documents):
    return spark.createDataFrame([(json.dumps(d),) for d in documents], "page string")


def test_pages_with_gaps(spark):
    likes = pages(spark, {"items": [{"added_at": "2024-01-01T00:00:00", "track": None}, {"added_at": "2024-01-01T00:00:00", "track": {"id": "t", "artists": [], "album": {"id": "x"}}}], "total": 2})
    assert rows(P.flatten_likes(likes), "track_id", "artist_id", "album_id", "liked_at") == [("t", None, "x", at(0))]
    albums = pages(spark, {"items": [{"album": {"id": None}}, {"album": {"id": "a", "images": [], "artists": [{"id": "r", "name": "R"}, {"id": "s"}]}}]}, {"oops": 1})
    assert rows(P.flatten_albums(albums), "id", "artist_id", "album_image_url") == [("a", "r", None)]
    artists = pages(spark, {"artists": [{"id": "r", "images": [{"url": "u1"}, {"url": "u2"}]}]})
    assert rows(P.flatten_artists(artists), "id", "image_url") == [("r", "u1")] and P.flatten_artists(artists).first().genres == []


def test_playability(spark):
    got = pages(spark, {"id": "a", "is_playable": True}, {"id": "b", "is_playable": False, "available_markets": ["US"]}, {"id": "c", "available_markets": ["US"]}, {"id": "d", "available_markets": []}, {"id": "e"})
    asked = spark.createDataFrame([(x,) for x in "abcdef"], "track_id string")
    assert rows(P.playability(asked, got, "US")) == [("a", True), ("b", False), ("c", True), ("d", False), ("e", False), ("f", False)]


def test_broken_pages_and_plays_go_to_quarantine(spark, tmp_path):
    late = {"played_at": "whenever", "track": {"id": "x"}}
    land(tmp_path / "in", "p1", page(item("a", 1), item(None, 2), late), "{not json", '{"other": 1}', page())
    assert run(spark, tmp_path) == [("a", at(0, 1))]
    found = spark.read.parquet(f"{tmp_path}/plays_unreadable").collect()
    assert sorted(r.problem for r in found) == ["page", "page", "time", "track"] and {"{not json", '{"other": 1}'} < {r.text for r in found}
    pages = spark.createDataFrame([("{not json",), ('{"items": []}',), (page(item("a", 1)),), ("[]",), (None,)], "page string")
    assert sorted(str(r.page) for r in P.unreadable(pages, "plays").collect()) == ["None", "[]", "{not json"]


def test_a_batch_reads_only_its_days(spark, tmp_path):
    land(tmp_path / "in", "p1", *[page(item("a", d)) for d in range(1, 7)])
    run(spark, tmp_path)
    import datetime

    near = S._days_of(spark, str(tmp_path / "plays"), [datetime.date(2024, 1, 2), datetime.date(2030, 1, 1)])
    assert all("day=2024-01-02" in f for f in near.inputFiles()) and near.count() == 1


def test_a_compacted_table_goes_on(spark, tmp_path):
    land(tmp_path / "in", "p1", page(item("a", 1), item("b", 1)))
    land(tmp_path / "in", "p2", page(item("c", 1)))
    run(spark, tmp_path)
    S.compact_plays(spark, str(tmp_path / "plays"), str(tmp_path / "next"))
    assert {f.split("/next/")[1].split("/part")[0] for f in spark.read.parquet(f"{tmp_path}/next").inputFiles()} == {"day=2024-01-01/batch=-1"}
    land(tmp_path / "in", "p3", page(item("a", 1), item("d", 1)))
    S.append_plays(S.polled_pages(spark, str(tmp_path / "in")), str(tmp_path / "next"), str(tmp_path / "state")).awaitTermination()
    assert rows(S.stored_plays(spark, str(tmp_path / "next")), "track_id") == [("a",), ("b",), ("c",), ("d",)]
