import types

import pytest

from earshot import session
from earshot.operators.upkeep import new_plays
from earshot.sources.snapshots import settle, stages, write_plays
from tests.helpers import play, plays, rows


def fake(master, named=None, zone="UTC", default="file:///"):
    conf = {"spark.checkpoint.dir": named, "spark.sql.session.timeZone": zone}
    hadoop = types.SimpleNamespace(get=lambda key, other: default)
    context = types.SimpleNamespace(master=master, applicationId="app", _jsc=types.SimpleNamespace(hadoopConfiguration=lambda: hadoop))
    return types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda key, other=None: conf[key] or other), sparkContext=context)


def test_the_shared_folder():
    made = session.shared_dir(fake("local[4]"))
    assert made == session.shared_dir(fake("local[4]"))
    assert session.shared_dir(fake("local-cluster[2,1,1024]", "file:///tmp/x/")) == "file:///tmp/x"
    assert session.shared_dir(fake("yarn", "hdfs://n/x")) == "hdfs://n/x"
    assert session.shared_dir(fake("yarn", "/x", default="hdfs://n")) == "/x"
    for bad in (fake("local-cluster[2,1,1024]"), fake("yarn"), fake("yarn", "/tmp/x"), fake("spark://h:7077", "file:///tmp/x", default="hdfs://n")):
        with pytest.raises(RuntimeError):
            session.shared_dir(bad)


def on_cluster(spark, named, app, given=None):
    """`spark` as the session of a cluster that names a folder. given: the writing of rows, if not `spark.range`."""
    conf = types.SimpleNamespace(get=lambda key, other=None: named if key == "spark.checkpoint.dir" else other)
    context = types.SimpleNamespace(master="spark://h:7077", applicationId=app, defaultParallelism=2, _jsc=spark.sparkContext._jsc)
    return types.SimpleNamespace(conf=conf, sparkContext=context, range=given or spark.range, read=spark.read, _jvm=spark._jvm)


def test_a_cluster_may_share_a_mounted_folder(spark, tmp_path):
    for n, named in enumerate((f"{tmp_path}/a", f"file://{tmp_path}/b/", f"file:{tmp_path}/c")):
        tries = []
        session_of = on_cluster(spark, named, f"mounted-{n}", lambda *a: tries.append(a) or spark.range(*a))
        assert session.shared_dir(session_of) == session.shared_dir(session_of) == named.rstrip("/")
        assert len(tries) == 1 and not list((tmp_path / "abc"[n]).iterdir())


def test_a_cluster_is_refused_a_folder_that_it_does_not_share(spark, tmp_path):
    lost = on_cluster(spark, f"{tmp_path}/lost", "lost", lambda start, end, step, parts: spark.range(start, end - 1, step, parts))  # a task's file is on another disk
    (tmp_path / "file").write_text("")
    for bad in (lost, lost, on_cluster(spark, f"{tmp_path}/file/x", "file")):
        with pytest.raises(RuntimeError):
            session.shared_dir(bad)


def test_snapshots_are_written_on_a_cluster(spark, tmp_path, monkeypatch):
    conf = types.SimpleNamespace(get=lambda key, other=None: str(tmp_path) if key == "spark.checkpoint.dir" else spark._jsparkSession.conf().get(key, other))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://h:7077")
    monkeypatch.setattr(type(spark), "conf", conf)
    assert rows(settle(spark.range(5), "kept")) == [(n,) for n in range(5)]


def test_the_zone_must_have_no_offset():
    for zone in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00", "GMT+0", "Africa/Abidjan"):
        session.require_utc(fake("local", zone=zone))
    for zone in ("America/New_York", "Europe/London", "+01:00", "nowhere"):
        with pytest.raises(RuntimeError):
            session.require_utc(fake("local", zone=zone))


def test_stages_are_removed_and_results_stay(spark, tmp_path):
    import os

    with stages(spark):
        inner = settle(spark.range(5), "inner")
        folder = inner.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        inner.write.parquet(f"{tmp_path}/result")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder) and spark.read.parquet(f"{tmp_path}/result").count() == 5


def test_a_poll_reads_the_months_it_polled(spark, tmp_path):
    stored = write_plays(plays(spark, [play("a", _day(m)) for m in range(1, 13)]), str(tmp_path))
    polled = plays(spark, [play("a", _day(3)), play("b", _day(3)), play("c", _day(5))])
    added = new_plays(stored, polled)
    plan = added._jdf.queryExecution().executedPlan().toString()
    filters = [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]  # the stored plays, and the written poll
    assert any("month" in f and "2024-03" in f for f in filters) and "LocalTableScan" not in plan and "ExistingRDD" not in plan
    assert rows(added, "track_id") == [("b",), ("c",)]


def _day(month):
    import datetime

    return datetime.datetime(2024, month, 9)
