import pytest

from earshot.sources import monthly
from earshot.sources.monthly import MonthlyPlays
from earshot.streaming.ingest import append_months
from tests.helpers import at, play, plays, rows


def moment(month, day=1, seconds=0.0):
    return at(seconds, day).replace(month=month)


@pytest.fixture
def table(spark, tmp_path):
    first = plays(spark, [play("a", moment(1)), play("b", moment(2)), play("c", moment(3)), play("n", None)])
    return MonthlyPlays.create(spark, str(tmp_path / "plays"), first)


def keys(df):
    return rows(df, "track_id", "played_at")


def test_a_merge_writes_its_months_only(spark, table):
    before = table.months()
    polled = plays(spark, [play("b", moment(2)), play("b", moment(2), 1), play("x", moment(2, 5)), play("x", moment(2, 5), 7), play("y", moment(4))])
    done = table.merge(polled)
    after = table.months()
    assert (done.version, done.added) == (2, 2)
    assert {m: after[m] for m in ("2024-01", "2024-03", "none")} == {m: before[m] for m in ("2024-01", "2024-03", "none")}
    assert len(after["2024-02"]) == 2 and after["2024-02"][0] == before["2024-02"][0] and len(after["2024-04"]) == 1
    assert keys(table.read(months=["2024-02", "2024-04"])) == rows(plays(spark, [play("b", moment(2)), play("x", moment(2, 5)), play("y", moment(4))]), "track_id", "played_at")
    assert table.read().filter("track_id = 'x'").first().duration_ms == 7  # the smaller of two rows of one key
    assert table.read().count() == 6


def test_readers_keep_their_version(spark, table):
    old = table.read()
    table.merge(plays(spark, [play("z", moment(1, 9))]))
    assert old.count() == 4 and table.read(1).count() == 4 and table.read().count() == 5
    assert table.merge(plays(spark, [play("z", moment(1, 9))])) == monthly.Merge(2, 0) and table.version() == 2  # again: nothing new
    assert table.merge(plays(spark, [])) == monthly.Merge(2, 0)


def test_only_polled_months_are_read(spark, table, monkeypatch):
    """And the poll is evaluated once: what is joined is its written form."""
    joined = []
    monkeypatch.setattr(monthly, "lacking_rows", lambda near, once, by: joined.append((near, once)) or real(near, once, by))
    real = __import__("earshot.operators.merge", fromlist=["x"]).lacking_rows
    table.merge(plays(spark, [play("q", moment(2, 3))]))
    near, once = joined[0]
    assert {f.rsplit("month=", 1)[1][:7] for f in near.inputFiles()} == {"2024-02"}
    assert once.inputFiles() and "ExistingRDD" not in once._jdf.queryExecution().toString()


def test_full_months_are_written_anew(spark, table, monkeypatch):
    monkeypatch.setattr(monthly, "PIECES", 3)
    for i in range(5):
        table.merge(plays(spark, [play(f"t{i}", moment(1, 2 + i)), play(f"t{i}", moment(3, 2 + i))]))
        assert len(table.months()["2024-01"]) <= 3
    assert table.read(months=["2024-01"]).count() == 6 and table.read().count() == 14
    assert len(table.months()["2024-02"]) == 1
    assert table.forget() > 0 and table.read().count() == 14 and keys(table.read(months=["2024-02"])) == [("b", moment(2))]


def test_two_writers(spark, table):
    other = MonthlyPlays(spark, table.root)
    table.merge(plays(spark, [play("w", moment(1, 20))]))
    other.version = lambda: 1  # it looked before
    with pytest.raises(RuntimeError, match="merge again"):
        other.merge(plays(spark, [play("v", moment(1, 21))]))
    assert MonthlyPlays(spark, table.root).read().count() == 5
    (out := table._fs.create(table._path(f"{table.root}/versions/0000000009"), False)).write(bytearray(b"cut off"))
    out.close()
    assert table.version() == 2
    with pytest.raises(ValueError):
        MonthlyPlays.create(spark, table.root, plays(spark, []))


def test_an_empty_table(spark, tmp_path):
    table = MonthlyPlays.create(spark, str(tmp_path / "none"), plays(spark, []))
    assert table.read().count() == 0 and table.merge(plays(spark, [play("a", moment(1))])).added == 1 and table.read().count() == 1


def test_a_stream_of_polls(spark, table, tmp_path):
    """Overlapping polls, and the same ones once more after the stream's state was lost."""
    for i in range(3):
        plays(spark, [play(f"s{k}", moment(2, 10, k)) for k in range(i, i + 3)]).coalesce(1).write.parquet(f"{tmp_path}/in/p{i}")
    schema = plays(spark, []).schema
    for state in ("one", "two"):
        polled = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        append_months(polled, table.root, str(tmp_path / state)).awaitTermination()
        assert table.read().count() == 9
