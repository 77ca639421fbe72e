import pytest
from pyspark.sql import functions as F

from earshot.sources.members import BUCKETS, MemberTable


def members(spark, rows):
    return spark.createDataFrame(rows, "slug string, position int, uri string")


def held(table, *args, **kwargs):
    return sorted(((r.slug, r.position, r.uri) for r in table.read(*args, **kwargs).collect()), key=str)


def test_a_run_replaces_its_playlists_and_no_others(spark, tmp_path):
    table = MemberTable.create(spark, str(tmp_path / "m"), members(spark, [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("c", 1, "w"), (None, 1, "n"), ("", 1, "e")]))
    decided = spark.createDataFrame([("b",), ("d",)], "slug string")
    assert table.replace(members(spark, [("a", 1, "q"), (None, 1, "m")]), decided) == 2
    assert held(table) == sorted([("a", 1, "q"), ("c", 1, "w"), (None, 1, "m"), ("", 1, "e")], key=str)
    assert len(held(table, 1)) == 6  # a reader of the former version sees it whole
    assert held(table, slugs=["a", "b"]) == [("a", 1, "q")] and held(table, slugs=[]) == []


def test_the_same_run_again_changes_nothing(spark, tmp_path):
    rows = members(spark, [("a", 1, "x"), ("a", 1, "x"), ("b", 1, "z")])  # repeated rows stay
    table = MemberTable.create(spark, str(tmp_path / "m"), rows)
    table.replace(rows)
    assert held(table) == [("a", 1, "x"), ("a", 1, "x"), ("b", 1, "z")]
    before = table.version()
    assert table.replace(members(spark, [])) == before


def test_empty_tables_and_other_columns(spark, tmp_path):
    table = MemberTable.create(spark, str(tmp_path / "m"), members(spark, []))
    assert held(table) == [] and table.forget() == 1  # the folder of no rows, which no version names
    table.replace(members(spark, [("a", 1, "x")]).drop("uri").withColumn("bucket", F.lit("other")))
    assert held(table) == [("a", 1, None)]
    with pytest.raises(ValueError):
        MemberTable.create(spark, table.root, members(spark, []))


def test_files_do_not_grow_with_the_playlists(spark, tmp_path):
    many = spark.range(3_000).select(F.concat(F.lit("list_"), F.col("id") % 1_500).alias("slug"), F.col("id").cast("int").alias("position"), F.lit("u").alias("uri"))
    table = MemberTable.create(spark, str(tmp_path / "m"), many)
    first = table.read().inputFiles()
    assert table.read().count() == 3_000 and len(first) <= BUCKETS
    table.replace(members(spark, [("list_7", 1, "v")]))
    assert len(set(table.read().inputFiles()) - set(first)) == 1  # one bucket was written anew
    assert table.read(slugs=["list_7"]).count() == 1 and len(table.read(slugs=["list_7"]).inputFiles()) == 1
    assert table.read().count() == 2_999 and table.forget() == 0 and table.read().count() == 2_999


def test_two_runs_at_once_are_told(spark, tmp_path):
    table = MemberTable.create(spark, str(tmp_path / "m"), members(spark, [("a", 1, "x")]))
    other = MemberTable(spark, table.root)
    other.version = lambda: 0 + 1
    table.replace(members(spark, [("a", 1, "y")]))
    with pytest.raises(RuntimeError):
        other.replace(members(spark, [("a", 1, "z")]))
    assert held(table) == [("a", 1, "y")]
