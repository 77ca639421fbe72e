"""Registered queries hand their operators every row; what a fetch did not find is a property of a row."""

import datetime

import pytest
from pyspark.sql import functions as F

from checks import linkage, page, upkeep
from checks.context import Context
from earshot.operators import upkeep as X
from earshot.operators import worklists as T

SF = "/root/testdata/sf0.001"
AT = datetime.datetime(2024, 1, 31)


@pytest.mark.parametrize(
    "module, operators, operator, argument, query, whole",
    [
        (upkeep, "X", "fill_link_metadata", 2, "fill_link_meta", lambda c: c.t["catalog"].count()),
        (linkage, "X", "merge_links", 1, "merge_links", lambda c: T.link_worklist(c.kept("import_catalog")).count()),
        (page, "P", "playability", 1, "playability", lambda c: c.t["song"].count()),
    ],
)
def test_every_row_is_handed_over(spark, monkeypatch, module, operators, operator, argument, query, whole):
    c, handed = Context.of(spark, SF), []
    operation = getattr(getattr(module, operators), operator)
    monkeypatch.setattr(getattr(module, operators), operator, lambda *a: handed.append(a[argument].count()) or operation(*a))
    module.Q[query][0](c)
    assert handed == [whole(c)]


def test_a_page_place_for_every_track(spark):
    c = Context.of(spark, SF)
    places = page.meta_pages(c).select(F.size(F.from_json("page", "tracks array<struct<id:string>>")["tracks"]).alias("n"))
    assert places.agg(F.sum("n")).first()[0] == c.t["song"].count()


def test_rows_without_result_change_nothing_but_the_stamp(spark):
    schema = "import_id long, matched_track_id string, matched_name string, matched_at timestamp_ntz, match_checked_at timestamp_ntz"
    stored = spark.createDataFrame([(1, None, "kept", None, None), (2, None, None, None, None), (3, None, None, None, None)], schema)
    links = spark.createDataFrame([(1, None, None), (2, "T2", "two")], "import_id long, matched_track_id string, matched_name string")
    got = sorted(map(tuple, X.merge_links(stored, links, stored.filter("import_id < 3"), AT).collect()))
    assert got == [(1, None, "kept", AT, AT), (2, "T2", "two", AT, AT), (3, None, None, None, None)]

    pending = spark.createDataFrame([(1, "T1", None, None, None), (2, "T2", None, None, None), (3, "T3", None, None, None)], schema)
    fetched = spark.createDataFrame([("T1", None), ("T2", "two")], "matched_track_id string, matched_name string")
    got = sorted(map(tuple, X.fill_link_metadata(pending, pending, fetched, AT).collect()))
    assert got == [(1, "T1", None, None, AT), (2, "T2", "two", AT, AT), (3, "T3", None, None, AT)]
