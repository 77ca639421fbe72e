import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from earshot.operators.rules import Bits, compile_rule, select_by_rule, uri
from earshot.plans import playlists as L
from tests.helpers import at, rows

AS_OF = "2024-01-31 00:00:00"
SCHEMA = ("track_id string, play_count long, added_at timestamp_ntz, last_played_at timestamp_ntz, first_played_at timestamp_ntz, artist string, "
          "album_name string, track_name string, is_liked boolean, is_playable boolean, excluded boolean, track_source string, library_origin string")


@pytest.fixture(scope="module")
def ut(spark):
    def row(i, plays, added=None, last=None, artist="Ann", album="Blue", name="song", liked=False, playable=True, excluded=False, source="library", origin="album"):
        return (i, plays, added, last, last, artist, album, name, liked, playable, excluded, source, origin)

    return spark.createDataFrame([
        row("a", 9, at(0, 30), at(0, 30)), row("b", 5, at(0, 2), at(0, 2), artist="BOB"), row("c", 5, None, None, liked=True),
        row("d", 7, playable=False), row("e", 7, excluded=True), row("f", 0, playable=None), row("g", 1, source="non_library", origin="non_library", album=None),
        row("h", 2, name="100% real_"), row("i", 3, at(0, 31), None, album="Red"),
    ], SCHEMA)


def picked(ut, *conditions, match="all", **more):
    rule = {"match": match, "conditions": list(conditions), **more}
    return [r.track_id for r in select_by_rule(ut, rule, AS_OF).collect()]


def c(field, value, operator=None, unit=None):
    return {"field": field, "operator": operator, "value": value, "unit": unit}


def test_empty_rule_selects_all_playable_and_orders_by_plays_then_id(ut):
    assert picked(ut) == ["a", "b", "c", "i", "h", "g"]


@pytest.mark.parametrize("cond,want", [
    (c("min_plays", "5"), "abc"), (c("max_plays", 2), "hg"), (c("plays", 5, "is"), "bc"), (c("plays", 5, "eq"), "bc"), (c("plays", 5, "gt"), "a"),
    (c("plays", 2, "lt"), "g"), (c("plays", 5, "gte"), "abc"), (c("plays", 2, "lte"), "hg"), (c("plays", 5, "is_not"), "aihg"),
    (c("added_after", "2024-01-30"), "ai"), (c("added_before", "2024-01-02"), "b"),
    (c("date_added", "2024-01-30", "gt"), "i"), (c("date_added", "2024-01-30", "lt"), "b"), (c("date_added", "2024-01-30", "gte"), "ai"),
    (c("date_added", "2024-01-30", "lte"), "ab"), (c("date_added", "2024-01-30", "eq"), "a"),
    (c("added_in_last", 1, "eq", "days"), "ai"), (c("added_in_last", "5", "lte", "weeks"), "abi"), (c("added_in_last", 0, "gte", "months"), "i"),
    (c("last_played_in_last", 2, "eq", "days"), "a"), (c("last_played_in_last", 2, "is_not", "days"), "b"),
    (c("last_played", "2024-01-15"), "a"), (c("first_played", "2024-01-01"), "ab"),
    (c("is_liked", True), "c"), (c("is_liked", "false"), "abihg"), (c("is_playable", False), "d"),
    (c("artist", "bob"), "b"), (c("artist", "bob", "is_not"), "b"), (c("album", "RED"), "i"), (c("track", "100%"), "h"), (c("track", "_ong"), "abcig"),
    (c("track_source", "non_library", "eq"), "g"), (c("track_source", "Library", "is_not"), "g"), (c("track_source", "both", "eq"), "abcihg"),
    (c("library_origin", "non_library", "eq"), "g"), (c("library_origin", "album", "is_not"), "g"),
])
def test_fields_and_operators(ut, cond, want):
    assert "".join(picked(ut, cond)) == want


@pytest.mark.parametrize("cond", [
    c("tempo", 1, "eq"), c("plays", "x", "gt"), c("plays", 1, "near"), c("added_in_last", 1, "eq", "years"), c("added_in_last", -1, "eq", "days"),
    c("added_in_last", 1, "gt", "days"), c("last_played_in_last", 1, "gte", "days"), c("track_source", "moon", "eq"), c("is_liked", "maybe"),
    c("date_added", "soon", "gt"), c("date_added", "2024-01-01", "is"), {"operator": "eq"},
])
def test_unusable_conditions_are_reported_and_left_out(ut, cond):
    rule = compile_rule({"conditions": [cond, c("min_plays", 5)]}, AS_OF)
    assert len(rule.problems) == 1
    assert [r.track_id for r in select_by_rule(ut, rule, AS_OF).collect()] == ["a", "b", "c"]


def test_groups_nest_and_guards_bind_to_the_whole_rule(ut):
    assert picked(ut, c("min_plays", 7), c("is_liked", True), match="any") == ["a", "c"]  # not d (unplayable), not e (excluded)
    nested = {"match": "any", "conditions": [c("artist", "bob"), {"match": "all", "conditions": [c("plays", 9, "is"), {"match": "any", "conditions": []}]}]}
    assert picked(ut, c("min_plays", 1), nested) == ["a", "b"]


def test_nested_is_playable_does_not_lift_the_guard(ut):
    assert picked(ut, {"match": "all", "conditions": [c("is_playable", False)]}) == []


def test_sort_limit_and_uri(ut):
    assert picked(ut, sort=[{"by": "last_played", "direction": "desc"}]) == ["c", "g", "h", "i", "a", "b"]  # nulls first, then ids
    assert picked(ut, sort=[{"by": "added", "direction": "asc"}, {"by": "plays", "direction": "up"}])[:3] == ["b", "a", "i"]
    assert picked(ut, sort=[{"by": "track", "direction": "asc"}], limit=1) == ["h"]
    assert compile_rule({"sort": [{"by": "mood"}]}, AS_OF).problems
    assert select_by_rule(ut, {"limit": 1}, AS_OF).select(uri().alias("u")).first().u == "spotify:track:a"
    with pytest.raises(ValueError):
        compile_rule("{not json", AS_OF)


def test_quotes_in_values_are_only_text(ut):
    assert picked(ut, c("artist", "x' OR '1'='1")) == []


def test_ranked_members_equal_one_selection_each(ut):
    docs = {"r1": {"limit": 2}, "r2": {"conditions": [c("max_plays", 5)], "limit": 3}, "r3": {"sort": [{"by": "artist", "direction": "asc"}], "limit": 4}}
    got = L.ranked_members(ut, {n: compile_rule(d, AS_OF) for n, d in docs.items()}).orderBy("rule", "position").collect()
    for name, doc in docs.items():
        want = [f"spotify:track:{r.track_id}" for r in select_by_rule(ut, doc, AS_OF).collect()]
        assert [r.uri for r in got if r.rule == name] == want
        assert [r.position for r in got if r.rule == name] == list(range(1, len(want) + 1))


def test_all_sort_orders_share_one_scan(spark, ut, tmp_path):
    ut.repartition(3).write.parquet(f"{tmp_path}/ut")
    stored = spark.read.parquet(f"{tmp_path}/ut")
    by = ["track", "artist", "last_played", "added", "plays", "album", "is_liked", "is_playable", "first_played_at", "track_source"]
    docs = {f"{a}-{b}-{way}": {"sort": [{"by": a, "direction": way}, {"by": b, "direction": "asc" if way == "desc" else "desc"}], "limit": 4 + i}
            for i, (a, b) in enumerate(zip(by, by[1:])) for way in ("asc", "desc") if {a, b} <= {*stored.columns, "track", "artist", "last_played", "added", "plays", "album"}}
    rules = {n: compile_rule(d, AS_OF) for n, d in docs.items()}
    members = L.ranked_members(stored, rules)
    assert len({r.sort for r in rules.values()}) > 8 and members._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = members.orderBy("rule", "position").collect()
    for name, rule in rules.items():
        assert [r.uri for r in got if r.rule == name] == [f"spotify:track:{r.track_id}" for r in select_by_rule(stored, rule, AS_OF).collect()], name


def test_masks_test_what_the_predicates_do(spark, ut):
    """Random trees over shared conditions, enough for several words; each condition is evaluated once."""
    rng = random.Random(4)

    def tree(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice([c("min_plays", rng.randrange(40)), c("max_plays", rng.randrange(40)), c("is_liked", rng.random() < 0.5), c("track", rng.choice("abcghi")), c("tempo", 1)])
        return {"match": rng.choice(["all", "any"]), "conditions": [tree(depth - 1) for _ in range(rng.randrange(4))]}

    docs = [{"match": rng.choice(["all", "any"]), "conditions": [tree(3) for _ in range(3)]} for _ in range(60)]
    rules = [compile_rule(d, AS_OF) for d in docs]
    bits = Bits(rules)
    assert len(bits.words) > 1 and len(bits.leaves) < sum(len(r.leaves) for r in rules) / 2
    flags = ut.withColumns(bits.columns()).select("track_id", *[F.coalesce(r.predicate, F.lit(False)).alias(f"p{i}") for i, r in enumerate(rules)], *[bits.test(r).alias(f"b{i}") for i, r in enumerate(rules)])
    for row in flags.collect():
        assert [row[f"p{i}"] for i in range(60)] == [row[f"b{i}"] for i in range(60)]


def playlists(spark, *lists):
    cols = "slug string, rules string, is_dynamic boolean, last_synced_at timestamp_ntz, track_count int, last_synced_hash string"
    return spark.createDataFrame([(s, json.dumps(r) if r is not None else None, d, None, n, h) for s, r, d, n, h in lists], cols)


def test_change_gate(spark, ut):
    empty = {"conditions": [c("min_plays", 99)]}
    digest = hashlib.sha256(b"spotify:track:a,spotify:track:b").hexdigest()
    none = hashlib.sha256(b"").hexdigest()
    lists = playlists(
        spark, ("same", {"limit": 2}, True, 2, digest), ("new", {"limit": 2}, True, 0, None), ("emptied", empty, True, 4, "old"),
        ("still_empty", empty, True, 0, none), ("static", {"limit": 2}, False, 7, "x"), ("exclusions", {"limit": 2}, True, 7, "x"), ("default", None, True, 1, "z"),
    )
    got = {r.slug: r for r in L.change_gate(ut, lists, AS_OF).collect()}
    assert {s: r.outcome for s, r in got.items()} == {
        "same": "unchanged", "new": "changed", "emptied": "emptied", "still_empty": "unchanged", "static": None, "exclusions": None, "default": "changed"}
    assert (got["new"].track_count, got["new"].last_synced_hash) == (2, digest)
    assert (got["emptied"].track_count, got["emptied"].last_synced_hash) == (0, "old")
    assert got["same"].last_synced_at is not None and got["static"].last_synced_at is None


def test_members_come_in_batches(spark, ut):
    wide = ut.crossJoin(spark.range(250)).withColumn("track_id", F.concat("track_id", F.lpad(F.col("id").cast("string"), 4, "0"))).drop("id")
    members = L.all_playlists(wide, playlists(spark, ("p", {"limit": 205}, True, 0, None)), AS_OF)
    assert rows(members.groupBy("batch").count()) == [(0, 100), (1, 100), (2, 5)]


def test_long_lists_equal_the_plain_selection(spark, ut, monkeypatch):
    wide = ut.crossJoin(spark.range(1_500)).withColumn("track_id", F.concat("track_id", F.lpad(F.col("id").cast("string"), 4, "0"))).drop("id")
    doc = {"limit": 9_001, "sort": [{"by": "artist", "direction": "asc"}]}
    want = [f"spotify:track:{r.track_id}" for r in select_by_rule(wide, doc, AS_OF).collect()]
    for top_k in (1_000, 10_000):  # numbered in a distributed sort, and per salt
        monkeypatch.setattr(L, "TOP_K", top_k)
        got = L.all_playlists(wide, playlists(spark, ("p", doc, True, 0, None)), AS_OF).orderBy("position").collect()
        assert [r.uri for r in got] == want and [r.position for r in got] == list(range(1, len(want) + 1)) and len(want) == 9_000


def test_any_number_of_documents(spark, ut, monkeypatch):
    monkeypatch.setattr(L, "RULES_PER_SCAN", 7)
    lists = playlists(spark, *[(f"p{i}", {"limit": i}, True, 0, None) for i in range(20)])
    got = L.all_playlists(ut, lists, AS_OF).groupBy("slug").count().collect()
    assert {r.slug: r["count"] for r in got} == {f"p{i}": min(i, 6) for i in range(1, 20)}


BROKEN = ["[]", "null", "3", "{not json", '{"conditions": null}', '{"conditions": "x"}', '{"conditions": [1]}', '{"limit": null}', '{"limit": Infinity}',
          '{"limit": -1}', '{"sort": [3]}', '{"sort": [{"by": []}]}', '{"conditions": [{"conditions": {}}]}', "[" * 100_000]


def test_broken_documents_stop_no_other_playlist(spark, ut):
    cols = "slug string, rules string, is_dynamic boolean, last_synced_at timestamp_ntz, track_count int, last_synced_hash string"
    good = json.dumps({"conditions": [c("tempo", 1), c("artist", "a\\b"), c("min_plays", 10**30), c("added_in_last", 10**9, "eq", "days")], "match": "any"})
    lists = spark.createDataFrame([(f"b{i}", d, True, None, 5, "h") for i, d in enumerate(BROKEN)] + [("good", good, True, None, 0, None)], cols)
    assert {r.slug for r in L.all_playlists(ut, lists, AS_OF).collect()} <= {"good"}
    problems = L.run_rules(ut, lists, AS_OF).problems.collect()
    assert {r.rule for r in problems if r.fatal} == set(BROKEN) and sum(not r.fatal for r in problems) == 3
    after = {r.slug: r for r in L.change_gate(ut, lists, AS_OF).collect()}
    assert all((after[f"b{i}"].outcome, after[f"b{i}"].track_count) == (None, 5) for i in range(len(BROKEN))) and after["good"].outcome


def test_backslash_takes_the_next_character(spark, ut):
    named = ut.withColumn("track_name", F.when(F.col("track_id") == "a", "ACDC").when(F.col("track_id") == "b", "x 50%").otherwise(F.lit("50 x\\")))
    assert picked(named, c("track", "ac\\dc")) == ["a"]
    assert picked(named, c("track", "50\\%")) == ["b"]
    assert "c" in picked(named, c("track", "x\\\\"))  # an escaped backslash
    assert picked(named, c("track", "50\\")) == ["b"]  # takes the closing %


def test_any_fact_sorts(ut):
    assert picked(ut.withColumn("skip_play_count", F.ascii("track_id")), sort=[{"by": "skip_play_count", "direction": "desc"}])[0] == "i"


def test_members_are_written_by_playlist(spark, ut, tmp_path):
    path = f"{tmp_path}/members"
    L.write_members(L.all_playlists(ut, playlists(spark, ("p", {"limit": 2}, True, 0, None), ("q", {"limit": 3}, True, 0, None)), AS_OF), path)
    table = L.write_members(L.all_playlists(ut, playlists(spark, ("q", {"limit": 1}, True, 0, None)), AS_OF), path)
    assert {(r.slug, r.position) for r in table.read().collect()} == {("p", 1), ("p", 2), ("q", 1)}
