import random

import pytest

from earshot.operators import plays as P
from earshot.operators import skew
from earshot.operators.ordered import above, grains, hour_sizes
from tests.helpers import at, play, plays, rows

EQ = "alias_track_id string, canonical_track_id string, reason string, created_by string, created_at timestamp_ntz"


def brute(data, library):
    """Resumes and skips by walking the plays in order."""
    order = sorted((r for r in data if r[0] and r[1]), key=lambda r: (r[1], r[0], r[4] or 0))
    last, resumes, skips = {}, {}, {}
    for i, r in enumerate(order):
        ms = library.get(r[0], r[4])
        resumes.setdefault(r[0], 0), skips.setdefault(r[0], 0)
        gap = (r[1] - last[r[0]]).total_seconds() * 1000 if r[0] in last else None
        if gap is not None and ms is not None and gap < ms:
            resumes[r[0]] += 1
        if i + 1 < len(order) and ms is not None and order[i + 1][0] != r[0]:
            if (order[i + 1][1] - r[1]).total_seconds() * 1000 < ms * 0.3:
                skips[r[0]] += 1
        last[r[0]] = r[1]
    return sorted((t, resumes[t], skips[t]) for t in resumes)


def behaviour(spark, data, library, limit=1_000_000):
    frame = plays(spark, data)
    known = spark.createDataFrame(list(library.items()), "track_id string, library_ms int")
    instants = P.instants(frame, known)
    sizes = P.play_stats(frame).select("track_id", "library_play_count")
    heavy = grains(instants, ["track_id"], "us", above(sizes, "library_play_count", limit), limit)
    hours = above(hour_sizes(instants), "n", limit)
    crowded = P.crowded_seconds(instants, hours, limit)
    return P.behaviour(instants, heavy, hours, crowded)


def shuffled(seed):
    rng = random.Random(seed)
    data = []
    for _ in range(600):
        when = at(rng.choice([rng.randrange(300), rng.randrange(86400)]), rng.choice([1, 1, 2, 9]))
        data.append(play(rng.choice("aaaabcde"), when, rng.choice([None, 0, 30_000, 200_000])))
    return data + [data[0]] * 40 + [play(None, at(5)), play("a", None)]


@pytest.mark.parametrize("limit", [1_000_000, 40, 2])  # whole hours, seconds, crowded seconds
@pytest.mark.parametrize("seed", [1, 2])
def test_behaviour_equals_walking_the_plays(spark, seed, limit):
    data, library = shuffled(seed), {"a": 120_000, "b": 0, "c": 90_000}
    assert rows(behaviour(spark, data, library, limit)) == brute(data, library)


def test_behaviour_with_salted_durations(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 50)
    data, library = shuffled(3), {"a": 120_000, "d": 10_000}
    assert rows(behaviour(spark, data, library, 40)) == brute(data, library)


def test_same_play_in_two_feeds_counts_once_after_resumes(spark):
    none = spark.createDataFrame([], EQ)
    twice = [play("t", at(0))]
    union = P.unified_plays([plays(spark, twice), plays(spark, twice)], none)
    assert union.count() == 2
    known = spark.createDataFrame([("t", 200_000)], "track_id string, library_ms int")
    assert rows(P.behaviour(P.instants(union, known))) == [("t", 1, 0)]


def test_aliases_rewrite_ids_and_untimed_plays_go(spark):
    eq = spark.createDataFrame([("A1", "T1", None, None, None)], EQ)
    got = P.unified_plays([plays(spark, [play("A1", at(0)), play("T2", at(1)), play("T3", None), play(None, at(2))])], eq)
    assert rows(got, "track_id") == [(None,), ("T1",), ("T2",)]


def test_gaps_keep_fractions_of_a_second(spark):
    data = [play("a", at(0.0), 1000), play("a", at(0.9999), 1000), play("a", at(1.9999), 1000)]
    assert rows(behaviour(spark, data, {})) == [("a", 1, 0)]


def test_latest_play_breaks_ties_by_value(spark):
    got = P.latest_play(plays(spark, [play("a", at(0), 5), play("a", at(9), 1), play("a", at(9), 2)]))
    assert rows(got, "track_id", "duration_ms") == [("a", 2)]


def test_no_single_task_over_plays(spark):
    """Nothing sorts or collects plays in one task; only per-hour edges may."""
    frame = plays(spark, shuffled(1))
    known = spark.createDataFrame([("a", 1)], "track_id string, library_ms int")
    plan = P.behaviour(P.instants(frame, known))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for block in plan.split("Exchange SinglePartition")[1:]:
        assert "_piece" in block.split("Exchange hashpartitioning")[0]
