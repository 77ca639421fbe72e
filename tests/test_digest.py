import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from earshot.operators.digest import PIECE_BYTES, ordered_digest
from earshot.plans.playlists import tracklist_hashes


def brute(rows, sep):
    groups = defaultdict(list)
    for key, at, text in rows:
        groups[key].append(((at is not None, at), text or ""))
    return {k: (hashlib.sha256(sep.join(t for _, t in sorted(v)).encode()).hexdigest(), len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("sep", ["", ",", "·"])
def test_equals_the_whole_text(spark, sep):
    rows = [(f"k{i % 7}" if i % 11 else None, i, "é" * (i % 5) if i % 13 else None) for i in range(3_000)]
    rows += [("long", i, "x" * PIECE_BYTES * (i % 3)) for i in range(9)] + [("one", None, "first"), ("one", 3, "last"), ("empty", 1, None)]
    got = ordered_digest(spark.createDataFrame(rows, "k string, at long, text string").repartition(5), ["k"], ["at"], "text", sep)
    assert {r.k: (r.digest, r.n_items) for r in got.collect()} == brute(rows, sep)


def test_no_rows(spark):
    got = ordered_digest(spark.createDataFrame([], "k string, at long, text string"), ["k"], ["at"], "text")
    assert got.columns == ["k", "digest", "n_items"] and got.collect() == []


def test_a_list_of_a_million_is_never_one_row(spark):
    items = spark.range(0, 1_000_000, 1, 8).select(F.lit("r").alias("rule"), (F.col("id") + 1).alias("position"), F.concat(F.lit("u:"), F.col("id").cast("string")).alias("uri"))
    hashed = tracklist_hashes(items)
    assert "collect_list" not in hashed._jdf.queryExecution().toString()
    want = hashlib.sha256(",".join(f"u:{i}" for i in range(1_000_000)).encode()).hexdigest()
    assert [(r.new_hash, r.new_count) for r in hashed.collect()] == [(want, 1_000_000)]
