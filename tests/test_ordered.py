import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.functions.times import HOUR
from tests.helpers import rows
from earshot.operators.ordered import above, cell, grains, hour_sizes, neighbour, neighbour_in_group, number_rows


@pytest.fixture(scope="module")
def moments(spark):
    rng = random.Random(7)
    spread = {rng.randrange(40 * 24 * HOUR) for _ in range(400)}
    dense = {5 * HOUR + rng.randrange(HOUR // 60) for _ in range(400)}  # one busy minute
    one_second = {9 * HOUR + i for i in range(300)}
    before_epoch = {-3 * HOUR + i * 7_000_001 for i in range(50)}
    us = sorted(spread | dense | one_second | before_epoch)
    return spark.createDataFrame([(u, f"t{u % 5}") for u in us], "us long, who string")


@pytest.mark.parametrize("limit", [1_000_000, 100])
@pytest.mark.parametrize("ahead", [True, False])
def test_neighbour_is_the_global_lead(moments, limit, ahead):
    heavy = above(hour_sizes(moments), "n", limit)
    assert (heavy is None) == (limit > 1000)
    got = neighbour(moments, "us", ["who"], heavy, ahead)
    order = W.orderBy(F.col("us") if ahead else F.desc("us"))
    want = moments.withColumns({"near_us": F.lead("us").over(order), "near_who": F.lead("who").over(order)})
    assert rows(got, "us", "near_us", "near_who") == rows(want, "us", "near_us", "near_who")


@pytest.mark.parametrize("limit", [1_000_000, 500, 50])  # whole groups, hours, seconds
def test_neighbour_in_group_is_the_lag(moments, limit):
    keyed = moments.withColumn("g", F.when(F.col("us") > 0, F.lit("hot")).otherwise(F.concat(F.lit("cold"), F.col("us") % 3)))
    heavy = grains(keyed, ["g"], "us", above(keyed.groupBy("g").agg(F.count("*").alias("n")), "n", limit), limit)
    got = neighbour_in_group(keyed, ["g"], "us", [], heavy, ahead=False)
    want = keyed.withColumn("near_us", F.lag("us").over(W.partitionBy("g").orderBy("us")))
    assert rows(got, "us", "near_us") == rows(want, "us", "near_us")


def test_cell_floors_negative_values(spark):
    df = spark.createDataFrame([(-1,), (0,), (9,), (10,), (-10,), (-11,)], "v long")
    assert [r.c for r in df.select(cell("v", 10).alias("c")).collect()] == [-1, 0, 0, 1, -1, -2]


def test_number_rows_counts_equal_rows_once(spark):
    df = spark.createDataFrame([(i % 7, None if i % 5 == 0 else i % 3) for i in range(700)], "a int, b int").repartition(5)
    got = {(r.a, r.b): (r.first_id, r.n) for r in number_rows(df, ["a", "b"]).collect()}
    ordered = sorted(df.collect(), key=lambda r: (r.a, r.b is None, r.b or 0))
    want = {}
    for i, r in enumerate(ordered, 1):
        first, n = want.get((r.a, r.b), (i, 0))
        want[(r.a, r.b)] = (first, n + 1)
    assert got == want
