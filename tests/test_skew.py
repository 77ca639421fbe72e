import pytest
from pyspark.sql import functions as F

from earshot.operators import skew
from earshot.operators.band import band_aggregate
from earshot.operators.skew import HOT_KEYS, drop_listed, hot_keys, key_sizes, lookup_join
from tests.helpers import rows


@pytest.fixture(autouse=True)
def few_rows_are_hot(monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 100)


@pytest.fixture(scope="module")
def facts(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 400).cast("string")))
    return spark.range(6000).select("id", hot.alias("k"))  # a third hot, a third spread, a third null


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 400, 2)], "k string, v int")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("salted", [True, False])
def test_salted_join_equals_plain_join(facts, lookup, no_broadcast, how, salted):
    hot = hot_keys(key_sizes(facts, ["k"]), ["k"], "_n") if salted else None
    got, want = lookup_join(facts, lookup, ["k"], how, hot=hot), facts.join(lookup, "k", how)
    assert rows(got, "id", "k", "v") == rows(want, "id", "k", "v")


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_stacked_lookups_plan_each_side_once(spark, tmp_path, no_broadcast):
    spark.range(100).select("id", F.col("id").alias("a"), F.col("id").alias("b"), F.col("id").alias("c")).write.parquet(f"{tmp_path}/facts")
    joined = spark.read.parquet(f"{tmp_path}/facts")
    for key in ("a", "b", "c"):
        joined = lookup_join(joined, spark.read.parquet(f"{tmp_path}/facts").select(key, F.col("id").alias(f"of_{key}")), [key])
    assert scans(joined) == 4


def test_an_exploded_lookup_counts_for_its_rows(spark):
    from earshot.operators.skew import planned_bytes

    listed = spark.range(10).select(F.explode(F.sequence(F.lit(0), F.col("id") * 1_000_000)).alias("k"))
    assert planned_bytes(listed) >= 100 * planned_bytes(spark.range(10))


def test_salts_follow_the_measured_count(facts):
    assert [(r.k, r["_salts"]) for r in hot_keys(key_sizes(facts, ["k"]), ["k"], "_n").collect()] == [("hot", 20)]


def test_salted_join_spreads_the_hot_key_and_the_nulls(facts, lookup, no_broadcast, spark):
    joined = lookup_join(facts, lookup, ["k"], hot=hot_keys(key_sizes(facts, ["k"]), ["k"], "_n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 3000  # neither the 2000 hot nor the 2000 null rows ended up in one task


def test_drop_listed_keeps_null_keys(facts, lookup, no_broadcast):
    got = drop_listed(facts, lookup, ["k"])
    assert rows(got, "id") == rows(facts.join(lookup, "k", "left_anti"), "id")
    assert got.filter("k IS NULL").count() == 2000


def test_hot_keys_are_bounded(facts):
    found = hot_keys(key_sizes(facts, ["k"]), ["k"], "_n")
    assert found.filter("k = 'hot'").count() == 1 and found.count() <= HOT_KEYS


def test_band_aggregate_equals_the_pairwise_join(spark):
    points = spark.createDataFrame([("a", v * 137 % 5000, v) for v in range(300)] + [("b", 10, 5)], "g string, v int, n int").dropDuplicates(["g", "v"])
    probes = spark.createDataFrame([("a", v * 91 % 6000) for v in range(300)] + [("b", -5), ("b", 2000), ("c", 1)], "g string, v int").distinct()
    got = band_aggregate(probes, points, ["g"], "v", 100, {"n": F.sum("n"), "lo": F.min("n")}).filter("n IS NOT NULL")
    p = points.select("g", F.col("v").alias("pv"), "n")
    want = probes.join(p, "g").filter("abs(v - pv) <= 100").groupBy("g", "v").agg(F.sum("n").alias("n"), F.min("n").alias("lo"))
    assert rows(got) == rows(want)
