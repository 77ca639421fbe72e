"""Joins of a large, possibly skewed fact side with one row per key of another.

Any single key may carry a third of the fact rows. A lookup that fits in memory is
broadcast, after its planned size was checked. Otherwise both sides are shuffled once and
AQE splits what is skewed; a caller that has counted its keys on a stored table hands in
the hot ones, and each is cut into as many salts as its rows ask for.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 512  # at most this many keys are salted; every other key holds less than 1 / HOT_KEYS of the rows
HOT_ROWS = 100_000  # rows of a hot key that one task gets


EXPLODED = 100  # rows a list may stand for where Catalyst's estimate counts one


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for the result of `df`. It takes an exploded list for one
    row, so a plan with a Generate counts EXPLODED times as much."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return int(str(plan.stats().sizeInBytes())) * (EXPLODED if "Generate " in plan.toString() else 1)


def broadcast_limit(df: DataFrame) -> int:
    text = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).lower()
    for unit, size in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10), ("m", 1 << 20), ("g", 1 << 30), ("b", 1)):
        if text.endswith(unit):
            return int(text[: -len(unit)]) * size
    return int(text)


def fits_broadcast(df: DataFrame) -> bool:
    return planned_bytes(df) <= broadcast_limit(df)


def small(df: DataFrame) -> DataFrame:
    """`df` to be broadcast if its planned size allows it."""
    return F.broadcast(df) if fits_broadcast(df) else df


def hot_keys(sizes: DataFrame, keys: list[str], count: str, at_least: int | None = None) -> DataFrame:
    """Of key counts, the HOT_KEYS most frequent keys with more than HOT_ROWS rows (or
    `at_least`), and in `_salts` how many pieces each is to be cut into.

    The list only steers salting; leaving a key out never changes a join's result.
    """
    piece = HOT_ROWS if at_least is None else at_least
    listed = sizes.filter((F.col(count) >= piece) & F.expr(" AND ".join(f"{k} IS NOT NULL" for k in keys)))
    return listed.orderBy(F.desc(count), *keys).limit(HOT_KEYS).select(*keys, F.ceil(F.col(count) / piece).cast("int").alias("_salts"))


def key_sizes(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key. Partial sums on the map side: a hot key costs one row per map task."""
    return facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    spread: Column | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """`facts` joined on `keys` with `lookup`, whatever the skew of `facts`.

    Each side is planned once, so stacked joins grow a plan by one shuffle each. `hot`
    (from `hot_keys`, at most HOT_KEYS rows) names the keys to salt; without it AQE splits
    the partitions that turn out skewed. `spread` picks a fact row's salt and must be a
    function of the row alone, so that a task run again after a lost executor salts it the
    same way.
    """
    if fits_broadcast(lookup):
        return facts.join(F.broadcast(lookup), keys, how)
    if hot is None:
        return facts.join(lookup, keys, how)
    row = spread if spread is not None else F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns])
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])  # matches nothing, so any salt will do
    pieces = F.coalesce("_salts", F.when(no_key, HOT_KEYS).otherwise(1))
    salted = facts.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.pmod(row, pieces).cast("int"))
    copies = lookup.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
    return salted.drop("_salts").join(copies.drop("_salts"), [*keys, "_salt"], how).drop("_salt")


def drop_listed(facts: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `facts` whose key is not in `listed` (null keys stay), whatever the skew."""
    if fits_broadcast(listed):
        return facts.join(F.broadcast(listed), keys, "left_anti")
    return facts.join(listed.select(*keys), keys, "left_anti")
