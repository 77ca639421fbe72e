"""Merging fresh rows into a stored table, without a table format.

Every function returns the table's next state (or the rows to append); writing it as a
new snapshot is the caller's step. Keys are unique in the target; a source with repeated
keys goes through `last_per_key` first.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.operators.skew import fits_broadcast


def old(name: str) -> Column:
    return F.col(f"_t.{name}")


def new(name: str) -> Column:
    return F.col(f"_s.{name}")


def keep_known(name: str) -> Column:
    """The fresh value, or the stored one where the fresh is null."""
    return F.coalesce(new(name), old(name))


def last_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key by `order`: what a loop of upserts would leave."""
    best = F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(best).select("_row.*")


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    matched: Mapping[str, Column] | None = None,
    inserted: Mapping[str, Column] | None = None,
    insert: bool = True,
) -> DataFrame:
    """Update rows whose key is in `source`, add rows whose key is not in `target`.

    `matched` gives new values of target columns in terms of `old(..)` and `new(..)`;
    columns it does not name stay. An added row takes the source's columns, or the
    values in `inserted`, else null. A source small enough to broadcast leaves the target
    unshuffled; otherwise both meet in one full outer join.
    """
    matched, inserted = dict(matched or {}), dict(inserted or {})
    types = dict(target.dtypes)

    def fresh(name):
        if name in inserted:
            return inserted[name].cast(types[name])
        return new(name).cast(types[name]) if name in source.columns else F.lit(None).cast(types[name])

    left = target.select(*keys, F.struct(*target.columns).alias("_t"))
    right = source.select(*keys, F.struct(*source.columns).alias("_s"))
    hit = F.col("_s").isNotNull()
    if fits_broadcast(source):
        updated = left.join(F.broadcast(right), keys, "left").select(
            *[F.when(hit, matched[c]).otherwise(old(c)).cast(types[c]).alias(c) if c in matched else old(c).alias(c) for c in target.columns]
        )
        if not insert:
            return updated
        present = target.select(*keys).join(F.broadcast(source.select(*keys)), keys, "left_semi")  # no larger than the source
        added = right.join(present, keys, "left_anti").select(*[fresh(c).alias(c) for c in target.columns])
        return updated.unionByName(added)
    joined = left.join(right, keys, "full_outer" if insert else "left")
    gone = F.col("_t").isNull()
    return joined.select(
        *[
            F.when(gone, fresh(c)).when(hit, matched.get(c, old(c)).cast(types[c])).otherwise(old(c)).alias(c)
            for c in target.columns
        ]
    )


def one_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; ties go to the smallest remaining values."""
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        return source.distinct()
    return source.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*").select(*source.columns)


def lacking_rows(target: DataFrame, once: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `once` (one per key) whose key the target lacks."""
    if fits_broadcast(once):
        present = target.select(*keys).join(F.broadcast(once.select(*keys)), keys, "left_semi").distinct()
        return once.join(present, keys, "left_anti")
    return once.join(target.select(*keys), keys, "left_anti")


def missing_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `source`, one per key, whose key the target lacks: what to append."""
    return lacking_rows(target, one_per_key(source, keys), keys)


def not_in(rows: DataFrame, key: str, listed: DataFrame, listed_key: str) -> DataFrame:
    """`key NOT IN (listed)`, with its null rule: one null in the list selects nothing."""
    ids = listed.select(F.col(listed_key).alias(key))
    if not ids.filter(F.col(key).isNull()).isEmpty():
        return rows.filter(F.lit(False))
    return rows.join(ids.distinct(), key, "left_anti")


def stamp(rows: DataFrame, key: str, processed: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    """Set `changes` on the rows whose key is in `processed`."""
    marked = rows.join(processed.select(F.col(processed.columns[0]).alias(key)).distinct().withColumn("_hit", F.lit(True)), key, "left")
    types = dict(rows.dtypes)
    return marked.select(
        *[F.when(F.col("_hit"), changes[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in rows.columns]
    )
