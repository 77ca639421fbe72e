"""Plays stored by month under a manifest (see `versions`)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.operators.merge import lacking_rows, one_per_key
from earshot.sources.snapshots import settle
from earshot.sources.versions import VersionedTable

PLAY_KEY = ["track_id", "played_at"]
NO_MONTH = "none"  # of plays without a time
PIECES = 8  # data folders of a month before a merge writes it anew


def month_of(played_at: str = "played_at") -> Column:
    return F.coalesce(F.date_format(played_at, "yyyy-MM"), F.lit(NO_MONTH))


@dataclass(frozen=True)
class Merge:
    """What a merge did: the version that holds it, and the rows it added."""

    version: int
    added: int


class MonthlyPlays(VersionedTable):
    """A table of plays (any columns beside track_id and played_at) at `root`."""

    part = "month"

    @classmethod
    def create(cls, spark: SparkSession, root: str, plays: DataFrame) -> MonthlyPlays:
        """A new table with these plays as its first version."""
        table = cls(spark, root)
        if table.version():
            raise ValueError(f"there is a table at {root}")
        table._commit(1, table._written(plays.withColumn("month", month_of())), plays.schema.json())
        return table

    def months(self, version: int | None = None) -> dict[str, list[tuple[str, int]]]:
        """The data folders of each month, with their rows: at most PIECES for a month."""
        return self.parts(version)

    def read(self, version: int | None = None, months: list[str] | None = None) -> DataFrame:
        """The plays of a version, or of some of its months, with their `month`."""
        version = version or self.version()
        schema = self._schema(version).add("month", "string")
        folders = self._folders(version, months)
        if not folders:
            return self.spark.createDataFrame([], schema)
        bare = self.spark.read.schema(self._schema(version)).parquet(*folders)  # the month is no partition here: folders differ
        return bare.withColumn("month", month_of())

    def merge(self, polled: DataFrame) -> Merge:
        """Add the polled plays whose (track_id, played_at) the table lacks, one of each.

        `polled` is evaluated once. Only its months are read, and within them its span of
        times; a month gets a new data folder, and one that already has PIECES is written anew as one.
        Merging the same poll again adds nothing and writes no version.
        """
        version = self.version()
        once = settle(one_per_key(polled, PLAY_KEY).withColumn("month", month_of()), "polled")
        found = once.agg(F.collect_set("month").alias("months"), F.min("played_at").alias("low"), F.max("played_at").alias("high")).first()
        near = self.read(version, found.months).filter(F.col("played_at").between(F.lit(found.low), F.lit(found.high)))
        fields = self._schema(version)
        added = lacking_rows(near, once, PLAY_KEY)
        added = added.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in added.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields], "month")
        fresh = self._written(added)
        if not fresh:
            return Merge(version, 0)
        listed = self.months(version)
        for month, parts in fresh.items():
            listed[month] = listed.get(month, []) + parts
        full = [m for m in fresh if len(listed[m]) > PIECES]
        if full:
            folders = [f"{self.root}/data/{folder}/month={m}" for m in full for folder, _ in listed[m]]
            listed |= self._written(self.spark.read.schema(fields).parquet(*folders).withColumn("month", month_of()))
        self._commit(version + 1, listed, fields.json())
        return Merge(version + 1, sum(n for parts in fresh.values() for _, n in parts))
