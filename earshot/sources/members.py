"""Members of playlists, stored in hash buckets under a manifest (see `versions`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.operators.skew import drop_listed
from earshot.sources.snapshots import settle
from earshot.sources.versions import VersionedTable

BUCKETS = 256  # a fixed number, so that files do not grow with the number of playlists


def bucket_of(slug: str = "slug") -> Column:
    return F.pmod(F.xxhash64(slug), F.lit(BUCKETS)).cast("string")


class MemberTable(VersionedTable):
    """Members (slug, position and any other columns), a playlist in one of BUCKETS buckets."""

    part = "bucket"

    @classmethod
    def create(cls, spark: SparkSession, root: str, members: DataFrame) -> MemberTable:
        """A new table with these members as its first version."""
        table = cls(spark, root)
        if table.version():
            raise ValueError(f"there is a table at {root}")
        table._commit(1, table._written(members.withColumn("bucket", bucket_of()), "slug", "position"), members.schema.json())
        return table

    def read(self, version: int | None = None, slugs: list[str] | None = None) -> DataFrame:
        """The members of a version, or of a few playlists: then only their buckets are read."""
        version = version or self.version()
        schema = self._schema(version)
        wanted = None
        if slugs is not None:
            few = self.spark.range(1).select(F.explode(F.lit(slugs).cast("array<string>")).alias("slug"))
            wanted = {r.bucket for r in few.select(bucket_of().alias("bucket")).collect()}
        folders = self._folders(version, wanted)
        found = self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)
        return found if slugs is None else found.filter(F.col("slug").isin(slugs))

    def replace(self, members: DataFrame, decided: DataFrame | None = None) -> int:
        """Put `members` in the place of what their playlists held; returns the version that holds them.

        `decided` (slug) names playlists that are settled by this run; one of them without members becomes empty.
        Other playlists stay. Only buckets that hold a settled playlist are read and written anew. `members` is
        evaluated once; replacing by the same members again changes nothing that a reader sees. A null slug is a
        playlist like any other. Columns the table lacks are left out, columns `members` lacks are null.
        """
        version = self.version()
        fields = self._schema(version)
        fresh = members.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in members.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
        fresh = settle(fresh, "fresh_members")
        slugs = fresh.select("slug") if decided is None else fresh.select("slug").unionByName(decided.select("slug"))
        settled = settle(slugs.distinct().withColumn("bucket", bucket_of()), "settled")
        touched = {r.bucket for r in settled.select("bucket").distinct().collect()}  # BUCKETS at most
        if not touched:
            return version
        folders = self._folders(version, touched)
        rows = fresh
        if folders:
            named = settled.select(F.col("slug").isNull().alias("_none"), F.coalesce("slug", F.lit("")).alias("_slug"))
            stored = self.spark.read.schema(fields).parquet(*folders)
            stored = stored.withColumns({"_none": F.col("slug").isNull(), "_slug": F.coalesce("slug", F.lit(""))})
            rows = rows.unionByName(drop_listed(stored, named, ["_none", "_slug"]).drop("_none", "_slug"))
        untouched = {b: listed for b, listed in self.parts(version).items() if b not in touched}
        self._commit(version + 1, untouched | self._written(rows.withColumn("bucket", bucket_of()), "slug", "position"), fields.json())
        return version + 1
