"""What a registered query gets: the fixture tables and the build over them."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession

from checks.fixture import AS_OF, Tables
from earshot.operators import plays as P
from earshot.operators.tracks import LibraryTables
from earshot.plans.library import LibraryBuild
from earshot.sources.snapshots import settle, settle_plays

_CONTEXTS: dict[tuple[str, str], "Context"] = {}


class Context:
    as_of = AS_OF

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.t = spark, Tables(spark, sf_dir)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Context":
        """One context per application and directory, so that snapshots are written once."""
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _CONTEXTS:
            _CONTEXTS[key] = cls(spark, sf_dir)
        return _CONTEXTS[key]

    @property
    def feeds(self) -> list[DataFrame]:
        return [self.t["plays"], self.t["stream_history"], self.t["import_history"]]

    @cached_property
    def lib(self) -> LibraryTables:
        names = ("tracks", "liked_tracks", "albums", "artists", "track_availability", "excluded_tracks", "track_id_equivalents")
        return LibraryTables(**{n: self.kept(n) for n in names})

    def kept(self, name: str) -> DataFrame:
        """A library table as the engine meets it: stored."""
        if not hasattr(self, "_kept"):
            self._kept = {}
        if name not in self._kept:
            self._kept[name] = settle(self.t[name], name)
        return self._kept[name]

    def unified_plays(self) -> DataFrame:
        return P.unified_plays([self.kept(n) for n in ("plays", "stream_history", "import_history")], self.lib.track_id_equivalents)

    @cached_property
    def up(self) -> DataFrame:
        return settle_plays(self.unified_plays())

    @cached_property
    def live(self) -> DataFrame:
        """The table that polls append to, stored by month."""
        return settle_plays(self.kept("plays"))

    @property
    def every_play(self) -> DataFrame:
        """The plays of all feeds as they came."""
        columns = ["track_id", "track_name", "artist_name", "played_at", "duration_ms"]
        return reduce(DataFrame.unionByName, [self.kept(n).select(*columns) for n in ("plays", "stream_history", "import_history")])

    def fresh_build(self) -> LibraryBuild:
        """A build with none of its stages written yet."""
        return LibraryBuild(self.lib, self.up)

    @cached_property
    def build(self) -> LibraryBuild:
        return self.fresh_build()

    @cached_property
    def ut(self) -> DataFrame:
        return settle(self.build.unified_tracks, "unified_tracks")
