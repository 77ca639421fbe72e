"""The library build: plays, then tracks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators import plays as P
from earshot.operators import tracks as K
from earshot.operators.ordered import ROWS_PER_PIECE, above, grains, hour_sizes
from earshot.operators.skew import drop_listed, fits_broadcast, hot_keys
from earshot.sources.snapshots import settle


@dataclass
class LibraryBuild:
    """The stages of the build over stored tables and stored unified plays.

    Stages that several others read are written once through `keep` (a snapshot in the
    cluster's shared folder by default), so plays are scanned a fixed number of times, a
    lost executor costs one stage, and the sizes that choose join strategies are real.
    """

    lib: K.LibraryTables
    plays: DataFrame
    keep: Callable[[DataFrame, str], DataFrame] = settle
    rows_per_piece: int = ROWS_PER_PIECE

    @cached_property
    def tracks_canon(self) -> DataFrame:
        return self.keep(K.one_per_canonical(self.lib.tracks, self.lib.track_id_equivalents, "id", "added_at"), "tracks_canon")

    @cached_property
    def likes_canon(self) -> DataFrame:
        return self.keep(K.one_per_canonical(self.lib.liked_tracks, self.lib.track_id_equivalents, "track_id", "liked_at"), "likes_canon")

    @cached_property
    def library_ms(self) -> DataFrame:
        return K.library_ms(self.tracks_canon, self.likes_canon)

    @cached_property
    def base(self) -> DataFrame:
        return K.base_tracks(self.lib, self.tracks_canon, self.likes_canon)

    @cached_property
    def play_stats(self) -> DataFrame:
        return self.keep(P.play_stats(self.plays), "play_stats")

    @cached_property
    def behaviour(self) -> DataFrame:
        sizes, limit = self.play_stats.select("track_id", "library_play_count"), self.rows_per_piece
        hot = hot_keys(sizes, ["track_id"], "library_play_count")
        rows = self.keep(P.instants(self.plays, self.library_ms, hot), "instants")
        if (sizes.agg(F.sum("library_play_count")).first()[0] or 0) <= limit:
            return P.behaviour(rows)  # all plays together are no more than one piece
        heavy_tracks = grains(rows, ["track_id"], "us", above(sizes, "library_play_count", limit), limit)
        heavy_hours = above(hour_sizes(rows), "n", limit)
        return P.behaviour(rows, heavy_tracks, heavy_hours, P.crowded_seconds(rows, heavy_hours, limit))

    @cached_property
    def stray_variants(self) -> DataFrame:
        known = K.known_ids(self.tracks_canon, self.likes_canon)
        return self.keep(drop_listed(P.play_variants(self.plays), known, ["track_id"]), "stray_variants")

    @cached_property
    def stray(self) -> K.StrayPlays:
        return K.stray_plays(self.stray_variants, self.lib.tracks)

    @cached_property
    def non_library(self) -> DataFrame:
        ids = self.keep(self.stray.unmatched_ids, "unmatched_ids")
        few = fits_broadcast(ids)  # then other plays need not be reduced at all
        plays = self.plays.join(F.broadcast(ids), "track_id", "left_semi") if few else self.plays
        return K.non_library_base(self.lib, ids, P.latest_play(plays))

    @cached_property
    def all_base(self) -> DataFrame:
        return self.base.unionByName(self.non_library)

    @cached_property
    def unified_tracks(self) -> DataFrame:
        return K.attach_stats(self.all_base, self.play_stats, self.behaviour, self.stray.fuzzy)
