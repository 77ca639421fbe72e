"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line.

The fixture tables are written once before timing, as the engine would find them; each
query then runs to a sink that computes every row and column and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.context import Context
from checks.registry import registered
from earshot.session import local_session

HEADLINES = (
    "unified_plays", "play_stats", "skip_resume", "fuzzy_match", "base_tracks", "unified_tracks", "plays_by_hour", "top_artist_all_months",
    "release_to_play", "metrics_snapshot", "rule_nested", "all_playlists", "merge_plays", "merge_tracks", "fill_history", "reconcile_remove",
    "worklist_artists", "fuzzy_report", "play_row_ids", "link_candidates", "link_best", "flatten_plays",
)


def main(names) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    ctx, found, took = Context.of(spark, sf_dir), registered(), {}
    for table in ("plays", "stream_history", "import_history", "outdated_albums", "resolved_fuzzy_matches", "import_catalog", "catalog"):
        ctx.kept(table)
    ctx.lib, ctx.up, ctx.ut, ctx.live  # noqa: B018 - written before the clock starts
    for name in names or HEADLINES:
        start = time.perf_counter()
        found[name][0](ctx).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
