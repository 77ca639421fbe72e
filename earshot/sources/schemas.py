"""Schemas of the library tables, and reading older data under them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {"s": T.StringType(), "i": T.IntegerType(), "l": T.LongType(), "b": T.BooleanType(),
          "t": T.TimestampNTZType(), "z": T.TimestampType(), "d": T.DateType(), "a": T.ArrayType(T.StringType())}


def _schema(spec: str) -> T.StructType:
    pairs = (item.split(":") for item in spec.split())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


_PLAY = "track_id:s played_at:t track_name:s artist_id:s duration_ms:i artist_name:s album_id:s album_name:s album_type:s checked_at:t"

SCHEMAS: dict[str, T.StructType] = {
    "plays": _schema(_PLAY),
    "stream_history": _schema(_PLAY),
    "import_history": _schema(_PLAY),
    "albums": _schema(
        "id:s name:s artist:s artist_id:s release_date:s total_tracks:i is_saved:b added_at:t tracks_synced:b "
        "album_type:s album_image_url:s tracks_checked_at:t"
    ),
    "tracks": _schema(
        "id:s name:s artist:s album:s album_id:s from_album:b track_number:i disc_number:i added_at:t duration_ms:i popularity:i"
    ),
    "liked_tracks": _schema(
        "track_id:s liked_at:t added_at:t last_checked_at:t track_name:s track_artist:s artist_id:s album_id:s "
        "album_in_library:b duration_ms:i popularity:i"
    ),
    "artists": _schema("id:s name:s genres:a image_url:s last_checked_at:t last_album_checked_at:t"),
    "track_availability": _schema("track_id:s is_playable:b checked_at:t"),
    "excluded_tracks": _schema("track_id:s"),
    "track_id_equivalents": _schema("alias_track_id:s canonical_track_id:s reason:s created_by:s created_at:t"),
    "resolved_fuzzy_matches": _schema("track_id:s resolved_at:t"),
    "outdated_albums": _schema(
        "artist_id:s artist_name:s album_name:s saved_album_id:s newer_album_id:s first_detected_at:t last_checked_at:t"
    ),
    "playlist_mappings": _schema(
        "slug:s name:s playlist_id:s last_synced_at:t status:s track_count:i rules:s is_dynamic:b snapshot_id:s "
        "last_synced_hash:s pending_delete:b missing_count:i last_missing_at:t last_missing_reason:s last_seen_at:t"
    ),
    "metrics_snapshots": _schema("snapshot_date:d data:s"),
    "logs": _schema("id:l timestamp:t source:s level:s message:s"),
    "import_catalog": _schema(
        "import_id:l name:s artist_name:s album_name:s duration_ms:i matched_track_id:s matched_name:s "
        "matched_artist_id:s matched_duration_ms:i matched_artist_name:s matched_album_id:s matched_album_name:s "
        "matched_album_type:s matched_at:t match_checked_at:t"
    ),
}

# Values a column takes where older data has none.
DEFAULTS: dict[str, dict[str, object]] = {
    "albums": {"is_saved": True, "tracks_synced": False},
    "playlist_mappings": {"is_dynamic": False, "pending_delete": False, "missing_count": 0},
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """`df` under the table's schema: missing columns added, nulls of defaulted columns filled."""
    defaults = DEFAULTS.get(table, {})
    columns = []
    for field in SCHEMAS[table]:
        value = F.col(field.name).cast(field.dataType) if field.name in df.columns else F.lit(None).cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def read_table(spark, path: str, table: str) -> DataFrame:
    """Parquet at `path`, read with the declared schema: columns the files lack come back null."""
    return conform(spark.read.schema(SCHEMAS[table]).parquet(path), table)
