import datetime

PLAY = "track_id string, played_at timestamp_ntz, track_name string, artist_id string, duration_ms int, artist_name string, album_id string, album_name string, album_type string"


def at(seconds: float, day: int = 1):
    return datetime.datetime(2024, 1, day) + datetime.timedelta(seconds=seconds)


def play(track, when, ms=200_000, name=None, artist="X"):
    return (track, when, name or f"song {track}", "AR", ms, artist, "AL", "Album", "album")


def plays(spark, rows):
    return spark.createDataFrame(rows, PLAY)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted(map(tuple, picked.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
