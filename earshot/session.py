"""Session settings the operators rely on, and where snapshots live."""

from __future__ import annotations

import datetime
import re
import tempfile
import uuid
import zoneinfo

from pyspark.sql import SparkSession


# What to set on a cluster beside its own memory and core settings. Shuffles start with
# many small partitions and AQE joins them up to the advisory size, so one setting serves
# a table of any size; skewed joins that are not salted are split by AQE.
CLUSTER_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "100m",
}


def local_session(cores: str = "8", **settings) -> SparkSession:
    """A local session for tests and benches; on a cluster, bring your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("earshot")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "12g")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL: dict[str, str] = {}
_SHARED: set[tuple[str, str]] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session on one machine may do without, and gets a temporary folder. On a cluster a
    path on a disk may be a mounted folder or one of a single machine: it is tried, and refused
    unless all that executors write there is seen.
    """
    master = spark.sparkContext.master
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not master.startswith("local") and re.match(r"file:|/", named) and _default_is_local(spark, named):
            _require_shared(spark, named.rstrip("/"))
        return named.rstrip("/")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="earshot-"))


TRIED = 64  # rows of the trial at least, each written by a task of its own; at least four for each core


def _require_shared(spark: SparkSession, named: str) -> None:
    """Try a folder once per application: every core writes to it, and all of that must be read back.

    Files that executors write to disks of their own are missing then, or cannot be read by others. Executors that
    join later are not tried.
    """
    tried = (spark.sparkContext.applicationId, named)
    if tried in _SHARED:
        return
    try:
        rows, path = max(TRIED, 4 * spark.sparkContext.defaultParallelism), f"{named}/trial-{uuid.uuid4().hex[:12]}"
        spark.range(0, rows, 1, rows).write.parquet(path)
        seen = spark.read.schema("id bigint").parquet(path).count()
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    except Exception as error:
        raise RuntimeError(f"spark.checkpoint.dir cannot be written and read by all executors: {named}") from error
    if seen != rows:
        raise RuntimeError(f"spark.checkpoint.dir is a folder of one machine: {named}")
    _SHARED.add(tried)


def _default_is_local(spark: SparkSession, path: str) -> bool:
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return path.startswith("file:") or default.startswith("file:")


def require_utc(spark: SparkSession) -> None:
    """Times without zone are UTC throughout, so the session's zone must be one without offset."""
    name = spark.conf.get("spark.sql.session.timeZone")
    if re.fullmatch(r"(?i)(UTC|GMT|UT|Z)?([+-]00?(:?00)?)?", name):
        return
    try:
        zone = zoneinfo.ZoneInfo(name)
        offsets = {zone.utcoffset(datetime.datetime(y, m, 1)) for y in (1970, 2000, 2024) for m in (1, 7)}
    except (zoneinfo.ZoneInfoNotFoundError, ValueError):
        offsets = {None}
    if offsets != {datetime.timedelta(0)}:
        raise RuntimeError(f"spark.sql.session.timeZone must be UTC, not {name}")
