"""Tables of data folders under a manifest.

A table is a folder of data folders and of versions. A version lists, for each part of the table (a month, a bucket),
the data folders it consists of; it is one small file, written last and never again. So a write makes the parts it
touches and nothing else, readers see one version whole, and a run that was cut off leaves folders that no version names.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from earshot.session import require_utc

DONE = "end"  # last line of a version


class VersionedTable:
    """A table at `root`, in parts named by the column `part`."""

    part = "part"

    def __init__(self, spark: SparkSession, root: str):
        require_utc(spark)
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # versions ------------------------------------------------------------------------

    def version(self) -> int:
        """The latest whole version, 0 if there is none."""
        folder = self._path(f"{self.root}/versions")
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return next((int(n) for n in sorted(names, reverse=True) if n.isdigit() and self._lines(int(n))[-1] == DONE), 0)

    def parts(self, version: int | None = None) -> dict[str, list[tuple[str, int]]]:
        """The data folders of each part, with their rows: a line per folder."""
        found: dict[str, list[tuple[str, int]]] = defaultdict(list)
        for line in self._lines(version or self.version())[1:-1]:
            part, folder, rows = line.split("\t")
            found[part].append((folder, int(rows)))
        return dict(found)

    def _lines(self, version: int) -> list[str]:
        stream = self._fs.open(self._path(f"{self.root}/versions/{version:010d}"))
        try:
            return (self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8") or "").split("\n")
        finally:
            stream.close()

    def _commit(self, version: int, parts: dict[str, list[tuple[str, int]]], schema: str) -> None:
        """Write a version, or fail if another run has written it first."""
        lines = [schema, *[f"{m}\t{folder}\t{rows}" for m, listed in sorted(parts.items()) for folder, rows in listed], DONE]
        path = self._path(f"{self.root}/versions/{version:010d}")
        try:
            out = self._fs.create(path, False)
        except Py4JJavaError as exists:
            raise RuntimeError(f"version {version} of {self.root} was written meanwhile: merge again") from exists
        out.write(bytearray("\n".join(lines).encode()))
        out.close()

    def _schema(self, version: int) -> StructType:
        return StructType.fromJson(json.loads(self._lines(version)[0]))

    # rows ----------------------------------------------------------------------------

    def _folders(self, version: int, wanted=None) -> list[str]:
        """The data folders of a version, or of some of its parts."""
        return [f"{self.root}/data/{folder}/{self.part}={m}" for m, listed in self.parts(version).items() if wanted is None or m in wanted for folder, _ in listed]

    def _written(self, rows: DataFrame, *order: str) -> dict[str, list[tuple[str, int]]]:
        """Write rows (with their part) into a new data folder, a part in files of even size, each sorted by `order`."""
        folder = uuid.uuid4().hex[:12]
        path = f"{self.root}/data/{folder}"
        even = rows.hint("rebalance", self.part)
        even = even.sortWithinPartitions(self.part, *order) if order else even
        even.write.mode("errorifexists").partitionBy(self.part).parquet(path)
        if not self._fs.exists(self._path(path)):
            return {}
        typed = StructType([f if f.name != self.part else StructType.fromDDL(f"{self.part} string")[0] for f in rows.schema])
        there = self.spark.read.schema(typed).parquet(path).groupBy(self.part).agg(F.count(F.lit(1)).alias("n")).collect()
        return {r[self.part]: [(folder, r.n)] for r in there}

    def forget(self, keep: int = 1) -> int:
        """Delete the versions before the last `keep`, and data no version names that is older than the
        latest version (a merge under way has younger data). Returns the number of data folders deleted."""
        last = self.version()
        kept = range(max(1, last - keep + 1), last + 1)
        named = {folder for v in kept for parts in self.parts(v).values() for folder, _ in parts}
        written = self._fs.getFileStatus(self._path(f"{self.root}/versions/{last:010d}")).getModificationTime()
        for status in self._fs.listStatus(self._path(f"{self.root}/versions")):
            if int(status.getPath().getName()) < kept.start:
                self._fs.delete(status.getPath(), False)
        data = self._path(f"{self.root}/data")
        listed = self._fs.listStatus(data) if self._fs.exists(data) else []
        old = [s.getPath() for s in listed if s.getPath().getName() not in named and s.getModificationTime() < written]
        for path in old:
            self._fs.delete(path, True)
        return len(old)
