"""What the operators share: reading tables, handing texts to Python in bounded batches, folds.

A Python step sees rows as Arrow batches. Spark bounds a batch by rows, and one row may be a very long
text, so `text_batches` cuts it further by bytes: what a step holds at once is one long text or about
`max_bytes` of short ones.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from earshot.sources.snapshots import settle

BATCH_BYTES = 1 << 20
BATCH_ROWS = 1_000  # what a step makes of a text may be far larger than a short text


_RESIDENT: dict = {}


def resident(key, build: Callable):
    """What a Python worker keeps between tasks: the thing built for `key`, and nothing built for another."""
    if key not in _RESIDENT:
        _RESIDENT.clear()
        if key is not None:
            _RESIDENT[key] = build()
    return _RESIDENT.get(key)


def trim() -> None:
    """Give freed memory back to the system at the end of a task: the worker lives on, and allocators keep it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has this
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, of: int) -> Column:
    """crc32 of the key as text, modulo `of`; null for a null key, which is in no fold."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % of


def texts_in(batch: pa.RecordBatch, column: int, field: str | None = None) -> pa.Array:
    """The texts of a batch: a column, or a field of a struct column."""
    return batch.column(column) if field is None else batch.column(column).field(field)


def text_batches(batches: Iterator[pa.RecordBatch], column: int, max_bytes: int = BATCH_BYTES, field: str | None = None) -> Iterator[pa.RecordBatch]:
    """The rows of `batches` in slices whose texts (see `texts_in`) have about `max_bytes`, of BATCH_ROWS at most."""
    for batch in batches:
        texts = texts_in(batch, column, field)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes, dtype=np.int64) // max_bytes + np.arange(len(sizes)) // BATCH_ROWS
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


BROADCAST_ROWS = 2_000_000  # of a key or a digest: some 100 to 300 MB as a hashed relation


def counted(keys: DataFrame) -> DataFrame:
    """`keys` (a written table of short rows), to be broadcast if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def small_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Hand rows to Python in Arrow batches of at most `rows`: a batch is held whole on both sides, and texts are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def text_keys(doc_id: str, text: str) -> dict[str, Column]:
    """What names a text where a decision about it is taken: the key of its row, and a hash of the text, as keys may repeat or be null."""
    return {"_key": F.col(doc_id), "_told": F.xxhash64(F.col(text))}


def without_texts(docs: DataFrame, dropped: DataFrame, *, doc_id: str, text: str) -> DataFrame:
    """The rows of `docs` but those named in `dropped` (the columns of `text_keys`), with all their columns. Documents
    neither travel to Python nor are shuffled for it, unless there are very many to drop."""
    dropped = counted(settle(dropped.select("_key", "_told").distinct(), "dropped"))
    same = docs[doc_id].eqNullSafe(dropped["_key"]) & (F.xxhash64(docs[text]) == dropped["_told"])
    return docs.join(dropped, same, "left_anti")


def whole_rows(docs: DataFrame) -> Column:
    """All columns of `docs` as one struct, so that no name can clash with a new column."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def as_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def as_texts(texts: pa.Array) -> list[str]:
    """Each text; null counts as empty, bytes that are not UTF-8 become the replacement character."""
    return [t.decode("utf-8", "replace") for t in as_bytes(texts)]


def map_texts(
    df: DataFrame, keys: dict[str, str | Column], text: str | Column, make: Callable[[], Callable], schema: str, max_bytes: int = BATCH_BYTES, inside: str | None = None
) -> DataFrame:
    """One row per row of `df`: the key columns, then what a Python step makes of the text.

    `make()` runs once per task and returns the step, which takes the Arrow array of texts and returns the
    arrays of the columns named in `schema`. Only keys and text travel to Python, whatever else `df` holds.
    `inside` names a key that is a struct and holds the text as its field `text`; then it travels once.
    """
    column = lambda c: F.col(c) if isinstance(c, str) else c
    kept = df.select(*[column(c).alias(k) for k, c in keys.items()], *([] if inside else [column(text).alias("__text")]))
    width = len(keys)
    fields = kept.schema.fields[:width]
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    at, field = ([f.name for f in fields].index(inside), text) if inside else (width, None)

    def run(batches):
        step = make()
        for batch in text_batches(batches, at, max_bytes, field):
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *step(texts_in(batch, at, field))], names=names)
        trim()

    out = f"{head}, {schema}" if head else schema
    names = [f.name for f in fields] + StructType.fromDDL(schema).names
    return kept.mapInArrow(run, out)


def discard(*tables: DataFrame) -> None:
    """Delete written stages that nothing will read again (each from `settle`, in a folder of its own)."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
