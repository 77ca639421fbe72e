"""Token ids in Parquet files that can be read in part.

One file row per document, in ascending document order across and inside the files: the key, the shard, the
offset of the first id inside the shard, the number of ids, the ids as a list column, and a struct of metadata.
Ids are dictionary-encoded (a vocabulary fits one dictionary, so an id takes as many bits as the vocabulary
needs) and fall back to delta encoding; metadata and ids are separate columns. Row groups and pages have set
sizes and the writer stores page indexes, so a filter on the key reads the pages that hold it and a reader of
metadata never touches ids.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from earshot.llm.common import as_bytes, text_batches, trim
from earshot.llm.word_encoder import encoder


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The same with `end_id` after each text."""
    if end_id is None:
        return ids, sizes
    return np.insert(ids, np.cumsum(sizes), end_id), sizes + 1


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    end_id: int | None,
    by_word: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
    meta: tuple[str, ...] = (),
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 2_000,
) -> None:
    """Encode every whole text and write the files to a new folder.

    by_word: the tokenizer may be applied as `WordEncoder` says. A null or empty text has no ids but `end_id` (None: none at all). Rows with a null key come first; rows of
    one key are ordered by a hash of the text and then as met, so repeated rows all stay and even a key that
    holds a third of all rows is spread over files. `meta` columns go into the struct `meta`, so their names
    cannot clash. An empty table gives files without rows.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.struct(F.lit(1).alias("v"), *meta).alias("meta"), F.monotonically_increasing_id().alias("met")
    )
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("met")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text", "meta")
    key = rows.schema["doc_id"].dataType.simpleString()
    about = rows.schema["meta"].dataType.simpleString()

    def run(batches):
        encode, shard, at = encoder(tokenizer, by_word), TaskContext.get().partitionId(), 0
        for batch in text_batches(batches, 1):
            ids, sizes = with_end(*encode.ids(as_bytes(batch.column(1))), end_id)
            ends = np.cumsum(sizes)
            tokens = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids, pa.int32()))
            shards = pa.array(np.full(len(sizes), shard), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), shards, pa.array(ends - sizes + at, pa.int64()), pa.array(sizes, pa.int64()), tokens, batch.column(2)],
                names=["doc_id", "shard", "shard_start", "n_tokens", "tokens", "meta"],
            )
            at += int(ends[-1])
        trim()

    encoded = rows.mapInArrow(run, f"doc_id {key}, shard int, shard_start long, n_tokens long, tokens array<int>, meta {about}")
    (
        encoded.write.mode("errorifexists").option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary", "true")
        .option("parquet.block.size", str(row_group_bytes)).option("parquet.page.size", str(page_bytes))
        .option("parquet.page.row.count.limit", str(page_rows)).option("parquet.columnindex.truncate.length", "64")
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a folder of token files; select and filter reach the scan."""
    return spark.read.parquet(path)


def shard_offsets(files: DataFrame) -> DataFrame:
    """Ids in all shards before each one. One row per written file, however many documents there are."""
    per_shard = files.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one task of short rows, a row per file
    return per_shard.select("shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))


def token_digests(files: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The offsets have one row per file, so their broadcast is bounded by the number of write tasks.
    """
    rows = files.select("doc_id", "shard", "shard_start", "n_tokens", "tokens")
    key = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            lists = batch.column(4)
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            crc = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(crc, pa.int64())], names=["doc_id", "shard", "shard_start", "n_tokens", "ids_crc32"])

    digests = rows.mapInArrow(run, f"doc_id {key}, shard int, shard_start long, n_tokens long, ids_crc32 long")
    placed = digests.join(F.broadcast(shard_offsets(files)), "shard", "left")
    return placed.select("doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")
