"""Digests of ordered lists of any length.

A digest is fed in order, so a list has to pass one place; what passes it here are pieces of some kilobytes, joined
where the sorted rows lie. No list is ever one row, and none is held by a task.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_BYTES = 8 << 10  # a longer item is a piece of its own


def _rows(batches):
    """(schema, row) of every row, a row as a list of Python values."""
    for batch in batches:
        yield from ((batch.schema, list(row)) for row in zip(*[c.to_pylist() for c in batch.columns]))


def _table(rows: list, types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, t) for column, t in zip(zip(*rows), types)], names=names)


def ordered_digest(items: DataFrame, group: list[str], order: list[str], text: str, sep: str = "", algorithm: str = "sha256") -> DataFrame:
    """group, digest, n_items: for each group the hex digest of its texts in ascending order (nulls first), joined by `sep`.

    A null text counts as empty. Items that tie in `order` should have equal texts, else their order is open. Rows are
    range-partitioned by group and order, so a group that holds most rows is spread over tasks; each joins neighbours
    to pieces, and the pieces of a group then pass one digest in order. An empty table gives no rows.
    """
    rows = items.select(*group, *order, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    keys, width = [F.col(c).asc_nulls_first() for c in (*group, *order)], len(group)
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    glue, names = sep.encode(), [f.name for f in rows.schema]

    def pieces(batches):
        head, parts, size, types, done = None, [], 0, None, []
        for schema, row in chain(_rows(batches), [(None, None)]):
            if head is not None and (row is None or row[:width] != head[:width] or size + len(row[-1]) > PIECE_BYTES):
                done.append([*head, glue.join(parts), len(parts)])
                head, parts, size = None, [], 0
                if len(done) >= 1_000 or row is None:
                    yield _table(done, types, [*names, "_n"])
                    done = []
            if row is None:
                continue
            types = types or [*[f.type for f in schema], pa.int64()]
            head = row[:-1] if head is None else head
            parts.append(row[-1])
            size += len(row[-1]) + len(glue)

    cut = rows.mapInArrow(pieces, rows.withColumn("_n", F.lit(0).cast("long")).schema)
    cut = cut.repartition(*group).sortWithinPartitions(*keys)

    def digests(batches):
        at, types, done = None, None, []
        for schema, row in chain(_rows(batches), [(None, None)]):
            if at is not None and (row is None or row[:width] != at):
                done.append([*at, whole.hexdigest(), count])
                at = None
                if len(done) >= 10_000 or row is None:
                    yield _table(done, types, [*group, "digest", "n_items"])
                    done = []
            if row is None:
                continue
            types = types or [*[f.type for f in schema][:width], pa.string(), pa.int64()]
            if at is None:
                at, whole, count = row[:width], hashlib.new(algorithm), 0
            else:
                whole.update(glue)
            whole.update(row[-2])
            count += row[-1]

    return cut.mapInArrow(digests, cut.select(*group, F.lit("").alias("digest"), F.lit(0).cast("long").alias("n_items")).schema)
