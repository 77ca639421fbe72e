"""Packing into length buckets that waste least padding.

The histogram of lengths of the whole table decides the buckets: dynamic programming over its distinct lengths
finds the `buckets` boundaries whose total padding (every document filled up to the boundary of its bucket) is
least. Documents of one bucket then form batches of at most `token_budget` padded tokens, in order of length and
key, so a batch is `floor(budget / boundary)` neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.sources.snapshots import settle


def best_boundaries(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """The at most `buckets` boundaries with the least total padding; the last is the greatest length.

    histogram: (length, documents). With lengths sorted, a bucket over lengths i+1..j costs
    length[j] * (C[j] - C[i]) - (S[j] - S[i]), C and S the running counts and tokens. For a fixed number of
    buckets the best start of the last one is the lowest of lines in length[j] with slope -C[i], so each round is
    one pass with a convex hull (exact integers). Ties go to the earlier start; a bucket that saves nothing is
    left out.
    """
    lengths = sorted(dict(histogram))
    count = dict(histogram)
    if not lengths:
        return []
    c, s = [0], [0]
    for x in lengths:
        c.append(c[-1] + count[x])
        s.append(s[-1] + count[x] * x)
    n = len(lengths)
    cost = [None] + [lengths[j - 1] * c[j] - s[j] for j in range(1, n + 1)]  # one bucket
    starts = [[0] * (n + 1)]
    best = (cost[n], 1)
    for k in range(2, min(buckets, n) + 1):
        hull: list[tuple[int, int, int]] = []  # slope, intercept, start
        after, start, at = [None] * (n + 1), [0] * (n + 1), 0
        for j in range(1, n + 1):
            i = j - 1
            if cost[i] is not None:
                line = (-c[i], cost[i] + s[i], i)
                while len(hull) > 1 and _hides(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
            if not hull:
                continue
            at = min(at, len(hull) - 1)
            x = lengths[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] < hull[at][0] * x + hull[at][1]:
                at += 1
            m, b, i = hull[at]
            after[j], start[j] = m * x + b + x * c[j] - s[j], i
        cost = after
        starts.append(start)
        if cost[n] < best[0]:
            best = (cost[n], k)
    out, j = [], n
    for k in range(best[1], 0, -1):
        out.append(lengths[j - 1])
        j = starts[k - 1][j]
    return out[::-1]


def _hides(a, b, c) -> bool:
    """Whether line b is nowhere below both a and c (slopes fall from a to c)."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def pack(lengths: DataFrame, *, doc_id: str = "doc_id", n_tokens: str = "n_tokens", buckets: int = 16, token_budget: int = 65_536) -> DataFrame:
    """The bucket and batch of every row of `lengths`.

    One row per row, repeated ones too: doc_id, n_tokens (null counts as 0), bucket (0 is the shortest),
    bucket_len (its boundary), batch_id (dense from 0 in order of bucket, length, key), slot (place in the batch),
    batch_docs, batch_tokens (real tokens), padding (padded minus real tokens of the row). A batch holds at most
    `token_budget` padded tokens, or one document if that alone is longer. Null keys come first in their length.
    An empty table gives no rows.

    The histogram goes to the driver: one row per distinct length, however many documents there are. Sorted rows
    are written once; their place in the written order gives ranks without a global window.
    """
    rows = lengths.select(F.col(doc_id).alias("doc_id"), F.greatest(F.coalesce(F.col(n_tokens).cast("long"), F.lit(0)), F.lit(0)).alias("n_tokens"))
    order = [F.col("n_tokens"), F.col("doc_id").asc_nulls_first(), F.col("met")]
    met = rows.withColumn("met", F.monotonically_increasing_id())
    placed = met.repartitionByRange(*order).sortWithinPartitions(*order).drop("met").withColumn("at", F.monotonically_increasing_id())
    placed = settle(placed.withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1)), "placed")

    histogram = {r.n_tokens: r.n for r in placed.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()}
    bounds = best_boundaries(list(histogram.items()), buckets) or [0]
    table, low, first_row, first_batch = [], -1, 0, 0
    for b, bound in enumerate(bounds):
        docs = sum(n for x, n in histogram.items() if low < x <= bound)
        size = max(1, token_budget // max(1, bound))
        table.append((b, bound, first_row, size, first_batch))
        low, first_row, first_batch = bound, first_row + docs, first_batch - (-docs // size)
    per_part = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row per write task
    before = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    ranked = placed.join(F.broadcast(before), "part").withColumn("rank", F.col("before") + F.col("at"))
    bucket = sum(((F.col("n_tokens") > b).cast("int") for b in bounds[:-1]), F.lit(0))
    return _batched(ranked.withColumn("bucket", bucket).join(F.broadcast(_bucket_table(placed, table)), "bucket"))


def _bucket_table(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """One row per bucket: at most the `buckets` asked for."""
    return df.sparkSession.createDataFrame(rows, "bucket int, bucket_len long, first_row long, size long, first_batch long")


def _batched(rows: DataFrame) -> DataFrame:
    in_bucket = F.col("rank") - F.col("first_row")
    slot = F.pmod(in_bucket, F.col("size"))
    rows = rows.withColumn("batch_id", F.col("first_batch") + ((in_bucket - slot) / F.col("size")).cast("long")).withColumn("slot", slot)
    whole = Window.partitionBy("batch_id")  # at most token_budget rows
    return rows.select(
        "doc_id", "n_tokens", "bucket", "bucket_len", "batch_id", "slot",
        F.count(F.lit(1)).over(whole).alias("batch_docs"),
        F.sum("n_tokens").over(whole).alias("batch_tokens"),
        (F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
    )
