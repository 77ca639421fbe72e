"""Next and previous row over data of any size and skew.

A plain LEAD over all plays sorts everything in one task, and a LAG per track sorts a
hot track in one task. Here a group that was measured to be too large for a task is cut
into pieces of an hour or of one second (which holds at most a million distinct
microseconds), and the edge of the neighbouring piece is carried over: pieces within a
day, then days.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.functions.times import DAY, HOUR, SECOND
from earshot.operators.skew import small
from earshot.sources.snapshots import settle

ROWS_PER_PIECE = 1_000_000


def cell(value: str | Column, width: int) -> Column:
    """floor(value / width) in whole numbers."""
    value = F.col(value) if isinstance(value, str) else value
    wide = F.lit(width).cast("bigint")
    return F.call_function("div", value - F.pmod(value, wide), wide)


def above(sizes: DataFrame, count: str, limit: int = ROWS_PER_PIECE) -> DataFrame | None:
    """The groups of `sizes` with more than `limit` rows, or None if there are none. Of N
    rows at most N / limit groups are so heavy; they are written, so that their size is known
    when they are joined."""
    heavy = sizes.filter(F.col(count) > limit).drop(count)
    return None if heavy.isEmpty() else settle(heavy, "heavy")


def grains(df: DataFrame, by: list[str], us: str, heavy: DataFrame | None, limit: int = ROWS_PER_PIECE) -> DataFrame | None:
    """For heavy groups the seconds per piece: an hour if each of its hours is small enough,
    else one second."""
    if heavy is None:
        return None
    inside = df.join(small(heavy), by).groupBy(*by, cell(us, HOUR).alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return settle(inside.groupBy(*by).agg(F.when(F.max("n") > limit, 1).otherwise(HOUR // SECOND).alias("grain")), "grains")


def hour_sizes(us: DataFrame) -> DataFrame:
    """(hour, n) of a frame with microseconds `us`."""
    return us.groupBy(cell("us", HOUR).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def neighbour_in_group(
    df: DataFrame, by: list[str], us: str, payload: list[str], heavy: DataFrame | None, ahead: bool = True
) -> DataFrame:
    """Add near_<us> and near_<payload> of the next (or previous) row of the same group,
    null at its end. (us, *payload) is unique within a group and is its order; `heavy`
    lists the groups to cut, with their grain."""
    order = [us, *payload]
    if heavy is None:
        return df.withColumns(_near(order, W.partitionBy(*by).orderBy(*_way(order, ahead))))
    cut = df.join(small(heavy), by, "left").withColumn("_piece", cell(us, SECOND) - F.pmod(cell(us, SECOND), F.col("grain")))
    edges = _edges(cut.filter(F.col("grain").isNotNull()), by, order, ahead)
    return _with_carry(cut.drop("grain"), by, order, ahead, _carry_by_day(edges, by, ahead))


def neighbour(
    df: DataFrame, us: str, payload: list[str], heavy: DataFrame | None, ahead: bool = True, outline: DataFrame | None = None
) -> DataFrame:
    """The same over all rows. They are cut by the hour, and the hours of `heavy` by the
    second. `outline` may be a frame that is cheaper to read than `df` and has the same
    first (or last) row in every piece."""
    order = [us, *payload]
    outline = (df if outline is None else outline).select(*order)
    hour = cell(us, HOUR)
    if heavy is None:
        piece = hour * (HOUR // SECOND)
        edges = _edges(outline.withColumn("_piece", piece), [], order, ahead)  # one row per hour: a century is 876,600 rows
        carry = edges.select("_piece", F.lead("_edge").over(W.orderBy(*_way(["_piece"], ahead))).alias("_carry"))
        return _with_carry(df.withColumn("_piece", piece), [], order, ahead, carry)
    heavy = small(heavy.select("hour", F.lit(True).alias("_heavy")))

    def pieces(rows):
        marked = rows.withColumn("hour", hour).join(heavy, "hour", "left")
        piece = F.when(F.col("_heavy"), cell(us, SECOND)).otherwise(F.col("hour") * (HOUR // SECOND))
        return marked.withColumn("_piece", piece).drop("_heavy", "hour")

    carry = _carry_by_day(_edges(pieces(outline), [], order, ahead), [], ahead)
    return _with_carry(pieces(df), [], order, ahead, carry)


def _way(names: list[str], ahead: bool) -> list[Column]:
    return [F.col(n).asc() if ahead else F.col(n).desc() for n in names]


def _near(order: list[str], window) -> dict[str, Column]:
    return {f"near_{n}": F.lead(n).over(window) for n in order}


def _edges(cut: DataFrame, by: list[str], order: list[str], ahead: bool) -> DataFrame:
    pick = F.min if ahead else F.max
    edge = pick(F.struct(*order)) if len(order) > 1 else F.struct(pick(order[0]).alias(order[0]))
    return cut.groupBy(*by, "_piece").agg(edge.alias("_edge"))


def _with_carry(cut: DataFrame, by: list[str], order: list[str], ahead: bool, carry: DataFrame) -> DataFrame:
    inside = cut.withColumns(_near(order, W.partitionBy(*by, "_piece").orderBy(*_way(order, ahead))))
    joined = inside.join(carry, [*by, "_piece"], "left")
    last = F.col(f"near_{order[0]}").isNull()  # of its piece
    near = {f"near_{n}": F.when(last, F.col(f"_carry.{n}")).otherwise(F.col(f"near_{n}")) for n in order}
    return joined.withColumns(near).drop("_carry", "_piece")


def _carry_by_day(edges: DataFrame, by: list[str], ahead: bool) -> DataFrame:
    """For every piece the edge of the next one: within its day, else of the next day. A day
    has at most 86,400 pieces and a century 36,525 days. The edges are read twice, hence
    written first."""
    dated = settle(edges.withColumn("_day", cell("_piece", DAY // SECOND)), "edges")
    within = dated.withColumn("_in_day", F.lead("_edge").over(W.partitionBy(*by, "_day").orderBy(*_way(["_piece"], ahead))))
    head = (F.min("_edge") if ahead else F.max("_edge")).alias("_head")
    days = dated.groupBy(*by, "_day").agg(head)
    days = days.withColumn("_next_day", F.lead("_head").over(W.partitionBy(*by).orderBy(*_way(["_day"], ahead))))
    return within.join(days, [*by, "_day"]).select(*by, "_piece", F.coalesce("_in_day", "_next_day").alias("_carry"))


def number_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, first_id, n): the 1-based row numbers first_id .. first_id + n - 1 that rows
    with these keys take in the global order by `keys`.

    Equal rows are counted first, so no run of equal keys can fill a partition. The sorted
    rows are written once with their partition and position, which fixes both; the count
    per partition then gives every partition its offset.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    placed = settle(counted.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))  # the upper bits hold the partition
    sizes = placed.groupBy("_part").agg(F.sum("n").alias("_n"))  # one row per partition
    offsets = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_offset"))
    before = F.sum("n").over(W.partitionBy("_part").orderBy("_at")) - F.col("n")
    numbered = placed.withColumn("_before", before).join(F.broadcast(offsets), "_part")
    return numbered.select(*keys, (F.col("_offset") + F.col("_before") + 1).alias("first_id"), "n")


def positions(df: DataFrame, group: list[str], order: list[Column], name: str = "position") -> DataFrame:
    """`df` with the 1-based place of each row in its group by `order`, which must tell the
    rows of a group apart.

    Rows are range-partitioned and sorted, so a group of any size is spread over tasks; the
    written order fixes each row's place in its partition, and a count per partition and
    group (no more rows than partitions and groups together) gives the places before it.
    """
    keys = [*[F.col(g).asc_nulls_first() for g in group], *order]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = settle(placed.withColumn("_part", F.shiftright("_at", 33)), "placed")  # the upper bits hold the partition
    found = placed.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*group).orderBy("_part")) - F.col("_n")
    offsets = found.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_part").alias("_p"), (before - F.col("_first")).alias("_offset"))
    same = [placed[g].eqNullSafe(offsets[f"_g_{g}"]) for g in group]
    joined = placed.join(offsets, reduce(and_, same, placed["_part"] == offsets["_p"]))
    return joined.select(*df.columns, (F.col("_at") + F.col("_offset") + 1).alias(name))
