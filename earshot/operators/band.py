"""Aggregates over a numeric band around a value, without forming the pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.operators.ordered import cell


def band_aggregate(
    probes: DataFrame,
    points: DataFrame,
    keys: list[str],
    value: str,
    width: int,
    measures: dict[str, Column],
) -> DataFrame:
    """For each probe (keys, value): `measures` over points of equal keys within `width`.

    Both sides hold one row per (keys, value). A point is put into its bucket of `width`
    and both neighbours, a probe into its own, so a window partition holds at most
    3 * width points however common a key is, and no probe x point pair is ever a row.
    """
    bucket = cell(value, width)
    cells = points.withColumn("_cell", F.explode(F.array(bucket - 1, bucket, bucket + 1))).withColumn("_probe", F.lit(False))
    asked = probes.select(*keys, value).withColumn("_cell", bucket).withColumn("_probe", F.lit(True))
    near = W.partitionBy(*keys, "_cell").orderBy(value).rangeBetween(-width, width)
    return (
        cells.unionByName(asked, allowMissingColumns=True)
        .select(*keys, value, "_probe", *[m.over(near).alias(n) for n, m in measures.items()])
        .filter("_probe").drop("_probe")
    )
