"""Rounding as the dashboards expect it: on decimals, never on doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(30,10)"


def half_up(x: Column, places: int = 1) -> Column:
    return F.round(x, places).cast("double")


def half_even(x: Column, places: int = 1) -> Column:
    return F.bround(x, places).cast("double")


def ratio(a: Column, b: Column) -> Column:
    """a / b as a decimal."""
    return (a.cast("decimal(20,0)") / b.cast("decimal(20,0)")).cast(EXACT)


def percent(a: Column, b: Column) -> Column:
    return ((a.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")) / b.cast("decimal(20,0)")).cast(EXACT)
