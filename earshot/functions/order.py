"""Sort keys that always say where nulls go.

The dashboards were written for a database that puts nulls last ascending and first
descending, the reverse of Spark; `asc` and `desc` spell that out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def asc(name: str | Column) -> Column:
    return F.col(name).asc_nulls_last() if isinstance(name, str) else name.asc_nulls_last()


def desc(name: str | Column) -> Column:
    return F.col(name).desc_nulls_first() if isinstance(name, str) else name.desc_nulls_first()
