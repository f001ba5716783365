"""Date lists: union of the dates of several datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def all_dates(*dfs: DataFrame, col: str = "date") -> DataFrame:
    """UNION ALL of the date columns."""
    return reduce(lambda a, b: a.unionByName(b), [d.select(F.col(col).alias(col)) for d in dfs])


def distinct_dates(*dfs: DataFrame, col: str = "date", drop_nulls: bool = True,
                   ordered: bool = False) -> DataFrame:
    """UNION DISTINCT of the date columns (NULL dates dropped: they name no day).

    Each input is de-duplicated before the union's shuffle (partial
    aggregation), so the shuffle carries one row per date per task.
    ``ordered`` sorts the dates (one row each, so the sort is small).
    """
    u = all_dates(*dfs, col=col)
    if drop_nulls:
        u = u.filter(F.col(col).isNotNull())
    out = u.distinct()
    return out.orderBy(F.asc_nulls_last(col)) if ordered else out
