"""Small relational building blocks named in the inventory (AG-7, SL-1, PF-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """AG-7: the distinct values of one column (hash aggregate; order only at the sink)."""
    return df.select(col).distinct()


def ordered(df: DataFrame, *cols: str) -> DataFrame:
    """SL-1: ordered listing for a sink (a range-partitioned global sort)."""
    return df.orderBy(*cols)


def exclude_regex(df: DataFrame, col: str, regex: str) -> DataFrame:
    """PF-6: drop rows whose column matches the pattern (find semantics, as grep -E)."""
    return df.filter(~F.coalesce(F.col(col).rlike(regex), F.lit(False)))
