"""Panel reducers per series over the displayed range (AG-13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reduce_series(df: DataFrame, keys: Sequence[str], calcs: Sequence[str],
                  time_col: str = "t", value_col: str = "value") -> DataFrame:
    """``lastNotNull`` / ``last`` / ``first`` / ``mean`` / ``max`` / ``min`` / ``sum`` / ``count``
    per series. One aggregation, partial (map-side) combine."""
    v, t = F.col(value_col), F.col(time_col)
    nn = df.filter(v.isNotNull())
    out = {
        "lastNotNull": F.max_by(v, t).alias("last"),
        "firstNotNull": F.min_by(v, t).alias("first"),
        "mean": F.avg(v).alias("mean"),
        "max": F.max(v).alias("max"),
        "min": F.min(v).alias("min"),
        "sum": F.sum(v).alias("sum"),
        "count": F.count(v).alias("count"),
    }
    aggs = [out[c] for c in calcs] + [F.max(t).alias(f"last_{time_col}")]
    return nn.groupBy(*keys).agg(*aggs)
