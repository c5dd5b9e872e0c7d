"""Series operators on ``samples`` (PF-1/2/8, WN-3/4, AG-1..5/12, SL-3).

``samples`` columns: metric, labels MAP<STRING,STRING>, series_id, ts_ns BIGINT, value DOUBLE
(plus optional kind/unit/ts). Results of vector operators carry ``j`` (grid index) and
``t`` (epoch seconds of the grid point).

Scale notes
-----------
* Nothing is partitioned by a bare series: a hot series would land on one task. Ordered
  work (counter deltas) is partitioned by ``(series_id, bucket)`` where ``bucket`` is a
  fixed slice of time, so one series spreads over as many tasks as it has buckets.
* Range functions are differences of a running total at the two ends of each window
  (``operators/ranges.py``): rows are bounded by the grid, not by the samples, and do not depend on
  range / step. There is no cross join with the grid.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import label, matchers
from ..functions.time import Grid, duration_ns, floor_div
from .ranges import NS, counter_windows

_SERIES = "struct<metric:string,labels:array<struct<key:string,value:string>>>"


def decode_series(df: DataFrame) -> DataFrame:
    """metric and labels back from the canonical ``series_id`` (a projection, no join).

    The ordered and aggregated stages carry only ``series_id`` and numbers: aggregates over
    strings or maps cannot use hash aggregation, and the label maps would ride every shuffle."""
    p = F.from_json(F.col("series_id"), _SERIES)
    return df.withColumn("metric", p["metric"]).withColumn("labels", F.map_from_entries(p["labels"]))


# ---------------------------------------------------------------- selection (PF-1/2/8)

def select_series(samples: DataFrame, metric: str | None = None,
                  label_matchers: Iterable[tuple[str, str, str]] = (),
                  metric_regex: str | None = None) -> DataFrame:
    """PF-1: ``metric{k="v", k2=~"re"}``. Absent labels compare as ''."""
    cond = matchers("labels", label_matchers)
    if metric is not None:
        cond = cond & (F.col("metric") == metric)
    if metric_regex is not None:
        cond = cond & F.col("metric").rlike(f"^(?:{metric_regex})$")
    return samples.filter(cond)


_CMP = {
    "==": lambda c, x: c == x, "!=": lambda c, x: c != x, ">": lambda c, x: c > x,
    ">=": lambda c, x: c >= x, "<": lambda c, x: c < x, "<=": lambda c, x: c <= x,
}


def where_value(df: DataFrame, op: str, x: float, col: str = "value") -> DataFrame:
    """PF-2: comparison that drops rows (``v > 0``)."""
    return df.filter(_CMP[op](F.col(col), F.lit(x)))


def time_range(df: DataFrame, start_ns: int, end_ns: int, col: str = "ts_ns") -> DataFrame:
    """PF-8: half-open ``[start, end)`` on epoch ns (pushes to the scan as a range)."""
    return df.filter((F.col(col) >= F.lit(start_ns)) & (F.col(col) < F.lit(end_ns)))


# ---------------------------------------------------------------- points

def dedup_points(samples: DataFrame) -> DataFrame:
    """Points are unique per (series_id, ts_ns); duplicates keep the larger value."""
    return decode_series(samples.groupBy("series_id", "ts_ns").agg(F.max("value").alias("value")))


def _with_bucket(df: DataFrame, origin_ns: int, size_ns: int, ts: str = "ts_ns") -> DataFrame:
    return df.withColumn("b", floor_div(F.col(ts) - F.lit(origin_ns), size_ns))


def _delta(v: Column, prev: Column) -> Column:
    """Counter increment with reset: v - prev if v >= prev else v; first point -> 0."""
    return (F.when(prev.isNull(), F.lit(0.0))
            .when(v >= prev, v - prev)
            .otherwise(v))


def _dedup_in_buckets(x: DataFrame) -> DataFrame:
    """Dedup (series_id, ts_ns) inside the (series_id, b) partitioning, so the ordered window
    and the bucket aggregate that follow need no further exchange."""
    return (x.select("series_id", "b", "ts_ns", "value").repartition("series_id", "b")
            .groupBy("series_id", "b", "ts_ns").agg(F.max("value").alias("value")))


def counter_inc(samples: DataFrame, chunk: str | int = "1d") -> DataFrame:
    """WN-4: per-sample counter increment (reset aware) over each series' full history.

    Ordered work runs per (series, time chunk); the first point of each chunk gets its
    predecessor from a chunk-level table (one row per occupied chunk) stitched with
    ``lag`` — so a hot series is split over its chunks.
    """
    size = duration_ns(chunk)
    x = _dedup_in_buckets(_with_bucket(samples, 0, size))
    w = Window.partitionBy("series_id", "b").orderBy("ts_ns")
    x = x.withColumn("prev_v", F.lag("value").over(w))
    chunks = (x.groupBy("series_id", "b")
              .agg(F.max_by("value", "ts_ns").alias("last_v")))
    wc = Window.partitionBy("series_id").orderBy("b")
    carry = chunks.select("series_id", "b", F.lag("last_v").over(wc).alias("carry_v"))
    out = x.join(carry, ["series_id", "b"], "left")
    prev = F.coalesce(F.col("prev_v"), F.col("carry_v"))
    return decode_series(out.select("series_id", "ts_ns", "value", _delta(F.col("value"), prev).alias("inc")))


def _explode_to_grid(df: DataFrame, grid: Grid, range_ns: int, g: int) -> DataFrame:
    """Attach every bucket row to the grid points j whose window [t-range, t) covers it."""
    m, k = grid.step_ns // g, range_ns // g
    jlo = F.greatest(floor_div(F.col("b") + F.lit(m), m), F.lit(0))
    jhi = F.least(floor_div(F.col("b") + F.lit(k), m), F.lit(grid.n_points - 1))
    return (df.filter(jlo <= jhi)
            .withColumn("j", F.explode(F.sequence(jlo, jhi))))


# ---------------------------------------------------------------- ranges (AG-4)

def rate(samples: DataFrame, grid: Grid, range_: str | int, temporality: str = "cumulative") -> DataFrame:
    """AG-4: increase / (last_ts - first_ts) seconds; < 2 samples or zero span -> no row.

    Delta samples (``temporality="delta"``) give what their running totals would give."""
    ends = counter_windows(samples, grid, range_, temporality)
    span = (F.col("last_ts") - F.col("first_ts")) / F.lit(float(NS))
    x = ends.filter((F.col("n") >= 2) & (F.col("last_ts") > F.col("first_ts")))
    return decode_series(x.select("series_id", "j", "t", (F.col("increase") / span).alias("value")))


def increase(samples: DataFrame, grid: Grid, range_: str | int, temporality: str = "cumulative") -> DataFrame:
    ends = counter_windows(samples, grid, range_, temporality)
    return decode_series(ends.filter(F.col("n") >= 2).select("series_id", "j", "t", F.col("increase").alias("value")))


# ---------------------------------------------------------------- instant vectors (WN-3)

def instant(samples: DataFrame, grid: Grid, lookback: str | int = "5m") -> DataFrame:
    """Newest sample in ``[t - lookback, t)`` per series and grid point; ties on ts_ns go
    to the larger value. Newest-per-step-bucket first (bounded by the grid), then each
    bucket's newest point is attached to the grid points within its lookback."""
    lb = duration_ns(lookback)
    x = samples.filter((F.col("ts_ns") >= F.lit(grid.start_ns - lb)) &
                       (F.col("ts_ns") < F.lit(grid.end_ns)))
    x = _dedup_in_buckets(_with_bucket(x, grid.start_ns, grid.step_ns))
    newest = x.groupBy("series_id", "b").agg(F.max("ts_ns").alias("sample_ts_ns"),
                                             F.max_by("value", "ts_ns").alias("value"))
    rel = F.col("sample_ts_ns") - F.lit(grid.start_ns)
    jlo = F.greatest(floor_div(rel, grid.step_ns) + F.lit(1), F.lit(0))
    jhi = F.least(floor_div(rel + F.lit(lb), grid.step_ns), F.lit(grid.n_points - 1))
    ex = newest.filter(jlo <= jhi).withColumn("j", F.explode(F.sequence(jlo, jhi)))
    res = ex.groupBy("series_id", "j").agg(F.max_by("value", "sample_ts_ns").alias("value"),
                                           F.max("sample_ts_ns").alias("sample_ts_ns"))
    res = res.select("series_id", "j", (grid.t_ns(F.col("j")) / F.lit(NS)).cast("bigint").alias("t"),
                     "sample_ts_ns", "value")
    return decode_series(res)


# ---------------------------------------------------------------- aggregation (AG-1/2/3/5/12)

def _by_cols(by: Sequence[str]) -> list[Column]:
    return [F.col("metric").alias("__name__") if k == "__name__" else label("labels", k).alias(k)
            for k in by]


_AGG = {
    "sum": lambda: F.sum("value"),
    "avg": lambda: F.avg("value"),
    "max": lambda: F.max("value"),
    "min": lambda: F.min("value"),
    "count": lambda: F.count("value").cast("double"),
}


def agg_by(v: DataFrame, op: str, by: Sequence[str] = (), time_cols: Sequence[str] = ("j", "t")) -> DataFrame:
    """``op(v) by (labels)``: drops the metric name and every label not in ``by``."""
    keys = [F.col(c) for c in time_cols] + _by_cols(by)
    return v.groupBy(*keys).agg(_AGG[op]().alias("value"))


def count_distinct_label(v: DataFrame, key: str, time_cols: Sequence[str] = ("j", "t")) -> DataFrame:
    """AG-3 companion: number of distinct values of one label per grid point."""
    return v.groupBy(*time_cols).agg(F.countDistinct(label("labels", key)).cast("double").alias("value"))


# ---------------------------------------------------------------- top-k (SL-3)

def topk(v: DataFrame, k: int, by: Sequence[str] = (), time_col: str = "j") -> DataFrame:
    """Largest ``k`` series per grid point (and group); ties broken by series_id."""
    parts = [F.col(time_col)] + [label("labels", b) for b in by]
    w = Window.partitionBy(*parts).orderBy(F.col("value").desc(), F.col("series_id"))
    return v.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
