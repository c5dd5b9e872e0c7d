"""Log operators (PF-10, PF-11, AG-11, AG-15, SL-2, SL-4, DD-4).

``logs`` columns: ts_ns, ts, severity_number, severity_text, body, attrs MAP, res MAP,
trace_id, span_id (plus an optional record id used as a tie-breaker).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import Grid, duration_ns, floor_div
from .promql import NS, _explode_to_grid

# How OTLP log fields become stream labels.
LOG_LABEL_SOURCE = {
    "service_name": "resource:service.name",
    "log_type": "attribute:log_type",
    "detected_level": "builtin:severityText",
    "logger": "attribute:logger",
}


def _source_expr(source: str) -> Column:
    scope, _, key = source.partition(":")
    if scope == "resource":
        return F.col("res")[key]
    if scope == "attribute":
        return F.col("attrs")[key]
    if scope == "builtin":
        return {"severityText": F.col("severity_text"), "body": F.col("body"),
                "traceId": F.col("trace_id"), "spanId": F.col("span_id")}[key]
    raise ValueError(source)


def log_labels(logs: DataFrame, mapping: dict[str, str] = LOG_LABEL_SOURCE) -> DataFrame:
    """PF-10: add ``stream`` MAP (absent sources dropped) and ``stream_id`` (canonical JSON)."""
    kv = [x for k, src in mapping.items() for x in (F.lit(k), _source_expr(src))]
    stream = F.map_filter(F.create_map(*kv), lambda k, v: v.isNotNull())
    return (logs.withColumn("stream", stream)
            .withColumn("stream_id", F.to_json(F.array_sort(F.map_entries(F.col("stream"))))))


def any_non_empty(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PF-11: one row, one BOOLEAN per field: is it non-empty in any record."""
    return df.agg(*[F.coalesce(F.bool_or(F.col(c).isNotNull() & (F.col(c).cast("string") != "")),
                               F.lit(False)).alias(f"has_{c}") for c in cols])


def first_non_empty(df: DataFrame, col: str) -> DataFrame:
    """SL-4: deterministic 'first' non-empty value: the smallest one."""
    return df.filter(F.col(col).isNotNull() & (F.col(col) != "")).agg(F.min(col).alias(f"first_{col}"))


def newest(df: DataFrame, n: int, ts: str = "ts_ns", tie: str | None = None) -> DataFrame:
    """SL-2: newest ``n`` rows (a top-n; Catalyst plans TakeOrderedAndProject)."""
    order = [F.col(ts).desc()] + ([F.col(tie).desc()] if tie else [])
    return df.orderBy(*order).limit(n)


def window_counts(df: DataFrame, keys: Sequence[str], grid: Grid, range_: str | int,
                  ts: str = "ts_ns") -> DataFrame:
    """AG-11 core: per key and grid point, number of records in ``[t - range, t)``.

    Counts per (key, bucket) first (partial aggregation, bounded by the grid), then each
    bucket count is attached to the grid points whose window covers it."""
    r = duration_ns(range_)
    g = math.gcd(grid.step_ns, r)
    x = df.filter((F.col(ts) >= F.lit(grid.start_ns - r)) & (F.col(ts) < F.lit(grid.end_ns)))
    x = x.withColumn("b", floor_div(F.col(ts) - F.lit(grid.start_ns), g))
    per = x.groupBy(*keys, "b").agg(F.count(F.lit(1)).alias("n"))
    ex = _explode_to_grid(per, grid, r, g)
    return (ex.groupBy(*keys, "j").agg(F.sum("n").alias("n"))
            .withColumn("t", (grid.t_ns(F.col("j")) / F.lit(NS)).cast("bigint")))


def log_count(logs: DataFrame, grid: Grid, range_: str | int, by: Sequence[str]) -> DataFrame:
    """``sum by (labels) (count_over_time({...}[range]))``."""
    x = logs.select(*[F.col("stream")[k].alias(k) for k in by], "ts_ns")
    return window_counts(x, by, grid, range_).withColumn("value", F.col("n").cast("double"))


def log_rate(logs: DataFrame, grid: Grid, range_: str | int, by: Sequence[str]) -> DataFrame:
    """``sum by (labels) (rate({...}[range]))`` = count / range seconds."""
    secs = duration_ns(range_) / NS
    return log_count(logs, grid, range_, by).withColumn("value", F.col("n") / F.lit(float(secs)))


def count_streams(logs: DataFrame) -> DataFrame:
    """AG-15: number of distinct streams and of distinct traces."""
    return logs.agg(F.countDistinct("stream_id").alias("n_streams"),
                    F.countDistinct("trace_id").alias("n_traces"))


def json_fields(df: DataFrame, body: str, schema: str) -> DataFrame:
    """DD-4: typed fields from JSON text bodies (unparsable -> NULL fields)."""
    return df.withColumn("fields", F.from_json(F.col(body), schema, {"mode": "PERMISSIVE"}))
