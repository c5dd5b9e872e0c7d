"""Span operators (PF-9, DD-1, DD-2, DD-3).

``spans`` columns: trace_id, span_id, parent_id, name, kind, start_ns, end_ns,
status_code, status_message, attrs MAP, res MAP.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.plan import left_join_keyed
from ..functions.time import duration_ns

# Span intrinsics that are not OTLP attributes.
INTRINSICS = ["kind", "status", "duration", "name", "rootName", "rootServiceName", "traceID", "spanID", "http.url"]

# Intrinsics that are columns; rootName and rootServiceName are there after ``root_attributes``.
_PLAIN = {"name": "name", "traceID": "trace_id", "spanID": "span_id", "rootName": "rootName",
          "rootServiceName": "rootServiceName"}
_KIND = {"unspecified": 0, "internal": 1, "server": 2, "client": 3, "producer": 4, "consumer": 5}
_STATUS = {"unset": 0, "ok": 1, "error": 2}


def duration(spans: DataFrame) -> Column:
    return F.col("end_ns") - F.col("start_ns")


def span_pred(field: str, op: str, value) -> Column:
    """One TraceQL-like predicate: ``span.x``, ``resource.x``, or an intrinsic."""
    if field.startswith("span."):
        c = F.col("attrs")[field[5:]]
    elif field.startswith("resource."):
        c = F.col("res")[field[9:]]
    elif field == "duration":
        c, value = F.col("end_ns") - F.col("start_ns"), duration_ns(value)
    elif field == "kind":
        c, value = F.col("kind"), _KIND.get(value, value)
    elif field == "status":
        c, value = F.col("status_code"), _STATUS.get(value, value)
    elif field in _PLAIN:
        c = F.col(_PLAIN[field])
    else:
        raise ValueError(f"unknown span field {field}")
    if op == "=":
        return c == F.lit(value)
    if op == "!=":
        return c != F.lit(value)
    if op == "=~":
        return c.rlike(f"^(?:{value})$")
    if op == ">":
        return c > F.lit(value)
    if op == ">=":
        return c >= F.lit(value)
    if op == "<":
        return c < F.lit(value)
    if op == "<=":
        return c <= F.lit(value)
    raise ValueError(op)


def select_spans(spans: DataFrame, preds: Iterable[tuple[str, str, object]]) -> DataFrame:
    """PF-9: conjunction of predicates (filters run on the scan's output, no shuffle)."""
    cond = F.lit(True)
    for f, op, v in preds:
        cond = cond & span_pred(f, op, v)
    return spans.filter(cond)


def root_attributes(spans: DataFrame) -> DataFrame:
    """DD-3: attach rootName / rootServiceName to every span of a trace.

    Root spans only (a filter) reduced to one row per trace (the earliest root if a trace
    has several), joined back on trace_id; a skewed trace is split by AQE's skew-join
    handling, which a window over trace_id could not do. Traces without root get NULL."""
    roots = (spans.filter(F.col("parent_id").isNull())
             .groupBy("trace_id")
             .agg(F.min_by(F.struct(F.col("name").alias("rootName"),
                                    F.col("res")["service.name"].alias("rootServiceName")),
                           F.struct("start_ns", "span_id")).alias("r"))
             .select("trace_id", "r.rootName", "r.rootServiceName"))
    return left_join_keyed(spans, roots, ["trace_id"])


def logs_with_spans(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """DD-1: log records joined to their span on (trace_id, span_id); logs without ids kept.

    Most log records carry no trace id; the join spreads them over all partitions."""
    s = spans.select("trace_id", "span_id", F.col("name").alias("span_name"),
                     (F.col("end_ns") - F.col("start_ns")).alias("span_duration_ns"),
                     F.col("status_code").alias("span_status"))
    return left_join_keyed(logs, s, ["trace_id", "span_id"])


def exemplar_spans(exemplars: DataFrame, spans: DataFrame) -> DataFrame:
    """DD-2: exemplar (trace_id, span_id, value) -> the span it points at."""
    s = spans.select("trace_id", "span_id", "name", (F.col("end_ns") - F.col("start_ns")).alias("duration_ns"))
    return left_join_keyed(exemplars, s, ["trace_id", "span_id"])


def count_traces(spans: DataFrame) -> DataFrame:
    return spans.agg(F.countDistinct("trace_id").alias("n_traces"))
