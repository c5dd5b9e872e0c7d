"""Adapters: the telemetry data model on the driver's tables.

Each adapter is a projection of one or two driver tables, so its size grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import series_key
from ..functions.time import epoch_ns

# Histogram bucket bounds of the ``a_hist`` adapter.
HIST_BOUNDS = [1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0]


def a_samples(events: DataFrame, kind: str = "counter") -> DataFrame:
    """events -> samples: metric = event_type, labels = {user, pod = user % 8}."""
    labels = F.create_map(F.lit("user"), F.col("user_id").cast("string"),
                          F.lit("pod"), (F.col("user_id") % 8).cast("string"))
    return (events
            .select(F.col("event_type").alias("metric"),
                    F.lit(kind).alias("kind"),
                    labels.alias("labels"),
                    epoch_ns("ts").alias("ts_ns"),
                    F.col("ts").cast("timestamp").alias("ts"),
                    F.col("value").cast("double").alias("value"),
                    F.col("event_id"))
            .withColumn("series_id", series_key("metric", "labels")))


def a_hist(events: DataFrame, bounds=HIST_BOUNDS) -> DataFrame:
    """events -> daily delta histogram points per (event_type, pod): count, sum, min, max,
    counts ARRAY<BIGINT> (n+1 for n bounds), bounds ARRAY<DOUBLE>.

    Two aggregations; the second gathers at most len(bounds)+1 entries per point."""
    from ..functions.histograms import bucket_index

    day_ns = 86_400 * 1_000_000_000
    ts_ns = epoch_ns("ts")
    x = events.select(F.col("event_type").alias("metric"), (F.col("user_id") % 8).cast("string").alias("pod"),
                      ((ts_ns - F.pmod(ts_ns, F.lit(day_ns))) + F.lit(day_ns)).alias("ts_ns"),
                      F.col("value"), bucket_index(F.col("value"), bounds).alias("idx"))
    per = x.groupBy("metric", "pod", "ts_ns", "idx").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"), F.min("value").alias("mn"),
        F.max("value").alias("mx"))
    pts = per.groupBy("metric", "pod", "ts_ns").agg(
        F.sum("n").alias("count"), F.sum("s").alias("sum"), F.min("mn").alias("min"), F.max("mx").alias("max"),
        F.map_from_entries(F.collect_list(F.struct("idx", "n"))).alias("m"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(len(bounds))), lambda i: F.coalesce(F.col("m")[i], F.lit(0)))
    labels = F.create_map(F.lit("pod"), F.col("pod"))
    return (pts.select("metric", labels.alias("labels"), "pod", "ts_ns",
                       F.timestamp_micros((F.col("ts_ns") / F.lit(1000)).cast("bigint")).alias("ts"),
                       "count", "sum", "min", "max",
                       counts.cast("array<bigint>").alias("counts"),
                       F.array(*[F.lit(float(b)) for b in bounds]).alias("bounds"))
            .withColumn("series_id", series_key("metric", "labels")))


# Log severities (OTLP severity numbers and texts).
SEVERITY = {"ERROR": 17, "WARN": 13, "INFO": 9}


def a_logs(events: DataFrame) -> DataFrame:
    """events -> log records: service = user % 8, log_type = event_type,
    level ERROR for ``error``, WARN for ``signup``, else INFO; body = props (JSON text).
    ``purchase`` records carry the trace/span id of order ``event_id`` (see a_spans)."""
    level = (F.when(F.col("event_type") == "error", "ERROR")
             .when(F.col("event_type") == "signup", "WARN").otherwise("INFO"))
    sev = F.when(level == "ERROR", SEVERITY["ERROR"]).when(level == "WARN", SEVERITY["WARN"]).otherwise(SEVERITY["INFO"])
    tid = F.when(F.col("event_type") == "purchase", F.concat(F.lit("o"), F.col("event_id").cast("string")))
    return events.select(
        F.col("event_id").alias("log_id"),
        epoch_ns("ts").alias("ts_ns"),
        F.col("ts").cast("timestamp").alias("ts"),
        sev.cast("int").alias("severity_number"),
        level.alias("severity_text"),
        F.col("props").alias("body"),
        F.create_map(F.lit("log_type"), F.col("event_type"),
                     F.lit("logger"), F.concat(F.lit("app."), F.col("event_type"))).alias("attrs"),
        F.create_map(F.lit("service.name"), F.concat(F.lit("svc-"), (F.col("user_id") % 8).cast("string")),
                     F.lit("service.namespace"), F.lit("shop"),
                     F.lit("deployment.environment.name"), F.lit("dev")).alias("res"),
        tid.alias("trace_id"),
        tid.alias("span_id"))


def a_spans(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """orders -> root spans (trace = span = 'o' || o_orderkey); lineitem -> child spans of
    their order: start = order date + line number ms, duration = l_quantity x 10 ms,
    status 2 (error) when l_returnflag = 'R' else 1."""
    ms = 1_000_000
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
                      epoch_ns("o_orderdate").alias("o_start"))
    res_o = F.create_map(F.lit("service.name"), F.concat(F.lit("svc-"), (F.col("o_custkey") % 8).cast("string")),
                         F.lit("service.namespace"), F.lit("shop"),
                         F.lit("deployment.environment.name"), F.lit("dev"))
    roots = o.select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("trace_id"),
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("span_id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.lit("POST /orders").alias("name"),
        F.lit(2).alias("kind"),
        F.col("o_start").alias("start_ns"),
        (F.col("o_start") + (F.col("o_totalprice") * F.lit(ms)).cast("bigint")).alias("end_ns"),
        F.when(F.col("o_orderstatus") == "F", 2).otherwise(1).alias("status_code"),
        F.when(F.col("o_orderstatus") == "F", "failed").otherwise("").alias("status_message"),
        F.create_map(F.lit("http.request.method"), F.lit("POST"),
                     F.lit("http.route"), F.lit("/orders"),
                     F.lit("http.response.status_code"),
                     F.when(F.col("o_orderstatus") == "F", "500").otherwise("200"),
                     F.lit("priority"), F.col("o_orderpriority")).alias("attrs"),
        res_o.alias("res"))
    li = lineitem.join(o, lineitem.l_orderkey == o.o_orderkey, "inner")
    child_id = F.concat(F.lit("l"), F.col("l_orderkey").cast("string"), F.lit("."),
                        F.col("l_linenumber").cast("string"), F.lit("."),
                        F.xxhash64(*[F.col(c) for c in lineitem.columns]).cast("string"))
    start = F.col("o_start") + F.col("l_linenumber").cast("bigint") * F.lit(ms)
    children = li.select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("trace_id"),
        child_id.alias("span_id"),
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("parent_id"),
        F.lit("SELECT lineitem").alias("name"),
        F.lit(3).alias("kind"),
        start.alias("start_ns"),
        (start + (F.col("l_quantity") * F.lit(10 * ms)).cast("bigint")).alias("end_ns"),
        F.when(F.col("l_returnflag") == "R", 2).otherwise(1).alias("status_code"),
        F.when(F.col("l_returnflag") == "R", "returned").otherwise("").alias("status_message"),
        F.create_map(F.lit("db.system"), F.lit("postgresql"),
                     F.lit("db.name"), F.lit("shop"),
                     F.lit("db.statement"), F.lit("SELECT * FROM lineitem WHERE id = ?"),
                     F.lit("part"), F.col("l_partkey").cast("string")).alias("attrs"),
        res_o.alias("res"))
    return roots.unionByName(children)
