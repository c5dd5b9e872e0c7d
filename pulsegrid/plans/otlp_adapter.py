"""OTLP adapter: driver tables encoded as OTLP-JSON export requests (one per row, so the
encoded table grows with the source table). Decoding them again exercises SRC-1..3.

The requests hold no higher-order functions and are emitted once (``with_columns_once``): under such
a function, or below ``from_json``, Spark interprets the whole tree of expressions a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.plan import with_columns_once
from ..functions.time import epoch_ns
from .adapters import HIST_BOUNDS

DAY_NS = 86_400 * 1_000_000_000

# How each event type is encoded (metric name, unit, instrument).
OTLP_METRICS = {
    "view": ("app.view.requests", "{request}", "counter"),
    "signup": ("app.signup.sessions", "1", "updown"),
    "purchase": ("app.purchase.size", "By", "gauge_double"),
    "error": ("app.error.latency", "ms", "gauge_int"),
    "click": ("app.click.duration", "s", "histogram"),
}


def kv(key: str, string: Column | None = None, integer: Column | None = None,
       boolean: Column | None = None) -> Column:
    null_s = F.lit(None).cast("string")
    return F.struct(F.lit(key).alias("key"),
                    F.struct((string if string is not None else null_s).alias("stringValue"),
                             (integer.cast("string") if integer is not None else null_s).alias("intValue"),
                             (boolean if boolean is not None else F.lit(None).cast("boolean")).alias("boolValue"))
                    .alias("value"))


def _resource(user: Column) -> Column:
    return F.struct(F.array(kv("service.name", F.concat(F.lit("svc-"), (user % 8).cast("string"))),
                            kv("service.instance.id", F.concat(F.lit("i-"), (user % 4).cast("string"))))
                    .alias("attributes"))


def _requests(df: DataFrame, req: Column) -> DataFrame:
    return with_columns_once(df, {"__json": F.to_json(req)}).select(F.col("__json").alias("json"))


def a_otlp_metrics(events: DataFrame) -> DataFrame:
    """events -> lines(json): one metric export request per event.

    Shapes: int attribute as string, bool attribute, duplicate attribute key (last wins),
    asInt as string (and an unparsable one), integer-written bounds, n+1 bucket counts,
    exemplars on some histogram points."""
    ts = epoch_ns("ts")
    u, et, eid = F.col("user_id"), F.col("event_type"), F.col("event_id")
    attrs = F.array(kv("pod", F.lit("x")), kv("user", integer=u), kv("pod", (u % 8).cast("string")),
                    kv("sampled", boolean=(u % 2 == 0)))
    attrs = F.when(eid % 50 == 0, attrs).otherwise(F.slice(attrs, 2, 3))
    start = (ts - F.pmod(ts, F.lit(DAY_NS))).cast("string")
    as_int = (F.when((et == "error") & (eid % 89 == 0), F.lit("n/a"))
              .otherwise(F.col("value").cast("bigint").cast("string")))
    num_point = F.struct(attrs.alias("attributes"), start.alias("startTimeUnixNano"),
                         ts.cast("string").alias("timeUnixNano"),
                         F.when(et.isin("signup", "error"), as_int).alias("asInt"),
                         F.when(~et.isin("signup", "error"), F.col("value")).alias("asDouble"))
    idx = sum((F.when(F.col("value") > float(b), 1).otherwise(0) for b in HIST_BOUNDS), F.lit(0))
    counts = F.array(*[F.when(idx == i, F.lit("1")).otherwise(F.lit("0")) for i in range(len(HIST_BOUNDS) + 1)])
    ex = F.when(eid % 3 == 0, F.array(F.struct(ts.cast("string").alias("timeUnixNano"),
                                               F.col("value").alias("asDouble"),
                                               F.concat(F.lit("o"), eid.cast("string")).alias("traceId"),
                                               F.concat(F.lit("o"), eid.cast("string")).alias("spanId"))))
    hist_point = F.struct(attrs.alias("attributes"), start.alias("startTimeUnixNano"),
                          ts.cast("string").alias("timeUnixNano"), F.lit("1").alias("count"),
                          F.col("value").alias("sum"), counts.alias("bucketCounts"),
                          F.array(*[F.lit(int(b)) for b in HIST_BOUNDS]).alias("explicitBounds"),
                          F.col("value").alias("min"), F.col("value").alias("max"), ex.alias("exemplars"))
    name = F.create_map(*[x for k, v in OTLP_METRICS.items() for x in (F.lit(k), F.lit(v[0]))])[et]
    unit = F.create_map(*[x for k, v in OTLP_METRICS.items() for x in (F.lit(k), F.lit(v[1]))])[et]
    metric = F.struct(
        name.alias("name"), unit.alias("unit"),
        F.when(et.isin("purchase", "error"), F.struct(F.array(num_point).alias("dataPoints"))).alias("gauge"),
        F.when(et.isin("view", "signup"),
               F.struct(F.array(num_point).alias("dataPoints"), F.lit(2).alias("aggregationTemporality"),
                        (et == "view").alias("isMonotonic"))).alias("sum"),
        F.when(et == "click", F.struct(F.array(hist_point).alias("dataPoints"),
                                       F.lit(2).alias("aggregationTemporality"))).alias("histogram"))
    req = F.struct(F.array(F.struct(
        _resource(u).alias("resource"),
        F.array(F.struct(F.struct(F.lit("app").alias("name"), F.lit("1.0").alias("version")).alias("scope"),
                         F.array(metric).alias("metrics"))).alias("scopeMetrics"))).alias("resourceMetrics"))
    return _requests(events, req)


def a_otlp_logs(events: DataFrame) -> DataFrame:
    """events -> one log export request per event (same fields as ``a_logs``)."""
    ts = epoch_ns("ts")
    u, et = F.col("user_id"), F.col("event_type")
    level = (F.when(et == "error", "ERROR").when(et == "signup", "WARN").otherwise("INFO"))
    sev = F.when(level == "ERROR", 17).when(level == "WARN", 13).otherwise(9)
    tid = F.when(et == "purchase", F.concat(F.lit("o"), F.col("event_id").cast("string"))).otherwise(F.lit(""))
    rec = F.struct(ts.cast("string").alias("timeUnixNano"), ts.cast("string").alias("observedTimeUnixNano"),
                   sev.alias("severityNumber"), level.alias("severityText"),
                   F.struct(F.col("props").alias("stringValue")).alias("body"),
                   F.array(kv("log_type", et), kv("logger", F.concat(F.lit("app."), et))).alias("attributes"),
                   tid.alias("traceId"), tid.alias("spanId"))
    req = F.struct(F.array(F.struct(
        _resource(u).alias("resource"),
        F.array(F.struct(F.struct(F.lit("app").alias("name")).alias("scope"),
                         F.array(rec).alias("logRecords"))).alias("scopeLogs"))).alias("resourceLogs"))
    return _requests(events, req)


def a_otlp_spans(spans: DataFrame) -> DataFrame:
    """spans (a_spans) -> one trace export request per span."""
    def entries(m):
        values = F.arrays_zip(F.map_values(m).alias("stringValue"))
        return F.arrays_zip(F.map_keys(m).alias("key"), values.alias("value"))
    attrs, res = entries("attrs"), entries("res")
    span = F.struct(F.col("trace_id").alias("traceId"), F.col("span_id").alias("spanId"),
                    F.coalesce(F.col("parent_id"), F.lit("")).alias("parentSpanId"), F.col("name").alias("name"),
                    F.col("kind").alias("kind"), F.col("start_ns").cast("string").alias("startTimeUnixNano"),
                    F.col("end_ns").cast("string").alias("endTimeUnixNano"), attrs.alias("attributes"),
                    F.struct(F.col("status_code").alias("code"), F.col("status_message").alias("message"))
                    .alias("status"))
    req = F.struct(F.array(F.struct(
        F.struct(res.alias("attributes")).alias("resource"),
        F.array(F.struct(F.struct(F.lit("app").alias("name")).alias("scope"),
                         F.array(span).alias("spans"))).alias("scopeSpans"))).alias("resourceSpans"))
    return _requests(spans, req)


# How each event type is rendered as a JMX bean line (see sources.jmx).
BEAN_SQL = """CASE event_type
  WHEN 'view' THEN 'kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec, clientId=c'
       || CAST(user_id % 4 AS STRING) || ', topic=orders-' || CAST(user_id % 5 AS STRING) || ', partition='
       || CASE WHEN user_id % 6 = 0 THEN '' ELSE CAST(user_id % 3 AS STRING) END || '>Value: ' || CAST(value AS STRING)
  WHEN 'click' THEN 'kafka.server<type=ReplicaManager, name=UnderReplicatedPartitions>Value: ' || CAST(value AS STRING)
  WHEN 'purchase' THEN 'kafka.controller<type=KafkaController, name=OfflinePartitionsCount>Value: '
       || CAST(value AS STRING)
  WHEN 'signup' THEN 'kafka.network<type=RequestMetrics, name=TotalTimeMs, request='
       || CASE WHEN user_id % 2 = 0 THEN 'Produce' ELSE 'Fetch' END || '>Value: ' || CAST(value AS STRING)
  ELSE CASE user_id % 3
       WHEN 0 THEN 'java.lang<type=Memory, name=Heap><HeapMemoryUsage>: ' || CASE event_id % 3
            WHEN 0 THEN CAST(CAST(floor(value) AS BIGINT) AS STRING)
            WHEN 1 THEN CAST(value AS STRING)
            ELSE CAST(CAST(floor(value) AS BIGINT) AS STRING) || '.25E3' END
       WHEN 1 THEN 'kafka.log<type=Log, name=Size, topic=orders-' || CAST(user_id % 5 AS STRING)
            || ', partition=>Value: ' || CAST(value AS STRING)
       ELSE 'kafka.server<type=SessionExpireListener, name=ZooKeeperSyncConnectsPerSec, clientId=c1, brokerHost=b'
            || CAST(user_id % 3 AS STRING) || ', brokerPort=9092>Value: ' || CAST(value AS STRING) END
  END"""


def a_beans(events: DataFrame) -> DataFrame:
    """events -> JMX bean lines (line, ts_ns, event_id)."""
    return events.select("event_id", "user_id", epoch_ns("ts").alias("ts_ns"), F.expr(BEAN_SQL).alias("line"))
