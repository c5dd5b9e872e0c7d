"""OTLP-JSON sources for metrics, logs and traces (SRC-1, SRC-2, SRC-3, SC-1, SC-8).

One export request per line (``spark.read.json`` splits line files; ``multiLine`` documents
are not splittable). The schema is always explicit: inference would turn int64-as-string
values and integer-looking bounds into unstable types. Numbers written as strings are
converted with ``try_cast`` so that an unparsable value becomes NULL (and is counted)
instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import attributes_to_map, merge_maps, series_key
from ..functions.names import prom_name

KV = "array<struct<key:string,value:struct<stringValue:string,intValue:string,boolValue:boolean,doubleValue:double>>>"
RESOURCE = f"struct<attributes:{KV}>"
SCOPE = "struct<name:string,version:string>"
NUM = f"struct<attributes:{KV},startTimeUnixNano:string,timeUnixNano:string,asInt:string,asDouble:double>"
EXEMPLAR = "struct<timeUnixNano:string,asDouble:double,traceId:string,spanId:string>"
HIST = (f"struct<attributes:{KV},startTimeUnixNano:string,timeUnixNano:string,count:string,sum:double,"
        f"bucketCounts:array<string>,explicitBounds:array<double>,min:double,max:double,exemplars:array<{EXEMPLAR}>>")
METRIC = (f"struct<name:string,unit:string,description:string,"
          f"gauge:struct<dataPoints:array<{NUM}>>,"
          f"sum:struct<dataPoints:array<{NUM}>,aggregationTemporality:int,isMonotonic:boolean>,"
          f"histogram:struct<dataPoints:array<{HIST}>,aggregationTemporality:int>>")
METRICS_SCHEMA = (f"struct<resourceMetrics:array<struct<resource:{RESOURCE},"
                  f"scopeMetrics:array<struct<scope:{SCOPE},metrics:array<{METRIC}>>>>>>")

LOG_RECORD = (f"struct<timeUnixNano:string,observedTimeUnixNano:string,severityNumber:int,severityText:string,"
              f"body:struct<stringValue:string>,attributes:{KV},traceId:string,spanId:string>")
LOGS_SCHEMA = (f"struct<resourceLogs:array<struct<resource:{RESOURCE},"
               f"scopeLogs:array<struct<scope:{SCOPE},logRecords:array<{LOG_RECORD}>>>>>>")

SPAN = (f"struct<traceId:string,spanId:string,parentSpanId:string,name:string,kind:int,"
        f"startTimeUnixNano:string,endTimeUnixNano:string,attributes:{KV},status:struct<code:int,message:string>>")
TRACES_SCHEMA = (f"struct<resourceSpans:array<struct<resource:{RESOURCE},"
                 f"scopeSpans:array<struct<scope:{SCOPE},spans:array<{SPAN}>>>>>>")


def _ns(c: Column) -> Column:
    return c.try_cast("bigint")


def _parse(df: DataFrame, col: str, schema: str) -> DataFrame:
    return df.select(F.from_json(F.col(col), schema).alias("r"))


def struct_schema(schema: str):
    """``struct<...>`` text -> StructType (for readers that want a table schema)."""
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(schema)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(struct_schema(schema)).json(path).select(F.struct("*").alias("r"))


# ---------------------------------------------------------------- metrics

def _metric_rows(req: DataFrame) -> DataFrame:
    rm = req.select(F.explode("r.resourceMetrics").alias("rm"))
    sm = rm.select(attributes_to_map("rm.resource.attributes").alias("res"), F.explode("rm.scopeMetrics").alias("sm"))
    return sm.select("res", F.col("sm.scope.name").alias("scope"), F.explode("sm.metrics").alias("m"))


def _temporality(field: str) -> Column:
    """delta, cumulative, or null where the request does not say (1 and 2 are the format's numbers)."""
    return F.when(F.col(f"{field}.aggregationTemporality") == 1, "delta").when(F.col(f"{field}.aggregationTemporality") == 2, "cumulative")


def metrics_from_requests(req: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples, histograms) from parsed export requests (column ``r``)."""
    m = _metric_rows(req)
    # gauge and sum points in one generator (one pass over the requests)
    gauge = F.transform(F.coalesce(F.col("m.gauge.dataPoints"), F.array().cast(f"array<{NUM}>")),
                        lambda p: F.struct(F.lit("gauge").alias("kind"), F.lit(None).cast("string").alias("temporality"), p.alias("p")))
    mono = F.coalesce(F.col("m.sum.isMonotonic"), F.lit(False))
    sums = F.transform(F.coalesce(F.col("m.sum.dataPoints"), F.array().cast(f"array<{NUM}>")),
                       lambda p: F.struct(F.when(mono, "counter").otherwise("updown").alias("kind"),
                                          _temporality("m.sum").alias("temporality"), p.alias("p")))
    # names are normalised once per metric, before its points are exploded
    pts = m.select("res", prom_name(F.col("m.name"), F.col("m.unit"), mono).alias("metric"), "m.unit",
                   F.inline(F.concat(gauge, sums)))
    value = F.coalesce(F.col("p.asDouble"), F.col("p.asInt").try_cast("double"))
    samples = pts.select(
        "metric", "kind", "unit", "temporality",
        merge_maps(F.col("res"), attributes_to_map("p.attributes")).alias("labels"),
        _ns(F.col("p.timeUnixNano")).alias("ts_ns"),
        value.alias("value"),
        (F.col("p.asDouble").isNull() & F.col("p.asInt").isNotNull() & value.isNull()).alias("rejected"))
    samples = (samples.withColumn("ts", F.timestamp_micros(F.floor(F.col("ts_ns") / 1000).cast("bigint")))
               .withColumn("series_id", series_key("metric", "labels")))

    h = m.select("res", prom_name(F.col("m.name"), F.col("m.unit"), F.lit(False)).alias("metric"),
                 _temporality("m.histogram").alias("temporality"), F.explode("m.histogram.dataPoints").alias("p"))
    hist = h.select(
        "metric", "temporality",
        merge_maps(F.col("res"), attributes_to_map("p.attributes")).alias("labels"),
        _ns(F.col("p.timeUnixNano")).alias("ts_ns"),
        F.col("p.count").try_cast("bigint").alias("count"),
        F.col("p.sum").alias("sum"), F.col("p.min").alias("min"), F.col("p.max").alias("max"),
        F.transform(F.coalesce(F.col("p.bucketCounts"), F.array().cast("array<string>")),
                    lambda x: x.try_cast("bigint")).alias("counts"),
        F.coalesce(F.col("p.explicitBounds"), F.array().cast("array<double>")).alias("bounds"),
        F.col("p.exemplars").alias("exemplars"))
    hist = (hist.withColumn("ts", F.timestamp_micros(F.floor(F.col("ts_ns") / 1000).cast("bigint")))
            .withColumn("series_id", series_key("metric", "labels")))
    return samples, hist


def read_otlp_metrics(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-1: OTLP-JSON metric export requests (one per line) -> (samples, histograms)."""
    return metrics_from_requests(_read(spark, path, METRICS_SCHEMA))


def parse_otlp_metrics(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    return metrics_from_requests(_parse(df, col, METRICS_SCHEMA))


def exemplars(hist: DataFrame) -> DataFrame:
    """Exemplars of histogram points: (metric, series_id, ts_ns, ex_ts_ns, value, trace_id, span_id)."""
    e = hist.select("metric", "series_id", "ts_ns", F.explode("exemplars").alias("e"))
    return e.select("metric", "series_id", "ts_ns", _ns(F.col("e.timeUnixNano")).alias("ex_ts_ns"),
                    F.col("e.asDouble").alias("value"), F.col("e.traceId").alias("trace_id"),
                    F.col("e.spanId").alias("span_id"))


# ---------------------------------------------------------------- logs

def logs_from_requests(req: DataFrame) -> DataFrame:
    rl = req.select(F.explode("r.resourceLogs").alias("rl"))
    sl = rl.select(attributes_to_map("rl.resource.attributes").alias("res"), F.explode("rl.scopeLogs").alias("sl"))
    lr = sl.select("res", F.explode("sl.logRecords").alias("l"))
    ts_ns = F.coalesce(_ns(F.col("l.timeUnixNano")), _ns(F.col("l.observedTimeUnixNano")))
    return lr.select(
        ts_ns.alias("ts_ns"),
        F.timestamp_micros(F.floor(ts_ns / 1000).cast("bigint")).alias("ts"),
        F.col("l.severityNumber").alias("severity_number"),
        F.col("l.severityText").alias("severity_text"),
        F.col("l.body.stringValue").alias("body"),
        attributes_to_map("l.attributes").alias("attrs"),
        F.col("res"),
        F.nullif(F.col("l.traceId"), F.lit("")).alias("trace_id"),
        F.nullif(F.col("l.spanId"), F.lit("")).alias("span_id"))


def read_otlp_logs(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2."""
    return logs_from_requests(_read(spark, path, LOGS_SCHEMA))


def parse_otlp_logs(df: DataFrame, col: str) -> DataFrame:
    return logs_from_requests(_parse(df, col, LOGS_SCHEMA))


# ---------------------------------------------------------------- traces

def spans_from_requests(req: DataFrame) -> DataFrame:
    rs = req.select(F.explode("r.resourceSpans").alias("rs"))
    ss = rs.select(attributes_to_map("rs.resource.attributes").alias("res"), F.explode("rs.scopeSpans").alias("ss"))
    sp = ss.select("res", F.explode("ss.spans").alias("s"))
    return sp.select(
        F.col("s.traceId").alias("trace_id"), F.col("s.spanId").alias("span_id"),
        F.nullif(F.col("s.parentSpanId"), F.lit("")).alias("parent_id"),
        F.col("s.name").alias("name"), F.col("s.kind").alias("kind"),
        _ns(F.col("s.startTimeUnixNano")).alias("start_ns"), _ns(F.col("s.endTimeUnixNano")).alias("end_ns"),
        F.coalesce(F.col("s.status.code"), F.lit(0)).alias("status_code"),
        F.col("s.status.message").alias("status_message"),
        attributes_to_map("s.attributes").alias("attrs"), F.col("res"))


def read_otlp_spans(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3."""
    return spans_from_requests(_read(spark, path, TRACES_SCHEMA))


def parse_otlp_spans(df: DataFrame, col: str) -> DataFrame:
    return spans_from_requests(_parse(df, col, TRACES_SCHEMA))


def rebase_times(df: DataFrame, now_ns: int, cols=("ts_ns",)) -> DataFrame:
    """SC-18: shift records so that the newest one is at ``now``; the offset is a scalar
    subquery over one aggregate (planned once, no join with the data)."""
    offset = df.agg((F.lit(now_ns) - F.max(cols[0])).alias("o")).scalar()
    out = df
    for c in cols:
        out = out.withColumn(c, F.col(c) + offset)
    return out
