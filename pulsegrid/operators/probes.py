"""AG-10 with probes as data: selectors of three languages, with matchers and a time range.

Signals of every kind are rows (lang, labels MAP, sid, ts_ns, value): samples with their name under
``__name__``, log records with their stream labels, spans with ``span.*``, ``resource.*`` and the
intrinsics. A probe is a row (query, lang, matchers ARRAY<STRUCT<label, op, value>>, start_ns, end_ns).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.plan import with_columns_once
from .alerts import meets

MATCHERS = "array<struct<label:string,op:string,value:string>>"
_ORDERED = (">", ">=", "<", "<=")


def metric_signals(samples: DataFrame) -> DataFrame:
    named = F.map_concat(F.create_map(F.lit("__name__"), F.col("metric")), F.col("labels"))
    return samples.select(F.lit("prometheus").alias("lang"), named.alias("labels"), F.col("series_id").alias("sid"),
                          "ts_ns", F.col("value").cast("double").alias("value"))


def log_signals(logs: DataFrame) -> DataFrame:
    """``logs`` as ``log_labels`` leaves them; a series is a stream, and a record has no value."""
    return logs.select(F.lit("loki").alias("lang"), F.col("stream").alias("labels"), F.col("stream_id").alias("sid"),
                       "ts_ns", F.lit(None).cast("double").alias("value"))


def span_signals(spans: DataFrame) -> DataFrame:
    """A series is a trace, and a span has no value. rootName and rootServiceName
    are labels where ``root_attributes`` has added them."""
    duration = F.col("end_ns") - F.col("start_ns")
    own = {"name": F.col("name"), "kind": F.col("kind"), "status": F.col("status_code"), "duration": duration,
           "traceID": F.col("trace_id"), "spanID": F.col("span_id")}
    own |= {c: F.col(c) for c in ("rootName", "rootServiceName") if c in spans.columns}
    intrinsic = F.create_map(*[x for k, c in own.items() for x in (F.lit(k), c.cast("string"))])

    def scoped(name, prefix):
        return F.transform_keys(F.coalesce(F.col(name), F.create_map().cast("map<string,string>")),
                                lambda k, v: F.concat(F.lit(prefix), k))
    return spans.select(F.lit("tempo").alias("lang"),
                        F.map_concat(intrinsic, scoped("attrs", "span."), scoped("res", "resource.")).alias("labels"),
                        F.col("trace_id").alias("sid"), F.col("start_ns").alias("ts_ns"),
                        F.lit(None).cast("double").alias("value"))


def _selects(probe: Column, ts: Column, true: Column, numbers: Column) -> Column:
    """Whether a row is in a probe's time range and meets its matchers: the texts by the outcomes of its
    anchor's tests, the ordered ones by numbers (an absent label or a text meets none)."""
    def compare(m):
        v, w = F.get(numbers, m["at"]), m["number"]
        return F.coalesce(F.when(m["op"] == ">", v > w).when(m["op"] == ">=", v >= w)
                          .when(m["op"] == "<", v < w).when(m["op"] == "<=", v <= w), F.lit(False))
    return ((ts >= probe["start_ns"]) & (ts < probe["end_ns"]) & F.forall(probe["ordered"], compare)
            & F.forall(probe["tests"], lambda i: F.get(true, i)))


def _anchored(probes: DataFrame) -> DataFrame:
    """One row per anchor (lang, ak, av): its probes, the distinct text matchers and ordered labels of these, and
    in each probe the places of its own among them. The anchor's own equality is what the join compares."""
    x = probes.withColumn("texts", F.filter("matchers", lambda m: ~m["op"].isin(*_ORDERED) & ~(
        (m["op"] == "=") & (m["value"] != "") & (m["label"] == F.col("ak")) & (m["value"] == F.col("av")))))
    x = x.withColumn("ordered", F.filter("matchers", lambda m: m["op"].isin(*_ORDERED)))
    probe = F.struct("query", "start_ns", "end_ns", "texts", "ordered")
    x = x.groupBy("lang", "ak", "av").agg(
        F.array_distinct(F.flatten(F.collect_set("texts"))).alias("tests"),
        F.array_distinct(F.flatten(F.collect_set("ordered.label"))).alias("number_labels"), F.collect_list(probe).alias("probes"))

    def placed(p):
        return F.struct(
            p["query"].alias("query"), p["start_ns"].alias("start_ns"), p["end_ns"].alias("end_ns"),
            F.transform(p["texts"], lambda m: (F.array_position("tests", m) - 1).cast("int")).alias("tests"),
            F.transform(p["ordered"], lambda m: F.struct(
                (F.array_position("number_labels", m["label"]) - 1).cast("int").alias("at"), m["op"].alias("op"),
                m["value"].try_cast("double").alias("number"))).alias("ordered"))
    return x.withColumn("probes", F.transform("probes", placed))


def probe_selectors(signals: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per probe: n_series, n_rows, first_value (the smallest value at its earliest row), status
    (PASS where any row was selected in [start_ns, end_ns), else FAIL).

    A probe's first equality matcher is its anchor: a row meets probes by an equi-join on (lang, label,
    value) of the labels that serve as anchors, so a row is compared with the probes it may satisfy and
    not with all. Probes without such a matcher meet every row of their language, as they must. An anchor's
    distinct text matchers are tested once a row, its labels turned into numbers once a row; each probe then
    only looks up its outcomes, and a row leaves the comparison once for each probe that selects it. The
    plan has the same size for any number of probes; which labels are anchors, and the time span of
    all probes, are scalar subqueries of the same job. A series has one value a time, as in the data
    model; of several any may be the first. Equal probe names count as one probe with all their rows."""
    eq = F.get(F.filter("matchers", lambda m: (m["op"] == "=") & (m["value"] != "")), 0)
    probes = catalog.select("query", "lang", F.coalesce("matchers", F.array().cast(MATCHERS)).alias("matchers"),
                            "start_ns", "end_ns").withColumn("eq", eq)
    probes = probes.select("*", F.coalesce("eq.label", F.lit("")).alias("ak"),
                           F.coalesce("eq.value", F.lit("")).alias("av")).drop("eq")
    anchors = probes.filter("lang is not null").groupBy("lang").agg(F.collect_set("ak").alias("aks")).agg(
        F.map_from_entries(F.collect_list(F.struct("lang", "aks")))).scalar()
    span = probes.agg(F.struct(F.min("start_ns").alias("lo"), F.max("end_ns").alias("hi")).alias("s")).scalar()
    x = signals.filter((F.col("ts_ns") >= span["lo"]) & (F.col("ts_ns") < span["hi"]))
    x = with_columns_once(x, {"anchors": anchors})
    x = x.select("lang", "labels", "sid", "ts_ns", "value", F.explode(F.try_element_at("anchors", "lang")).alias("ak"))
    x = x.withColumn("av", F.when(F.col("ak") == "", "").otherwise(F.try_element_at("labels", "ak")))
    x = x.join(F.broadcast(_anchored(probes)), ["lang", "ak", "av"])
    outcomes = F.struct(
        F.transform("tests", lambda m: meets(F.col("labels"), F.array(m))).alias("true"),
        F.transform("number_labels", lambda k: F.try_element_at("labels", k).try_cast("double")).alias("numbers"))
    selecting = F.transform(F.array(outcomes), lambda o: F.filter("probes", lambda p: _selects(
        p, F.col("ts_ns"), o["true"], o["numbers"]))["query"])[0]
    got = x.select("sid", "ts_ns", "value", F.explode(selecting).alias("query"))
    # numbers only in the buffers: series first, then times, then the probe
    series = got.groupBy("query", "sid").agg(F.count(F.lit(1)).alias("n"), F.min("ts_ns").alias("at"),
                                             F.min_by("value", "ts_ns").alias("v"))
    times = series.groupBy("query", "at").agg(F.count(F.lit(1)).alias("s"), F.sum("n").alias("n"), F.min("v").alias("v"))
    per = times.groupBy("query").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.min_by("v", "at").alias("v"))
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    return catalog.select("query").distinct().join(per, "query", "left").select(
        "query", F.coalesce("s", F.lit(0)).cast("bigint").alias("n_series"), n.alias("n_rows"),
        F.col("v").alias("first_value"), F.when(n > 0, "PASS").otherwise("FAIL").alias("status"))
