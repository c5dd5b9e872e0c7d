"""Hand-made OTLP-JSON fixtures (shapes after FIXTURES.md §1-3; values are our own)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import histograms as H
from pulsegrid.operators import logs as L
from pulsegrid.operators import traces as T
from pulsegrid.sources import otlp as O

T0 = 1_700_000_000_000_000_000
S = 1_000_000_000


def kv(k, **v):
    return {"key": k, "value": v}


def metrics_request():
    res = {"attributes": [kv("service.name", stringValue="checkout"), kv("service.instance.id", stringValue="i-1")]}
    hist = {"name": "http.server.request.duration", "unit": "s", "histogram": {"aggregationTemporality": 2, "dataPoints": [
        {"attributes": [kv("http.route", stringValue="/a"), kv("http.response.status_code", intValue="200")],
         "startTimeUnixNano": str(T0), "timeUnixNano": str(T0 + 60 * S), "count": "10", "sum": 2.5,
         "bucketCounts": ["1", "2", "3", "4"], "explicitBounds": [0.1, 1, 5], "min": 0.01, "max": 9.0,
         "exemplars": [{"timeUnixNano": str(T0 + 30 * S), "asDouble": 7.5, "traceId": "t1", "spanId": "s1"}]},
        {"attributes": [], "startTimeUnixNano": str(T0), "timeUnixNano": str(T0 + 60 * S), "count": "0", "sum": 0,
         "bucketCounts": [], "explicitBounds": []}]}}
    counter = {"name": "app.orders", "unit": "{order}", "sum": {"aggregationTemporality": 2, "isMonotonic": True,
               "dataPoints": [
                   {"attributes": [kv("shop", stringValue="x")], "timeUnixNano": str(T0 + 10 * S), "asInt": "5"},
                   {"attributes": [kv("shop", stringValue="x")], "timeUnixNano": str(T0 + 20 * S), "asInt": "7"},
                   {"attributes": [kv("shop", stringValue="x")], "timeUnixNano": str(T0 + 30 * S), "asInt": "2"},
                   {"attributes": [kv("shop", stringValue="x")], "timeUnixNano": str(T0 + 30 * S), "asInt": "3"},
                   {"attributes": [kv("shop", stringValue="x")], "timeUnixNano": str(T0 + 40 * S), "asInt": "4"}]}}
    gauge0 = {"name": "jvm.thread.count", "unit": "{thread}", "gauge": {"dataPoints": [
        {"timeUnixNano": str(T0 + 10 * S), "asInt": "0"}]}}
    gauge_bool = {"name": "jvm.thread.live", "unit": "1", "gauge": {"dataPoints": [
        {"attributes": [kv("jvm.thread.daemon", boolValue=True), kv("dup", stringValue="a"),
                        kv("dup", stringValue="b")], "timeUnixNano": str(T0 + 10 * S), "asDouble": 3.0}]}}
    bad = {"name": "db.client.connections.usage", "unit": "{connection}", "sum": {"isMonotonic": False,
           "dataPoints": [{"timeUnixNano": str(T0 + 10 * S), "asInt": "n/a"}]}}
    return {"resourceMetrics": [{"resource": res, "scopeMetrics": [
        {"scope": {"name": "app", "version": "1"}, "metrics": [hist, counter, gauge0, gauge_bool, bad]}]}]}


@pytest.fixture(scope="module")
def metric_tables(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("otlp")
    with open(os.path.join(d, "m.json"), "w") as f:
        f.write(json.dumps(metrics_request()) + "\n")
    s, h = O.read_otlp_metrics(spark, str(d))
    return s.cache(), h.cache()


def test_metric_names_kinds_and_labels(metric_tables):
    s, _ = metric_tables
    rows = {(r.metric, r.kind) for r in s.select("metric", "kind").collect()}
    assert rows == {("app_orders_total", "counter"), ("jvm_thread_count", "gauge"),
                    ("jvm_thread_live_ratio", "gauge"), ("db_client_connections_usage", "updown")}
    live = s.filter(F.col("metric") == "jvm_thread_live_ratio").first()
    assert live.labels["jvm.thread.daemon"] == "true"
    assert live.labels["dup"] == "b"  # duplicate key: the last one wins
    assert live.labels["service.name"] == "checkout"
    zero = s.filter(F.col("metric") == "jvm_thread_count").first()
    assert zero.value == 0.0 and zero.labels == {"service.name": "checkout", "service.instance.id": "i-1"}


def test_unparsable_number_is_rejected_not_fatal(metric_tables):
    s, _ = metric_tables
    bad = s.filter(F.col("metric") == "db_client_connections_usage").first()
    assert bad.value is None and bad.rejected is True
    assert s.filter(F.col("rejected")).count() == 1


def test_histogram_buckets_and_quantile(metric_tables):
    _, h = metric_tables
    b = H.cumulative_buckets(h, keep=["metric", "ts_ns"]).orderBy("le").collect()
    assert [(r.le, r.cum) for r in b] == [(0.1, 1), (1.0, 3), (5.0, 6), (float("inf"), 10)]
    q = H.histogram_quantile(h.filter(F.size("counts") > 0), [0.5, 0.95, 1.0], by=["metric"]).orderBy("q").collect()
    # 0.5 -> rank 5 in (1, 5]: 1 + 4 * (5 - 3) / 3; 0.95 -> +Inf bucket -> largest finite bound
    assert q[0].value == pytest.approx(1 + 4 * 2 / 3)
    assert q[1].value == 5.0 and q[2].value == 5.0


def test_empty_bucket_array_gives_no_rows_and_zero_total_is_null(spark, metric_tables):
    _, h = metric_tables
    empty = h.filter(F.size("counts") == 0)
    assert H.cumulative_buckets(empty, keep=["metric"]).count() == 0
    arr = spark.createDataFrame([([(1.0, 0), (float("inf"), 0)],)], "b array<struct<le:double,cum:bigint>>")
    assert arr.select(H.quantile_from_buckets(F.lit(0.5), F.col("b")).alias("v")).first().v is None


def test_exemplars(metric_tables):
    _, h = metric_tables
    ex = O.exemplars(h).collect()
    assert len(ex) == 1 and ex[0].trace_id == "t1" and ex[0].value == 7.5


def test_counter_reset_and_duplicate_point(metric_tables):
    from pulsegrid.functions.time import Grid
    from pulsegrid.operators import promql as pq

    s, _ = metric_tables
    c = s.filter(F.col("metric") == "app_orders_total")
    inc = {r.ts_ns: r.inc for r in pq.counter_inc(c).collect()}
    # 5 -> 7 (+2) -> reset, duplicate keeps the larger value 3 (+3) -> 4 (+1)
    assert [inc[T0 + k * S] for k in (10, 20, 30, 40)] == [0.0, 2.0, 3.0, 1.0]
    g = Grid(T0 + 60 * S, T0 + 60 * S, 60 * S)
    r = pq.rate(c, g, 60 * S).first()
    assert r.value == pytest.approx(6.0 / 30.0)


def logs_request():
    res = {"attributes": [kv("service.name", stringValue="api"), kv("service.namespace", stringValue="shop")]}
    recs = [
        {"timeUnixNano": str(T0), "severityNumber": 9, "severityText": "INFO", "body": {"stringValue": "started"},
         "attributes": [kv("log_type", stringValue="app"), kv("logger", stringValue="main")]},
        {"timeUnixNano": str(T0 + S), "severityNumber": 13, "severityText": "WARN",
         "body": {"stringValue": json.dumps({"status": "declined", "amount": 12.5})},
         "attributes": [kv("log_type", stringValue="payment")], "traceId": "t1", "spanId": "s1"},
        {"timeUnixNano": str(T0 + 2 * S), "severityNumber": 17, "severityText": "ERROR",
         "body": {"stringValue": json.dumps({"action": "login", "result": "fail"})},
         "attributes": [kv("log_type", stringValue="audit")], "traceId": "", "spanId": ""},
    ]
    return {"resourceLogs": [{"resource": res, "scopeLogs": [{"scope": {"name": "app"}, "logRecords": recs}]}]}


def traces_request():
    res = {"attributes": [kv("service.name", stringValue="api")]}

    def span(tid, sid, parent, name, start, dur_ms, code=1, **attrs):
        return {"traceId": tid, "spanId": sid, "parentSpanId": parent, "name": name, "kind": 2 if not parent else 3,
                "startTimeUnixNano": str(T0 + start), "endTimeUnixNano": str(T0 + start + dur_ms * 1_000_000),
                "attributes": [kv(k, stringValue=v) for k, v in attrs.items()], "status": {"code": code}}

    spans = [span("clean", "a", "", "GET /", 0, 50), span("clean", "b", "a", "SELECT", 1, 10, **{"db.system": "pg"}),
             span("fail", "c", "", "POST /pay", 0, 100, 2), span("fail", "d", "c", "INSERT", 1, 20, 2),
             span("slow", "e", "", "GET /report", 0, 800), span("slow", "f", "zz", "orphan", 1, 5),
             span("rootless", "g", "h", "child", 0, 5)]
    return {"resourceSpans": [{"resource": res, "scopeSpans": [{"scope": {"name": "app"}, "spans": spans}]}]}


def test_logs_labels_and_json_bodies(spark, tmp_path):
    p = tmp_path / "l.json"
    p.write_text(json.dumps(logs_request()) + "\n")
    lg = L.log_labels(O.read_otlp_logs(spark, str(tmp_path)))
    rows = lg.orderBy("ts_ns").collect()
    assert [r.stream.get("detected_level") for r in rows] == ["INFO", "WARN", "ERROR"]
    assert rows[0].stream == {"service_name": "api", "log_type": "app", "detected_level": "INFO", "logger": "main"}
    assert "logger" not in rows[1].stream
    assert rows[1].trace_id == "t1" and rows[2].trace_id is None
    f = L.json_fields(lg, "body", "status string, amount double, action string").orderBy("ts_ns").collect()
    assert f[0].fields.status is None and f[1].fields.amount == 12.5 and f[2].fields.action == "login"
    probe = L.any_non_empty(lg, ["trace_id", "severity_text"]).first()
    assert probe.has_trace_id and probe.has_severity_text


def test_traces_roots_predicates_and_orphans(spark, tmp_path):
    p = tmp_path / "t.json"
    p.write_text(json.dumps(traces_request()) + "\n")
    sp = O.read_otlp_spans(spark, str(tmp_path))
    r = {x.span_id: x for x in T.root_attributes(sp).collect()}
    assert r["b"].rootName == "GET /" and r["f"].rootName == "GET /report"  # orphan keeps its trace root
    assert r["g"].rootName is None  # trace without root
    slow = T.select_spans(sp, [("duration", ">=", "100ms"), ("kind", "=", "server")]).select("span_id").collect()
    assert {x.span_id for x in slow} == {"c", "e"}
    db = T.select_spans(sp, [("span.db.system", "=", "pg")]).count()
    err = T.select_spans(sp, [("status", "=", "error")]).count()
    assert db == 1 and err == 2
