"""Stream = batch: replay the driver's events as a file stream (AvailableNow, several
micro-batches in event-time order) and compare closed windows with the batch operators."""

import json
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.time import Grid
from pulsegrid.operators import alerts as AL
from pulsegrid.operators import logs as L
from pulsegrid.operators import promql as pq
from pulsegrid.plans.adapters import a_logs, a_samples
from pulsegrid.streaming import ingest
from pulsegrid.streaming import operators as SO
from tests.conftest import SF_SMALL

BOUNDS = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-02-01"]
GRID = Grid.of("2023-12-31 00:00:00", "2024-02-02 00:00:00", "1h")
DELAY_S = 3600


@pytest.fixture(scope="module")
def replay(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("replay"))
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for i in range(4):  # one file per week, written in event-time order
        ev.filter((F.col("ts") >= BOUNDS[i]) & (F.col("ts") < BOUNDS[i + 1])).coalesce(1) \
            .write.parquet(f"{d}/events/part{i}")
        time.sleep(1.1)
    max_s = ev.agg(F.max(F.unix_seconds(F.col("ts").cast("timestamp")))).first()[0]
    return d, ev, max_s


def _run(df, d, name):
    q = (df.writeStream.format("parquet").option("path", f"{d}/{name}")
         .option("checkpointLocation", f"{d}/ck-{name}").trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.read.parquet(f"{d}/{name}")


def _stream(spark, d, ev):
    return ingest.stream_parquet(spark, f"{d}/events/*", ev.schema, max_files=1)


def test_stream_log_counts_equal_batch(spark, replay):
    d, ev, max_s = replay
    st = L.log_labels(a_logs(_stream(spark, d, ev))).select("ts", F.col("stream")["detected_level"].alias("level"))
    got = _run(SO.stream_log_count(st, "6 hours", "1 hour", ["level"], "1 hour"), d, "counts")
    batch = L.log_count(L.log_labels(a_logs(ev)), GRID, "6h", ["detected_level"])
    closed = batch.filter(F.col("t") <= max_s - DELAY_S).select("t", F.col("detected_level").alias("level"), "value")
    got = got.select("t", "level", "value")
    assert closed.count() > 0
    assert got.exceptAll(closed).count() == 0 and closed.exceptAll(got).count() == 0


def test_stream_rate_equals_batch(spark, replay):
    d, ev, max_s = replay
    got = _run(SO.stream_rate(a_samples(_stream(spark, d, ev)), "1 day", "1 hour", "1 hour"), d, "rate")
    batch = pq.rate(a_samples(ev), GRID, "1d").filter(F.col("t") <= max_s - DELAY_S)
    a = got.select("t", "series_id", F.round("value", 6).alias("v"))
    b = batch.select("t", "series_id", F.round("value", 6).alias("v"))
    assert b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_alerts_equal_batch(spark, replay):
    d, ev, max_s = replay
    rules = [AL.AlertRule("ViewHigh", "view", ">", 100, "6h"), AL.AlertRule("Odd", "view", ">", 50, "90m"),
             AL.AlertRule("ClickLow", "click", "<", 200, "2h", matchers=(("user", "!=", "1"),))]
    got = _run(SO.stream_alerts(a_samples(_stream(spark, d, ev)), rules, "12h", "1h", "1 hour"), d, "alerts")
    batch = AL.alert_states(pq.instant(a_samples(ev), GRID, "12h"), rules, GRID).filter(F.col("t") <= max_s - DELAY_S - 3600)
    got = got.filter(F.col("t") <= max_s - DELAY_S - 3600)
    cols = ["alert", "series_id", "t", "value", "state"]
    a, b = got.select(cols), batch.select(cols)
    assert b.filter("state = 'firing'").count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_late_and_repeated_rows_change_nothing(spark, tmp_path):
    """Rows out of order within the delay, repeats with other values, over several micro-batches."""
    def points(n, minutes, value):
        return [(f"s{k}", 1704067200 + 60 * m, float(v)) for k in range(n) for m, v in zip(minutes, value)]
    batches = [points(2, [0, 10, 30, 50], [1, 5, 9, 2]), points(2, [20, 45, 40, 10], [7, 11, 10, 4]),
               points(2, [60, 55, 80], [3, 2.5, 8]), points(2, [70, 120, 110, 300], [5, 9, 1, 2])]
    schema = "series_id string, s long, value double"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(1.1)
    every = spark.read.parquet(f"{tmp_path}/in")

    def samples(df):
        return df.select("series_id", F.col("s").cast("timestamp").alias("ts"), (F.col("s") * 10**9).alias("ts_ns"), "value")
    stream = samples(ingest.stream_parquet(spark, f"{tmp_path}/in", every.schema, max_files=1))
    got = _run(SO.stream_rate(stream, "1 hour", "30 minutes", "1 hour"), tmp_path, "rate")
    pts = {}
    for r in samples(every).collect():
        pts.setdefault(r.series_id, {})
        pts[r.series_id][r.ts_ns] = max(r.value, pts[r.series_id].get(r.ts_ns, r.value))
    want = set()
    for sid, p in pts.items():
        for t in range(1704067200, 1704067200 + 240 * 60 + 1, 1800):
            x = [(k, v) for k, v in sorted(p.items()) if (t - 3600) * 10**9 <= k < t * 10**9]
            if len(x) > 1:
                inc = sum(b[1] if b[1] < a[1] else b[1] - a[1] for a, b in zip(x, x[1:]))
                want.add((sid, t, round(inc / ((x[-1][0] - x[0][0]) / 1e9), 9)))
    assert {(r.series_id, r.t, round(r.value, 9)) for r in got.collect()} == want
    kept = _run(SO.dedup_points(stream, "1 hour"), tmp_path, "dedup").collect()
    closed = {(s, k, v) for s, p in pts.items() for k, v in p.items() if k <= (1704067200 + 240 * 60) * 10**9}
    assert {(r.series_id, r.ts_ns, r.value) for r in kept} == closed and len(kept) == len(closed)


def test_routing_is_written_once(spark, replay, scratch):
    d, ev, _ = replay
    from pulsegrid.plans.q_panels import topic_records
    for _ in range(2):  # the second run finds nothing new in its checkpoint
        q = SO.write_routed(topic_records(_stream(spark, d, ev)), f"{scratch}/routed", f"{scratch}/ck")
        q.awaitTermination()
    out = spark.read.parquet(f"{scratch}/routed")
    assert out.count() == ev.count()
    assert {r.domain for r in out.select("domain").distinct().collect()} == {"ticket", "web", "user", "ops"}


def test_stream_otlp_equals_batch(spark, scratch):
    from pulsegrid.plans.otlp_adapter import a_otlp_metrics
    from pulsegrid.sources import otlp as O

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    a_otlp_metrics(ev).write.text(f"{scratch}/otlp")
    batch, _ = O.read_otlp_metrics(spark, f"{scratch}/otlp")
    s, _ = ingest.stream_otlp_metrics(spark, f"{scratch}/otlp")
    got = _run(s.select("series_id", "ts_ns", "value"), scratch, "otlp_out")
    b = batch.select("series_id", "ts_ns", "value")
    assert got.exceptAll(b).count() == 0 and b.exceptAll(got).count() == 0


def _entries(df, d, name):
    """The rows written, and how many rows the last stateful step of each batch took in."""
    q = (df.writeStream.format("parquet").option("path", f"{d}/{name}")
         .option("checkpointLocation", f"{d}/ck-{name}").trigger(availableNow=True).start())
    q.awaitTermination()
    states = [p["stateOperators"] for p in q.recentProgress if p["stateOperators"]]
    return df.sparkSession.read.parquet(f"{d}/{name}"), sum(max(s["numRowsUpdated"] for s in p) for p in states)


def test_rate_in_blocks_equals_batch_with_fewer_entries(spark, replay):
    d, ev, max_s = replay
    end_ns = (max_s - DELAY_S) // 3600 * 3600 * 10**9
    got, few = _entries(SO.stream_rate(a_samples(_stream(spark, d, ev)), "1 day", "1 hour", "1 hour", "1 day", end_ns), d, "rate-blocks")
    batch = pq.rate(a_samples(ev), GRID, "1d").filter(F.col("t") <= max_s - DELAY_S)
    a = got.select("t", "series_id", F.round("value", 6).alias("v"))
    b = batch.select("t", "series_id", F.round("value", 6).alias("v"))
    assert b.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert few < 4 * ev.count()  # 24 places a point before


def test_alerts_in_blocks_equal_batch_with_fewer_entries(spark, replay):
    d, ev, max_s = replay
    end_ns = (max_s - DELAY_S) // 3600 * 3600 * 10**9
    rules = [AL.AlertRule("ViewHigh", "view", ">", 100, "6h"), AL.AlertRule("Odd", "view", ">", 50, "90m")]
    got, few = _entries(SO.stream_alerts(a_samples(_stream(spark, d, ev)), rules, "12h", "1h", "1 hour", "1 day", end_ns), d, "alert-blocks")
    batch = AL.alert_states(pq.instant(a_samples(ev), GRID, "12h"), rules, GRID).filter(F.col("t") <= max_s - DELAY_S)
    cols = ["alert", "series_id", "t", "value", "state"]
    a, b = got.select(cols), batch.select(cols)
    assert b.filter("state = 'firing'").count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert few < 4 * 2 * ev.filter("event_type = 'view'").count()  # 7 places a grid time, 12 a point before
