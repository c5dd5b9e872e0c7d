"""Streaming queries (STR-1, STR-2, STR-3, STR-6): each runs a Structured Streaming job with
``Trigger.AvailableNow`` over the driver's table as a file stream, writes parquet into the
shared checkpoint folder (``spark.checkpoint.dir``), and returns that table.

Append mode emits a window once the watermark passes its end, so the oracles hold the
closed windows: ``t <= max(ts) - delay``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import label
from ..operators import logs as L
from ..operators.alerts import AlertRule
from ..operators.promql import decode_series
from ..session import checkpoint_dir
from ..sources.tables import read_table
from ..streaming import ingest
from ..streaming import operators as SO
from .adapters import a_logs, a_samples
from .otlp_adapter import a_otlp_metrics
from .q_metrics import S0
from .q_signals import LOGS_SQL
from . import q_sources  # noqa: F401  (registers otlp_samples, whose oracle is shared)
from .registry import _ORACLES, query

DELAY_S = 3600
HOUR_NS = 3600 * 10**9


def stream_table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A driver table replayed as a file stream (the glob matches exactly its file)."""
    schema = read_table(spark, d, name).schema
    return spark.readStream.schema(schema).parquet(os.path.join(d, f"{name}.parque[t]"))


def run_available_now(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Run the stream to the end of its input; output and checkpoint live in the shared folder."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/pulsegrid-streams/{name}-{uuid.uuid4().hex}"
    q = (df.writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def last_closed_ns(spark: SparkSession, d: str) -> int:
    """The last full hour that the watermark passes when all of ``events`` is replayed."""
    newest = read_table(spark, d, "events").agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()[0]
    closed = (newest or 0) * 1000 - DELAY_S * 10**9
    return closed - closed % HOUR_NS


def _closed(t_col: str = "t_ns") -> str:
    return f"{t_col} <= (SELECT max(epoch_us(ts)) * 1000 FROM events) - {DELAY_S * 10**9}"


def _hour_grid(span_ns: int) -> str:
    """Every epoch-aligned hour end that can close a window over the events."""
    return f"""g AS (SELECT range * {HOUR_NS} AS t_ns FROM range(
  (SELECT min(epoch_us(ts)) * 1000 // {HOUR_NS} FROM events),
  (SELECT max(epoch_us(ts)) * 1000 // {HOUR_NS} FROM events) + {span_ns // HOUR_NS} + 2))"""


# ---------------------------------------------------------------- STR-2 counts

@query("stream_log_counts", f"""WITH {LOGS_SQL}, {_hour_grid(6 * HOUR_NS)}
SELECT CAST(g.t_ns // 1000000000 AS BIGINT) AS t, detected_level AS level, CAST(count(*) AS DOUBLE) AS value
FROM l JOIN g ON l.ts_ns >= g.t_ns - {6 * HOUR_NS} AND l.ts_ns < g.t_ns
WHERE {_closed('g.t_ns')}
GROUP BY g.t_ns, detected_level""")
def q_stream_log_counts(spark, d):
    logs = L.log_labels(a_logs(stream_table(spark, d, "events")))
    x = logs.select("ts", F.col("stream")["detected_level"].alias("level"))
    out = run_available_now(spark, SO.stream_log_count(x, "6 hours", "1 hour", ["level"], "1 hour"), "log_counts")
    return out.select("t", "level", "value")


# ---------------------------------------------------------------- STR-2 rate

@query("stream_rates", f"""WITH {S0},
s AS (SELECT metric, "user", ts_ns, max(value) AS value FROM s0 GROUP BY metric, "user", ts_ns),
p AS (SELECT *, lag(ts_ns) OVER w AS prev_ts, lag(value) OVER w AS prev_v
      FROM s WINDOW w AS (PARTITION BY metric, "user" ORDER BY ts_ns)),
{_hour_grid(24 * HOUR_NS)}
SELECT metric, "user", CAST(g.t_ns // 1000000000 AS BIGINT) AS t,
       round(sum(CASE WHEN prev_ts >= g.t_ns - {24 * HOUR_NS}
                      THEN CASE WHEN value >= prev_v THEN value - prev_v ELSE value END ELSE 0 END)
             / ((max(ts_ns) - min(ts_ns)) / 1e9), 6) AS value
FROM p JOIN g ON p.ts_ns >= g.t_ns - {24 * HOUR_NS} AND p.ts_ns < g.t_ns
WHERE {_closed('g.t_ns')}
GROUP BY metric, "user", g.t_ns HAVING count(*) >= 2 AND max(ts_ns) > min(ts_ns)""")
def q_stream_rates(spark, d):
    s = a_samples(stream_table(spark, d, "events"))
    out = run_available_now(spark, SO.stream_rate(s, "1 day", "1 hour", "1 hour", "1 day", last_closed_ns(spark, d)), "rates")
    out = decode_series(out)
    return out.select("metric", label("labels", "user").alias("user"), "t", F.round("value", 6).alias("value"))


# ---------------------------------------------------------------- STR-3 alerts

STREAM_ALERTS = [AlertRule("ViewHigh", "view", ">", 100, "6h", "warning"),
                 AlertRule("ClickLow", "click", "<", 200, "2h", "info", matchers=(("user", "!=", "1"),))]
LOOKBACK_NS = 12 * HOUR_NS


def _state_sql(alert: str, metric: str, cond: str, steps: int, where: str = "true") -> str:
    return f"""SELECT '{alert}' AS alert, "user", CAST(t_ns // 1000000000 AS BIGINT) AS t, value,
       CASE WHEN NOT c THEN 'inactive' WHEN sum(c::INT) OVER (PARTITION BY "user" ORDER BY t_ns
              RANGE BETWEEN {steps * HOUR_NS} PRECEDING AND CURRENT ROW) > {steps} THEN 'firing' ELSE 'pending' END AS state
FROM (SELECT *, {cond} AS c FROM v WHERE metric = '{metric}' AND {where})"""


@query("stream_alert_states", f"""WITH {S0}, {_hour_grid(LOOKBACK_NS)},
v AS (SELECT metric, "user", g.t_ns, arg_max(value, (ts_ns, value)) AS value
      FROM s0 JOIN g ON s0.ts_ns >= g.t_ns - {LOOKBACK_NS} AND s0.ts_ns < g.t_ns
      WHERE {_closed(f'g.t_ns + {HOUR_NS}')} GROUP BY metric, "user", g.t_ns)
{_state_sql('ViewHigh', 'view', 'value > 100', 6)} UNION ALL
{_state_sql('ClickLow', 'click', 'value < 200', 2, "\"user\" <> '1'")}""")
def q_stream_alert_states(spark, d):
    s = a_samples(stream_table(spark, d, "events"))
    out = run_available_now(spark, SO.stream_alerts(s, STREAM_ALERTS, "12h", "1h", "1 hour", "1 day", last_closed_ns(spark, d)), "alerts")
    # a state is final once the watermark is a step past it
    newest = read_table(spark, d, "events").agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).scalar()
    out = decode_series(out.filter((F.col("t") + 3600 + DELAY_S) * 1_000_000 <= newest))
    return out.select("alert", label("labels", "user").alias("user"), "t", "value", "state")


# ---------------------------------------------------------------- STR-6 dedup

@query("stream_dedup_points", f"""WITH {S0} SELECT metric, "user", ts_ns, max(value) AS value FROM s0
WHERE ts_ns <= (SELECT max(epoch_us(ts)) * 1000 FROM events) - {DELAY_S * 10**9} GROUP BY ALL""")
def q_stream_dedup_points(spark, d):
    s = a_samples(stream_table(spark, d, "events"))
    lower = s.withColumn("value", F.col("value") - 1)  # every point delivered twice, with another value
    out = run_available_now(spark, SO.dedup_points(s.unionByName(lower), "1 hour"), "dedup")
    out = decode_series(out)
    return out.select("metric", label("labels", "user").alias("user"), "ts_ns", "value")


# ---------------------------------------------------------------- STR-1 ingest

@query("stream_otlp_samples", _ORACLES["otlp_samples"])
def q_stream_otlp_samples(spark, d):
    """Encoded export requests land in a folder; the ingest stream decodes them."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/pulsegrid-streams/otlp-in-{uuid.uuid4().hex}"
    a_otlp_metrics(read_table(spark, d, "events")).write.text(base)
    s, _ = ingest.stream_otlp_metrics(spark, base)
    out = run_available_now(spark, s, "otlp")
    lab = F.col("labels")
    return out.select("metric", "kind", lab["service.name"].alias("svc"), lab["user"].alias("user"),
                      lab["pod"].alias("pod"), lab["sampled"].alias("sampled"), "ts_ns", "value", "rejected")

