"""Histogram, log and trace queries (SC-10, AG-6, DD-5, PF-10/11, AG-11/15, SL-2/4, DD-1/3/4, PF-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import histograms as H
from ..operators import logs as L
from ..operators import traces as T
from ..sources.tables import read_table
from . import params as P
from .adapters import HIST_BOUNDS, a_hist, a_logs, a_spans
from .registry import query

MS = 1_000_000
QS = [0.5, 0.9, 0.99]


def hist(spark: SparkSession, d: str) -> DataFrame:
    return a_hist(read_table(spark, d, "events"))


def logs(spark: SparkSession, d: str) -> DataFrame:
    return L.log_labels(a_logs(read_table(spark, d, "events")))


def spans(spark: SparkSession, d: str) -> DataFrame:
    return a_spans(read_table(spark, d, "orders"), read_table(spark, d, "lineitem"))


# ---------------------------------------------------------------- oracle SQL pieces

_idx_cases = " ".join(f"WHEN value <= {b} THEN {i}" for i, b in enumerate(HIST_BOUNDS))
_bvals = ", ".join(f"({i}, {float(b)})" for i, b in enumerate(HIST_BOUNDS)) + f", ({len(HIST_BOUNDS)}, 'inf'::DOUBLE)"
HIST_SQL = f"""e AS (
  SELECT event_type AS metric, CAST(user_id % 8 AS VARCHAR) AS pod,
         epoch_us(ts) * 1000 - (epoch_us(ts) * 1000) % 86400000000000 + 86400000000000 AS ts_ns, value,
         CASE {_idx_cases} ELSE {len(HIST_BOUNDS)} END AS idx
  FROM events),
b AS (SELECT * FROM (VALUES {_bvals}) t(i, le)),
p AS (SELECT DISTINCT metric, pod, ts_ns FROM e),
c AS (
  SELECT p.metric, p.pod, p.ts_ns, b.i, b.le, count(e.idx) AS cum
  FROM p JOIN b ON TRUE
  LEFT JOIN e ON e.metric = p.metric AND e.pod = p.pod AND e.ts_ns = p.ts_ns AND e.idx <= b.i
  GROUP BY p.metric, p.pod, p.ts_ns, b.i, b.le)"""

LOGS_SQL = """l AS (
  SELECT event_id AS log_id, epoch_us(ts) * 1000 AS ts_ns,
         'svc-' || CAST(user_id % 8 AS VARCHAR) AS service_name, event_type AS log_type,
         CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'WARN' ELSE 'INFO' END
           AS detected_level,
         'app.' || event_type AS logger, props AS body,
         CASE WHEN event_type = 'purchase' THEN 'o' || CAST(event_id AS VARCHAR) END AS trace_id
  FROM events)"""

G = f"""g AS (SELECT range AS j, {P.START_NS} + range * {P.STEP_NS} AS t_ns FROM range(0, {P.N_POINTS}))"""

SPANS_SQL = f"""li AS (
  SELECT 'o' || CAST(l_orderkey AS VARCHAR) AS trace_id, 'SELECT lineitem' AS name, 3 AS kind,
         epoch_us(o_orderdate) * 1000 + l_linenumber * {MS} AS start_ns,
         CAST(trunc(l_quantity * {10 * MS}) AS BIGINT) AS duration_ns,
         CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS status_code,
         CAST(l_partkey AS VARCHAR) AS part, 'svc-' || CAST(o_custkey % 8 AS VARCHAR) AS svc
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ro AS (
  SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS trace_id, 'POST /orders' AS name, 2 AS kind,
         epoch_us(o_orderdate) * 1000 AS start_ns,
         CAST(trunc(o_totalprice * {MS}) AS BIGINT) AS duration_ns,
         CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS status_code,
         'svc-' || CAST(o_custkey % 8 AS VARCHAR) AS svc
  FROM orders)"""


# ---------------------------------------------------------------- histograms

@query("hist_buckets", f"""WITH {HIST_SQL}
SELECT metric, pod, ts_ns, le, cum FROM c""")
def q_hist_buckets(spark, d):
    return H.cumulative_buckets(hist(spark, d), keep=["metric", "pod", "ts_ns"])


@query("hist_quantile", f"""WITH {HIST_SQL},
h AS (SELECT metric, ts_ns, i, le, sum(cum) AS cum FROM c GROUP BY metric, ts_ns, i, le),
tot AS (SELECT metric, ts_ns, max(cum) FILTER (WHERE i = {len(HIST_BOUNDS)}) AS tot FROM h GROUP BY metric, ts_ns),
qs AS (SELECT unnest({QS}::DOUBLE[]) AS q),
hit AS (
  SELECT h.metric, h.ts_ns, qs.q, tot.tot, min(h.i) FILTER (WHERE h.cum >= qs.q * tot.tot) AS hi
  FROM h JOIN tot ON h.metric = tot.metric AND h.ts_ns = tot.ts_ns JOIN qs ON TRUE
  GROUP BY h.metric, h.ts_ns, qs.q, tot.tot)
SELECT hit.metric AS event_type, hit.ts_ns, hit.q,
       round(CASE WHEN hit.tot = 0 THEN NULL
                  WHEN hit.hi = {len(HIST_BOUNDS)} THEN {float(HIST_BOUNDS[-1])}
                  WHEN up.cum = coalesce(lo.cum, 0) THEN up.le
                  ELSE coalesce(lo.le, 0) + (up.le - coalesce(lo.le, 0)) * (hit.q * hit.tot - coalesce(lo.cum, 0))
                       / (up.cum - coalesce(lo.cum, 0)) END, 6) AS value
FROM hit JOIN h up ON up.metric = hit.metric AND up.ts_ns = hit.ts_ns AND up.i = hit.hi
LEFT JOIN h lo ON lo.metric = hit.metric AND lo.ts_ns = hit.ts_ns AND lo.i = hit.hi - 1""")
def q_hist_quantile(spark, d):
    r = H.histogram_quantile(hist(spark, d), QS, by=["metric"])
    return r.select(F.col("metric").alias("event_type"), "ts_ns", "q", F.round("value", 6).alias("value"))


@query("hist_series", f"""WITH {HIST_SQL},
pts AS (SELECT metric, pod, ts_ns, count(*) AS n, sum(value) AS s FROM e GROUP BY metric, pod, ts_ns)
SELECT metric || '_bucket' AS name, pod, ts_ns,
       CASE WHEN le = 'inf'::DOUBLE THEN '+Inf' ELSE CAST(CAST(le AS BIGINT) AS VARCHAR) END AS le,
       CAST(cum AS DOUBLE) AS value FROM c
UNION ALL SELECT metric || '_count', pod, ts_ns, NULL, CAST(n AS DOUBLE) FROM pts
UNION ALL SELECT metric || '_sum', pod, ts_ns, NULL, round(s, 6) FROM pts""")
def q_hist_series(spark, d):
    r = H.histogram_series(hist(spark, d), keep=["pod"])
    return r.select("name", "pod", "ts_ns", "le", F.round("value", 6).alias("value"))


# ---------------------------------------------------------------- logs

@query("log_labels", f"""WITH {LOGS_SQL}
SELECT log_id, service_name, log_type, detected_level, logger FROM l""")
def q_log_labels(spark, d):
    x = logs(spark, d)
    return x.select("log_id", *[F.col("stream")[k].alias(k) for k in L.LOG_LABEL_SOURCE])


@query("log_count_by_level", f"""WITH {LOGS_SQL}, {G}
SELECT CAST(g.t_ns // 1000000000 AS BIGINT) AS t, detected_level, CAST(count(*) AS DOUBLE) AS value
FROM l JOIN g ON l.ts_ns >= g.t_ns - {P.LOG_RANGE_NS} AND l.ts_ns < g.t_ns
WHERE regexp_full_match(service_name, 'svc-[0-3]')
GROUP BY g.t_ns, detected_level""", headline=True)
def q_log_count_by_level(spark, d):
    x = logs(spark, d).filter(F.col("stream")["service_name"].rlike("^(?:svc-[0-3])$"))
    return L.log_count(x, P.GRID, P.LOG_RANGE, ["detected_level"]).select("t", "detected_level", "value")


@query("log_rate_by_type", f"""WITH {LOGS_SQL}, {G}
SELECT CAST(g.t_ns // 1000000000 AS BIGINT) AS t, log_type,
       round(count(*) / {P.LOG_RANGE_NS / 1e9}, 9) AS value
FROM l JOIN g ON l.ts_ns >= g.t_ns - {P.LOG_RANGE_NS} AND l.ts_ns < g.t_ns
WHERE detected_level = 'INFO'
GROUP BY g.t_ns, log_type""")
def q_log_rate_by_type(spark, d):
    x = logs(spark, d).filter(F.col("stream")["detected_level"] == "INFO")
    r = L.log_rate(x, P.GRID, P.LOG_RANGE, ["log_type"])
    return r.select("t", "log_type", F.round("value", 9).alias("value"))


@query("count_streams", f"""WITH {LOGS_SQL}
SELECT count(DISTINCT (service_name, log_type, detected_level, logger)) AS n_streams,
       count(DISTINCT trace_id) AS n_traces FROM l""")
def q_count_streams(spark, d):
    return L.count_streams(logs(spark, d))


@query("label_probe", f"""WITH {LOGS_SQL}
SELECT coalesce(bool_or(trace_id IS NOT NULL AND trace_id <> ''), false) AS has_trace_id,
       coalesce(bool_or(body IS NOT NULL AND body <> ''), false) AS has_body,
       coalesce(bool_or(detected_level IS NOT NULL AND detected_level <> ''), false) AS has_severity_text
FROM l""")
def q_label_probe(spark, d):
    return L.any_non_empty(logs(spark, d), ["trace_id", "body", "severity_text"])


@query("newest_logs", f"""WITH {LOGS_SQL}
SELECT log_id, ts_ns, detected_level AS severity_text, body FROM l ORDER BY ts_ns DESC, log_id DESC LIMIT 10""")
def q_newest_logs(spark, d):
    return L.newest(logs(spark, d), 10, tie="log_id").select("log_id", "ts_ns", "severity_text", "body")


@query("first_non_empty_level", f"""WITH {LOGS_SQL}
SELECT min(detected_level) AS first_severity_text FROM l WHERE detected_level <> ''""")
def q_first_non_empty_level(spark, d):
    return L.first_non_empty(logs(spark, d), "severity_text")


@query("body_fields", f"""WITH {LOGS_SQL}
SELECT log_type, count(*) AS n, CAST(sum(TRY_CAST(json_extract(body, '$.k') AS INTEGER)) AS BIGINT) AS k_sum,
       round(avg(TRY_CAST(json_extract(body, '$.k') AS INTEGER)), 6) AS k_avg
FROM l GROUP BY log_type""")
def q_body_fields(spark, d):
    x = L.json_fields(logs(spark, d), "body", "k INT")
    return (x.groupBy(F.col("attrs")["log_type"].alias("log_type"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("fields.k").cast("bigint").alias("k_sum"),
                 F.round(F.avg("fields.k"), 6).alias("k_avg")))


# ---------------------------------------------------------------- traces

@query("select_spans", f"""WITH {SPANS_SQL}
SELECT trace_id, start_ns, duration_ns, part FROM li
WHERE duration_ns >= 100000000 AND status_code = 2""")
def q_select_spans(spark, d):
    s = T.select_spans(spans(spark, d), [("span.db.system", "=", "postgresql"), ("duration", ">=", "100ms"),
                                         ("status", "=", "error")])
    return s.select("trace_id", "start_ns", (F.col("end_ns") - F.col("start_ns")).alias("duration_ns"),
                    F.col("attrs")["part"].alias("part"))


@query("span_roots", f"""WITH {SPANS_SQL}
SELECT li.trace_id, li.name, li.kind, li.start_ns, ro.name AS rootName, ro.svc AS rootServiceName
FROM li LEFT JOIN ro ON li.trace_id = ro.trace_id
UNION ALL SELECT trace_id, name, kind, start_ns, name, svc FROM ro""")
def q_span_roots(spark, d):
    r = T.root_attributes(spans(spark, d))
    return r.select("trace_id", "name", F.col("kind").cast("int").alias("kind"), "start_ns", "rootName",
                    "rootServiceName")


@query("logs_with_spans", f"""WITH {LOGS_SQL}, {SPANS_SQL}
SELECT l.log_id, l.trace_id, ro.name AS span_name, ro.duration_ns AS span_duration_ns FROM l
LEFT JOIN ro ON l.trace_id = ro.trace_id""")
def q_logs_with_spans(spark, d):
    j = T.logs_with_spans(logs(spark, d), spans(spark, d))
    return j.select("log_id", "trace_id", "span_name", "span_duration_ns")
