"""Source queries: OTLP metrics / logs / traces decoding, JMX relabelling, time rebasing
(SRC-1..3, SRC-7, SC-1, SC-2, SC-8, SC-18, DD-2)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions import histograms as H
from ..functions.time import to_epoch_ns
from ..operators import traces as T
from ..sources import jmx
from ..sources import otlp as O
from ..sources.tables import read_table
from .adapters import HIST_BOUNDS, a_spans
from .otlp_adapter import BEAN_SQL, a_beans, a_otlp_logs, a_otlp_metrics, a_otlp_spans
from .q_signals import LOGS_SQL, SPANS_SQL
from .registry import query

MS = 1_000_000
REBASE_NOW = "2024-02-01 00:00:00"


def otlp_metrics(spark: SparkSession, d: str):
    return O.parse_otlp_metrics(a_otlp_metrics(read_table(spark, d, "events")), "json")


@query("otlp_samples", """SELECT
  CASE event_type WHEN 'view' THEN 'app_view_requests_total' WHEN 'signup' THEN 'app_signup_sessions_ratio'
       WHEN 'purchase' THEN 'app_purchase_size_bytes' ELSE 'app_error_latency_milliseconds' END AS metric,
  CASE event_type WHEN 'view' THEN 'counter' WHEN 'signup' THEN 'updown' ELSE 'gauge' END AS kind,
  'svc-' || CAST(user_id % 8 AS VARCHAR) AS svc, CAST(user_id AS VARCHAR) AS "user",
  CAST(user_id % 8 AS VARCHAR) AS pod, CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END AS sampled,
  epoch_us(ts) * 1000 AS ts_ns,
  CASE WHEN event_type = 'error' AND event_id % 89 = 0 THEN NULL
       WHEN event_type IN ('signup', 'error') THEN CAST(CAST(trunc(value) AS BIGINT) AS DOUBLE) ELSE value END AS value,
  (event_type = 'error' AND event_id % 89 = 0) AS rejected
FROM events WHERE event_type <> 'click'""", headline=True)
def q_otlp_samples(spark, d):
    s, _ = otlp_metrics(spark, d)
    lab = F.col("labels")
    return s.select("metric", "kind", lab["service.name"].alias("svc"), lab["user"].alias("user"),
                    lab["pod"].alias("pod"), lab["sampled"].alias("sampled"), "ts_ns", "value", "rejected")


_bv = ", ".join(f"({i}, {float(b)})" for i, b in enumerate(HIST_BOUNDS)) + f", ({len(HIST_BOUNDS)}, 'inf'::DOUBLE)"
_idx = " ".join(f"WHEN value <= {b} THEN {i}" for i, b in enumerate(HIST_BOUNDS))


@query("otlp_hist_buckets", f"""WITH e AS (
  SELECT CAST(user_id AS VARCHAR) AS "user", epoch_us(ts) * 1000 AS ts_ns,
         CASE {_idx} ELSE {len(HIST_BOUNDS)} END AS idx FROM events WHERE event_type = 'click'),
b AS (SELECT * FROM (VALUES {_bv}) t(i, le))
SELECT 'app_click_duration_seconds' AS metric, "user", ts_ns, b.le, CAST(CASE WHEN idx <= b.i THEN 1 ELSE 0 END AS BIGINT)
       AS cum FROM e JOIN b ON TRUE""")
def q_otlp_hist_buckets(spark, d):
    _, h = otlp_metrics(spark, d)
    h = h.withColumn("user", F.col("labels")["user"])
    return H.cumulative_buckets(h, keep=["metric", "user", "ts_ns"])


@query("exemplar_spans", f"""SELECT 'app_click_duration_seconds' AS metric, epoch_us(ts) * 1000 AS ts_ns, value,
       o.o_orderkey IS NOT NULL AS has_span,
       CASE WHEN o.o_orderkey IS NOT NULL THEN 'POST /orders' END AS span_name,
       CAST(trunc(o.o_totalprice * {MS}) AS BIGINT) AS span_duration_ns
FROM events e LEFT JOIN orders o ON o.o_orderkey = e.event_id
WHERE e.event_type = 'click' AND e.event_id % 3 = 0""")
def q_exemplar_spans(spark, d):
    _, h = otlp_metrics(spark, d)
    ex = O.exemplars(h)
    j = T.exemplar_spans(ex, a_spans(read_table(spark, d, "orders"), read_table(spark, d, "lineitem")))
    return j.select("metric", "ts_ns", "value", F.col("name").isNotNull().alias("has_span"),
                    F.col("name").alias("span_name"), F.col("duration_ns").alias("span_duration_ns"))


@query("otlp_logs", f"""WITH {LOGS_SQL}
SELECT l.ts_ns, CASE detected_level WHEN 'ERROR' THEN 17 WHEN 'WARN' THEN 13 ELSE 9 END AS severity_number,
       detected_level AS severity_text, body, service_name, log_type, trace_id FROM l""")
def q_otlp_logs(spark, d):
    lg = O.parse_otlp_logs(a_otlp_logs(read_table(spark, d, "events")), "json")
    return lg.select("ts_ns", "severity_number", "severity_text", "body",
                     F.col("res")["service.name"].alias("service_name"), F.col("attrs")["log_type"].alias("log_type"),
                     "trace_id")


@query("otlp_spans", f"""WITH {SPANS_SQL}
SELECT trace_id, false AS is_root, name, kind, start_ns, duration_ns, status_code, svc FROM li
UNION ALL SELECT trace_id, true, name, kind, start_ns, duration_ns, status_code, svc FROM ro""")
def q_otlp_spans(spark, d):
    sp = a_spans(read_table(spark, d, "orders"), read_table(spark, d, "lineitem"))
    dec = O.parse_otlp_spans(a_otlp_spans(sp), "json")
    return dec.select("trace_id", F.col("parent_id").isNull().alias("is_root"), "name", "kind", "start_ns",
                      (F.col("end_ns") - F.col("start_ns")).alias("duration_ns"), "status_code",
                      F.col("res")["service.name"].alias("svc"))


def _jmx_sql(extra: bool = False) -> str:
    """Oracle: the same rule table evaluated with DuckDB regexes."""
    import re

    branches = []
    for i, (pat, name_t, typ, labs) in enumerate(jmx.KAFKA_RULES):
        w = f"^.*(?:{pat}).*$"

        def tmpl(t):
            parts, pos = [], 0
            for m in re.finditer(r"\$(\d+)", t):
                if m.start() > pos:
                    parts.append("'" + t[pos:m.start()] + "'")
                parts.append(f"regexp_extract(line, '{w}', {m.group(1)})")
                pos = m.end()
            if pos < len(t):
                parts.append("'" + t[pos:] + "'")
            return " || ".join(parts)

        # the value does not follow from the rule table: it is what stands after the line's last colon
        val = "TRY_CAST(trim(list_extract(string_split(line, ':'), -1)) AS DOUBLE)"
        name = f"lower(regexp_replace(regexp_replace({tmpl(name_t)}, '[^a-zA-Z0-9:_]', '_', 'g'), '__+', '_', 'g'))"
        lab = {k.lower(): tmpl(v) for k, v in labs.items()}
        branches.append((w, i, name, typ, lab, val))
    keys = ["clientid", "topic", "partition", "broker", "request", "name"]

    def case(expr_of):
        return "CASE " + " ".join(f"WHEN regexp_matches(line, '{b[0]}') THEN {expr_of(b)}" for b in branches) + " END"

    cols = [case(lambda b: str(b[1])) + " AS rule", case(lambda b: b[2]) + " AS metric",
            case(lambda b: f"'{b[3]}'") + " AS type", case(lambda b: b[5]) + " AS value"]
    cols += [case(lambda b, k=k: b[4].get(k, "NULL")) + f" AS l_{k}" for k in keys]
    if extra:
        return (f"x AS (SELECT event_id, user_id, epoch_us(ts) * 1000 AS ts_ns, {BEAN_SQL} AS line FROM events),\n"
                f"jx AS (SELECT event_id, user_id, ts_ns, {', '.join(cols)} FROM x)")
    return (f"WITH x AS (SELECT event_id, {BEAN_SQL} AS line FROM events)\n"
            f"SELECT event_id, {', '.join(cols)} FROM x")


@query("jmx_relabel", _jmx_sql())
def q_jmx_relabel(spark, d):
    r = jmx.relabel(a_beans(read_table(spark, d, "events")))
    lab = F.col("labels")
    return r.select("event_id", "rule", F.col("name").alias("metric"), "type", "value",
                    *[lab[k].alias(f"l_{k}") for k in ["clientid", "topic", "partition", "broker", "request", "name"]])


@query("rebased_events", f"""SELECT event_id,
  epoch_us(ts) * 1000 + ({to_epoch_ns(REBASE_NOW)} - max(epoch_us(ts) * 1000) OVER ()) AS ts_ns FROM events""")
def q_rebased_events(spark, d):
    from ..functions.time import epoch_ns

    ev = read_table(spark, d, "events").select("event_id", epoch_ns("ts").alias("ts_ns"))
    return O.rebase_times(ev, to_epoch_ns(REBASE_NOW))
