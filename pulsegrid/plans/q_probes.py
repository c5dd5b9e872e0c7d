"""Probes driven by a table (AG-10), every outcome of label and name checks (JN-5, JN-7, ST-3), trace
selection by root attributes (PF-9), and the sinks read back (SNK-1, SNK-2)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import coverage as C
from ..operators import probes as PR
from ..operators import traces as T
from ..sources import sinks
from ..session import checkpoint_dir
from ..sources.tables import read_table
from . import params as P
from .adapters import a_samples
from .q_corpus import DASHBOARD_METRICS, LINT_SQL, TG_SQL, lint_findings, routed
from .q_signals import LOGS_SQL, SPANS_SQL, logs, spans
from .registry import query

FOREVER = 1 << 62
DAY_NS = 86_400 * 10**9


def folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/pulsegrid-sinks/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- AG-10

def _matchers(*ms: str):
    return F.array(*[F.struct(F.lit(label).alias("label"), op.alias("op"), value.alias("value")) for label, op, value in ms])


def probe_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Probes derived from ``events``: 16 per event type for samples, 16 for logs, 16 for traces. Samples
    take all four matchers, logs a time range each, odd traces have no equality to look up by."""
    ev = read_table(spark, d, "events").select("event_type", (F.col("user_id") % 16).alias("k"))
    k, r = F.col("k").cast("string"), F.col("k") % 4
    band = F.concat(F.lit("[0-"), (F.col("k") % 8).cast("string"), F.lit("]"))
    op = F.when(r == 0, "=").when(r == 1, "!=").when(r == 2, "=~").otherwise("!~")
    prom = ev.distinct().select(
        F.concat(F.lit("metric "), "event_type", F.lit(" "), k).alias("query"), F.lit("prometheus").alias("lang"),
        _matchers(("__name__", F.lit("="), F.col("event_type")), ("pod", op, F.when(r < 2, k).otherwise(band)))
        .alias("matchers"), F.lit(P.START_NS).alias("start_ns"), F.lit(P.END_NS).alias("end_ns"))
    ks = ev.select("k").distinct()
    loki = ks.select(
        F.concat(F.lit("log "), k).alias("query"), F.lit("loki").alias("lang"),
        _matchers(("log_type", F.lit("=~"), F.lit("view|err.*")),
                  ("service_name", F.lit("="), F.concat(F.lit("svc-"), k))).alias("matchers"),
        (F.lit(P.START_NS) + F.col("k") * DAY_NS).alias("start_ns"),
        (F.lit(P.START_NS) + (F.col("k") + 10) * DAY_NS).alias("end_ns"))
    root = ("rootName", F.lit("=~"), F.lit("POST.*"))
    long_ = ("duration", F.lit(">="), (F.col("k") * 30_000_000).cast("string"))
    tempo = ks.select(
        F.concat(F.lit("trace "), k).alias("query"), F.lit("tempo").alias("lang"),
        F.when(F.col("k") % 2 == 1, _matchers(root, long_, ("status", F.lit("="), F.lit("")))).otherwise(
            _matchers(root, long_, ("resource.service.name", F.lit("="), F.concat(F.lit("svc-"), k)),
                      ("span.part", F.lit("!="), F.lit("")))).alias("matchers"),
        F.lit(0).cast("long").alias("start_ns"), F.lit(FOREVER).alias("end_ns"))
    # odd traces: status is never empty, so the matcher is turned round to keep them non-empty
    tempo = tempo.withColumn("matchers", F.transform("matchers", lambda m: F.struct(
        m["label"].alias("label"), F.when(m["label"] == "status", "!=").otherwise(m["op"]).alias("op"),
        m["value"].alias("value"))))
    return prom.unionByName(loki).unionByName(tempo)


@query("probe_selectors", f"""WITH {LOGS_SQL}, {SPANS_SQL},
ks AS (SELECT DISTINCT user_id % 16 AS k FROM events),
pc AS (SELECT DISTINCT event_type, user_id % 16 AS k FROM events),
ms AS (SELECT 'metric ' || pc.event_type || ' ' || CAST(pc.k AS VARCHAR) AS query, e.user_id, epoch_us(e.ts) * 1000 AS tm, e.value
       FROM pc JOIN events e ON e.event_type = pc.event_type
        AND epoch_us(e.ts) * 1000 >= {P.START_NS} AND epoch_us(e.ts) * 1000 < {P.END_NS}
        AND CASE pc.k % 4 WHEN 0 THEN e.user_id % 8 = pc.k WHEN 1 THEN e.user_id % 8 <> pc.k
                          WHEN 2 THEN e.user_id % 8 <= pc.k % 8 ELSE e.user_id % 8 > pc.k % 8 END),
m AS (SELECT query, count(DISTINCT user_id) AS n_series, count(*) AS n_rows, arg_min(value, (tm, value)) AS first_value
      FROM ms GROUP BY query),
lg AS (SELECT 'log ' || CAST(k AS VARCHAR) AS query, count(DISTINCT (service_name, log_type, detected_level, logger)) AS n_series,
              count(*) AS n_rows, CAST(NULL AS DOUBLE) AS first_value
       FROM ks JOIN l ON service_name = 'svc-' || CAST(k AS VARCHAR) AND (log_type = 'view' OR log_type LIKE 'err%')
        AND ts_ns >= {P.START_NS} + k * {DAY_NS} AND ts_ns < {P.START_NS} + (k + 10) * {DAY_NS} GROUP BY 1),
sp AS (SELECT trace_id, svc, duration_ns, part FROM li UNION ALL SELECT trace_id, svc, duration_ns, NULL FROM ro),
t AS (SELECT 'trace ' || CAST(k AS VARCHAR) AS query, count(DISTINCT trace_id) AS n_series, count(*) AS n_rows,
             CAST(NULL AS DOUBLE) AS first_value
      FROM ks JOIN sp ON duration_ns >= k * 30000000
       AND (k % 2 = 1 OR (svc = 'svc-' || CAST(k AS VARCHAR) AND part IS NOT NULL)) GROUP BY 1),
f AS (SELECT * FROM m UNION ALL SELECT * FROM lg UNION ALL SELECT * FROM t),
c AS (SELECT 'metric ' || event_type || ' ' || CAST(k AS VARCHAR) AS query FROM pc
      UNION ALL SELECT 'log ' || CAST(k AS VARCHAR) FROM ks UNION ALL SELECT 'trace ' || CAST(k AS VARCHAR) FROM ks)
SELECT c.query, coalesce(n_series, 0) AS n_series, coalesce(n_rows, 0) AS n_rows, first_value,
       CASE WHEN coalesce(n_rows, 0) > 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM c LEFT JOIN f ON c.query = f.query""")
def q_probe_selectors(spark, d):
    signals = (PR.metric_signals(a_samples(read_table(spark, d, "events")))
               .unionByName(PR.log_signals(logs(spark, d)))
               .unionByName(PR.span_signals(T.root_attributes(spans(spark, d)))))
    return PR.probe_selectors(signals, probe_catalog(spark, d))


# ---------------------------------------------------------------- JN-5, JN-7, ST-3: all outcomes

LABEL_SOURCE = """CASE user_id % 6 WHEN 0 THEN 'attribute:key.' || CAST(user_id AS STRING)
  WHEN 1 THEN 'attribute:key.' || CAST(user_id AS STRING) WHEN 2 THEN 'resource:service' WHEN 3 THEN 'builtin:severityText'
  WHEN 4 THEN 'header:x' ELSE 'resource:key.' || CAST(user_id AS STRING) END"""


def _label_sql(cond: str) -> str:
    return f"""WITH u AS (SELECT DISTINCT user_id, {LABEL_SOURCE} AS source FROM events),
w AS (SELECT 'l' || CAST(user_id AS VARCHAR) AS label, split_part(source, ':', 1) AS scope, split_part(source, ':', 2) AS key FROM u),
a AS (SELECT DISTINCT 'attribute' AS scope, 'key.' || CAST(user_id AS VARCHAR) AS key FROM events WHERE user_id % 2 = 0
      UNION ALL SELECT 'resource', 'service.name' UNION ALL SELECT 'builtin', 'severityText')
SELECT 'log_label' AS "check", label AS subject,
       CASE WHEN scope = 'header' THEN 'WARN' WHEN EXISTS (SELECT 1 FROM a WHERE a.scope = w.scope AND {cond}) THEN 'PASS'
            ELSE 'FAIL' END AS status,
       CASE WHEN scope = 'header' THEN 'unknown source' ELSE scope || '.' || key END AS detail FROM w"""


def _label_outcomes(spark: SparkSession, d: str, mode: str) -> DataFrame:
    u = read_table(spark, d, "events").select("user_id").distinct()
    labels = u.select(F.concat(F.lit("l"), F.col("user_id").cast("string")).alias("label"), F.expr(LABEL_SOURCE).alias("source"))
    keys = (u.filter("user_id % 2 = 0").select(F.lit("attribute").alias("scope"),
                                              F.concat(F.lit("key."), F.col("user_id").cast("string")).alias("key"))
            .unionByName(C.literal_table(spark, [("resource", "service.name")], "scope string, key string")))
    return C.label_coverage(labels, keys, C.literal_table(spark, [("severityText",)], "field string"), mode)


@query("label_outcomes", _label_sql("a.key = w.key"))
def q_label_outcomes(spark, d):
    return _label_outcomes(spark, d, "equal")


@query("label_outcomes_substring", _label_sql("contains(a.key, w.key)"))
def q_label_outcomes_substring(spark, d):
    return _label_outcomes(spark, d, "substring")


DYNAMIC = f"""CASE user_id % 5 WHEN 0 THEN event_type || '_total' WHEN 1 THEN event_type || '_duration_seconds_bucket'
  WHEN 2 THEN 'traces_' || event_type WHEN 3 THEN '{DASHBOARD_METRICS[0]}'
  ELSE event_type || '_unseen_' || CAST(user_id AS STRING) END"""


@query("name_outcomes", f"""WITH n AS (SELECT DISTINCT {DYNAMIC} AS name FROM events),
p AS (SELECT DISTINCT event_type || '_total' AS name FROM events UNION SELECT event_type || '_duration_seconds' FROM events),
c AS (SELECT name, CASE WHEN name = '{DASHBOARD_METRICS[0]}' THEN 'known'
                        WHEN name LIKE '%\\_bucket' ESCAPE '\\' AND regexp_replace(name, '_bucket$', '') IN (SELECT name FROM p)
                          THEN 'histogram_part'
                        WHEN regexp_matches(name, '{C.INFRA_METRIC_RE}') THEN 'infrastructure'
                        WHEN name IN (SELECT name FROM p) THEN 'provided' ELSE 'unverified' END AS class FROM n)
SELECT 'dynamic_metric' AS "check", name AS subject, CASE WHEN class = 'unverified' THEN 'WARN' ELSE 'PASS' END AS status,
       class AS detail FROM c""")
def q_name_outcomes(spark, d):
    ev = read_table(spark, d, "events")
    dynamic = ev.select(F.expr(DYNAMIC).alias("name"))
    known = C.literal_table(spark, [(DASHBOARD_METRICS[0],)], "name string")
    provided = ev.select(F.explode(F.array(F.concat("event_type", F.lit("_total")),
                                           F.concat("event_type", F.lit("_duration_seconds")))).alias("name"))
    return C.name_findings(C.classify_names(dynamic, known, provided))


@query("types_or_default", """SELECT 'refund' AS event_type WHERE EXISTS (SELECT 1 FROM events WHERE event_type = 'refund')
UNION ALL SELECT n_name FROM nation WHERE NOT EXISTS (SELECT 1 FROM events WHERE event_type = 'refund')""")
def q_types_or_default(spark, d):
    found = read_table(spark, d, "events").filter("event_type = 'refund'").select("event_type").distinct()
    return C.or_default(found, read_table(spark, d, "nation").select(F.col("n_name").alias("event_type")))


# ---------------------------------------------------------------- PF-9

@query("select_by_root", f"""WITH {SPANS_SQL}
SELECT trace_id, start_ns, duration_ns FROM li WHERE svc IN ('svc-1', 'svc-3') AND trace_id <> 'o1' AND status_code = 2""")
def q_select_by_root(spark, d):
    s = T.select_spans(T.root_attributes(spans(spark, d)), [
        ("rootName", "=", "POST /orders"), ("rootServiceName", "=~", "svc-[13]"), ("traceID", "!=", "o1"),
        ("spanID", "=~", "l.*"), ("status", "=", "error")])
    return s.select("trace_id", "start_ns", (F.col("end_ns") - F.col("start_ns")).alias("duration_ns"))


# ---------------------------------------------------------------- SNK-1, SNK-2

@query("written_targets", rf"""WITH {TG_SQL},
q AS (SELECT DISTINCT lang, regexp_extract(path, '([^/]+)\.json$', 1) AS dashboard, text AS line FROM rt
      WHERE lang IS NOT NULL AND text IS NOT NULL AND text <> '')
SELECT lang, dashboard, false AS header, line FROM q
UNION ALL SELECT DISTINCT lang, dashboard, true, '# ' || dashboard FROM q""")
def q_written_targets(spark, d):
    path = folder(spark, "targets")
    sinks.write_targets(routed(spark, d).filter("lang is not null and text <> ''"), path)
    return spark.read.schema("dashboard string, header boolean, line string, lang string").parquet(path)


@query("written_report", f"""WITH {LINT_SQL}
SELECT count(*) FILTER (WHERE status = 'PASS') AS pass, count(*) FILTER (WHERE status = 'FAIL') AS fail,
       count(*) FILTER (WHERE status = 'WARN') AS warn, count(*) FILTER (WHERE status = 'SKIP') AS skip,
       count(*) AS total FROM allf""")
def q_written_report(spark, d):
    return sinks.write_report(lint_findings(spark, d), folder(spark, "report"), "run-1")
