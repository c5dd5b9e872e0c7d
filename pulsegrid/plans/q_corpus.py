"""Query-corpus queries: extraction, routing, substitution, lint checks, token coverage
(SRC-4/5, PF-3..7, SC-3..7, SC-11, SC-16, SC-19, LT-1..8, JN-7, ST-1..3, AG-8/9/14, WN-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions.plan import settled
from ..functions.templates import substitute, substitute_sql
from ..operators import coverage as C
from ..operators import lint as LT
from ..operators.relational import distinct_sorted
from ..sources import corpus as S
from ..sources.tables import read_table
from . import corpus_adapter as A
from .registry import query

# Metrics the dashboards are known to need.
DASHBOARD_METRICS = [
    "http_server_request_duration_seconds", "app_http_server_active_requests", "jvm_memory_used_bytes",
    "jvm_memory_limit_bytes", "jvm_memory_committed_bytes", "jvm_memory_used_after_last_gc_bytes",
    "jvm_gc_duration_seconds", "jvm_thread_count", "jvm_cpu_recent_utilization_ratio", "jvm_cpu_count",
    "jvm_cpu_time_seconds_total", "jvm_system_cpu_utilization_ratio", "jvm_buffer_memory_used_bytes",
    "jvm_buffer_memory_limit_bytes", "jvm_buffer_count", "jvm_class_count", "jvm_class_loaded_total",
    "jvm_class_unloaded_total", "db_client_connections_usage", "db_client_connections_max",
    "db_client_connections_pending_requests", "db_client_connections_wait_time_milliseconds",
    "db_client_connections_use_time_milliseconds", "db_client_connections_create_time_milliseconds",
    "process_cpu_start_time_seconds",
]

# Log labels the dashboards use.
DASHBOARD_LOG_LABELS = ["service_name", "log_type", "detected_level", "logger"]

# Default span / resource attributes when no trace query names any.
DEFAULT_SPAN_ATTRS = ["http.request.method", "http.response.status_code", "http.route", "url.path",
                      "db.system", "db.statement", "db.name"]
DEFAULT_RESOURCE_ATTRS = ["service.name", "service.namespace", "deployment.environment.name"]


# ---------------------------------------------------------------- Spark plans

def docs(spark: SparkSession, d: str) -> DataFrame:
    return A.a_dashboards(read_table(spark, d, "events"))


def targets(spark: SparkSession, d: str) -> DataFrame:
    return S.dashboard_targets(docs(spark, d))


def routed(spark: SparkSession, d: str) -> DataFrame:
    return S.route_targets(targets(spark, d))


def rules(spark: SparkSession, d: str) -> DataFrame:
    return S.load_rules(A.a_rule_files(read_table(spark, d, "events")))


def lint_findings(spark: SparkSession, d: str) -> DataFrame:
    return C.union_findings(
        LT.corpus_findings(spark, S.document_rows(docs(spark, d))),
        LT.check_tags(spark, settled(A.a_ds_tags(read_table(spark, d, "events")))),
        LT.check_rule_lines(spark, settled(rules(spark, d))))


# ---------------------------------------------------------------- oracle SQL pieces

TG_SQL = f"""ev AS (SELECT *, {A.PATH} AS path, {A.INVALID} AS invalid FROM events),
tg AS (
  SELECT path, {A.PANEL1_ID} AS panel_id, {A.DS_TYPE} AS ds_type, {A.DS_UID} AS ds_uid, 'A' AS ref,
         {A.EXPR1} AS expr, {A.QUERY1} AS query FROM ev WHERE NOT invalid
  UNION ALL
  SELECT path, {A.PANEL2_ID}, 'prometheus', 'prometheus', 'A', {A.EXPR2}, NULL FROM ev WHERE NOT invalid),
rt AS (
  SELECT *, CASE WHEN lang = 'traceql' THEN query WHEN lang IS NOT NULL THEN expr END AS text FROM (
    SELECT *, CASE WHEN ds_type = 'prometheus' OR ds_uid = 'prometheus' THEN 'promql'
                   WHEN ds_type = 'loki' OR ds_uid = 'loki' THEN 'logql'
                   WHEN ds_type = 'tempo' OR ds_uid = 'tempo' THEN 'traceql' END AS lang FROM tg))"""

_checks = ", ".join(f"('{c[0]}')" for c in LT.TARGET_CHECKS)
LINT_T_SQL = rf"""vt AS (
  SELECT 'traceql_variable_regex' AS "check", path AS subject, 'FAIL' AS status, text AS detail FROM rt
    WHERE text <> '' AND lang = 'traceql' AND regexp_matches(text, '=~"\$')
  UNION ALL SELECT 'traceql_unscoped_kind', path, 'FAIL', text FROM rt
    WHERE text <> '' AND lang = 'traceql' AND regexp_matches(replace(text, 'span.kind', ''), 'kind\s*=')
  UNION ALL SELECT 'logql_detected_level', path, 'FAIL', text FROM rt
    WHERE text <> '' AND lang = 'logql' AND regexp_matches(text, '\|\s*level\s*=~?') AND NOT contains(text, 'detected_level')
  UNION ALL SELECT 'promql_histogram_by_le', path, 'FAIL', text FROM rt
    WHERE text <> '' AND lang = 'promql' AND regexp_matches(text, 'histogram_quantile\(')
      AND NOT regexp_matches(text, 'by\s*\([^)]*\ble\b[^)]*\)')),
lt AS (
  SELECT * FROM vt UNION ALL
  SELECT "check", '*', 'PASS', 'no violation' FROM (VALUES {_checks}) c("check")
    WHERE "check" NOT IN (SELECT "check" FROM vt))"""

_allowed = ", ".join("'" + u + "'" for u in LT.ALLOWED_UIDS)
LINT_SQL = TG_SQL + ",\n" + LINT_T_SQL + f""",
lj AS (SELECT 'json_valid' AS "check", path AS subject, CASE WHEN invalid THEN 'FAIL' ELSE 'PASS' END AS status,
              CASE WHEN invalid THEN 'parse error' ELSE '' END AS detail FROM ev),
bad AS (SELECT DISTINCT path, ds_uid FROM tg WHERE ds_uid IS NOT NULL AND ds_uid NOT IN ({_allowed})),
lu AS (SELECT 'datasource_uid' AS "check", ev.path AS subject,
              CASE WHEN bad.ds_uid IS NULL THEN 'PASS' ELSE 'FAIL' END AS status, coalesce(bad.ds_uid, '') AS detail
       FROM (SELECT DISTINCT path FROM ev WHERE NOT invalid) ev LEFT JOIN bad ON ev.path = bad.path),
tags AS (SELECT DISTINCT 'tempo-svc-' || CAST(user_id % 8 AS STRING) AS subject,
                CASE WHEN user_id % 8 = 3 THEN 'service.name' ELSE 'resource.service.name' END AS key FROM events),
lg AS (SELECT 'tempo_tag_scope' AS "check", subject, 'FAIL' AS status, key AS detail FROM tags WHERE key = 'service.name'
       UNION ALL SELECT 'tempo_tag_scope', '*', 'PASS', 'no violation'
       WHERE NOT EXISTS (SELECT 1 FROM tags WHERE key = 'service.name')),
ru AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id),
rl AS (SELECT {A.RULE_PATH} || ':users-' || CAST(user_id % 10 AS STRING) || ':UserErrors' || CAST(user_id AS STRING) AS path,
              string_split('sum(count_over_time({{service_name="svc-' || CAST(user_id % 8 AS STRING) || '"}}' || chr(10)
                           || '  | ' || {A.RULE_LEVEL} || ' [5m]))' || chr(10) || '  > ' || CAST(n AS STRING), chr(10))
                AS lines FROM ru),
ln AS (SELECT path, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM rl),
vr AS (SELECT 'loki_rule_level' AS "check", path || ':' || CAST(i AS STRING) AS subject, 'FAIL' AS status,
              trim(line) AS detail FROM ln
       WHERE contains(line, 'level=') AND NOT contains(line, 'detected_level') AND NOT regexp_matches(line, '^\\s*#')),
lr AS (SELECT * FROM vr UNION ALL SELECT 'loki_rule_level', '*', 'PASS', 'no violation'
       WHERE NOT EXISTS (SELECT 1 FROM vr)),
allf AS (SELECT * FROM lj UNION ALL SELECT * FROM lt UNION ALL SELECT * FROM lu UNION ALL SELECT * FROM lg
         UNION ALL SELECT * FROM lr)"""


# ---------------------------------------------------------------- extraction (SRC-4)

@query("dashboard_targets", f"""WITH {TG_SQL} SELECT path, panel_id, ds_type, ds_uid, ref, expr, query FROM tg""",
       headline=True)
def q_dashboard_targets(spark, d):
    return targets(spark, d)


@query("routed_queries", f"""WITH {TG_SQL}
SELECT path, panel_id, lang, {substitute_sql('text')} AS query,
       CASE WHEN regexp_matches(text, '(rate|count_over_time|sum|avg|topk)\\(') THEN 'instant' ELSE 'range' END AS kind,
       substring({substitute_sql('text')}, 1, 60) AS label
FROM rt WHERE lang IS NOT NULL AND text IS NOT NULL AND text <> ''""")
def q_routed_queries(spark, d):
    r = S.non_empty(routed(spark, d).filter(F.col("lang").isNotNull()), "text")
    q = substitute(F.col("text"))
    return r.select("path", "panel_id", "lang", q.alias("query"), N.query_kind(F.col("text")).alias("kind"),
                    N.truncate_label(q, 60).alias("label"))


@query("rules_loaded", f"""WITH ru AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
SELECT {A.RULE_PATH} AS path, 'users-' || CAST(user_id % 10 AS STRING) AS grp,
       'UserErrors' || CAST(user_id AS STRING) AS alert,
       'sum(count_over_time({{service_name="svc-' || CAST(user_id % 8 AS STRING) || '"}}' || chr(10)
         || '  | ' || {A.RULE_LEVEL} || ' [5m]))' || chr(10) || '  > ' || CAST(n AS STRING) AS expr,
       CASE user_id % 3 WHEN 0 THEN 60000000000 WHEN 1 THEN 300000000000 ELSE 5400000000000 END AS for_ns,
       {A.RULE_SEVERITY} AS severity
FROM ru""")
def q_rules_loaded(spark, d):
    return rules(spark, d).select("path", "grp", "alert", "expr", "for_ns", "severity")


# ---------------------------------------------------------------- lint (LT-1..8)

@query("lint_findings", f"""WITH {LINT_SQL} SELECT * FROM allf""", headline=True)
def q_lint_findings(spark, d):
    return lint_findings(spark, d)


@query("lint_tally", f"""WITH {LINT_SQL}
SELECT "check", count(*) FILTER (WHERE status = 'PASS') AS pass, count(*) FILTER (WHERE status = 'FAIL') AS fail,
       count(*) FILTER (WHERE status = 'WARN') AS warn, count(*) FILTER (WHERE status = 'SKIP') AS skip,
       count(*) AS total FROM allf GROUP BY "check" """)
def q_lint_tally(spark, d):
    return C.tally(lint_findings(spark, d), ["check"])


@query("lint_verdict", f"""WITH {LINT_SQL}
SELECT CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'WARN') THEN 'WARN' ELSE 'PASS' END
       AS verdict FROM allf""")
def q_lint_verdict(spark, d):
    return C.verdict(lint_findings(spark, d))


@query("uid_per_file", f"""WITH {LINT_SQL} SELECT * FROM lu""")
def q_uid_per_file(spark, d):
    dd = docs(spark, d)
    return LT.check_uids(dd, S.dashboard_targets(dd))


# ---------------------------------------------------------------- tokens and coverage of names

_known = ", ".join(f"('{m}')" for m in DASHBOARD_METRICS)
TOK_SQL = TG_SQL + rf""",
tok AS (SELECT DISTINCT name FROM (
          SELECT unnest(regexp_extract_all(expr, '([a-z][a-z_]*[a-z])[{{\s]', 1)) AS name FROM rt
          WHERE lang = 'promql' AND expr <> '') WHERE contains(name, '_'))"""


@query("metric_tokens", f"""WITH {TOK_SQL} SELECT name FROM tok""")
def q_metric_tokens(spark, d):
    r = routed(spark, d).filter((F.col("lang") == "promql") & (F.col("expr") != ""))
    return distinct_sorted(r.select(F.explode(N.metric_tokens(F.col("expr"))).alias("name")), "name")


@query("classify_metric_names", f"""WITH {TOK_SQL},
known AS (SELECT * FROM (VALUES {_known}) t(name)),
prov AS (SELECT DISTINCT event_type || '_total' AS name FROM events
         UNION SELECT DISTINCT event_type || '_duration_seconds' FROM events),
b AS (SELECT name, regexp_replace(regexp_replace(regexp_replace(name, '_bucket$', ''), '_count$', ''), '_sum$', '')
             AS base FROM tok)
SELECT name, CASE WHEN name IN (SELECT name FROM known) THEN 'known'
                  WHEN base <> name AND base IN (SELECT name FROM prov) THEN 'histogram_part'
                  WHEN regexp_matches(name, '{C.INFRA_METRIC_RE}') THEN 'infrastructure'
                  WHEN name IN (SELECT name FROM prov) THEN 'provided'
                  ELSE 'unverified' END AS class
FROM b""")
def q_classify_metric_names(spark, d):
    dyn = q_metric_tokens(spark, d)
    known = C.literal_table(spark, [(m,) for m in DASHBOARD_METRICS], "name string")
    ev = read_table(spark, d, "events")
    prov = (ev.select(F.concat("event_type", F.lit("_total")).alias("name"))
            .unionByName(ev.select(F.concat("event_type", F.lit("_duration_seconds")).alias("name"))))
    return C.classify_names(dyn, known, prov)


_labels = ", ".join(f"('{x}')" for x in DASHBOARD_LOG_LABELS)


@query("unknown_log_labels", rf"""WITH {TG_SQL}
SELECT DISTINCT name FROM (
  SELECT unnest(regexp_extract_all(expr, '([a-z_]+)\s*[=!~]', 1)) AS name FROM rt WHERE lang = 'logql' AND expr <> '')
WHERE name NOT IN (SELECT * FROM (VALUES {_labels}) t(n))""")
def q_unknown_log_labels(spark, d):
    r = routed(spark, d).filter((F.col("lang") == "logql") & (F.col("expr") != ""))
    dyn = r.select(F.explode(N.label_tokens(F.col("expr"))).alias("name"))
    known = C.literal_table(spark, [(x,) for x in DASHBOARD_LOG_LABELS], "name string")
    return C.unknown(dyn, known)


_dspan = ", ".join(f"('span', '{x}')" for x in DEFAULT_SPAN_ATTRS)
_dres = ", ".join(f"('resource', '{x}')" for x in DEFAULT_RESOURCE_ATTRS)


@query("trace_attrs_or_default", rf"""WITH {TG_SQL},
q AS (SELECT query FROM rt WHERE lang = 'traceql' AND query <> ''),
sp AS (SELECT DISTINCT 'span' AS scope, unnest(regexp_extract_all(query, 'span\.([a-z_.]+)', 1)) AS attr FROM q),
rs AS (SELECT DISTINCT 'resource' AS scope, unnest(regexp_extract_all(query, 'resource\.([a-z_.]+)', 1)) AS attr FROM q)
SELECT * FROM sp UNION ALL SELECT * FROM (VALUES {_dspan}) t(scope, attr) WHERE NOT EXISTS (SELECT 1 FROM sp)
UNION ALL SELECT * FROM rs UNION ALL SELECT * FROM (VALUES {_dres}) t(scope, attr) WHERE NOT EXISTS (SELECT 1 FROM rs)""")
def q_trace_attrs_or_default(spark, d):
    r = settled(routed(spark, d).filter((F.col("lang") == "traceql") & (F.col("query") != "")).select("query"))
    sp = r.select(F.lit("span").alias("scope"), F.explode(N.span_attr_tokens("query")).alias("attr")).distinct()
    rs = r.select(F.lit("resource").alias("scope"),
                  F.explode(N.resource_attr_tokens("query")).alias("attr")).distinct()
    dsp = C.literal_table(spark, [("span", x) for x in DEFAULT_SPAN_ATTRS], "scope string, attr string")
    drs = C.literal_table(spark, [("resource", x) for x in DEFAULT_RESOURCE_ATTRS], "scope string, attr string")
    return C.or_default(sp, dsp).unionByName(C.or_default(rs, drs))


# ---------------------------------------------------------------- WN-1 section fill + PF-7

def query_lines(r: DataFrame) -> DataFrame:
    """Extracted-queries files as lines: per language file, a ``# Dashboard:`` header, the
    substituted queries, and a blank line, per dashboard (line numbers from panel ids)."""
    r = S.non_empty(r.filter(F.col("lang").isNotNull()), "text")
    doc = F.floor(F.col("panel_id") / 10).cast("bigint")
    body = r.select(F.col("lang").alias("file"), F.col("panel_id").alias("line_no"),
                    substitute(F.col("text")).alias("line"))
    heads = r.select(F.col("lang").alias("file"), doc.alias("d"), "path").distinct()
    hdr = heads.select("file", (F.col("d") * 10).alias("line_no"),
                       F.concat(F.lit("# Dashboard: dash-"), F.col("d").cast("string")).alias("line"))
    blank = heads.select("file", (F.col("d") * 10 + 9).alias("line_no"), F.lit("").alias("line"))
    return body.unionByName(hdr).unionByName(blank)


@query("section_fill", f"""WITH {TG_SQL},
b AS (SELECT lang AS file, panel_id AS line_no, {substitute_sql('text')} AS line, panel_id // 10 AS d
      FROM rt WHERE lang IS NOT NULL AND text IS NOT NULL AND text <> ''),
h AS (SELECT DISTINCT file, d FROM b),
lines AS (SELECT file, line_no, line FROM b
          UNION ALL SELECT file, d * 10, '# Dashboard: dash-' || CAST(d AS STRING) FROM h
          UNION ALL SELECT file, d * 10 + 9, '' FROM h),
f AS (SELECT file, line_no, line,
             last_value(CASE WHEN regexp_matches(line, '^# Dashboard: (.*)$')
                             THEN regexp_extract(line, '^# Dashboard: (.*)$', 1) END IGNORE NULLS)
               OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
      FROM lines)
SELECT file, line_no, section, line FROM f WHERE NOT regexp_matches(line, '^\\s*(#.*)?$')""")
def q_section_fill(spark, d):
    filled = LT.fill_section(settled(query_lines(settled(routed(spark, d)))), chunk=100_000)
    return S.strip_comments(filled).select("file", "line_no", "section", "line")


# ---------------------------------------------------------------- main coverage flow (JN-1, SC-2, JN-7; SC-6 against decoded spans)

REQUIRED_METRICS = [*DASHBOARD_METRICS, "app_view_requests_total", "app_purchase_size_bytes",
                    "app_click_duration_seconds_bucket"]
_required = ", ".join(f"('{m}')" for m in REQUIRED_METRICS)


@query("metric_coverage", f"""WITH p AS (SELECT DISTINCT CASE event_type
    WHEN 'view' THEN 'app_view_requests_total' WHEN 'signup' THEN 'app_signup_sessions_ratio'
    WHEN 'purchase' THEN 'app_purchase_size_bytes' WHEN 'error' THEN 'app_error_latency_milliseconds'
    ELSE 'app_click_duration_seconds' END AS name FROM events),
r AS (SELECT * FROM (VALUES {_required}) t(name)),
c AS (SELECT r.name, p.name IS NOT NULL AS hit FROM r LEFT JOIN p ON regexp_replace(r.name, '_bucket$', '') = p.name)
SELECT 'metric' AS "check", name AS subject, CASE WHEN hit THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN hit THEN 'covered' ELSE 'missing' END AS detail FROM c
UNION ALL SELECT 'metric', name, 'WARN', 'provided, in no required list' FROM p
WHERE name NOT IN (SELECT regexp_replace(name, '_bucket$', '') FROM r)""")
def q_metric_coverage(spark, d):
    """Names decoded from the export requests and normalised, against the required metrics."""
    from .q_sources import otlp_metrics

    s, h = otlp_metrics(spark, d)
    provided = s.select(F.col("metric").alias("name")).unionByName(h.select(F.col("metric").alias("name"))).distinct()
    required = C.literal_table(spark, [(m,) for m in REQUIRED_METRICS], "full string").withColumn(
        "name", N.strip_histogram_suffix("full"))
    hit = required.join(provided.withColumn("hit", F.lit(True)), "name", "left")
    found = hit.select(*C.finding("metric", F.col("full"), F.when(F.col("hit"), "PASS").otherwise("FAIL"),
                                  F.when(F.col("hit"), "covered").otherwise("missing")))
    extra = provided.join(required, "name", "left_anti")
    return C.union_findings(found, extra.select(
        *C.finding("metric", F.col("name"), "WARN", F.lit("provided, in no required list"))))


_named = ", ".join(f"('{s}', '{a}')" for s, a in
                   [("span", x) for x in [*DEFAULT_SPAN_ATTRS, "duration", "messaging.system"]]
                   + [("resource", x) for x in DEFAULT_RESOURCE_ATTRS] + [("resource", "host.name")])


@query("span_attr_coverage", f"""WITH k AS (
  SELECT 'span' AS scope, unnest(['http.request.method', 'http.route', 'http.response.status_code', 'priority']) AS attr
  FROM orders
  UNION ALL SELECT 'span', unnest(['db.system', 'db.name', 'db.statement', 'part'])
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT 'resource', unnest(['service.name', 'service.namespace', 'deployment.environment.name']) FROM orders)
SELECT 'trace_attribute' AS "check", n.scope || '.' || n.attr AS subject,
       CASE WHEN n.attr IN ('kind', 'status', 'duration', 'name', 'rootName', 'rootServiceName', 'traceID', 'spanID', 'http.url')
              OR h.attr IS NOT NULL THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN n.attr = 'duration' THEN 'intrinsic' WHEN h.attr IS NOT NULL THEN 'attribute' ELSE 'missing' END AS detail
FROM (VALUES {_named}) n(scope, attr) LEFT JOIN (SELECT DISTINCT * FROM k) h ON n.scope = h.scope AND n.attr = h.attr""")
def q_span_attr_coverage(spark, d):
    """Attributes that trace queries name must be intrinsics or keys of the decoded spans."""
    from ..operators.traces import INTRINSICS
    from ..sources import otlp as O
    from .adapters import a_spans
    from .otlp_adapter import a_otlp_spans

    spans = O.parse_otlp_spans(a_otlp_spans(a_spans(read_table(spark, d, "orders"), read_table(spark, d, "lineitem"))), "json")
    keys = F.array(F.struct(F.lit("span").alias("scope"), F.map_keys("attrs").alias("attrs")),
                   F.struct(F.lit("resource").alias("scope"), F.map_keys("res").alias("attrs")))
    sets = spans.select(F.inline(keys)).distinct()  # spans of a kind have one list of keys
    provided = sets.select("scope", F.explode("attrs").alias("attr")).distinct().withColumn("hit", F.lit(True))
    rows = [("span", x) for x in [*DEFAULT_SPAN_ATTRS, "duration", "messaging.system"]]
    rows += [("resource", x) for x in [*DEFAULT_RESOURCE_ATTRS, "host.name"]]
    named = C.literal_table(spark, rows, "scope string, attr string").join(provided, ["scope", "attr"], "left")
    own = F.col("attr").isin(*INTRINSICS)
    detail = F.when(own, "intrinsic").when(F.col("hit"), "attribute").otherwise("missing")
    return named.select(*C.finding("trace_attribute", F.concat_ws(".", "scope", "attr"),
                                   F.when(detail == "missing", "FAIL").otherwise("PASS"), detail))
