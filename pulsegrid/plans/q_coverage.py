"""Coverage queries over documents / labels / part / benchmark / logs (JN-1..6, ST-1, AG-8/9/10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import coverage as C
from ..operators import logs as L
from ..sources.tables import read_table
from .adapters import a_logs, a_samples
from .registry import query

# ---------------------------------------------------------------- part name adapter

PART_OTEL = "'part.' || lower(p_type) || '.' || replace(p_name, ' ', '_')"
PART_PROM = "lower(replace(p_brand, '#', '_')) || '_' || replace(p_name, ' ', '_')"


def part_names(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(names(otel_name), mapping(otel_name, prom_name)): names of all parts; the mapping
    comes from parts with p_size > 25, one candidate per brand (the first one wins)."""
    p = read_table(spark, d, "part")
    otel = F.concat(F.lit("part."), F.lower("p_type"), F.lit("."), F.regexp_replace("p_name", " ", "_"))
    prom = F.concat(F.lower(F.regexp_replace("p_brand", "#", "_")), F.lit("_"), F.regexp_replace("p_name", " ", "_"))
    names = p.select(otel.alias("otel_name")).distinct()
    mapping = p.filter(F.col("p_size") > 25).select(otel.alias("otel_name"), prom.alias("prom_name"))
    return names, mapping


def doc_coverage(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents").select("doc_id")
    labs = read_table(spark, d, "labels").select("doc_id")
    return C.coverage_findings("doc_label", docs, labs, "doc_id")


LOG_LABEL_ROWS = [(k, v) for k, v in L.LOG_LABEL_SOURCE.items()]


def log_label_findings(spark: SparkSession, d: str) -> DataFrame:
    logs = a_logs(read_table(spark, d, "events"))
    keys = (logs.select(F.lit("attribute").alias("scope"), F.explode(F.map_keys("attrs")).alias("key"))
            .unionByName(logs.select(F.lit("resource").alias("scope"), F.explode(F.map_keys("res")).alias("key"))))
    builtin = (L.any_non_empty(logs, ["severity_text"])
               .select(F.when(F.col("has_severity_text"), F.lit("severityText")).alias("field"))
               .filter(F.col("field").isNotNull()))
    labels = C.literal_table(spark, LOG_LABEL_ROWS, "label string, source string")
    return C.label_coverage(labels, keys, builtin)


DOC_COV_SQL = """dc AS (
  SELECT 'doc_label' AS "check", CAST(d.doc_id AS VARCHAR) AS subject,
         CASE WHEN l.doc_id IS NOT NULL THEN 'PASS' ELSE 'FAIL' END AS status,
         CASE WHEN l.doc_id IS NOT NULL THEN 'covered' ELSE 'missing' END AS detail
  FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l
    ON d.doc_id = l.doc_id)"""

_llv = ", ".join(f"('{k}', '{v}')" for k, v in LOG_LABEL_ROWS)
LOG_LABEL_SQL = f"""k AS (
  SELECT DISTINCT scope, key FROM (
    SELECT 'attribute' AS scope, unnest(['log_type', 'logger']) AS key FROM events
    UNION ALL SELECT 'resource', unnest(['service.name', 'service.namespace', 'deployment.environment.name'])
      FROM events
    UNION ALL SELECT 'builtin', 'severityText' FROM events)),
ll AS (
  SELECT 'log_label' AS "check", label AS subject,
         CASE WHEN split_part(source, ':', 1) NOT IN ('resource', 'attribute', 'builtin') THEN 'WARN'
              WHEN k.key IS NOT NULL THEN 'PASS' ELSE 'FAIL' END AS status,
         CASE WHEN split_part(source, ':', 1) NOT IN ('resource', 'attribute', 'builtin') THEN 'unknown source'
              ELSE split_part(source, ':', 1) || '.' || regexp_extract(source, '^[^:]*:(.*)$', 1) END AS detail
  FROM (VALUES {_llv}) t(label, source)
  LEFT JOIN k ON k.scope = split_part(source, ':', 1) AND k.key = regexp_extract(source, '^[^:]*:(.*)$', 1))"""


@query("doc_label_coverage", f"""WITH {DOC_COV_SQL} SELECT * FROM dc""")
def q_doc_label_coverage(spark, d):
    return doc_coverage(spark, d)


@query("missing_docs", """SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_missing_docs(spark, d):
    return C.missing(read_table(spark, d, "documents").select("doc_id"),
                     read_table(spark, d, "labels").select("doc_id"), "doc_id")


@query("covered_docs", """SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""")
def q_covered_docs(spark, d):
    return C.covered(read_table(spark, d, "documents").select("doc_id", "lang"),
                     read_table(spark, d, "labels").select("doc_id"), "doc_id")


@query("map_part_names", f"""WITH m AS (SELECT {PART_OTEL} AS otel_name, min({PART_PROM}) AS mapped
                                      FROM part WHERE p_size > 25 GROUP BY 1),
n AS (SELECT DISTINCT {PART_OTEL} AS otel_name FROM part)
SELECT n.otel_name, coalesce(m.mapped, replace(n.otel_name, '.', '_')) AS prom_name
FROM n LEFT JOIN m ON n.otel_name = m.otel_name""")
def q_map_part_names(spark, d):
    names, mapping = part_names(spark, d)
    return C.map_names(names, mapping).select("otel_name", "prom_name")


@query("reverse_part_names", f"""WITH r AS (SELECT {PART_PROM} AS prom_name, min({PART_OTEL}) AS otel_name
                                          FROM part WHERE p_size > 25 GROUP BY 1),
q AS (SELECT DISTINCT {PART_PROM} AS prom_name FROM part)
SELECT q.prom_name, coalesce(r.otel_name, 'unknown') AS otel_name FROM q LEFT JOIN r ON q.prom_name = r.prom_name""")
def q_reverse_part_names(spark, d):
    _, mapping = part_names(spark, d)
    p = read_table(spark, d, "part")
    req = p.select(F.concat(F.lower(F.regexp_replace("p_brand", "#", "_")), F.lit("_"),
                            F.regexp_replace("p_name", " ", "_")).alias("prom_name")).distinct()
    return C.reverse_map(req, mapping).select("prom_name", "otel_name")


@query("log_label_coverage", f"""WITH {LOG_LABEL_SQL} SELECT * FROM ll""")
def q_log_label_coverage(spark, d):
    return log_label_findings(spark, d)


@query("benchmark_in_documents", """SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b
ON contains(d.text, b.text)""", headline=True)
def q_benchmark_in_documents(spark, d):
    return C.contains_join(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"),
                           "doc_id", "text", "item_id", "text")


@query("coverage_tally", f"""WITH {DOC_COV_SQL}, {LOG_LABEL_SQL},
f AS (SELECT * FROM dc UNION ALL SELECT * FROM ll)
SELECT "check", count(*) FILTER (WHERE status = 'PASS') AS pass, count(*) FILTER (WHERE status = 'FAIL') AS fail,
       count(*) FILTER (WHERE status = 'WARN') AS warn, count(*) FILTER (WHERE status = 'SKIP') AS skip,
       count(*) AS total FROM f GROUP BY "check" """)
def q_coverage_tally(spark, d):
    f = C.union_findings(doc_coverage(spark, d), log_label_findings(spark, d))
    return C.tally(f, ["check"])


@query("coverage_verdict", f"""WITH {DOC_COV_SQL}, {LOG_LABEL_SQL},
f AS (SELECT * FROM dc UNION ALL SELECT * FROM ll)
SELECT "check", CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'WARN') THEN 'WARN'
                     ELSE 'PASS' END AS verdict FROM f GROUP BY "check" """)
def q_coverage_verdict(spark, d):
    f = C.union_findings(doc_coverage(spark, d), log_label_findings(spark, d))
    return C.verdict(f, ["check"])


# ---------------------------------------------------------------- AG-10 probe

PROBE_METRICS = ["view", "click", "purchase", "signup", "error", "checkout"]


@query("probe_queries", f"""WITH s AS (
  SELECT event_type AS metric,
         '{{"metric":"' || event_type || '","labels":[{{"key":"pod","value":"' || CAST(user_id % 8 AS VARCHAR)
         || '"}},{{"key":"user","value":"' || CAST(user_id AS VARCHAR) || '"}}]}}' AS series_id,
         epoch_us(ts) * 1000 AS ts_ns, value FROM events),
c AS (SELECT * FROM (VALUES {", ".join(f"('{m}')" for m in PROBE_METRICS)}) t(metric)),
a AS (SELECT metric, count(DISTINCT series_id) AS n_series, arg_min(value, (series_id, ts_ns, value)) AS first_value
      FROM s GROUP BY metric)
SELECT c.metric AS query, coalesce(a.n_series, 0) AS n_series, a.first_value,
       CASE WHEN coalesce(a.n_series, 0) > 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM c LEFT JOIN a ON c.metric = a.metric""")
def q_probe_queries(spark, d):
    s = a_samples(read_table(spark, d, "events"))
    cat = C.literal_table(spark, [(m,) for m in PROBE_METRICS], "metric string")
    return C.probe(s, cat)
