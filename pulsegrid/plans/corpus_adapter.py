"""Query-corpus adapter: dashboards, rule files and datasource tags derived from ``events``.

Every event becomes one small dashboard document (so documents grow with the table and no
group is collected). The query text of each target follows a planned share of violations
for every lint check, plus a near miss of each. The generator columns are plain SQL
expressions over ``events`` so that the DuckDB oracle derives exactly the same targets
without going through JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.plan import with_columns_once

# ---------------------------------------------------------------- generator expressions (SQL)

PATH = ("'team-' || CAST(user_id % 20 AS STRING) || '/dash-' || CAST(event_id AS STRING) || '.json'")
INVALID = "event_id % 97 = 0"
EMPTY = "event_id % 53 = 0"

DS_TYPE = """CASE event_type
  WHEN 'view' THEN CASE WHEN user_id % 4 = 1 THEN NULL ELSE 'prometheus' END
  WHEN 'click' THEN 'prometheus' WHEN 'purchase' THEN 'loki' WHEN 'signup' THEN 'tempo'
  ELSE 'prometheus' END"""

# ('$' || '{x}' keeps Spark SQL's ${var} substitution away from the literal)
DS_UID = """CASE
  WHEN event_type = 'error' AND user_id % 6 = 0 THEN 'mimir-old'
  WHEN event_type = 'error' AND user_id % 6 = 1 THEN '$' || '{datasource}'
  WHEN event_type IN ('view', 'click', 'error') THEN 'prometheus'
  WHEN event_type = 'purchase' THEN 'loki' ELSE 'tempo' END"""

_U = "CAST(user_id AS STRING)"
EXPR1 = f"""CASE WHEN {EMPTY} THEN '' ELSE CASE event_type
  WHEN 'view' THEN 'sum(rate(view_total{{pod="$pod", user="' || {_U} || '"}}[$__rate_interval])) by (pod)'
  WHEN 'click' THEN 'histogram_quantile(0.9, sum(rate(click_duration_seconds_bucket{{user="' || {_U} || '"}}[5m])) by ('
       || CASE user_id % 3 WHEN 0 THEN 'service' WHEN 1 THEN 'le, pod' ELSE 'handle' END || '))'
  WHEN 'purchase' THEN CASE user_id % 4
       WHEN 0 THEN 'sum(count_over_time({{service_name="$service"}} | level="ERROR" [5m]))'
       WHEN 1 THEN 'sum(count_over_time({{service_name="$service"}} | detected_level="ERROR" | level="x" [5m]))'
       ELSE '{{service_name="$service", log_type="$log_type", user="' || {_U} || '"}} | detected_level=~"$level"' END
  WHEN 'signup' THEN NULL
  ELSE CASE user_id % 2 WHEN 0 THEN 'up{{job="user-' || {_U} || '"}} == 0'
       ELSE 'process_cpu_seconds_total{{job="user-' || {_U} || '"}} > 0' END
  END END"""

QUERY1 = f"""CASE WHEN event_type <> 'signup' THEN NULL WHEN {EMPTY} THEN '' ELSE CASE
  WHEN user_id % 7 = 0 THEN '{{resource.service.name=~"$svc"}}'
  WHEN user_id % 5 = 0 THEN '{{resource.service.name="$svc" && kind=server}}'
  WHEN user_id % 5 = 1 THEN '{{span.kind=server && duration > $min_duration}}'
  ELSE '{{resource.service.name="$svc" && span.http.route="/orders/' || {_U} || '"}}' END END"""

EXPR2 = "'sum(jvm_memory_used_bytes{pod=\"' || CAST(user_id % 8 AS STRING) || '\"}) by (pod)'"

PANEL1_ID = "event_id * 10 + 1"
PANEL2_ID = "event_id * 10 + 2"


def a_dashboards(events: DataFrame) -> DataFrame:
    """events -> documents_json(path, json): a row panel with a nested panel, plus a stat panel. Every
    seventh document holds its panels two levels deeper, as rows of a section."""
    x = events.select(F.expr(PATH).alias("path"), "event_id", "user_id",
                      F.expr(DS_TYPE).alias("ds_type"), F.expr(DS_UID).alias("ds_uid"),
                      F.expr(EXPR1).alias("expr1"), F.expr(QUERY1).alias("query1"),
                      F.expr(EXPR2).alias("expr2"), F.expr(INVALID).alias("invalid"))
    ds = F.struct(F.col("ds_type").alias("type"), F.col("ds_uid").alias("uid"))
    inner = F.struct(F.expr(PANEL1_ID).alias("id"), F.lit("timeseries").alias("type"), ds.alias("datasource"),
                     F.array(F.struct(F.lit("A").alias("refId"), F.col("expr1").alias("expr"),
                                      F.col("query1").alias("query"))).alias("targets"))
    row = F.struct(F.lit("row").alias("type"), F.lit("Details").alias("title"), F.array(inner).alias("panels"))
    stat = F.struct(F.expr(PANEL2_ID).alias("id"), F.lit("stat").alias("type"),
                    F.struct(F.lit("prometheus").alias("type"), F.lit("prometheus").alias("uid")).alias("datasource"),
                    F.array(F.struct(F.lit("A").alias("refId"), F.col("expr2").alias("expr"))).alias("targets"))
    deeper = F.col("event_id") % 7 == 3
    doc = F.concat(F.lit('{"title":"dash-'), F.col("event_id").cast("string"),
                   F.when(deeper, '","sections":[{"rows":[{"panels":[').otherwise('","panels":['),
                   F.to_json(row), F.lit(","), F.to_json(stat), F.when(deeper, "]}]}]}").otherwise("]}"))
    x = with_columns_once(x, {"doc": doc})
    doc = F.when(F.col("invalid"), F.substring("doc", 1, 40)).otherwise(F.col("doc"))  # truncated: invalid JSON
    return with_columns_once(x.select("path", doc.alias("j")), {"json": F.col("j")}).select("path", "json")


# ---------------------------------------------------------------- rules

RULE_PATH = "'rules/user-' || CAST(user_id AS STRING) || '.json'"
RULE_LEVEL = "CASE WHEN user_id % 5 = 0 THEN 'level=\"ERROR\"' ELSE 'detected_level=\"ERROR\"' END"
RULE_FOR = "CASE user_id % 3 WHEN 0 THEN '1m' WHEN 1 THEN '5m' ELSE '1h30m' END"
RULE_SEVERITY = "CASE WHEN user_id % 2 = 0 THEN 'critical' ELSE 'warning' END"


def a_rule_files(events: DataFrame) -> DataFrame:
    """events -> one rule document per user: a log alert whose threshold is the user's event count
    (multi-line expr; every fifth user filters ``level=`` instead of ``detected_level=``). A quarter of
    the documents hold their groups under ``spec``, a quarter in a list of such documents."""
    u = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    expr = F.concat(F.lit('sum(count_over_time({service_name="svc-'), (F.col("user_id") % 8).cast("string"),
                    F.lit('"}\n  | '), F.expr(RULE_LEVEL), F.lit(" [5m]))\n  > "), F.col("n").cast("string"))
    rule = F.struct(F.concat(F.lit("UserErrors"), F.col("user_id").cast("string")).alias("alert"),
                    expr.alias("expr"), F.expr(RULE_FOR).alias("for"),
                    F.create_map(F.lit("severity"), F.expr(RULE_SEVERITY)).alias("labels"),
                    F.create_map(F.lit("summary"),
                                 F.lit("errors for {{ $labels.service_name }}: {{ $value }}")).alias("annotations"))
    grp = F.struct(F.concat(F.lit("users-"), (F.col("user_id") % 10).cast("string")).alias("name"),
                   F.array(rule).alias("rules"))
    groups = F.struct(F.array(grp).alias("groups"))
    spec = F.struct(F.lit("PrometheusRule").alias("kind"), groups.alias("spec"))
    deep = F.struct(F.lit("List").alias("kind"), F.array(spec).alias("items"))
    doc = F.when(F.col("user_id") % 4 == 1, F.to_json(spec)).when(F.col("user_id") % 4 == 3, F.to_json(deep))
    return u.select(F.expr(RULE_PATH).alias("path"), doc.otherwise(F.to_json(groups)).alias("json"))


# ---------------------------------------------------------------- datasource tags

def a_ds_tags(events: DataFrame) -> DataFrame:
    """events -> tracing datasource tag settings per service; service 3 uses an unscoped key."""
    svc = events.select((F.col("user_id") % 8).alias("pod")).distinct()
    key = F.when(F.col("pod") == 3, "service.name").otherwise("resource.service.name")
    return svc.select(F.concat(F.lit("tempo-svc-"), F.col("pod").cast("string")).alias("subject"), key.alias("key"))
