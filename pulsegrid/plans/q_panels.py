"""Broker panels and alerts over relabelled JMX samples, and event topics
(AG-1..3/13, WN-2, SC-12..15, SC-17, STR-4, STR-5 in batch form)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import label, merge_maps, series_key
from ..functions.names import topic_parts
from ..functions.templates import legend
from ..functions.time import duration_ns, epoch_ns
from ..operators import alerts as AL
from ..operators import panels as PN
from ..operators import promql as pq
from ..operators.reducers import reduce_series
from ..sources import jmx
from ..sources.corpus import load_rules
from ..sources.tables import read_table
from . import params as P
from .otlp_adapter import a_beans
from .q_metrics import INSTANT_SQL
from .q_sources import _jmx_sql
from .registry import query

NS = 1_000_000_000


def jmx_samples(spark: SparkSession, d: str) -> DataFrame:
    """Broker samples: relabelled bean lines with the scrape labels namespace / pod."""
    r = jmx.relabel(a_beans(read_table(spark, d, "events")))
    r = r.filter(F.col("rule").isNotNull() & F.col("value").isNotNull())
    scrape = F.create_map(F.lit("namespace"), F.lit("kafka"),
                          F.lit("pod"), F.concat(F.lit("broker-"), (F.col("user_id") % 3).cast("string")))
    s = r.select(F.col("name").alias("metric"), merge_maps(F.col("labels"), scrape).alias("labels"), "ts_ns", "value")
    return s.withColumn("series_id", series_key("metric", "labels"))


def jmx_instant(spark: SparkSession, d: str, metric: str | None = None, matchers=()) -> DataFrame:
    s = jmx_samples(spark, d)
    if metric is not None:
        s = pq.select_series(s, metric, matchers)
    return pq.instant(s, P.GRID, P.LOOKBACK)


def state_samples(spark: SparkSession, d: str) -> DataFrame:
    """What the cluster's state exporters report, rendered from events: readiness of broker pods
    (one series for each condition, complementary; broker-0 is always ready) and consumer lag."""
    ev = read_table(spark, d, "events").filter("event_type IN ('click', 'view') AND value IS NOT NULL")
    pod = F.concat(F.lit("broker-"), (F.col("user_id") % 3).cast("string"))
    ready = F.when((F.col("user_id") % 3 == 0) | (F.col("value") < 300), 1.0).otherwise(0.0)
    ns = F.lit("kafka").alias("namespace")

    def one(metric, labels, value):
        pairs = F.create_map(*[x for k, c in labels.items() for x in (F.lit(k), c)])
        return F.struct(F.lit(metric).alias("metric"), pairs.alias("labels"), value.alias("value"))
    rows = F.when(F.col("event_type") == "click", F.array(
        one(READY, {"namespace": ns, "pod": pod, "condition": F.lit("true")}, ready),
        one(READY, {"namespace": ns, "pod": pod, "condition": F.lit("false")}, 1.0 - ready))).otherwise(F.array(
            one(LAG, {"namespace": ns, "pod": pod, "consumergroup": F.concat(F.lit("g"), (F.col("user_id") % 4).cast("string"))},
                F.col("value") * 50)))
    x = ev.select(epoch_ns("ts").alias("ts_ns"), F.inline(rows))
    return x.withColumn("series_id", series_key("metric", "labels")).select("metric", "labels", "ts_ns", "value", "series_id")


def alert_input(spark: SparkSession, d: str, rules) -> DataFrame:
    """Instant vector of only the series the rules look at (selection before evaluation)."""
    s = jmx_samples(spark, d).unionByName(state_samples(spark, d))
    return pq.instant(s.filter(F.col("metric").isin(*AL.rule_metrics(rules))), P.GRID, P.LOOKBACK)


# ---------------------------------------------------------------- oracle SQL pieces

_LK = "metric, l_clientid, l_topic, l_partition, l_broker, l_request, l_name, pod"
JS_SQL = _jmx_sql(extra=True) + f""",
js AS (SELECT metric, l_clientid, l_topic, l_partition, l_broker, l_request, l_name,
              'broker-' || CAST(user_id % 3 AS VARCHAR) AS pod, ts_ns, value
       FROM jx WHERE rule IS NOT NULL AND value IS NOT NULL),
g AS (SELECT range AS j, {P.START_NS} + range * {P.STEP_NS} AS t_ns FROM range(0, {P.N_POINTS})),
ji AS (SELECT * FROM (
         SELECT js.*, g.j, g.t_ns,
                row_number() OVER (PARTITION BY {_LK}, g.j ORDER BY ts_ns DESC, value DESC) AS rn
         FROM js JOIN g ON js.ts_ns >= g.t_ns - {P.LOOKBACK_NS} AND js.ts_ns < g.t_ns) WHERE rn = 1)"""


_AK = _LK + ", condition, consumergroup"
ALERT_JS_SQL = _jmx_sql(extra=True) + f""",
js0 AS (SELECT metric, l_clientid, l_topic, l_partition, l_broker, l_request, l_name,
              'broker-' || CAST(user_id % 3 AS VARCHAR) AS pod, ts_ns, value, NULL AS condition, NULL AS consumergroup
       FROM jx WHERE rule IS NOT NULL AND value IS NOT NULL),
st AS (SELECT *, CASE WHEN user_id % 3 = 0 OR value < 300 THEN 1.0 ELSE 0.0 END AS ready FROM events
       WHERE event_type IN ('click', 'view') AND value IS NOT NULL),
js AS (SELECT * FROM js0
       UNION ALL SELECT 'kube_pod_status_ready', NULL, NULL, NULL, NULL, NULL, NULL, 'broker-' || CAST(user_id % 3 AS VARCHAR),
              epoch_us(ts) * 1000, CASE c WHEN 'true' THEN ready ELSE 1.0 - ready END, c, NULL
       FROM st, (VALUES ('true'), ('false')) v(c) WHERE event_type = 'click'
       UNION ALL SELECT 'kafka_consumergroup_group_lag', NULL, NULL, NULL, NULL, NULL, NULL, 'broker-' || CAST(user_id % 3 AS VARCHAR),
              epoch_us(ts) * 1000, value * 50, NULL, 'g' || CAST(user_id % 4 AS VARCHAR) FROM st WHERE event_type = 'view'),
g AS (SELECT range AS j, {P.START_NS} + range * {P.STEP_NS} AS t_ns FROM range(0, {P.N_POINTS})),
ji AS (SELECT * FROM (
         SELECT js.*, g.j, g.t_ns,
                row_number() OVER (PARTITION BY {_AK}, g.j ORDER BY ts_ns DESC, value DESC) AS rn
         FROM js JOIN g ON js.ts_ns >= g.t_ns - {P.LOOKBACK_NS} AND js.ts_ns < g.t_ns)
       WHERE rn = 1 AND condition IS DISTINCT FROM 'false')"""


# ---------------------------------------------------------------- panels

MSG_IN = "kafka_server_brokertopicmetrics_messagesinpersec"
UNDER_REP = "kafka_server_replicamanager_underreplicatedpartitions"
OFFLINE = "kafka_controller_kafkacontroller_offlinepartitionscount"
REQ_TIME = "kafka_network_requestmetrics_totaltimems"

# Panel thresholds and value mapping of the broker overview.
UNDER_REP_STEPS = [(None, "green"), (1, "orange"), (5, "red")]
BROKER_STEPS = [(None, "red"), (1, "orange"), (3, "green")]
CONTROLLER_TEXT = {0: "No Active Controller", 1: "Active"}


@query("kafka_messages_in_by_topic", f"""WITH {JS_SQL},
a AS (SELECT l_topic AS topic, t_ns, sum(value) AS value FROM ji WHERE metric = '{MSG_IN}' GROUP BY l_topic, t_ns)
SELECT topic AS legend, round(arg_max(value, t_ns), 6) AS last, round(avg(value), 6) AS mean,
       round(max(value), 6) AS max FROM a GROUP BY topic""")
def q_kafka_messages_in_by_topic(spark, d):
    v = jmx_instant(spark, d, MSG_IN, [("namespace", "=", "kafka")])
    s = pq.agg_by(v, "sum", ["topic"]).withColumn("labels", F.create_map(F.lit("topic"), F.col("topic")))
    red = reduce_series(s.withColumn("legend", legend("{{ topic }}")), ["legend"], ["lastNotNull", "mean", "max"])
    return red.select("legend", F.round("last", 6).alias("last"), F.round("mean", 6).alias("mean"),
                      F.round("max", 6).alias("max"))


def _steps_sql(col: str, steps) -> str:
    base = [c for s, c in steps if s is None][0]
    out = f"'{base}'"
    for s, c in sorted([(s, c) for s, c in steps if s is not None]):
        out = f"CASE WHEN {col} >= {float(s)} THEN '{c}' ELSE {out} END"
    return out


@query("kafka_under_replicated_stat", f"""WITH {JS_SQL},
a AS (SELECT t_ns, sum(value) AS value FROM ji WHERE metric = '{UNDER_REP}' GROUP BY t_ns),
r AS (SELECT arg_max(value, t_ns) AS last, max(t_ns) AS t_ns FROM a)
SELECT round(last, 6) AS last, {_steps_sql('last', UNDER_REP_STEPS)} AS color,
       CAST(t_ns // 1000000000 AS BIGINT) AS last_t FROM r WHERE t_ns IS NOT NULL""")
def q_kafka_under_replicated_stat(spark, d):
    v = jmx_instant(spark, d, UNDER_REP, [("namespace", "=", "kafka")])
    s = pq.agg_by(v, "sum", []).withColumn("k", F.lit(1))
    red = reduce_series(s, ["k"], ["lastNotNull"])
    return red.select(F.round("last", 6).alias("last"), PN.threshold_color("last", UNDER_REP_STEPS).alias("color"),
                      "last_t")


@query("kafka_online_brokers", f"""WITH {JS_SQL},
a AS (SELECT t_ns, count(*) AS n_series, count(DISTINCT pod) AS n_pods FROM ji WHERE metric = '{OFFLINE}'
      GROUP BY t_ns)
SELECT CAST(t_ns // 1000000000 AS BIGINT) AS t, CAST(n_series AS DOUBLE) AS n_series, CAST(n_pods AS DOUBLE) AS n_pods,
       CASE n_pods WHEN 0 THEN 'No Active Controller' WHEN 1 THEN 'Active' ELSE CAST(n_pods AS VARCHAR) END AS pods_text,
       {_steps_sql('n_pods', BROKER_STEPS)} AS color FROM a""")
def q_kafka_online_brokers(spark, d):
    v = jmx_instant(spark, d, OFFLINE, [("namespace", "=", "kafka")])
    n = pq.agg_by(v, "count", []).withColumnRenamed("value", "n_series")
    p = pq.count_distinct_label(v, "pod").withColumnRenamed("value", "n_pods")
    j = n.join(p, ["j", "t"])
    return j.select("t", "n_series", "n_pods", PN.value_text("n_pods", CONTROLLER_TEXT).alias("pods_text"),
                    PN.threshold_color("n_pods", BROKER_STEPS).alias("color"))


@query("kafka_request_rate", f"""WITH {JS_SQL},
p AS (SELECT js.*, lag(ts_ns) OVER w AS prev_ts, lag(value) OVER w AS prev_v FROM (
        SELECT {_LK}, ts_ns, max(value) AS value FROM js WHERE metric = '{REQ_TIME}' GROUP BY ALL) js
      WINDOW w AS (PARTITION BY {_LK} ORDER BY ts_ns)),
r AS (SELECT {_LK}, g.t_ns,
             sum(CASE WHEN prev_ts >= g.t_ns - {P.RANGE_NS}
                      THEN CASE WHEN value >= prev_v THEN value - prev_v ELSE value END ELSE 0 END)
               / ((max(ts_ns) - min(ts_ns)) / 1e9) AS value
      FROM p JOIN g ON p.ts_ns >= g.t_ns - {P.RANGE_NS} AND p.ts_ns < g.t_ns
      GROUP BY {_LK}, g.t_ns HAVING count(*) >= 2 AND max(ts_ns) > min(ts_ns))
SELECT CAST(t_ns // 1000000000 AS BIGINT) AS t, l_request AS request, round(sum(value), 6) AS value
FROM r GROUP BY t_ns, l_request""")
def q_kafka_request_rate(spark, d):
    s = pq.select_series(jmx_samples(spark, d), REQ_TIME, [("namespace", "=", "kafka")])
    r = pq.agg_by(pq.rate(s, P.GRID, P.RATE_RANGE), "sum", ["request"])
    return r.select("t", "request", F.round("value", 6).alias("value"))


# ---------------------------------------------------------------- alerts

READY, LAG = "kube_pod_status_ready", "kafka_consumergroup_group_lag"

# Broker alert rules (metric, comparison, threshold, hold time, severity, texts, selector).
KAFKA_ALERTS = [
    AL.AlertRule("KafkaBrokerNotReady", READY, "==", 0, "5m", "critical", "broker {{ $labels.pod }} not ready",
                 (("namespace", "=", "kafka"), ("pod", "=~", "broker-.*"), ("condition", "=", "true")),
                 "{{ $labels.pod }} in {{ $labels.namespace }} reports ready = {{ $value }}"),
    AL.AlertRule("KafkaUnderReplicatedPartitions", UNDER_REP, ">", 0, "5m", "warning",
                 "{{ $labels.pod }}: {{ $value }} under-replicated partitions", (),
                 "replicas of {{ $labels.pod }} lag"),
    AL.AlertRule("KafkaOfflinePartitions", OFFLINE, ">", 0, "1m", "critical",
                 "{{ $value }} offline partitions", (), "no leader for {{ $value }} partitions"),
    AL.AlertRule("KafkaConsumerLagHigh", LAG, ">", 10000, "10m", "warning",
                 "consumer group {{ $labels.consumergroup }} lag {{ $value }}", (("consumergroup", "!=", ""),),
                 "{{ $labels.consumergroup }} is behind by {{ $value }}"),
]
# a rule over the event samples whose hold time spans several grid steps
EVENT_ALERTS = [AL.AlertRule("ViewHigh", "view", ">", 200, "3h", "warning", "user {{ $labels.user }} at {{ $value }}")]


def _alert_sql(rules) -> str:
    vals = ", ".join(f"('{r.alert}', '{r.metric}', '{r.op}', {float(r.threshold)}, {duration_ns(r.for_)})"
                     for r in rules)
    return f"rl AS (SELECT * FROM (VALUES {vals}) t(alert, metric, op, threshold, for_ns))"


def _alert_states_sql(keys: str) -> str:
    return f"""ax AS (
  SELECT ji.*, rl.alert, rl.for_ns,
         coalesce(CASE rl.op WHEN '>' THEN value > threshold WHEN '<' THEN value < threshold
                             WHEN '==' THEN value = threshold END, false) AS cond
  FROM ji JOIN rl ON ji.metric = rl.metric),
ay AS (SELECT *, cond AND (lag(j) OVER w IS NULL OR lag(j) OVER w <> j - 1 OR NOT lag(cond) OVER w) AS start
      FROM ax WINDOW w AS (PARTITION BY alert, {keys} ORDER BY j)),
az AS (SELECT *, last_value(CASE WHEN start THEN j END IGNORE NULLS)
                  OVER (PARTITION BY alert, {keys} ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t0_j
      FROM ay)"""


_STATE = f"""CASE WHEN NOT cond THEN 'inactive' WHEN (j - t0_j) * {P.STEP_NS} < for_ns THEN 'pending' ELSE 'firing' END"""


@query("kafka_alerts", f"""WITH {ALERT_JS_SQL}, {_alert_sql(KAFKA_ALERTS)}, {_alert_states_sql(_AK)}
SELECT alert, pod, CAST(t_ns // 1000000000 AS BIGINT) AS t, value, {_STATE} AS state,
       CASE WHEN cond THEN CAST(t_ns // 1000000000 AS BIGINT) - (j - t0_j) * {P.STEP_NS // NS} END AS active_since
FROM az""", headline=True)
def q_kafka_alerts(spark, d):
    st = AL.alert_states(alert_input(spark, d, KAFKA_ALERTS), KAFKA_ALERTS, P.GRID)
    return st.select("alert", label("labels", "pod").alias("pod"), "t", "value", "state", "active_since")


@query("kafka_alert_summaries", f"""WITH {ALERT_JS_SQL}, {_alert_sql(KAFKA_ALERTS)}, {_alert_states_sql(_AK)},
f AS (SELECT *, CAST(value AS VARCHAR) AS v FROM az WHERE {_STATE} = 'firing')
SELECT alert, pod, CAST(t_ns // 1000000000 AS BIGINT) AS t,
       CASE alert WHEN 'KafkaBrokerNotReady' THEN 'broker ' || pod || ' not ready'
                  WHEN 'KafkaUnderReplicatedPartitions' THEN pod || ': ' || v || ' under-replicated partitions'
                  WHEN 'KafkaOfflinePartitions' THEN v || ' offline partitions'
                  ELSE 'consumer group ' || consumergroup || ' lag ' || v END AS summary,
       CASE alert WHEN 'KafkaBrokerNotReady' THEN pod || ' in kafka reports ready = ' || v
                  WHEN 'KafkaUnderReplicatedPartitions' THEN 'replicas of ' || pod || ' lag'
                  WHEN 'KafkaOfflinePartitions' THEN 'no leader for ' || v || ' partitions'
                  ELSE consumergroup || ' is behind by ' || v END AS description FROM f""")
def q_kafka_alert_summaries(spark, d):
    st = AL.alert_states(alert_input(spark, d, KAFKA_ALERTS), KAFKA_ALERTS, P.GRID)
    st = AL.alerts_with_summary(st.filter(F.col("state") == "firing"), KAFKA_ALERTS)
    return st.select("alert", label("labels", "pod").alias("pod"), "t", F.col("summary_text").alias("summary"),
                     F.col("description_text").alias("description"))


@query("event_alerts", f"""WITH {INSTANT_SQL}, ji AS (SELECT metric, "user", pod, j, t_ns, value FROM i), {_alert_sql(EVENT_ALERTS)},
{_alert_states_sql('metric, "user"')}
SELECT alert, "user", CAST(t_ns // 1000000000 AS BIGINT) AS t, value, {_STATE} AS state FROM az""")
def q_event_alerts(spark, d):
    from .q_metrics import instant_vec

    st = AL.alert_states(instant_vec(spark, d), EVENT_ALERTS, P.GRID)
    return st.select("alert", label("labels", "user").alias("user"), "t", "value", "state")


# ---------------------------------------------------------------- rules as a table (SRC-5 -> WN-2)

def metric_rule_files(events: DataFrame) -> DataFrame:
    """events -> one rule document per user with a rule for each of the user's event types: a
    comparison of one series, selected by user and pod, that must hold for a while."""
    u, n = F.col("user_id").cast("string"), F.col("user_id")
    types = events.select("user_id", "event_type").distinct()
    expr = F.concat("event_type", F.lit('{user="'), u, F.when(n % 2 == 0, F.lit('", pod=~"[0-4]"}')).otherwise(F.lit('", pod!="3"}')),
                    F.when(n % 3 == 0, F.lit(" < ")).otherwise(F.lit(" >= ")), (F.lit(100) + n % 150).cast("string"))
    expr = F.when(n % 11 == 0, F.concat(F.lit("sum("), expr, F.lit(")"))).otherwise(expr)
    rule = F.struct(F.concat("event_type", F.lit("-of-"), u).alias("alert"), expr.alias("expr"),
                    F.when(n % 4 == 0, "1m").when(n % 4 == 1, "2h").otherwise("3h").alias("for"),
                    F.create_map(F.lit("severity"), F.when(n % 2 == 0, "critical").otherwise("warning")).alias("labels"),
                    F.create_map(F.lit("summary"), F.lit("user {{ $labels.user }}{{$labels.none}} at {{ $value }}")).alias("annotations"))
    docs = types.groupBy("user_id").agg(F.collect_list(rule).alias("rules"))  # one rule a type: bounded
    group = F.struct(F.concat(F.lit("user-"), u).alias("name"), F.col("rules"))
    return docs.select(F.concat(F.lit("rules/"), u).alias("path"), F.to_json(F.struct(F.array(group).alias("groups"))).alias("json"))


@query("rule_table_alerts", f"""WITH {INSTANT_SQL},
rl AS (SELECT DISTINCT event_type AS metric, user_id, 100.0 + user_id % 150 AS threshold,
              CASE user_id % 4 WHEN 0 THEN {60 * NS} WHEN 1 THEN {7200 * NS} ELSE {10800 * NS} END AS for_ns
       FROM events WHERE user_id % 11 <> 0),
ax AS (SELECT i.metric || '-of-' || i."user" AS alert, i.metric, "user", j, t_ns, value, for_ns,
              CASE WHEN user_id % 2 = 0 THEN 'critical' ELSE 'warning' END AS severity,
              coalesce(CASE WHEN user_id % 3 = 0 THEN value < threshold ELSE value >= threshold END, false) AS cond
       FROM i JOIN rl ON i.metric = rl.metric AND i."user" = CAST(rl.user_id AS VARCHAR)
       WHERE CASE WHEN user_id % 2 = 0 THEN pod IN ('0', '1', '2', '3', '4') ELSE pod <> '3' END),
ay AS (SELECT *, cond AND (lag(j) OVER w IS NULL OR lag(j) OVER w <> j - 1 OR NOT lag(cond) OVER w) AS start
      FROM ax WINDOW w AS (PARTITION BY alert ORDER BY j)),
az AS (SELECT *, last_value(CASE WHEN start THEN j END IGNORE NULLS)
         OVER (PARTITION BY alert ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t0_j FROM ay)
SELECT alert, severity, CAST(t_ns // {NS} AS BIGINT) AS t, value, {_STATE} AS state,
       CASE WHEN {_STATE} = 'firing' THEN 'user ' || "user" || ' at ' || CAST(value AS VARCHAR) END AS summary FROM az""")
def q_rule_table_alerts(spark, d):
    """Alert states of rules read from rule documents: one rule a (user, event type)."""
    from .q_metrics import instant_vec

    rules = AL.comparison_rules(load_rules(metric_rule_files(read_table(spark, d, "events"))))
    st = AL.rule_states(instant_vec(spark, d), rules, P.GRID)
    text = AL.rendered(F.col("annotations")["summary"], F.col("labels"), F.col("value"))
    return st.select("alert", "severity", "t", "value", "state", F.when(F.col("state") == "firing", text).alias("summary"))


# ---------------------------------------------------------------- topics (SC-17, STR-4, STR-5)

# Event domains per event type and retention per domain (days).
DOMAIN_OF = {"purchase": "ticket", "view": "web", "click": "web", "signup": "user", "error": "ops"}
RETENTION_DAYS = {"ticket": 7, "web": 3, "user": 30, "ops": 3}
PARTITIONS = {"ticket": 6, "web": 3, "user": 3, "ops": 3}

_dom_sql = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DOMAIN_OF.items()) + " END"
TOPIC_SQL = f"({_dom_sql} || '.' || event_type || '.v1')"


def topic_records(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.expr(TOPIC_SQL).alias("topic"), epoch_ns("ts").alias("ts_ns"),
                         F.col("user_id").cast("string").alias("key"), F.col("props").alias("value"))


def topics_table(spark: SparkSession, records: DataFrame) -> DataFrame:
    """Topic dimension: the distinct topics seen, with domain / partitions / retention."""
    t = records.select("topic").distinct().withColumn("p", topic_parts("topic"))
    dom = F.col("p.domain")
    ret = F.create_map(*[x for k, v in RETENTION_DAYS.items() for x in (F.lit(k), F.lit(v * 86_400_000))])[dom]
    parts = F.create_map(*[x for k, v in PARTITIONS.items() for x in (F.lit(k), F.lit(v))])[dom]
    return t.select("topic", dom.alias("domain"), parts.alias("partitions"), ret.cast("bigint").alias("retention_ms"))


@query("topic_routing", f"""SELECT {_dom_sql} AS domain, event_type, 'v1' AS version, count(*) AS n,
       min(epoch_us(ts) * 1000) AS first_ns, max(epoch_us(ts) * 1000) AS last_ns
FROM events GROUP BY 1, 2""")
def q_topic_routing(spark, d):
    r = topic_records(read_table(spark, d, "events")).withColumn("p", topic_parts("topic"))
    return (r.groupBy(F.col("p.domain").alias("domain"), F.col("p.event_type").alias("event_type"),
                      F.col("p.version").alias("version"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("ts_ns").alias("first_ns"), F.max("ts_ns").alias("last_ns")))


_ret_sql = "CASE " + " ".join(f"WHEN {_dom_sql} = '{k}' THEN {v * 86_400_000}" for k, v in RETENTION_DAYS.items()) + " END"


@query("retained_records", f"""SELECT event_id, {TOPIC_SQL} AS topic FROM events
WHERE epoch_us(ts) * 1000 >= (SELECT max(epoch_us(ts) * 1000) FROM events) - ({_ret_sql}) * 1000000""")
def q_retained_records(spark, d):
    rec = topic_records(read_table(spark, d, "events"))
    return retain(rec, topics_table(spark, rec)).select("event_id", "topic")


def retain(records: DataFrame, topics: DataFrame) -> DataFrame:
    """STR-5: keep records younger than their topic's retention, relative to the newest record.
    ``now`` is a scalar subquery; the topic dimension is joined (AQE broadcasts it when small)."""
    now = records.agg(F.max("ts_ns")).scalar()
    j = records.join(topics.select("topic", "retention_ms"), "topic")
    return j.filter(F.col("ts_ns") >= now - F.col("retention_ms") * F.lit(1_000_000))
