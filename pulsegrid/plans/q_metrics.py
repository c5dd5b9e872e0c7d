"""Metric queries over the ``a_samples`` adapter (PF-1/2/8, WN-3/4, AG-1..5/12/13, SL-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import label
from ..operators import promql as pq
from ..operators.reducers import reduce_series
from ..sources.tables import read_table
from . import params as P
from .adapters import a_samples
from .registry import query

DAY_NS = 86_400 * 1_000_000_000


def samples(spark: SparkSession, d: str) -> DataFrame:
    return a_samples(read_table(spark, d, "events"))


def _series_cols(df: DataFrame) -> list:
    return [F.col("metric"), label("labels", "user").alias("user"), label("labels", "pod").alias("pod")]


# ---------------------------------------------------------------- shared oracle SQL pieces

S0 = """s0 AS (
  SELECT event_type AS metric, CAST(user_id AS VARCHAR) AS "user", CAST(user_id % 8 AS VARCHAR) AS pod,
         epoch_us(ts) * 1000 AS ts_ns, value, event_id
  FROM events)"""
S = S0 + """,
s AS (SELECT metric, "user", pod, ts_ns, max(value) AS value FROM s0 GROUP BY metric, "user", pod, ts_ns)"""
G = f"""g AS (SELECT range AS j, {P.START_NS} + range * {P.STEP_NS} AS t_ns FROM range(0, {P.N_POINTS}))"""
SID = """'{"metric":"' || metric || '","labels":[{"key":"pod","value":"' || pod || '"},{"key":"user","value":"' || "user" || '"}]}'"""

RATE_SQL = f"""{S},
p AS (SELECT *, lag(ts_ns) OVER w AS prev_ts, lag(value) OVER w AS prev_v
      FROM s WINDOW w AS (PARTITION BY metric, "user" ORDER BY ts_ns)),
{G},
r AS (
  SELECT metric, "user", pod, g.j, g.t_ns,
         sum(CASE WHEN prev_ts >= g.t_ns - {P.RANGE_NS}
                  THEN CASE WHEN value >= prev_v THEN value - prev_v ELSE value END ELSE 0 END)
           / ((max(ts_ns) - min(ts_ns)) / 1e9) AS value
  FROM p JOIN g ON p.ts_ns >= g.t_ns - {P.RANGE_NS} AND p.ts_ns < g.t_ns
  GROUP BY metric, "user", pod, g.j, g.t_ns
  HAVING count(*) >= 2 AND max(ts_ns) > min(ts_ns))"""

INSTANT_SQL = f"""{S},
{G},
i AS (
  SELECT metric, "user", pod, j, t_ns, ts_ns AS sample_ts_ns, value FROM (
    SELECT s.*, g.j, g.t_ns,
           row_number() OVER (PARTITION BY metric, "user", g.j ORDER BY ts_ns DESC, value DESC) AS rn
    FROM s JOIN g ON s.ts_ns >= g.t_ns - {P.LOOKBACK_NS} AND s.ts_ns < g.t_ns) WHERE rn = 1)"""


def _t(col: str = "t_ns") -> str:
    return f"CAST({col} // 1000000000 AS BIGINT)"


# ---------------------------------------------------------------- PF-1 / PF-2 / PF-8

SEL_LO, SEL_HI = P.MID_NS - 7 * DAY_NS, P.MID_NS


@query("series_select", f"""WITH {S0}
SELECT metric, "user", pod, ts_ns, value FROM s0
WHERE metric = 'purchase' AND regexp_full_match(pod, '[0-3]') AND "user" <> '7' AND value > 100
  AND ts_ns >= {SEL_LO} AND ts_ns < {SEL_HI}""")
def q_series_select(spark, d):
    s = pq.select_series(samples(spark, d), "purchase", [("pod", "=~", "[0-3]"), ("user", "!=", "7")])
    s = pq.time_range(pq.where_value(s, ">", 100), SEL_LO, SEL_HI)
    return s.select(*_series_cols(s), "ts_ns", "value")


# ---------------------------------------------------------------- WN-4

@query("counter_increase", f"""WITH {S},
p AS (SELECT *, lag(value) OVER (PARTITION BY metric, "user" ORDER BY ts_ns) AS prev_v FROM s)
SELECT metric, "user", pod, ts_ns, value,
       round(CASE WHEN prev_v IS NULL THEN 0 WHEN value >= prev_v THEN value - prev_v ELSE value END, 6) AS inc
FROM p""")
def q_counter_increase(spark, d):
    c = pq.counter_inc(samples(spark, d))
    return c.select(*_series_cols(c), "ts_ns", "value", F.round("inc", 6).alias("inc"))


# ---------------------------------------------------------------- AG-4 / AG-5

@query("rate_per_series", f"""WITH {RATE_SQL}
SELECT metric, "user", pod, {_t()} AS t, round(value, 6) AS value FROM r""")
def q_rate_per_series(spark, d):
    r = pq.rate(samples(spark, d), P.GRID, P.RATE_RANGE)
    return r.select(*_series_cols(r), "t", F.round("value", 6).alias("value"))


@query("increase_per_series", f"""WITH {S},
p AS (SELECT *, lag(ts_ns) OVER w AS prev_ts, lag(value) OVER w AS prev_v
      FROM s WINDOW w AS (PARTITION BY metric, "user" ORDER BY ts_ns)),
{G}
SELECT metric, "user", pod, {_t('g.t_ns')} AS t,
       round(sum(CASE WHEN prev_ts >= g.t_ns - {P.RANGE_NS}
                      THEN CASE WHEN value >= prev_v THEN value - prev_v ELSE value END ELSE 0 END), 6) AS value
FROM p JOIN g ON p.ts_ns >= g.t_ns - {P.RANGE_NS} AND p.ts_ns < g.t_ns
GROUP BY metric, "user", pod, g.t_ns HAVING count(*) >= 2""")
def q_increase_per_series(spark, d):
    r = pq.increase(samples(spark, d), P.GRID, P.RATE_RANGE)
    return r.select(*_series_cols(r), "t", F.round("value", 6).alias("value"))


def sum_rate_by_type(spark, d) -> DataFrame:
    r = pq.rate(samples(spark, d), P.GRID, P.RATE_RANGE)
    return pq.agg_by(r, "sum", ["__name__"]).withColumnRenamed("__name__", "event_type")


@query("sum_rate_by_type", f"""WITH {RATE_SQL}
SELECT metric AS event_type, {_t()} AS t, round(sum(value), 6) AS value FROM r GROUP BY metric, t_ns""",
       headline=True)
def q_sum_rate_by_type(spark, d):
    return sum_rate_by_type(spark, d).select("event_type", "t", F.round("value", 6).alias("value"))


@query("rate_panel", f"""WITH {RATE_SQL},
a AS (SELECT metric AS event_type, t_ns, sum(value) AS value FROM r GROUP BY metric, t_ns)
SELECT event_type, round(arg_max(value, t_ns), 6) AS last, round(avg(value), 6) AS mean,
       round(max(value), 6) AS max, {_t('max(t_ns)')} AS last_t
FROM a GROUP BY event_type""", headline=True)
def q_rate_panel(spark, d):
    """Flagship: sum(rate(events[1d])) by (event_type) -> lastNotNull / mean / max per series."""
    return flagship(spark, d)


def flagship(spark, d) -> DataFrame:
    v = sum_rate_by_type(spark, d)
    red = reduce_series(v, ["event_type"], ["lastNotNull", "mean", "max"], time_col="t")
    return red.select("event_type", F.round("last", 6).alias("last"), F.round("mean", 6).alias("mean"),
                      F.round("max", 6).alias("max"), F.col("last_t"))


# ---------------------------------------------------------------- WN-3 and instant aggregations

def instant_vec(spark, d, metric: str | None = None) -> DataFrame:
    """Instant vector; selecting the metric first lets the scan filter on it (pushed down)."""
    s = samples(spark, d)
    if metric is not None:
        s = pq.select_series(s, metric)
    return pq.instant(s, P.GRID, P.LOOKBACK)


@query("instant_vector", f"""WITH {INSTANT_SQL}
SELECT metric, "user", pod, {_t()} AS t, sample_ts_ns, value FROM i""", headline=True)
def q_instant_vector(spark, d):
    i = instant_vec(spark, d)
    return i.select(*_series_cols(i), "t", "sample_ts_ns", "value")


@query("sum_all", f"""WITH {INSTANT_SQL}
SELECT {_t()} AS t, round(sum(value), 6) AS value FROM i WHERE metric = 'view' GROUP BY t_ns""")
def q_sum_all(spark, d):
    v = instant_vec(spark, d, "view")
    return pq.agg_by(v, "sum", []).select("t", F.round("value", 6).alias("value"))


@query("sum_by_pod", f"""WITH {INSTANT_SQL}
SELECT {_t()} AS t, pod, round(sum(value), 6) AS value FROM i WHERE metric = 'view' GROUP BY t_ns, pod""")
def q_sum_by_pod(spark, d):
    v = instant_vec(spark, d, "view")
    return pq.agg_by(v, "sum", ["pod"]).select("t", "pod", F.round("value", 6).alias("value"))


@query("count_series", f"""WITH {INSTANT_SQL}
SELECT {_t()} AS t, CAST(count(*) AS DOUBLE) AS n_series, CAST(count(DISTINCT pod) AS DOUBLE) AS n_pods
FROM i WHERE metric = 'click' GROUP BY t_ns""")
def q_count_series(spark, d):
    v = instant_vec(spark, d, "click")
    n = pq.agg_by(v, "count", []).withColumnRenamed("value", "n_series")
    p = pq.count_distinct_label(v, "pod").withColumnRenamed("value", "n_pods")
    return n.join(p, ["j", "t"]).select("t", "n_series", "n_pods")


@query("avg_by_type", f"""WITH {INSTANT_SQL}
SELECT metric AS event_type, {_t()} AS t, round(avg(value), 6) AS value FROM i GROUP BY metric, t_ns""")
def q_avg_by_type(spark, d):
    v = pq.agg_by(instant_vec(spark, d), "avg", ["__name__"]).withColumnRenamed("__name__", "event_type")
    return v.select("event_type", "t", F.round("value", 6).alias("value"))


@query("topk_per_step", f"""WITH {INSTANT_SQL}
SELECT t, "user", pod, value, rank FROM (
  SELECT {_t()} AS t, "user", pod, value,
         row_number() OVER (PARTITION BY j ORDER BY value DESC, {SID}) AS rank
  FROM i WHERE metric = 'view') WHERE rank <= {P.TOPK}""")
def q_topk_per_step(spark, d):
    v = pq.topk(instant_vec(spark, d, "view"), P.TOPK)
    return v.select("t", label("labels", "user").alias("user"), label("labels", "pod").alias("pod"),
                    "value", F.col("rank").cast("bigint").alias("rank"))


@query("panel_reduce_by_pod", f"""WITH {INSTANT_SQL},
a AS (SELECT pod, t_ns, sum(value) AS value FROM i WHERE metric = 'view' GROUP BY pod, t_ns)
SELECT pod, round(arg_max(value, t_ns), 6) AS last, round(avg(value), 6) AS mean,
       round(max(value), 6) AS max, {_t('max(t_ns)')} AS last_t
FROM a GROUP BY pod""")
def q_panel_reduce_by_pod(spark, d):
    v = pq.agg_by(instant_vec(spark, d, "view"), "sum", ["pod"])
    red = reduce_series(v, ["pod"], ["lastNotNull", "mean", "max"], time_col="t")
    return red.select("pod", F.round("last", 6).alias("last"), F.round("mean", 6).alias("mean"),
                      F.round("max", 6).alias("max"), "last_t")
