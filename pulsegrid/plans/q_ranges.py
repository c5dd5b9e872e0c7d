"""Rates over long ranges and fine steps, quantiles over rated buckets, delta temporality
(AG-4, AG-5, AG-6, SRC-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.labels import series_key
from ..functions.time import Grid
from ..operators import promql as pq
from ..operators import ranges as R
from ..sources.tables import read_table
from . import params as P
from .adapters import HIST_BOUNDS, a_hist
from .q_metrics import RATE_SQL, S, samples
from .q_signals import HIST_SQL, QS
from .registry import query

DAY_NS = 86_400 * 1_000_000_000
FINE = Grid.of(P.GRID_START, P.GRID_END, "1m")
LONG_NS = 30 * DAY_NS
DAILY = Grid.of(P.GRID_START, P.GRID_END, "1d")
HIST_RANGE = "5d"
EPOCH_DAYS = 7                # a process of the adapter lives so long, then counts from zero
COARSE_FROM_NS = P.START_NS + 15 * DAY_NS
COARSE_DROPS = (3, 6)         # buckets that the coarser layout merges into the next


def cumulative_hist(events: DataFrame) -> DataFrame:
    """Daily points of cumulative histograms per (metric, pod): counts grow within an epoch of seven
    days and restart with the next; from a fixed day on, even pods report with fewer bounds."""
    h = a_hist(events)
    day = F.floor(F.col("ts_ns") / F.lit(DAY_NS))
    w = (Window.partitionBy("metric", "pod", F.floor(day / EPOCH_DAYS)).orderBy("ts_ns")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    n = len(HIST_BOUNDS) + 1
    fine = F.array(*[F.sum(F.get("counts", F.lit(i))).over(w) for i in range(n)])
    h = h.select("metric", "pod", "labels", "ts_ns", fine.alias("counts"), "bounds")
    coarse = (F.col("pod").cast("int") % 2 == 0) & (F.col("ts_ns") >= COARSE_FROM_NS)
    kept = [i for i in range(n) if i not in COARSE_DROPS]
    merged = F.array(*[F.get("counts", F.lit(i)) + (F.get("counts", F.lit(i - 1)) if i - 1 in COARSE_DROPS else F.lit(0)) for i in kept])
    fewer = F.array(*[F.get("bounds", F.lit(i)) for i in kept[:-1]])
    return h.select("metric", "pod", "labels", "ts_ns", F.when(coarse, merged).otherwise(F.col("counts")).alias("counts"),
                    F.when(coarse, fewer).otherwise(F.col("bounds")).alias("bounds"),
                    series_key("metric", "labels").alias("series_id"))


# ---------------------------------------------------------------- AG-4 / AG-5: long range, fine step

@query("rate_30d_at_1m", f"""WITH s AS (SELECT event_type AS metric, epoch_us(ts) * 1000 AS ts_ns, max(value) AS value FROM events GROUP BY ALL),
p AS (SELECT *, lag(value) OVER w AS prev_v, row_number() OVER w AS n FROM s WINDOW w AS (PARTITION BY metric ORDER BY ts_ns)),
q AS (SELECT metric, ts_ns, n, sum(CASE WHEN prev_v IS NULL THEN 0 WHEN value >= prev_v THEN value - prev_v ELSE value END)
        OVER (PARTITION BY metric ORDER BY ts_ns) AS total FROM p),
g AS (SELECT {FINE.start_ns} + range * {FINE.step_ns} AS t_ns FROM range(0, {FINE.n_points})),
m AS (SELECT DISTINCT metric FROM s),
k AS (SELECT metric, t_ns, t_ns - {LONG_NS} AS low FROM g, m),
l AS (SELECT k.*, q.ts_ns AS last_ts, q.n AS last_n, q.total AS last_total FROM k ASOF JOIN q ON k.metric = q.metric AND k.t_ns > q.ts_ns),
f AS (SELECT l.*, q.ts_ns AS first_ts, q.n AS first_n, q.total AS first_total FROM l ASOF JOIN q ON l.metric = q.metric AND l.low <= q.ts_ns)
SELECT metric AS event_type, CAST(t_ns // 1000000000 AS BIGINT) AS t,
       round((last_total - first_total) / ((last_ts - first_ts) / 1e9), 6) AS value
FROM f WHERE last_n > first_n AND last_ts > first_ts""")
def q_rate_30d_at_1m(spark, d):
    """One series a type: rows of the plan follow the points and the grid, not range / step (43,200)."""
    e = read_table(spark, d, "events")
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    s = e.select(F.col("event_type").alias("metric"), none.alias("labels"),
                 (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("ts_ns"), F.col("value").cast("double").alias("value"))
    r = pq.rate(s.withColumn("series_id", series_key("metric", "labels")), FINE, LONG_NS)
    return r.select(F.col("metric").alias("event_type"), "t", F.round("value", 6).alias("value"))


# ---------------------------------------------------------------- SRC-1: delta temporality

@query("delta_rate_by_type", f"""WITH {S}, {RATE_SQL[RATE_SQL.index('g AS'):RATE_SQL.index('r AS (')].rstrip().rstrip(',')},
r AS (SELECT metric, g.t_ns, (sum(value) - arg_min(value, ts_ns)) / ((max(ts_ns) - min(ts_ns)) / 1e9) AS value
      FROM s JOIN g ON s.ts_ns >= g.t_ns - {P.RANGE_NS} AND s.ts_ns < g.t_ns
      GROUP BY metric, "user", g.t_ns HAVING count(*) >= 2 AND max(ts_ns) > min(ts_ns))
SELECT metric AS event_type, CAST(t_ns // 1000000000 AS BIGINT) AS t, round(sum(value), 6) AS value FROM r GROUP BY ALL""")
def q_delta_rate_by_type(spark, d):
    """Event values as delta sums: the rate of their running total."""
    r = pq.agg_by(pq.rate(samples(spark, d), P.GRID, P.RATE_RANGE, temporality="delta"), "sum", ["__name__"])
    return r.select(F.col("__name__").alias("event_type"), "t", F.round("value", 6).alias("value"))


# ---------------------------------------------------------------- AG-6 over AG-4

_LAST = len(HIST_BOUNDS)
_CUMULATIVE = f"""cu AS (
  SELECT *, sum(cum) OVER (PARTITION BY metric, pod, i, (ts_ns // {DAY_NS}) // {EPOCH_DAYS} ORDER BY ts_ns) AS v,
         CAST(pod AS INT) % 2 = 0 AND ts_ns >= {COARSE_FROM_NS} AS coarse FROM c),
al0 AS (SELECT a.metric, a.pod, a.ts_ns, a.i, a.le, a.coarse, b.v FROM cu a JOIN cu b ON a.metric = b.metric AND a.pod = b.pod
       AND a.ts_ns = b.ts_ns AND b.i = CASE WHEN a.coarse AND a.i IN {COARSE_DROPS} THEN a.i - 1 ELSE a.i END),
al AS (SELECT *, v - coalesce(lag(v) OVER (PARTITION BY metric, pod, ts_ns ORDER BY i), 0) AS own FROM al0),
lg AS (SELECT *, lag(v) OVER w AS pv, lag(own) OVER w AS pown, lag(coarse) OVER w AS pc FROM al WINDOW w AS (PARTITION BY metric, pod, i ORDER BY ts_ns)),
rs AS (SELECT *, bool_or(pv IS NULL OR own < pown OR coarse <> pc) OVER (PARTITION BY metric, pod, ts_ns) AS reset FROM lg),
dd AS (SELECT metric, pod, ts_ns, i, le, CASE WHEN reset THEN v ELSE v - pv END AS d FROM rs)"""
_DELTA = "dd AS (SELECT metric, pod, ts_ns, i, le, cum AS d FROM c)"


def _quantile_sql(increments: str) -> str:
    return f"""WITH {HIST_SQL}, {increments},
g AS (SELECT {DAILY.start_ns} + range * {DAILY.step_ns} AS t_ns FROM range(0, {DAILY.n_points})),
wi AS (SELECT metric, pod, t_ns, min(ts_ns) AS f, max(ts_ns) AS l FROM dd JOIN g ON ts_ns >= t_ns - {5 * DAY_NS} AND ts_ns < t_ns
       WHERE i = 0 GROUP BY ALL HAVING max(ts_ns) > min(ts_ns)),
h AS (SELECT metric, t_ns, i, le, sum(v) AS cum FROM (
        SELECT wi.metric, wi.t_ns, wi.pod, i, le, sum(CASE WHEN ts_ns > f THEN d ELSE 0 END) / ((any_value(l) - any_value(f)) / 1e9) AS v
        FROM wi JOIN dd ON dd.metric = wi.metric AND dd.pod = wi.pod AND ts_ns >= f AND ts_ns <= l GROUP BY ALL) GROUP BY ALL),
tot AS (SELECT metric, t_ns, cum AS tot FROM h WHERE i = {_LAST}),
hit AS (SELECT h.metric, h.t_ns, q, tot, min(i) FILTER (WHERE cum >= q * tot) AS hi
        FROM h JOIN tot USING (metric, t_ns), (SELECT unnest({QS}::DOUBLE[]) AS q) GROUP BY ALL)
SELECT hit.metric, CAST(hit.t_ns // 1000000000 AS BIGINT) AS t, q,
       round(CASE WHEN tot = 0 THEN NULL WHEN hi = {_LAST} THEN {float(HIST_BOUNDS[-1])}
                  WHEN up.cum = coalesce(lo.cum, 0) THEN up.le
                  ELSE coalesce(lo.le, 0) + (up.le - coalesce(lo.le, 0)) * (q * tot - coalesce(lo.cum, 0)) / (up.cum - coalesce(lo.cum, 0)) END, 8) AS value
FROM hit JOIN h up ON up.metric = hit.metric AND up.t_ns = hit.t_ns AND up.i = hi
LEFT JOIN h lo ON lo.metric = hit.metric AND lo.t_ns = hit.t_ns AND lo.i = hi - 1"""


def _quantiles(hist: DataFrame, temporality: str) -> DataFrame:
    r = R.rated_bucket_quantile(hist, QS, DAILY, HIST_RANGE, by=["__name__"], temporality=temporality)
    return r.select("metric", "t", "q", F.round("value", 8).alias("value"))


@query("rated_bucket_quantile", _quantile_sql(_CUMULATIVE))
def q_rated_bucket_quantile(spark: SparkSession, d: str):
    """histogram_quantile(q, sum by (le, metric) (rate(buckets[5d]))) with resets and a change of bounds."""
    return _quantiles(cumulative_hist(read_table(spark, d, "events")), "cumulative")


@query("delta_bucket_quantile", _quantile_sql(_DELTA))
def q_delta_bucket_quantile(spark: SparkSession, d: str):
    return _quantiles(a_hist(read_table(spark, d, "events")), "delta")
