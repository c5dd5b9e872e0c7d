"""Streaming operators: sliding counts and rates, alert states, dedup, topic routing
(STR-2, STR-3, STR-4, STR-6).

Windows follow the batch contract: the window for range ``r`` ending at ``t`` is
``[t - r, t)`` — exactly ``F.window(ts, r, step)`` — so closed windows of a stream equal
the batch result at the same grid points (t on the step grid anchored at the epoch).
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import topic_parts
from ..functions.plan import with_columns_once
from ..functions.time import duration_ns
from ..operators.alerts import holds, selected

NS = 1_000_000_000


def _window_cols(w: str = "window") -> list:
    return [F.unix_seconds(F.col(f"{w}.end")).alias("t"), F.unix_seconds(F.col(f"{w}.start")).alias("t_start")]


def stream_log_count(logs: DataFrame, range_: str, step: str, by: Sequence[str], delay: str) -> DataFrame:
    """STR-2: ``count_over_time`` per stream labels on sliding windows (append mode emits a
    window once the watermark passes its end). ``by`` are columns of ``logs``."""
    x = logs.withWatermark("ts", delay)
    return (x.groupBy(F.window("ts", range_, step), *by).agg(F.count(F.lit(1)).alias("n"))
            .select(*_window_cols(), *by, F.col("n").cast("double").alias("value")))


def dedup_points(samples: DataFrame, delay: str | None = None) -> DataFrame:
    """STR-6: repeated (series, ts) points count once, with the larger value. In a stream a point
    is emitted when the watermark passes its time, so every repetition within ``delay`` is seen."""
    if samples.isStreaming:
        samples = samples.withWatermark("ts", delay or "10 minutes")
    return samples.groupBy("series_id", "ts", "ts_ns").agg(F.max("value").alias("value"))


# ---------------------------------------------------------------- rates (buckets, then windows)

def _blocks(at: str, span_ns: int, block_ns: int, end_ns: int):
    """Blocks of ``block_ns``, one of them ending at ``end_ns``, each with the ``span_ns`` before its end."""
    start = (end_ns - span_ns) % block_ns // 1000
    return F.window(at, _micros(span_ns), _micros(block_ns), f"{start} microseconds")


def _micros(ns: int) -> str:
    return f"{ns // 1000} microseconds"


def _interval_ns(text: str) -> int:
    """``1 day``, ``30 minutes`` (Spark's intervals) or ``6h`` in nanoseconds."""
    return duration_ns(re.sub(r"\s*(second|minute|hour|day|week)s?\s*", lambda m: m[1][0], text))


def _ends(block_ns: int, step_ns: int):
    """Grid times that a block answers for, in nanoseconds: those in its last ``block_ns``."""
    last = F.unix_micros("window.end") * 1000
    return F.sequence(last - F.lit(block_ns - step_ns), last, F.lit(step_ns))


def stream_rate(samples: DataFrame, range_: str, step: str, delay: str, block: str | None = None,
                end_ns: int = 0) -> DataFrame:
    """STR-2: per (window, series) the counter increase over the pairs inside the window, by seconds.

    Two window aggregations in a row. A bucket of one ``step`` holds a series' points until the
    watermark passes it (rows in any order, repeated times keep the larger value), then leaves six
    numbers; a window of ``range_`` (a multiple of ``step``) stitches its buckets' numbers. State is
    keyed by (time, series): a hot series spreads over its buckets, an idle one leaves no state.

    Windows are made ``block`` (a multiple of ``step``) at a time: a block holds the buckets of all
    windows that end in it, so that a bucket is kept in ``range_ / block + 1`` places instead of
    ``range_ / step``, and emits them when the watermark passes its end. The default, one step, emits
    each window at once. A replay passes a longer block and as ``end_ns`` the last grid time that its
    watermark passes, where a block then ends: no closed window is left behind."""
    range_ns, step_ns = _interval_ns(range_), _interval_ns(step)
    block_ns = _interval_ns(block or step)
    x = samples.withWatermark("ts", delay)
    buckets = x.groupBy(F.window("ts", _micros(step_ns)), "series_id").agg(
        F.sort_array(F.collect_list(F.struct("ts_ns", "value"))).alias("points"))
    buckets = with_columns_once(buckets, {"p": F.filter("points", lambda e, i: F.coalesce(
        F.get("points", i + 1)["ts_ns"] != e["ts_ns"], F.lit(True)))})
    first, last = F.get("p", F.lit(0)), F.element_at("p", -1)
    part = F.struct(first["ts_ns"].alias("first_ts"), first["value"].alias("first"), last["ts_ns"].alias("last_ts"),
                    last["value"].alias("last"), F.size("p").alias("n"), _increase(
                        F.col("p"), lambda e: e["value"], lambda e: e["value"]).alias("inside"))
    blocks = buckets.select(F.window_time("window").alias("at"), "series_id", part.alias("part")).groupBy(
        _blocks("at", range_ns + block_ns - step_ns, block_ns, end_ns), "series_id").agg(
        F.sort_array(F.collect_list("part")).alias("all"))
    several = (F.size("all") > 1) | (F.get("all", F.lit(0))["n"] > 1)  # one point makes no pair
    windows = blocks.filter(several).select("series_id", "all", F.explode(_ends(block_ns, step_ns)).alias("t_ns"))
    windows = with_columns_once(windows, {"parts": F.filter("all", lambda e: (
        e["first_ts"] >= F.col("t_ns") - F.lit(range_ns)) & (e["first_ts"] < F.col("t_ns")))}).filter("size(parts) > 0")
    inside = F.aggregate("parts", F.lit(0.0), lambda a, e: a + e["inside"])
    increase = inside + _increase(F.col("parts"), lambda e: e["last"], lambda e: e["first"])
    n = F.aggregate("parts", F.lit(0), lambda a, e: a + e["n"])
    span = F.element_at("parts", -1)["last_ts"] - F.get("parts", F.lit(0))["first_ts"]
    t = F.expr(f"t_ns div {NS}")
    out = with_columns_once(windows, {"n": n, "span": span}).filter("n >= 2 AND span > 0")
    return out.select(t.alias("t"), (t - F.lit(range_ns // NS)).alias("t_start"), "series_id",
                      (increase / (F.col("span") / F.lit(float(NS)))).alias("value"))


def _increase(items, before, after):
    """Increase over neighbouring items: from ``before(item)`` to ``after(next item)``; a reset counts the new value."""
    pairs = F.transform(items, lambda e, i: F.when(i == 0, 0.0).otherwise(
        F.when(after(e) < before(F.get(items, i - 1)), after(e)).otherwise(after(e) - before(F.get(items, i - 1)))))
    return F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x)


# ---------------------------------------------------------------- alerts (buckets, then blocks of grid times)

def stream_alerts(samples: DataFrame, rules: list, lookback: str, step: str, delay: str, block: str | None = None,
                  end_ns: int = 0) -> DataFrame:
    """STR-3: the batch alert states on the epoch-aligned grid of ``step``, for grid times that the
    watermark has passed.

    A bucket keeps the newest value of each (rule, series); its width divides ``step`` and ``lookback``.
    A block (see ``stream_rate``) holds the buckets that its grid times and the times that ``for`` spans
    before them look back to. A grid time's value is the newest within ``lookback``, so a pending alert
    fires with time and needs no new sample: firing if the condition held at all times ``for`` spans."""
    step_ns, back_ns = _interval_ns(step), _interval_ns(lookback)
    block_ns = _interval_ns(block or step)
    hold = max(_steps(r.for_, step_ns) for r in rules)
    arr = F.array(*[F.struct(F.lit(r.alert).alias("alert"), F.lit(r.metric).alias("metric")) for r in rules])
    # generated, since a plain filter moves below the watermark, which all samples advance
    x = with_columns_once(samples.withWatermark("ts", delay), {"mine": F.filter(arr, lambda r: r["metric"] == F.col("metric"))})
    x = x.withColumn("alert", F.explode("mine.alert"))
    x = x.filter(selected(rules, F.col("alert"), F.col("labels")))
    buckets = x.groupBy(F.window("ts", _micros(math.gcd(step_ns, back_ns))), "alert", "series_id").agg(
        F.max(F.struct("ts_ns", "value")).alias("newest"))
    blocks = buckets.select(F.window_time("window").alias("at"), "alert", "series_id", "newest").groupBy(
        _blocks("at", back_ns + hold * step_ns + block_ns - step_ns, block_ns, end_ns), "alert", "series_id").agg(
        F.sort_array(F.collect_list("newest")).alias("all"))

    def by_rule(value):
        out = F.lit(None)
        for r in rules:
            out = F.when(F.col("alert") == r.alert, value(r)).otherwise(out)
        return out
    steps = by_rule(lambda r: F.lit(_steps(r.for_, step_ns)))

    def at(t):  # the grid time's newest value in reach (null: none)
        reach = F.filter("all", lambda e: (e["ts_ns"] >= t - F.lit(back_ns)) & (e["ts_ns"] < t))
        return F.transform(F.array(F.try_element_at(reach, F.lit(-1))), lambda e: F.struct(
            t.alias("t_ns"), e.isNotNull().alias("there"), e["value"].alias("value"), F.coalesce(by_rule(
                lambda r: holds(F.lit(r.op), e["value"], F.lit(float(r.threshold)))), F.lit(False)).alias("cond")))[0]
    grid = F.transform(_ends(block_ns + hold * step_ns, step_ns), at)  # the held times first, then the block's
    blocks = with_columns_once(blocks.select("window", "alert", "series_id", "all"), {"grid": grid, "steps": steps})
    out = blocks.select("alert", "series_id", "grid", "steps", F.posexplode("grid").alias("i", "now"))
    out = out.filter((F.col("i") >= hold) & F.col("now.there"))
    held = F.forall(F.slice("grid", F.col("i") + 1 - F.col("steps"), F.col("steps") + 1), lambda e: e["cond"])
    state = F.when(~F.col("now.cond"), "inactive").when(held, "firing").otherwise("pending")
    return out.select("alert", "series_id", F.expr(f"now.t_ns div {NS}").alias("t"), F.col("now.value").alias("value"),
                      state.alias("state"))


def _steps(for_: str, step_ns: int) -> int:
    """Grid steps after which a condition has held for ``for``."""
    return -(-duration_ns(for_) // step_ns)


# ---------------------------------------------------------------- topic routing (STR-4)

def route_events(records: DataFrame) -> DataFrame:
    """Adds domain / event_type / version from the topic name."""
    return records.withColumn("p", topic_parts("topic")).select(
        "*", F.col("p.domain").alias("domain"), F.col("p.event_type").alias("event_type"),
        F.col("p.version").alias("version")).drop("p")


def write_routed(records: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """One folder per domain. The file sink commits each micro-batch once through its log, so a
    batch that is replayed after a failure is not written twice (read ``path`` as a whole)."""
    w = (route_events(records).writeStream.format("parquet").option("path", path).partitionBy("domain")
         .option("checkpointLocation", checkpoint))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
