"""Range functions over counters and histograms: rate, increase, quantiles over rated buckets.

``increase`` over ``[t - range, t)`` is the difference of a reset-corrected running total between
the window's last and first point, so a window costs two look-ups, whatever its length:

1. *Cells.* Points are grouped by (series, a, b): ``a`` is the grid step a point lies in, ``b`` the
   step in which it leaves the window. Ordered work (duplicates, resets) runs inside a cell, so a hot
   series is split over its cells; a cell leaves a handful of numbers.
2. *Stitch.* Per series, cells (at most two a grid step) are put in order and summed up: the running
   total at each cell's first and last point.
3. *Ends.* The last cell before ``t`` is the last of its ``a``, and stands until the next ``a``; the
   first cell of the window is the first of its ``b``. Each (series, grid point) meets exactly one of
   either kind: rows are twice the result, independent of range / step and of their divisors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.histograms import quantile_from_buckets
from ..functions.labels import label
from ..functions.time import Grid, duration_ns, floor_div

NS = 1_000_000_000
TEMPORALITIES = ("cumulative", "delta")
_CELL = ["series_id", "a", "b"]


def _in_cells(points: DataFrame, grid: Grid, range_ns: int) -> DataFrame:
    """Points that any window of the grid can hold, with their cell."""
    ts = F.col("ts_ns")
    x = points.filter((ts >= F.lit(grid.start_ns - range_ns)) & (ts < F.lit(grid.end_ns)))
    return (x.withColumn("a", floor_div(ts - F.lit(grid.start_ns), grid.step_ns))
            .withColumn("b", floor_div(ts + F.lit(range_ns - grid.start_ns), grid.step_ns)))


def _increments(now: Sequence[Column], before: Sequence[Column], layout: tuple[Column, Column] | None,
                temporality: str) -> list[Column]:
    """What each number grew by since the point before (null: none). Delta points are increments
    already. A point is a reset if its number fell or, with a layout (numbers are then cumulative
    over buckets), if the layout changed or any single bucket fell; it then counts from zero."""
    if temporality == "delta":
        return list(now)
    reset = before[0].isNull() | (now[0] < before[0])
    for i in range(1, len(now)):
        reset = reset | (now[i] - now[i - 1] < before[i] - before[i - 1])
    if layout is not None:
        reset = reset | (layout[0] != layout[1])
    return [F.when(reset, n).otherwise(n - b) for n, b in zip(now, before)]


def _window_ends(points: DataFrame, values: list[str], grid: Grid, range_ns: int, temporality: str,
                 layout: str | None = None) -> DataFrame:
    """(series_id, j, n, first_ts, last_ts, inc_<value>...) for each series and grid point whose window
    holds a point. ``points``: series_id, ts_ns, the value columns, and the layout (a number)."""
    if temporality not in TEMPORALITIES:
        raise ValueError(f"temporality is one of {TEMPORALITIES}")
    extra = [layout] if layout else []
    x = _in_cells(points, grid, range_ns).select(*_CELL, "ts_ns", *values, *extra).repartition(*_CELL)
    w = Window.partitionBy(*_CELL).orderBy("ts_ns", *[F.desc(v) for v in reversed(values)])
    x = x.withColumn("again", F.lag("ts_ns").over(w) == F.col("ts_ns"))
    x = x.filter(~F.coalesce("again", F.lit(False)))  # points are unique per time: the larger one stays
    x = x.select("*", *[F.lag(v).over(w).alias(f"was_{v}") for v in [*values, *extra]],
                 F.lag("ts_ns").over(w).isNull().alias("is_first"), F.lead("ts_ns").over(w).isNull().alias("is_last"))
    inner = _increments([F.col(v) for v in values], [F.col(f"was_{v}") for v in values],
                        (F.col(layout), F.col(f"was_{layout}")) if layout else None, temporality)
    cells = x.groupBy(*_CELL).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts_ns").alias("first_ts"), F.max("ts_ns").alias("last_ts"),
        *[F.sum(F.when(~F.col("is_first"), i).otherwise(F.lit(0.0))).alias(f"in_{v}") for v, i in zip(values, inner)],
        *[F.sum(F.when(F.col("is_first"), F.col(v))).alias(f"f_{v}") for v in [*values, *extra]],
        *[F.sum(F.when(F.col("is_last"), F.col(v))).alias(f"l_{v}") for v in [*values, *extra]])

    # few and small rows that grow by the explode below: as many tasks as set, not as few as their bytes suggest
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = cells.repartition(tasks, "series_id")
    ws = Window.partitionBy("series_id").orderBy("first_ts")
    past = ws.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = _increments([F.col(f"f_{v}") for v in values], [F.lag(f"l_{v}").over(ws) for v in values],
                       (F.col(f"f_{layout}"), F.lag(f"l_{layout}").over(ws)) if layout else None, temporality)
    cells = cells.select("*", *[e.alias(f"edge_{v}") for v, e in zip(values, edge)],
                         F.lag("b").over(ws).alias("b_before"), F.lead("a").over(ws).alias("a_after"))
    cells = cells.select(
        "series_id", "a", "b", "b_before", "a_after", "first_ts", "last_ts",
        F.sum("n").over(past).alias("n_last"), (F.sum("n").over(past) - F.col("n") + 1).alias("n_first"),
        *[(F.sum(F.col(f"edge_{v}") + F.col(f"in_{v}")).over(past)).alias(f"to_{v}") for v in values],
        *[(F.sum(F.col(f"edge_{v}") + F.col(f"in_{v}")).over(past) - F.col(f"in_{v}")).alias(f"from_{v}") for v in values])

    def span(low, high):
        low, high = F.greatest(low, F.lit(0)), F.least(high, F.lit(grid.n_points - 1))
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    leaves = floor_div(F.col("last_ts") + F.lit(range_ns - grid.start_ns), grid.step_ns)
    is_end = F.col("a_after").isNull() | (F.col("a_after") != F.col("a"))
    is_start = F.col("b_before").isNull() | (F.col("b_before") != F.col("b"))
    ends = span(F.col("a") + 1, F.least(F.coalesce("a_after", leaves), leaves))
    starts = span(F.greatest(F.coalesce(F.col("b_before") + 1, F.lit(0)), F.col("a") + 1), F.col("b"))

    def side(js, keep, last):
        return F.transform(F.when(keep, js).otherwise(F.array().cast("array<bigint>")),
                           lambda j: F.struct(j.alias("j"), F.lit(last).alias("last")))
    rows = cells.select("*", F.explode(F.concat(side(ends, is_end, True), side(starts, is_start, False))).alias("x"))
    last = F.col("x.last")

    def at(col, is_last):
        return F.max(F.when(last if is_last else ~last, F.col(col)))
    return rows.groupBy("series_id", F.col("x.j").alias("j")).agg(
        (at("n_last", True) - at("n_first", False) + 1).alias("n"),
        at("first_ts", False).alias("first_ts"), at("last_ts", True).alias("last_ts"),
        *[(at(f"to_{v}", True) - at(f"from_{v}", False)).alias(f"inc_{v}") for v in values])


def counter_windows(samples: DataFrame, grid: Grid, range_: str | int, temporality: str = "cumulative") -> DataFrame:
    """(series_id, j, t, n, first_ts, last_ts, increase) for counter samples (series_id, ts_ns, value)."""
    ends = _window_ends(samples, ["value"], grid, duration_ns(range_), temporality)
    return ends.select("series_id", "j", (grid.t_ns(F.col("j")) / F.lit(NS)).cast("bigint").alias("t"),
                       "n", "first_ts", "last_ts", F.col("inc_value").alias("increase"))


# ---------------------------------------------------------------- histograms (AG-6 over AG-4)

def merged_bounds(hist: DataFrame, most: int = 512) -> list[float]:
    """All distinct finite bounds, ascending. Bounds are configuration: more than ``most`` are an error."""
    rows = hist.select(F.explode("bounds").alias("le")).filter(F.col("le") < F.lit(float("inf"))).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} distinct histogram bounds")
    return sorted(r.le for r in rows)


def aligned_counts(bounds: Column, counts: Column, les: Sequence[float]) -> Column:
    """Cumulative counts at each of ``les`` and +Inf: what lies in buckets that end there or below."""
    running = F.aggregate(counts, F.array().cast("array<double>"), lambda acc, c: F.concat(
        acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + c)))
    own = F.transform(F.array(running), lambda run: F.when(
        bounds == F.array(*[F.lit(float(x)) for x in les]), run).otherwise(F.concat(
            F.transform(F.array(*[F.lit(float(x)) for x in les]), lambda le: F.coalesce(
                F.get(run, F.size(F.filter(bounds, lambda b: b <= le)) - 1), F.lit(0.0))),
            F.array(F.element_at(run, -1)))))
    return own[0]


def rated_buckets(hist: DataFrame, grid: Grid, range_: str | int, by: Sequence[str] = (),
                  temporality: str = "cumulative") -> DataFrame:
    """``sum by (le, by...) (rate(buckets[range]))`` -> (by..., j, t, buckets ARRAY<STRUCT<le, cum>>).

    ``hist``: series_id, labels, ts_ns, counts, bounds; points may be cumulative (with resets) or
    deltas. Bounds may differ between series and change within one: all points are brought to the
    merged bounds first. Resets are found on the point as a whole. Points without counts are left out;
    windows with fewer than two points of a series give nothing for it."""
    points = hist.filter(F.size("counts") > 0)
    les = merged_bounds(points)
    names = [f"v{i}" for i in range(len(les) + 1)]
    x = points.select("series_id", "ts_ns", F.xxhash64("bounds").alias("layout"),
                      aligned_counts(F.col("bounds"), F.col("counts"), les).alias("v"))
    x = x.select("series_id", "ts_ns", "layout", *[F.get("v", F.lit(i)).alias(c) for i, c in enumerate(names)])
    ends = _window_ends(x, names, grid, duration_ns(range_), temporality, "layout")
    span = (F.col("last_ts") - F.col("first_ts")) / F.lit(float(NS))
    series = F.from_json("series_id", "struct<metric:string,labels:array<struct<key:string,value:string>>>")
    labels = F.map_from_entries(series["labels"])
    keys = [(series["metric"] if k == "__name__" else label(labels, k)).alias("metric" if k == "__name__" else k) for k in by]
    rated = ends.filter((F.col("n") >= 2) & (F.col("last_ts") > F.col("first_ts"))).select(
        *keys, "j", *[(F.col(f"inc_{c}") / span).alias(c) for c in names])
    groups = ["metric" if k == "__name__" else k for k in by]
    sums = rated.groupBy(*groups, "j").agg(*[F.sum(c).alias(c) for c in names])
    buckets = F.array(*[F.struct(F.lit(float(le)).alias("le"), F.col(c).alias("cum"))
                        for le, c in zip([*les, float("inf")], names)])
    return sums.select(*groups, "j", (grid.t_ns(F.col("j")) / F.lit(NS)).cast("bigint").alias("t"), buckets.alias("buckets"))


def rated_bucket_quantile(hist: DataFrame, qs: Sequence[float], grid: Grid, range_: str | int, by: Sequence[str] = (),
                          temporality: str = "cumulative") -> DataFrame:
    """``histogram_quantile(q, sum by (le, by...) (rate(buckets[range])))`` for each ``q``."""
    x = rated_buckets(hist, grid, range_, by, temporality)
    keep = [c for c in x.columns if c != "buckets"]
    x = x.select(*keep, F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q"), "buckets")
    return x.select(*keep, "q", quantile_from_buckets(F.col("q"), F.col("buckets")).alias("value"))
