"""Explicit-bounds histograms: bucket rows and quantiles as Catalyst expressions (SC-10, AG-6, DD-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INF = float("inf")


def bucket_index(value: Column, bounds: Sequence[float]) -> Column:
    """Index of the first bucket whose upper bound ``le >= value`` (len(bounds) = +Inf)."""
    arr = F.array(*[F.lit(float(b)) for b in bounds])
    return F.size(F.filter(arr, lambda b: b < value))


def le_label(le: Column) -> Column:
    """Prometheus ``le`` label text: shortest decimal form, ``+Inf`` for the last bucket."""
    return (F.when(le == F.lit(INF), F.lit("+Inf"))
            .when(le == F.floor(le), F.floor(le).cast("bigint").cast("string"))
            .otherwise(le.cast("string")))


def cumulative_buckets(hist: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """SC-10: one row per bucket with cumulative count; ``n + 1`` counts for ``n`` bounds,
    the extra one is the +Inf bucket. Empty or missing bucket arrays give no rows."""
    counts = F.col("counts")
    exploded = hist.select(*keep, "bounds", "counts", F.posexplode_outer("counts").alias("i", "c"))
    exploded = exploded.filter(F.col("i").isNotNull())
    cum = F.aggregate(F.slice(counts, 1, F.col("i") + 1), F.lit(0).cast("bigint"), lambda a, x: a + x)
    le = F.when(F.col("i") < F.size("bounds"), F.get(F.col("bounds"), F.col("i"))).otherwise(F.lit(INF))
    return exploded.select(*keep, le.alias("le"), cum.alias("cum"))


def quantile_from_buckets(q: Column, buckets: Column) -> Column:
    """histogram_quantile on ``ARRAY<STRUCT<le DOUBLE, cum BIGINT|DOUBLE>>`` sorted by ``le``
    (last element is +Inf).

    First bucket with ``cum >= q * total``; linear inside it, lower bound 0 for the first;
    the +Inf bucket returns the largest finite bound; total 0 -> NULL.
    """
    n = F.size(buckets)
    tot = F.element_at(buckets, -1)["cum"].cast("double")
    rank = q * tot
    indexed = F.transform(buckets, lambda x, i: F.struct(x["le"].alias("le"), x["cum"].cast("double").alias("cum"),
                                                        i.alias("i")))
    hit = F.get(F.filter(indexed, lambda x: x["cum"] >= rank), 0)
    i = hit["i"]
    upper, ucum = hit["le"], hit["cum"]
    prev = F.get(indexed, i - 1)
    lower = F.when(i == 0, F.lit(0.0)).otherwise(prev["le"])
    lcum = F.when(i == 0, F.lit(0.0)).otherwise(prev["cum"])
    inner = F.when(ucum == lcum, upper).otherwise(lower + (upper - lower) * (rank - lcum) / (ucum - lcum))
    largest_finite = F.get(indexed, n - 2)["le"]
    return (F.when((tot.isNull()) | (tot == 0), F.lit(None).cast("double"))
            .when(upper == F.lit(INF), largest_finite)
            .otherwise(inner))


def histogram_quantile(hist: DataFrame, qs: Sequence[float], by: Sequence[str],
                       time_col: str = "ts_ns") -> DataFrame:
    """AG-6: ``histogram_quantile(q, sum by (le, by...) (buckets))``.

    Step 1 sums cumulative counts per (by, t, le) with a partial aggregate; step 2 gathers
    the per-group bucket list, whose length is the number of distinct bounds (not data
    size), and evaluates every quantile with higher-order functions (no UDF)."""
    rows = cumulative_buckets(hist, keep=[*by, time_col])
    summed = rows.groupBy(*by, time_col, "le").agg(F.sum("cum").alias("cum"))
    grouped = summed.groupBy(*by, time_col).agg(
        F.array_sort(F.collect_list(F.struct("le", "cum"))).alias("buckets"))
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    return (grouped.select(*by, time_col, F.explode(qarr).alias("q"), "buckets")
            .select(*by, time_col, "q", quantile_from_buckets(F.col("q"), F.col("buckets")).alias("value")))


def histogram_series(hist: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """DD-5: histogram points -> ``<m>_bucket{le}``, ``<m>_count``, ``<m>_sum`` sample rows."""
    b = cumulative_buckets(hist, keep=["metric", *keep, "ts_ns"])
    buckets = b.select(F.concat(F.col("metric"), F.lit("_bucket")).alias("name"), *keep, "ts_ns",
                       le_label(F.col("le")).alias("le"), F.col("cum").cast("double").alias("value"))
    cnt = hist.select(F.concat(F.col("metric"), F.lit("_count")).alias("name"), *keep, "ts_ns",
                      F.lit(None).cast("string").alias("le"), F.col("count").cast("double").alias("value"))
    sm = hist.select(F.concat(F.col("metric"), F.lit("_sum")).alias("name"), *keep, "ts_ns",
                     F.lit(None).cast("string").alias("le"), F.col("sum").cast("double").alias("value"))
    return buckets.unionByName(cnt).unionByName(sm)
