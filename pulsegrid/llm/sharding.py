"""Sharding by extendible hashing (DataFrame expressions only).

Rows are hashed to 60 bits of their key's md5. The directory starts as one bucket; only a
bucket over the byte limit splits, on the next hash bit, until every shard fits.

* A row's size is ``octet_length`` of its text (null: 0).
* A shard is named by its depth (bits used) and prefix (those bits).
* Rows that agree in all 60 bits (repeated keys) and exceed the limit together are dealt into
  numbered parts of at most ``limit`` bytes; ``part`` is 0 everywhere else. A single row larger
  than the limit is a part of its own, the only shard that may exceed the limit.
* A null key hashes like the empty text. An empty table gives an empty result. Other columns are
  kept; the result columns replace columns of the same names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HASH_BITS, fresh, hash60, join_sized, settle

LIMIT = 32 << 20
STEP = 12


def directory(rows: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """Levels of the directory over ``rows`` (h, bytes): (bits, table of (cell, depth, bytes)).

    A level looks ``STEP`` bits further down, and only below buckets that were still too large.
    Every cell of ``bits`` hash bits names the depth of the shard it lies in, or a null depth
    where the cell alone is over the limit and the next level goes on. One aggregation of the
    rows a level; the search for the split bit runs on cell sums."""
    levels, base, open_cells = [], 0, None
    while base < HASH_BITS:
        bits = base + STEP
        here = rows
        if open_cells is not None:
            parent = F.shiftright("h", HASH_BITS - base)
            here = rows.withColumn("up", parent).join(open_cells, "up", "left_semi")
        cells = settle(here.groupBy(F.shiftright("h", HASH_BITS - bits).alias("cell"))
                       .agg(F.sum("bytes").alias("bytes")))
        # every bucket on the way from depth `base` to depth `bits`, and the first that fits
        way = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(base), F.lit(bits))).alias("d"))
        way = way.withColumn("prefix", F.expr(f"shiftright(cell, {bits} - d)"))
        sums = way.groupBy("d", "prefix").agg(F.sum("bytes").alias("total")).filter(F.col("total") <= limit)
        fit = way.join(sums, ["d", "prefix"]).groupBy("cell").agg(
            F.min("d").alias("depth"), F.max("total").alias("bytes"))
        level = settle(cells.select("cell").join(fit, "cell", "left"))
        levels.append((bits, level))
        left = level.filter("depth is null").select(F.col("cell").alias("up"))
        if left.isEmpty():
            break
        open_cells, base = left, bits
    return levels


def shard(df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``df`` with n_bytes, shard_depth, shard_prefix, part and shard_bytes (what the shard holds)."""
    h, b, part = fresh(df, "shard_h", "shard_row_bytes", "shard_part")
    wide = df.withColumn(h, hash60(F.col(key))).withColumn(
        b, F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
    slim = settle(wide.select(F.col(h).alias("h"), F.col(b).alias("bytes")))
    levels = directory(slim, limit)
    depths, totals = [], []
    for bits, level in levels:
        cell, depth, total = fresh(wide, f"shard_cell{bits}", f"shard_depth{bits}", f"shard_total{bits}")
        table = level.select(F.col("cell").alias(cell), F.col("depth").alias(depth), F.col("bytes").alias(total))
        wide = join_sized(wide.withColumn(cell + "k", F.shiftright(h, HASH_BITS - bits)), table,
                          F.col(cell + "k") == F.col(cell), row_bytes=32)
        depths.append(F.col(depth))
        totals.append(F.col(total))
    split = F.coalesce(*depths)
    out = {"n_bytes": F.col(b), "shard_depth": F.coalesce(split, F.lit(HASH_BITS)).cast("int")}
    out["shard_prefix"] = F.expr(f"shiftright({h}, {HASH_BITS} - shard_depth)")
    keep = [f"`{c}`" for c in df.columns
            if c.lower() not in ("n_bytes", "shard_depth", "shard_prefix", "part", "shard_bytes")]
    total = F.coalesce(*totals)
    named = wide.select(*keep, F.col(h), *[out[c].alias(c) for c in ("n_bytes", "shard_depth")],
                        total.alias(part)).withColumn("shard_prefix", out["shard_prefix"])
    if len(levels) * STEP < HASH_BITS or levels[-1][1].filter("depth is null").isEmpty():
        return named.withColumn("part", F.lit("0")).withColumnRenamed(part, "shard_bytes").drop(h)
    return _parts(named, h, part, limit)


def _parts(named: DataFrame, h: str, total: str, limit: int) -> DataFrame:
    """Deal rows that share all hash bits into parts: by running bytes within each input partition."""
    fits = named.filter(F.col(total).isNotNull()).withColumn("part", F.lit("0"))
    over = named.filter(F.col(total).isNull())
    pid, run, big = fresh(named, "shard_pid", "shard_run", "shard_big")
    over = over.withColumn(pid, F.spark_partition_id()).withColumn(big, F.col("n_bytes") > limit // 2)
    w = Window.partitionBy(h, pid, big).orderBy("n_bytes").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_bytes").over(w), F.lit(0))
    number = F.row_number().over(Window.partitionBy(h, pid, big).orderBy("n_bytes"))
    over = over.withColumn(run, F.when(F.col(big), number).otherwise(F.floor(before / (limit // 2))))
    over = over.withColumn("part", F.concat_ws("-", F.col(pid) + 1, F.when(F.col(big), "big").otherwise("run"), run))
    sums = over.groupBy(h, "part").agg(F.sum("n_bytes").alias("shard_bytes"))
    over = over.drop(total, pid, run, big).join(sums, [h, "part"])
    cols = [c for c in named.columns if c not in (h, total)] + ["part", "shard_bytes"]
    return fits.withColumnRenamed(total, "shard_bytes").select(cols).unionByName(over.select(cols))
