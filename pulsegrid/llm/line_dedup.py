"""Line dedup by site-relative frequency (DataFrame expressions only).

A line that stands on a large share of one site's pages is boilerplate of that site.

* Lines are split at ``\\n`` and compared without surrounding blanks; blank lines never count
  and are never dropped. A line counts once per page, however often it stands there.
* A line is dropped from every page of a site when it is on at least ``min_pages`` of the
  site's pages and on more than ``ratio`` of them.
* Null text stays null, a text all of whose lines go becomes empty, other texts keep their
  remaining lines byte for byte. A null host is a site of its own. Repeated rows are pages of
  their own. Other columns are kept; the result columns replace columns of the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, join_sized, settle

RATIO, MIN_PAGES = 0.1, 5
_TRIM = " \t\x0b\x0c\r"


def _key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(_TRIM)))


def boilerplate(df: DataFrame, text: str = "text", host: str = "source",
                ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, drops): per site the 64-bit keys of the lines to drop.

    Counts are partial aggregates over (site, line key), so neither a hot site nor a hot line
    meets in one task. The array is bounded: a line in it is on more than ``ratio`` of the
    site's pages, so there are at most (distinct lines per page) / ratio of them."""
    pages = df.select(F.col(host).alias("host"), F.col(text).alias("text"))
    keys = F.array_distinct(F.transform(
        F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(_TRIM)) != ""), _key))
    lines = (pages.select("host", F.explode(keys).alias("line")).groupBy("host", "line")
             .agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages))
    totals = pages.groupBy("host").agg(F.count("*").alias("pages")).withColumnRenamed("host", "h")
    return (lines.join(totals, F.col("host").eqNullSafe(F.col("h")))
            .filter(F.col("n") > F.col("pages") * F.lit(ratio))
            .groupBy("host").agg(F.collect_list("line").alias("drops")))


def line_dedup(df: DataFrame, text: str = "text", host: str = "source",
               ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``df`` with ``text`` less its site's boilerplate lines, and n_lines, n_dropped (long)."""
    host_, drops, parts, kept = fresh(df, "dedup_host", "dedup_drops", "dedup_lines", "dedup_kept")
    found = settle(boilerplate(df, text, host, ratio, min_pages)).select(
        F.col("host").alias(host_), F.col("drops").alias(drops))
    wide = join_sized(df, found, F.col(host).eqNullSafe(F.col(host_)),
                      row_bytes=64 + 8 * F.size(drops) + F.coalesce(F.octet_length(F.col(host_).cast("string")), F.lit(0)))
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    wide = wide.withColumn(parts, lines).withColumn(
        kept, F.when(F.col(drops).isNull(), F.col(parts)).otherwise(
            F.filter(parts, lambda x: ~F.array_contains(F.col(drops), _key(x)))))
    gone = F.size(parts) - F.size(kept)
    out = {text: F.when(gone == 0, F.col(text)).otherwise(F.array_join(kept, "\n")),
           "n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.size(parts)).cast("long"),
           "n_dropped": gone.cast("long")}
    cols = [c for c in df.columns if c.lower() not in ("n_lines", "n_dropped") or c == text]
    return wide.select(*[(out[c] if c == text else F.col(f"`{c}`")).alias(c) for c in cols],
                       out["n_lines"].alias("n_lines"), out["n_dropped"].alias("n_dropped"))
