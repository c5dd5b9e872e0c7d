"""Pieces the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ensure_checkpoint_dir

# A word is a run of characters other than space and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
HASH_BITS = 60


def settle(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder; later reads survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that no column of ``df`` has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def join_sized(left: DataFrame, right: DataFrame, on, how: str = "left", row_bytes: int | Column = 64) -> DataFrame:
    """Join with a settled table; it is broadcast only if its measured size is below Spark's threshold.

    ``row_bytes`` is the size of every row or, where rows have no common bound, a column of their sizes.
    Beyond that the plain join runs: a sort-merge join whose hot keys AQE splits."""
    spark = left.sparkSession
    most = _bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10m"))
    each = F.lit(row_bytes) if isinstance(row_bytes, int) else row_bytes
    if (right.agg(F.sum(each)).first()[0] or 0) <= most:
        right = F.broadcast(right)
    return left.join(right, on, how)


def _bytes(text: str) -> int:
    text = text.strip().lower().removesuffix("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], 1)
    return int(float(text.rstrip("kmg")) * scale)


def hash60(key: Column) -> Column:
    """The first 60 bits of the md5 of the key as text (null: of the empty text), a non-negative long."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def word_list(text: Column) -> Column:
    """Words of a text as an array (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it can reach.

    Alternating large-star and small-star rounds (minimum label per node by partial aggregation,
    one equi-join back), each round's edges written to the checkpoint folder. Nothing but two
    numbers a round comes to the driver."""
    both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    cur, seen = settle(both), None
    while True:
        now = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(now) == seen or now[0] == 0:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = tuple(now)
        cur = settle(_small_star(_large_star(cur)))


def _large_star(edges: DataFrame) -> DataFrame:
    out = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = out.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (out.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
            .filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
