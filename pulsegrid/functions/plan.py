"""Plan helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Add costly columns evaluated exactly once per row.

    Catalyst inlines a projected expression into every consumer it collapses into, and
    pushes filters below projections by substituting the expression — so a JSON parse or a
    regex chain referenced by several later expressions (or by a filter) runs several times.
    Emitting the values through a generator (``inline`` of a one-element array) is a barrier
    for both: later projections and filters read the generated attributes."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def settled(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder: what several branches of a plan read
    is computed once, and survives lost executors."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def left_join_keyed(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join that reads both sides once and spreads left rows with a NULL key.

    In a shuffle join every NULL key hashes to the same partition; when many rows lack the key (logs
    without a trace id) that partition would hold them all. A hash of the keys joins them as a further
    key; for rows with a NULL key, which match nothing, it is a hash of the whole row instead
    (without maps, which have no hash)."""
    has = F.lit(True)
    for k in keys:
        has = has & F.col(k).isNotNull()
    plain = [f.name for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    spread = F.when(has, F.xxhash64(*keys)).otherwise(F.xxhash64(*[F.col(f"`{c}`") for c in plain]))
    out = left.withColumn("__spread", spread).join(
        right.withColumn("__spread", F.xxhash64(*keys)), [*keys, "__spread"], "left")
    return out.select(*[F.col(f"`{c}`") for c in left.columns],
                      *[F.col(f"`{c}`") for c in right.columns if c not in keys])
