"""Panel presentation: thresholds, value mappings, legends (SC-12, SC-14, SC-15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def threshold_color(value: Column | str, steps: Sequence[tuple[float | None, str]]) -> Column:
    """SC-14: the last step with ``step <= value``; a ``None`` step is minus infinity."""
    v = F.col(value) if isinstance(value, str) else value
    base = [c for s, c in steps if s is None]
    out = F.lit(base[0] if base else None)
    for s, c in sorted([(s, c) for s, c in steps if s is not None], key=lambda t: t[0]):
        out = F.when(v >= F.lit(float(s)), F.lit(c)).otherwise(out)
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(out)


def value_text(value: Column | str, mapping: dict[int, str]) -> Column:
    """SC-15: integer value -> text, else the number itself."""
    v = F.col(value) if isinstance(value, str) else value
    m = F.create_map(*[x for k, t in mapping.items() for x in (F.lit(int(k)), F.lit(t))])
    exact = v == F.floor(v)
    return F.coalesce(F.when(exact, m[v.cast("bigint")]), F.when(exact, v.cast("bigint").cast("string")),
                      v.cast("string"))
