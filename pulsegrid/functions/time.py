"""Durations, epoch nanoseconds and evaluation grids (SC-8, SC-9)."""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Duration units accepted by the query languages, in nanoseconds.
UNIT_NS = {
    "ns": 1,
    "us": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60 * 1_000_000_000,
    "h": 3600 * 1_000_000_000,
    "d": 86400 * 1_000_000_000,
    "w": 7 * 86400 * 1_000_000_000,
}

# One grammar for literals and columns: one or more whole numbers with a unit, nothing between.
_PART = r"(\d+)(ns|us|ms|s|m|h|d|w)"
_DURATION = rf"^(?:{_PART.replace('(', '(?:', 1).replace('(ns', '(?:ns')})+$"


def duration_ns(text: str | int) -> int:
    """A duration literal such as ``5m`` or ``1h30m`` in nanoseconds; anything else is an error."""
    if isinstance(text, int):
        return text
    text = text.strip()
    if not re.match(_DURATION, text):
        raise ValueError(f"not a duration: {text!r}")
    return sum(int(n) * UNIT_NS[u] for n, u in re.findall(_PART, text))


def duration_ns_col(c: Column | str) -> Column:
    """SC-9 as an expression, the same grammar; anything else -> NULL."""
    c = F.trim(F.col(c) if isinstance(c, str) else c)
    factor = F.create_map(*[x for k, v in UNIT_NS.items() for x in (F.lit(k), F.lit(v))])
    parts = F.regexp_extract_all(c, F.lit(_PART), F.lit(0))
    total = F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, x: a + F.regexp_extract(x, _PART, 1).cast("bigint")
                        * factor[F.regexp_extract(x, _PART, 2)])
    return F.when(c.rlike(_DURATION), total)


def epoch_ns(ts: Column | str) -> Column:
    """TIMESTAMP / TIMESTAMP_NTZ -> BIGINT epoch nanoseconds (session zone is UTC)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp")) * F.lit(1000)


def to_epoch_ns(value: str | int | _dt.datetime) -> int:
    if isinstance(value, int):
        return value
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value.replace(" ", "T"))
    if value.tzinfo is None:
        value = value.replace(tzinfo=_dt.timezone.utc)
    delta = value - _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
    return (delta.days * 86400 + delta.seconds) * 1_000_000_000 + delta.microseconds * 1000


@dataclass(frozen=True)
class Grid:
    """Evaluation grid ``start, start+step, ..., <= end`` (all epoch ns)."""

    start_ns: int
    end_ns: int
    step_ns: int

    @classmethod
    def of(cls, start, end, step) -> "Grid":
        g = cls(to_epoch_ns(start), to_epoch_ns(end), duration_ns(step))
        if g.step_ns <= 0 or g.end_ns < g.start_ns:
            raise ValueError("grid needs step > 0 and end >= start")
        return g

    @property
    def n_points(self) -> int:
        return (self.end_ns - self.start_ns) // self.step_ns + 1

    def t_ns(self, j: Column) -> Column:
        return F.lit(self.start_ns) + j * F.lit(self.step_ns)


def floor_div(x: Column, d: int) -> Column:
    """Exact integer floor division for BIGINT (``div`` truncates toward zero)."""
    return F.call_function("div", x - F.pmod(x, F.lit(d)), F.lit(d))
