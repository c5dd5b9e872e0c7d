"""Label sets, series identity and label matchers (SC-1, PF-1)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def series_key(metric: Column | str, labels: Column | str) -> Column:
    """Canonical series id: independent of map order, distinct per metric,
    safe when label values contain delimiters (JSON-escaped)."""
    return F.to_json(F.struct(_c(metric).alias("metric"),
                              F.array_sort(F.map_entries(_c(labels))).alias("labels")))


def attr_value(v: Column) -> Column:
    """OTLP AnyValue union -> STRING (stringValue, intValue-as-string, bool, double)."""
    return F.coalesce(v["stringValue"], v["intValue"],
                      F.lower(v["boolValue"].cast("string")),
                      v["doubleValue"].cast("string"))


def attributes_to_map(attrs: Column | str) -> Column:
    """SC-1: ARRAY<STRUCT<key, value AnyValue>> -> MAP<STRING,STRING>.

    Lists whose keys differ become maps as they are. ``map_from_entries`` rejects duplicate keys by
    default, so of others the last entry per key is kept first (position-wise, entries pair by pair).
    """
    a = _c(attrs)
    keys = a["key"]
    plain = F.size(F.array_except(keys, F.array(F.lit(None).cast("string")))) == F.size(a)  # distinct, none null
    entries = F.transform(a, lambda e, i: F.named_struct(F.lit("key"), e["key"], F.lit("value"),
                                                          attr_value(e["value"]), F.lit("pos"), i))
    # last occurrence wins: keep an entry only if no later entry has the same key
    last = F.filter(entries, lambda e: ~F.exists(entries, lambda o: (o["key"] == e["key"]) & (o["pos"] > e["pos"])))
    kv = F.transform(last, lambda e: F.named_struct(F.lit("key"), e["key"], F.lit("value"), e["value"]))
    return (F.when(a.isNull(), F.create_map().cast("map<string,string>"))
            .when(plain, F.map_from_arrays(keys, F.transform(a["value"], attr_value))).otherwise(F.map_from_entries(kv)))


def label(labels: Column | str, key: str) -> Column:
    """Label value; an absent label reads as the empty string."""
    return F.coalesce(_c(labels)[key], F.lit(""))


def matcher(labels: Column | str, key: str, op: str, value: str) -> Column:
    """One PromQL-style matcher: ``=``, ``!=``, ``=~`` (fully anchored), ``!~``."""
    v = label(labels, key)
    if op == "=":
        return v == F.lit(value)
    if op == "!=":
        return v != F.lit(value)
    if op == "=~":
        return v.rlike(f"^(?:{value})$")
    if op == "!~":
        return ~v.rlike(f"^(?:{value})$")
    raise ValueError(f"unknown matcher op {op!r}")


def matchers(labels: Column | str, ms: Iterable[tuple[str, str, str]]) -> Column:
    cond = F.lit(True)
    for k, op, v in ms:
        cond = cond & matcher(labels, k, op, v)
    return cond


def merge_maps(base: Column | str, over: Column | str) -> Column:
    """``base`` overlaid with ``over`` (keys of ``over`` win) without tripping the duplicate-key check."""
    b, o = _c(base), _c(over)
    return F.map_concat(F.map_filter(b, lambda k, v: ~F.array_contains(F.map_keys(o), k)), o)
