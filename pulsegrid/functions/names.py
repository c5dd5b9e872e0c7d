"""Name and token functions over query text and metric names (SC-2..6, SC-16, SC-17, SC-19)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit -> Prometheus suffix used when an OTLP metric name is normalised.
UNIT_SUFFIX = {"s": "_seconds", "By": "_bytes", "ms": "_milliseconds", "1": "_ratio"}


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def prom_name(name: Column | str, unit: Column | str, monotonic: Column | str) -> Column:
    """SC-2: dots -> underscores, unit suffix (``{x}`` units add nothing), ``_total`` for
    monotonic sums. Suffixes already present are not repeated."""
    base = F.regexp_replace(_c(name), r"\.", "_")
    u = _c(unit)
    suffix = F.coalesce(F.create_map(*[x for k, v in UNIT_SUFFIX.items() for x in (F.lit(k), F.lit(v))])[u],
                        F.lit(""))
    with_unit = F.when((suffix != "") & ~base.endswith(suffix), F.concat(base, suffix)).otherwise(base)
    return F.when(F.coalesce(_c(monotonic), F.lit(False)) & ~with_unit.endswith("_total"),
                  F.concat(with_unit, F.lit("_total"))).otherwise(with_unit)


def strip_histogram_suffix(name: Column | str) -> Column:
    """SC-3: strip ``_bucket``, then ``_count``, then ``_sum`` — each once, in that order."""
    x = F.regexp_replace(_c(name), r"_bucket$", "")
    x = F.regexp_replace(x, r"_count$", "")
    return F.regexp_replace(x, r"_sum$", "")


def metric_tokens(expr: Column | str) -> Column:
    """SC-4: metric-name tokens in a query: lower-case words with ``_`` followed by ``{`` or a blank."""
    toks = F.regexp_extract_all(_c(expr), F.lit(r"([a-z][a-z_]*[a-z])[{\s]"), 1)
    return F.filter(toks, lambda t: t.contains("_"))


def label_tokens(expr: Column | str) -> Column:
    """SC-5: label names used in matchers (``name =``, ``name !=``, ``name =~``)."""
    return F.regexp_extract_all(_c(expr), F.lit(r"([a-z_]+)\s*[=!~]"), 1)


def span_attr_tokens(query: Column | str) -> Column:
    """SC-6 (span scope)."""
    return F.regexp_extract_all(_c(query), F.lit(r"span\.([a-z_.]+)"), 1)


def resource_attr_tokens(query: Column | str) -> Column:
    """SC-6 (resource scope)."""
    return F.regexp_extract_all(_c(query), F.lit(r"resource\.([a-z_.]+)"), 1)


def query_kind(expr: Column | str) -> Column:
    """SC-16: metric (instant) query when it uses an aggregation / range function, else log (range) query."""
    return F.when(_c(expr).rlike(r"(rate|count_over_time|sum|avg|topk)\("), "instant").otherwise("range")


def topic_parts(topic: Column | str) -> Column:
    """SC-17: ``{domain}.{event-type}.{version}`` -> struct."""
    p = F.split(_c(topic), r"\.")
    return F.struct(F.get(p, 0).alias("domain"), F.get(p, 1).alias("event_type"), F.get(p, 2).alias("version"))


def json_valid(text: Column | str) -> Column:
    """SC-19: the text parses as JSON."""
    return _c(text).isNotNull() & F.try_parse_json(_c(text)).isNotNull()


def truncate_label(c: Column | str, n: int) -> Column:
    """SC-11: first ``n`` characters."""
    return F.substring(_c(c), 1, n)
