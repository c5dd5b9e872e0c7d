"""Template handling: variable substitution, legend / annotation rendering (SC-7, SC-12, SC-13)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dashboard template variables and the values substituted for them, in the
# order they are applied (order matters: ``$service_name`` before ``$service``).
SUBSTITUTIONS = [
    ("$service_name", "shop/shop-server"),
    ("${service_name}", "shop/shop-server"),
    ("$svc", "shop-server"),
    ("${svc}", "shop-server"),
    ("$interval", "5m"),
    ("${interval}", "5m"),
    ("$__rate_interval", "5m"),
    ("${__rate_interval}", "5m"),
    ("$__interval", "1m"),
    ("${__interval}", "1m"),
    ("$log_type", ".*"),
    ("${log_type}", ".*"),
    ("$service", ".*"),
    ("${service}", ".*"),
    ("$level", ".*"),
    ("${level}", ".*"),
    ("$severity", ".*"),
    ("${severity}", ".*"),
    ("$search", ""),
    ("${search}", ""),
    ("$datasource", ""),
    ("${datasource}", ""),
    ("$http_route", ".*"),
    ("${http_route}", ".*"),
    ("$http_request_method", ".*"),
    ("${http_request_method}", ".*"),
    ("$http_response_status_code", ".*"),
    ("${http_response_status_code}", ".*"),
    ("$min_duration", "100ms"),
    ("${min_duration}", "100ms"),
    ("$span_name", ".*"),
    ("${span_name}", ".*"),
    ("$db_system", ".*"),
    ("${db_system}", ".*"),
    ("$log_level", "ERROR"),
    ("${log_level}", "ERROR"),
    ("$instance", ".*"),
    ("${instance}", ".*"),
    ("$__range", "1h"),
    ("[$__auto]", "[5m]"),
]


def substitute(c: Column | str, subs=SUBSTITUTIONS) -> Column:
    """SC-7: ordered literal replacements, a left fold of ``replace`` (JVM-side)."""
    out = F.col(c) if isinstance(c, str) else c
    for k, v in subs:
        out = F.replace(out, F.lit(k), F.lit(v))
    return out


def substitute_sql(col: str, subs=SUBSTITUTIONS) -> str:
    """The same fold as nested SQL ``replace`` calls (used by the oracle)."""
    out = col
    for k, v in subs:
        out = f"replace({out}, '{k}', '{v}')"
    return out


_VAR = re.compile(r"\{\{\s*([^}]*?)\s*\}\}")


def render(template: str, resolve) -> Column:
    """SC-12 / SC-13: ``{{ pod }} - {{ name }}`` -> ``concat`` of literals and columns, built at
    plan time. ``resolve(name) -> Column`` maps a placeholder to its value."""
    parts, pos = [], 0
    for m in _VAR.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(F.coalesce(resolve(m.group(1)).cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


def legend(template: str, labels: Column | str = "labels") -> Column:
    """SC-12: legend text from a label map (``{{ pod }}``)."""
    lab = F.col(labels) if isinstance(labels, str) else labels
    return render(template, lambda name: lab[name])


def annotation(template: str, labels: Column | str = "labels", value: Column | str = "value") -> Column:
    """SC-13: ``{{ $labels.pod }}`` and ``{{ $value }}``."""
    lab = F.col(labels) if isinstance(labels, str) else labels
    val = F.col(value) if isinstance(value, str) else value

    def resolve(name: str) -> Column:
        if name == "$value":
            return val
        if name.startswith("$labels."):
            return lab[name[len("$labels."):]]
        return F.lit(None)

    return render(template, resolve)
