"""JMX bean lines -> metric samples with ordered relabel rules (SRC-7).

Each rule is ``(pattern, name template, type, {label: template})``. A line is matched by the
first rule whose pattern occurs in it (the pattern is wrapped as ``^.*(?:P).*$``), ``$n``
in templates refers to the n-th group, names and label names are lower-cased, and the
sample value is the number after the last ``:`` (fractions and exponents included); a
group of the pattern is not a value, no rule names one.
The rules are data: the expressions are built from them at plan time and run as one
``coalesce`` of ``when`` branches in rule order (no per-row Python).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Broker relabel rules (pattern, name, type, labels), in evaluation order.
KAFKA_RULES = [
    (r"kafka.server<type=(.+), name=(.+), clientId=(.+), topic=(.+), partition=(.*)>Value",
     "kafka_server_$1_$2", "GAUGE", {"clientId": "$3", "topic": "$4", "partition": "$5"}),
    (r"kafka.server<type=(.+), name=(.+), clientId=(.+), brokerHost=(.+), brokerPort=(.+)>Value",
     "kafka_server_$1_$2", "GAUGE", {"clientId": "$3", "broker": "$4:$5"}),
    (r"kafka.server<type=(.+), name=(.+)>Value", "kafka_server_$1_$2", "GAUGE", {}),
    (r"kafka.controller<type=(.+), name=(.+)>Value", "kafka_controller_$1_$2", "GAUGE", {}),
    (r"kafka.network<type=(.+), name=(.+), request=(.+)>Value", "kafka_network_$1_$2", "GAUGE",
     {"request": "$3"}),
    (r"kafka.log<type=(.+), name=(.+), topic=(.+), partition=(.+)>Value", "kafka_log_$1_$2", "GAUGE",
     {"topic": "$3", "partition": "$4"}),
    (r"java.lang<type=(.+), name=(.+)><(.+)>: (\d+)", "java_lang_$1_$3", "GAUGE", {"name": "$2"}),
]

_REF = re.compile(r"\$(\d+)")


def _template(line: Column, pattern: str, template: str) -> Column:
    parts, pos = [], 0
    for m in _REF.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(F.regexp_extract(line, pattern, int(m.group(1))))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


def _safe_name(c: Column) -> Column:
    """Metric names: invalid characters -> '_', runs of '_' collapsed, lower-cased."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"[^a-zA-Z0-9:_]", "_"), r"__+", "_"))


def relabel(lines: DataFrame, rules=KAFKA_RULES, line_col: str = "line") -> DataFrame:
    """SRC-7: adds ``rule`` (index, NULL when unmatched), ``name``, ``type``, ``labels`` MAP and ``value``."""
    line = F.col(line_col)
    branches = None
    for i, (pat, name_t, typ, labs) in enumerate(rules):
        wrapped = f"^.*(?:{pat}).*$"
        labmap = {k.lower(): _template(line, wrapped, v) for k, v in labs.items()}
        value = F.regexp_extract(line, r":\s*([-+0-9.eE]+)\s*$", 1).try_cast("double")
        labels = (F.create_map(*[x for k in sorted(labmap) for x in (F.lit(k), labmap[k])]) if labmap
                  else F.create_map().cast("map<string,string>"))
        out = F.struct(F.lit(i).alias("rule"), _safe_name(_template(line, wrapped, name_t)).alias("name"),
                       F.lit(typ).alias("type"), labels.alias("labels"), value.alias("value"))
        branch = F.when(line.rlike(wrapped), out)
        branches = branch if branches is None else branches.when(line.rlike(wrapped), out)
    none = F.struct(F.lit(None).cast("int").alias("rule"), F.lit(None).cast("string").alias("name"),
                    F.lit(None).cast("string").alias("type"), F.lit(None).cast("map<string,string>").alias("labels"),
                    F.lit(None).cast("double").alias("value"))
    # a generator keeps the rule chain evaluated once per line: filters on its fields cannot be
    # pushed below it (through a projection they would be inlined and re-evaluate the regexes)
    return lines.select("*", F.inline(F.array(branches.otherwise(none))))
