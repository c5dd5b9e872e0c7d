"""Alert evaluation over an instant vector on a grid (WN-2, PF-2, SC-13).

State per (rule, series) at every grid point where the series has a value:
condition false -> ``inactive``; true since ``t0`` -> ``pending`` while ``t - t0 < for``,
then ``firing``. A missing grid step ends the island (the next true step starts anew).
Gaps-and-islands with ``lag`` and a running ``last(ignorenulls)``; each window partition is
one (rule, series) whose length is bounded by the grid, not by the number of samples.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import matchers
from ..functions.plan import with_columns_once
from ..functions.templates import annotation
from ..functions.time import Grid, duration_ns


@dataclass(frozen=True)
class AlertRule:
    alert: str
    metric: str
    op: str
    threshold: float
    for_: str
    severity: str = "warning"
    summary: str = ""
    matchers: tuple[tuple[str, str, str], ...] = ()  # (label, =|!=|=~|!~, value)
    description: str = ""


def holds(op: Column, v: Column, x: Column) -> Column:
    return (F.when(op == ">", v > x).when(op == ">=", v >= x).when(op == "<", v < x)
            .when(op == "<=", v <= x).when(op == "==", v == x).when(op == "!=", v != x))


def alert_states(v: DataFrame, rules: list[AlertRule], grid: Grid) -> DataFrame:
    """``v``: instant vector (series_id, metric, labels, j, t, value); ``rules``: AlertRule list.

    The rules are configuration: they become a literal array that every row filters by its
    metric and explodes (one row per matching rule) — no join, no broadcast of data."""
    arr = F.array(*[F.struct(F.lit(r.alert).alias("alert"), F.lit(r.metric).alias("metric"),
                             F.lit(r.op).alias("op"), F.lit(float(r.threshold)).alias("threshold"),
                             F.lit(duration_ns(r.for_)).alias("for_ns"), F.lit(r.severity).alias("severity"),
                             F.lit(r.summary).alias("summary")) for r in rules])
    x = v.filter(F.col("metric").isin(*{r.metric for r in rules}))
    x = x.withColumn("r", F.explode(F.filter(arr, lambda r: r["metric"] == F.col("metric"))))
    x = x.filter(selected(rules, F.col("r.alert"), F.col("labels")))
    x = x.select("*", *[F.col(f"r.{c}").alias(c) for c in ("alert", "op", "threshold", "for_ns", "severity",
                                                          "summary")]).drop("r")
    x = _held_states(x, grid)
    return x.select("alert", "severity", "summary", "series_id", "metric", "labels", "j", "t", "value", "state", "active_since")


def _held_states(x: DataFrame, grid: Grid) -> DataFrame:
    """States of rows (alert, op, threshold, for_ns, series_id, j, t, value): gaps and islands for
    each (rule, series), which the grid bounds."""
    x = x.withColumn("cond", F.coalesce(holds(F.col("op"), F.col("value"), F.col("threshold")), F.lit(False)))
    w = Window.partitionBy("alert", "series_id").orderBy("j")
    prev_j, prev_c = F.lag("j").over(w), F.lag("cond").over(w)
    start = F.col("cond") & (prev_j.isNull() | (prev_j != F.col("j") - 1) | ~prev_c)
    x = x.withColumn("start", start)
    wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("t0_j", F.last(F.when(F.col("start"), F.col("j")), ignorenulls=True).over(wr))
    held_ns = (F.col("j") - F.col("t0_j")) * F.lit(grid.step_ns)
    state = (F.when(~F.col("cond"), "inactive")
             .when(held_ns < F.col("for_ns"), "pending").otherwise("firing"))
    return x.select("*", state.alias("state"),
                    F.when(F.col("cond"), F.col("t") - (F.col("j") - F.col("t0_j")) * F.lit(grid.step_ns // 10**9))
                    .alias("active_since"))


def selected(rules: list[AlertRule], alert: Column, labels: Column) -> Column:
    """Whether a series' labels meet the matchers of the rule named ``alert``."""
    cond = F.lit(True)
    for r in rules:
        if r.matchers:
            cond = F.when(alert == r.alert, matchers(labels, r.matchers)).otherwise(cond)
    return cond


def rule_metrics(rules: list[AlertRule]) -> list[str]:
    return sorted({r.metric for r in rules})


def alerts_with_summary(states: DataFrame, rules: list[AlertRule]) -> DataFrame:
    """Attach the rendered annotations of each rule (``{{ $labels.x }}``, ``{{ $value }}``)."""
    texts = {"summary_text": "summary", "description_text": "description"}
    for col, field in texts.items():
        text = F.lit(None).cast("string")
        for r in rules:
            text = F.when(F.col("alert") == r.alert, annotation(getattr(r, field))).otherwise(text)
        states = states.withColumn(col, text)
    return states


# ---------------------------------------------------------------- rules as a table

_COMPARISON = r"^\s*([A-Za-z_:][A-Za-z0-9_:]*)\s*(\{[^}]*\})?\s*(==|!=|>=|<=|>|<)\s*([-+]?[0-9][0-9.eE+-]*)\s*$"
_MATCHER = r'([A-Za-z_][A-Za-z0-9_]*)\s*(=~|!~|!=|=)\s*"([^"]*)"'


def comparison_rules(rules: DataFrame) -> DataFrame:
    """Rules of the form ``metric{label="x", other=~"re"} > number`` as columns: those of ``rules``
    (see ``load_rules``) and metric, matchers ARRAY<STRUCT<label, op, value>>, op, threshold. These
    are NULL for any other expression, so that a caller can tell what is not evaluated."""
    def part(i):
        return F.nullif(F.regexp_extract("expr", _COMPARISON, i), F.lit(""))
    found = F.regexp_extract_all(F.coalesce(part(2), F.lit("")), F.lit(_MATCHER), F.lit(0))
    ms = F.transform(found, lambda m: F.struct(*[F.regexp_extract(m, _MATCHER, i).alias(n)
                                                for i, n in enumerate(("label", "op", "value"), 1)]))
    return rules.select("*", part(1).alias("metric"), F.when(part(1).isNotNull(), ms).alias("matchers"),
                        part(3).alias("op"), part(4).try_cast("double").alias("threshold"))


def meets(labels: Column, matcher_list: Column) -> Column:
    """Whether a label map meets every matcher of a list that is data (absent labels are '')."""
    def one(m):
        v = F.coalesce(F.try_element_at(labels, m["label"]), F.lit(""))
        like = F.rlike(v, F.concat(F.lit("^(?:"), m["value"], F.lit(")$")))
        return (F.when(m["op"] == "=", v == m["value"]).when(m["op"] == "!=", v != m["value"])
                .when(m["op"] == "=~", like).when(m["op"] == "!~", ~like).otherwise(False))
    return F.forall(matcher_list, one)


def rule_states(v: DataFrame, rules: DataFrame, grid: Grid) -> DataFrame:
    """WN-2 with rules as a table: (alert, metric, matchers, op, threshold, for_ns, severity,
    annotations). The instant vector meets the rules by an equi-join on the metric and the values of all
    labels that a rule compares by ``=``, so that a row is compared with the rules it may satisfy and not
    with all of its metric. Rules without such a matcher meet every series of their metric, as they must.
    The other matchers are data, so the plan has the same size for any number of rules; which sets of
    labels the rules compare is a scalar subquery of the same job. ``for_ns`` NULL counts as no hold
    time; a rule without metric selects nothing."""
    r = rules.filter(F.col("metric").isNotNull() & F.col("threshold").isNotNull()).select(
        "alert", "metric", "matchers", "op", "threshold", F.coalesce("for_ns", F.lit(0)).alias("for_ns"), "severity", "annotations")
    equal = F.array_sort(F.filter("matchers", lambda m: (m["op"] == "=") & (m["value"] != "")))
    r = with_columns_once(r, {"equal": equal}).select(
        "*", F.col("equal.label").alias("eq_labels"), F.col("equal.value").alias("eq_values")).drop("equal")
    sets = r.agg(F.collect_set("eq_labels")).scalar()
    x = with_columns_once(v, {"sets": sets})
    x = x.withColumn("eq_labels", F.explode(F.filter("sets", lambda s: F.forall(
        s, lambda k: F.map_contains_key(F.col("labels"), k))))).drop("sets")
    x = x.withColumn("eq_values", F.transform("eq_labels", lambda k: F.try_element_at("labels", k)))
    # by merge: the optimizer's estimates may take the instant vector for the small side and broadcast it
    x = x.join(r.hint("merge"), ["metric", "eq_labels", "eq_values"]).filter(meets(F.col("labels"), F.col("matchers")))
    return _held_states(x, grid).select("alert", "severity", "annotations", "series_id", "metric", "labels", "j", "t",
                                        "value", "state", "active_since")


def rendered(template: Column, labels: Column, value: Column) -> Column:
    """SC-13 for a template that is data: each ``{{ $labels.x }}`` and ``{{ $value }}`` is replaced;
    absent labels and other placeholders give nothing."""
    holes = F.array_distinct(F.regexp_extract_all(template, F.lit(r"\{\{[^}]*\}\}"), F.lit(0)))

    def text(hole):
        name = F.regexp_extract(hole, r"\$labels\.([A-Za-z0-9_]+)", 1)
        return F.coalesce(F.when(hole.rlike(r"^\{\{\s*\$value\s*\}\}$"), value.cast("string"))
                          .when(name != "", F.try_element_at(labels, name)), F.lit(""))
    return F.aggregate(holes, template, lambda acc, hole: F.replace(acc, hole, text(hole)))
