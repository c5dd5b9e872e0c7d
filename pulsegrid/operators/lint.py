"""Rule checks over the query corpus, all in one pass (LT-1..8, PF-5, AG-14, WN-1).

Findings: ``(check, subject, status, detail)``. A check with no violation anywhere reports a
single PASS row (subject ``*``), as the reference's summary does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import json_valid
from ..functions.plan import settled
from ..functions.time import floor_div
from ..sources.corpus import route_targets
from .coverage import finding, per_subject

# Target checks as (check, language, pattern that flags, pattern that clears).
# ``clears`` is a plain substring for the log check and a regex for the histogram check.
TARGET_CHECKS = [
    ("traceql_variable_regex", "traceql", r'=~"\$', None, None),
    ("traceql_unscoped_kind", "traceql", r"(?<!span\.)kind\s*=", None, None),
    ("logql_detected_level", "logql", r"\|\s*level\s*=~?", "detected_level", None),
    ("promql_histogram_by_le", "promql", r"histogram_quantile\(", None, r"by\s*\([^)]*\ble\b[^)]*\)"),
]

# Datasource uids a dashboard may reference.
ALLOWED_UIDS = ["prometheus", "loki", "tempo", "pyroscope", "-- Grafana --", "$datasource", "${datasource}",
                "-- Dashboard --", "-- Mixed --", "grafana"]


def _pass_when_empty(spark: SparkSession, violations: DataFrame, checks: list[str]) -> DataFrame:
    """One PASS row for each check without any violation (anti-join against a fixed list)."""
    names = spark.createDataFrame([(c,) for c in checks], "check string")
    hit = violations.select("check").distinct()
    clean = F.broadcast(names).join(hit, "check", "left_anti")
    return clean.select("check", F.lit("*").alias("subject"), F.lit("PASS").alias("status"),
                        F.lit("no violation").alias("detail"))


def check_targets(spark: SparkSession, targets: DataFrame) -> DataFrame:
    """LT-2..LT-5 in one pass: every routed target row is tested against every check by
    exploding an array of (check, violated) structs."""
    tests = []
    for name, lang, flag, clears_sub, clears_re in TARGET_CHECKS:
        cond = (F.col("lang") == lang) & F.col("text").rlike(flag)
        if clears_sub:
            cond = cond & ~F.col("text").contains(clears_sub)
        if clears_re:
            cond = cond & ~F.col("text").rlike(clears_re)
        tests.append(F.struct(F.lit(name).alias("check"), F.coalesce(cond, F.lit(False)).alias("bad")))
    x = (targets.filter(F.col("text").isNotNull() & (F.col("text") != ""))
         .select("path", "text", F.explode(F.array(*tests)).alias("c"))
         .filter(F.col("c.bad")))
    viol = x.select(F.col("c.check").alias("check"), F.col("path").alias("subject"),
                    F.lit("FAIL").alias("status"), F.col("text").alias("detail"))
    return viol.unionByName(_pass_when_empty(spark, viol, [c[0] for c in TARGET_CHECKS]))


def check_json(docs: DataFrame) -> DataFrame:
    """LT-1: document parses as JSON; one finding per file."""
    ok = json_valid(F.col("json"))
    return docs.select(*finding("json_valid", F.col("path"), F.when(ok, "PASS").otherwise("FAIL"),
                                F.when(ok, "").otherwise("parse error")))


def corpus_findings(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """LT-1 to LT-6 from the rows of ``document_rows``, which are settled first: every document is
    read and parsed once, whatever the number of checks."""
    rows = settled(rows)
    per_doc = rows.select("path", "valid").distinct()
    json_ok = per_doc.select(*finding("json_valid", F.col("path"), F.when(F.col("valid"), "PASS").otherwise("FAIL"),
                                      F.when(F.col("valid"), "").otherwise("parse error")))
    viol = not_allowed(rows).withColumnRenamed("path", "subject")
    uids = per_subject(per_doc.filter("valid").select(F.col("path").alias("subject")), viol, "datasource_uid")
    return json_ok.unionByName(check_targets(spark, route_targets(rows))).unionByName(uids)


def not_allowed(targets: DataFrame, col: str = "ds_uid", allowed=ALLOWED_UIDS) -> DataFrame:
    """PF-5: distinct values outside the allow-list, per file."""
    return (targets.filter(F.col(col).isNotNull() & ~F.col(col).isin(*allowed))
            .select("path", F.col(col).alias("item")).distinct())


def check_uids(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """LT-6 via AG-14: a valid file passes when it references no unknown uid, else one FAIL per uid."""
    subjects = docs.filter(json_valid(F.col("json"))).select(F.col("path").alias("subject"))
    viol = not_allowed(targets).withColumnRenamed("path", "subject")
    return per_subject(subjects, viol, "datasource_uid")


def check_tags(spark: SparkSession, tags: DataFrame) -> DataFrame:
    """LT-7: tracing datasource tags must use the scoped key ``resource.service.name``."""
    viol = tags.filter(F.col("key") == "service.name").select(
        *finding("tempo_tag_scope", F.col("subject"), "FAIL", F.col("key")))
    return viol.unionByName(_pass_when_empty(spark, viol, ["tempo_tag_scope"]))


def check_rule_lines(spark: SparkSession, rules: DataFrame) -> DataFrame:
    """LT-8: a rule expression line filtering ``level=`` without ``detected_level``; the finding names
    file, group, rule and the 1-based line inside the expression. A rule whose hold time is no
    duration (``for_ns`` NULL) is a finding of its own."""
    lines = rules.select("path", "grp", "alert", F.posexplode(F.split(F.col("expr"), "\n")).alias("i", "line"))
    bad = lines.filter(F.col("line").contains("level=") & ~F.col("line").contains("detected_level")
                       & ~F.col("line").rlike(r"^\s*#"))
    viol = bad.select(*finding("loki_rule_level",
                               F.concat_ws(":", "path", "grp", "alert", (F.col("i") + 1).cast("string")),
                               "FAIL", F.trim(F.col("line"))))
    held = rules.filter(F.col("for_ns").isNull()).select(*finding(
        "rule_duration", F.concat_ws(":", "path", "grp", "alert"), "FAIL", "no duration"))
    return viol.unionByName(_pass_when_empty(spark, viol, ["loki_rule_level"])).unionByName(held)


# ---------------------------------------------------------------- WN-1

def fill_section(lines: DataFrame, chunk: int = 1_000_000, header_re: str = r"^# Dashboard: (.*)$") -> DataFrame:
    """WN-1: every line gets the section named by the nearest preceding header line of its file.

    ``lines(file, line_no, line)``. Ordered work runs per (file, chunk of line numbers); the
    section carried into a chunk comes from a chunk-level table (one row per chunk with a
    header) stitched with ``last(ignorenulls)`` — so one huge file is split over its chunks."""
    hdr = F.regexp_extract(F.col("line"), header_re, 1)
    x = (lines.withColumn("chunk", floor_div(F.col("line_no"), chunk))
         .withColumn("hdr", F.when(F.col("line").rlike(header_re), hdr)))
    w = (Window.partitionBy("file", "chunk").orderBy("line_no")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = x.withColumn("in_chunk", F.last("hdr", ignorenulls=True).over(w))
    last_in_chunk = (x.filter(F.col("hdr").isNotNull()).groupBy("file", "chunk")
                     .agg(F.max_by("hdr", "line_no").alias("last_hdr")))
    # the chunk table has one row per occupied chunk: bounded by lines / chunk
    ch = x.select("file", "chunk").distinct().join(last_in_chunk, ["file", "chunk"], "left")
    wc = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    ch = ch.select("file", "chunk", F.last("last_hdr", ignorenulls=True).over(wc).alias("prev_hdr"))
    out = x.join(ch, ["file", "chunk"], "left")
    return out.select("file", "line_no", "line", F.coalesce("in_chunk", "prev_hdr").alias("section"))
