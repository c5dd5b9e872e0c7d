"""Sinks and small relational pieces (SNK-1, SNK-2, AG-7, SL-1, PF-6)."""

from pyspark.sql import functions as F

from pulsegrid.operators import relational as R
from pulsegrid.operators.coverage import INFRA_METRIC_RE
from pulsegrid.sources import sinks


def test_write_targets_and_report(spark, scratch):
    t = spark.createDataFrame([("x/d1.json", 1, "promql", "up"), ("x/d1.json", 2, "logql", "{a=\"b\"}"),
                               ("x/d1.json", 4, "promql", "up"), ("y/d2.json", 3, "promql", "sum(x)")], "path string, panel_id long, lang string, text string")
    sinks.write_targets(t, f"{scratch}/targets")
    back = spark.read.parquet(f"{scratch}/targets")
    assert {(r.lang, r.dashboard) for r in back.select("lang", "dashboard").distinct().collect()} == {
        ("promql", "d1"), ("logql", "d1"), ("promql", "d2")}
    assert sorted((r.lang, r.dashboard, r.header, r.line) for r in back.collect()) == [
        ("logql", "d1", False, "{a=\"b\"}"), ("logql", "d1", True, "# d1"), ("promql", "d1", False, "up"),
        ("promql", "d1", True, "# d1"), ("promql", "d2", False, "sum(x)"), ("promql", "d2", True, "# d2")]
    f = spark.createDataFrame([("c", "a", "PASS", ""), ("c", "b", "FAIL", "x")], "check string, subject string, "
                              "status string, detail string")
    t1 = sinks.write_report(f, f"{scratch}/report", "run1").first()
    t2 = sinks.write_report(f.filter(F.col("status") == "PASS"), f"{scratch}/report", "run2").first()
    assert (t1["pass"], t1["fail"], t1["total"]) == (1, 1, 2) and (t2["pass"], t2["fail"]) == (1, 0)
    assert spark.read.json(f"{scratch}/report").count() == 3  # appended, one folder per run


def test_relational_pieces(spark):
    df = spark.createDataFrame([("up",), ("traces_spanmetrics",), ("app_total",), ("app_total",)], "name string")
    assert [r.name for r in R.ordered(R.distinct_sorted(df, "name"), "name").collect()] == [
        "app_total", "traces_spanmetrics", "up"]
    assert [r.name for r in R.exclude_regex(df, "name", INFRA_METRIC_RE).distinct().collect()] == ["app_total"]
