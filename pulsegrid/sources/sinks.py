"""Sinks: extracted queries per language / dashboard, and run reports (SNK-1, SNK-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.coverage import tally


def write_targets(targets: DataFrame, path: str) -> None:
    """SNK-1: one folder per language; in its files, in order, each dashboard's header line and then its
    distinct queries (dashboard, header, line). Rows are range-partitioned by that order, so there is
    no folder or file per dashboard and a large dashboard may span files."""
    dashboard = F.regexp_extract(F.col("path"), r"([^/]+)\.json$", 1)
    lines = F.array(F.struct(F.lit(True).alias("header"), F.concat(F.lit("# "), dashboard).alias("line")),
                    F.struct(F.lit(False).alias("header"), F.col("text").alias("line")))
    x = targets.select("lang", dashboard.alias("dashboard"), F.inline(lines)).distinct()
    order = ["lang", "dashboard", F.col("header").desc(), "line"]
    x.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("lang").parquet(path)


def write_report(findings: DataFrame, path: str, run_id: str) -> DataFrame:
    """SNK-2: append the findings of one run under ``run_id=...`` and return its tally."""
    findings.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").json(path)
    return tally(findings.sparkSession.read.json(path).filter(F.col("run_id") == run_id))
