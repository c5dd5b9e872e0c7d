"""Physical-plan properties that matter at scale (checked on the executed plans)."""

import pytest

from pulsegrid.plans import registry
from pulsegrid.operators import promql as pq
from pulsegrid.plans.adapters import a_samples
from pulsegrid.sources import store
from tests.conftest import SF_SMALL

QUERIES = registry.queries()


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["rate_panel", "sum_rate_by_type", "instant_vector", "kafka_alerts",
                                  "log_count_by_level", "hist_quantile", "counter_increase"])
def test_series_plans_hash_aggregate_no_cross_join(spark, name):
    p = _plan(QUERIES[name](spark, SF_SMALL))
    assert "SortAggregate" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_products(spark, name):
    p = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p


def test_scan_prunes_columns(spark):
    p = _plan(QUERIES["rate_panel"](spark, SF_SMALL))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "props" not in scan and "event_id" not in scan  # only ts, user_id, event_type, value are read


def test_store_prunes_days_and_pushes_range(spark, scratch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    store.write_signal(a_samples(ev).drop("labels"), f"{scratch}/samples")
    lo, hi = 1704067200 * 10**9 + 3 * store.DAY_NS, 1704067200 * 10**9 + 5 * store.DAY_NS
    df = store.read_signal(spark, f"{scratch}/samples", lo, hi)
    p = _plan(df)
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "PartitionFilters: [isnotnull(day" in scan and "ts_ns" in scan.split("PushedFilters:")[1]
    assert df.count() == a_samples(ev).filter(f"ts_ns >= {lo} and ts_ns < {hi}").count()
    part = scan.split("PartitionFilters:")[1].split("PushedFilters:")[0]
    assert "2024-01-04" in part and "2024-01-05" in part
