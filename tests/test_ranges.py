"""Range windows against brute force: any step and range, resets, duplicates, deltas, bounds that change."""

import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.labels import series_key
from pulsegrid.functions.time import Grid
from pulsegrid.operators import promql as pq
from pulsegrid.operators import ranges as R

S = 1_000_000_000


def points(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("labels", F.create_map(F.lit("s"), F.col("s"))).withColumn("series_id", series_key("metric", "labels"))


def windows(rows, grid, range_ns, temporality):
    """{(series, j): (n, first_ts, last_ts, increase)}"""
    out, by = {}, {}
    for s, ts, v in rows:
        by.setdefault(s, {})[ts] = max(v, by.get(s, {}).get(ts, v))
    for s, pts in by.items():
        for j in range(grid.n_points):
            t = grid.start_ns + j * grid.step_ns
            inside = sorted((ts, v) for ts, v in pts.items() if t - range_ns <= ts < t)
            if inside:
                inc = sum(b if temporality == "delta" or b < a else b - a for (_, a), (_, b) in zip(inside, inside[1:]))
                out[s, j] = (len(inside), inside[0][0], inside[-1][0], inc)
    return out


@pytest.mark.parametrize("temporality", R.TEMPORALITIES)
@pytest.mark.parametrize("step,range_", [(10, 30), (7, 19), (10, 3), (1, 500), (13, 13)])
def test_windows_equal_brute_force(spark, step, range_, temporality):
    rng = random.Random(step * range_)
    rows = [(rng.choice("ab"), rng.randint(0, 200) * S + rng.choice([0, 0, 1]), float(rng.randint(0, 9))) for _ in range(120)]
    rows += [("c", 50 * S, 1.0), ("a", 100 * S, 3.0), ("a", 100 * S, 5.0)]
    grid = Grid(20 * S, 180 * S, step * S)
    df = points(spark, [("m", *r) for r in rows], "metric string, s string, ts_ns long, value double")
    got = R.counter_windows(df, grid, range_ * S, temporality).collect()
    want = windows(rows, grid, range_ * S, temporality)
    assert {(eval(r.series_id)["labels"][0]["value"], r.j): (r.n, r.first_ts, r.last_ts, r.increase) for r in got} == want


def test_rows_of_the_plan_do_not_follow_range_over_step(spark):
    df = points(spark, [("m", "a", i * S, float(i)) for i in range(0, 1000, 100)], "metric string, s string, ts_ns long, value double")
    grid = Grid(0, 1000 * S, S)
    plan = pq.rate(df, grid, 500 * S)
    assert plan.count() == 900  # grid points 101 to 1000: from the second point on, the window holds two or more
    generated = [n for n in str(plan._jdf.queryExecution().executedPlan()).splitlines() if "Generate explode" in n]
    assert len(set(generated)) <= 2  # one explode of the window ends (listed in the final and the initial plan)


def test_unknown_temporality_is_an_error(spark):
    df = points(spark, [("m", "a", 0, 1.0)], "metric string, s string, ts_ns long, value double")
    with pytest.raises(ValueError, match="temporality"):
        pq.rate(df, Grid(0, S, S), S, temporality="both")


HIST = "metric string, s string, ts_ns long, counts array<long>, bounds array<double>"


def test_buckets_merge_bounds_and_reset_as_a_point(spark):
    a, b = [1.0, 5.0, 10.0], [5.0]
    rows = [("m", "x", 0, [1, 1, 1, 1], a), ("m", "x", 10 * S, [2, 1, 3, 1], a),
            ("m", "x", 20 * S, [9, 0, 3, 1], a),      # one bucket fell: all count from zero
            ("m", "x", 30 * S, [4, 2], b),            # other bounds: counts from zero too
            ("m", "x", 40 * S, [6, 2], b), ("m", "y", 5 * S, [0, 0, 0, 0], a), ("m", "y", 25 * S, [0, 0, 4, 0], a),
            ("m", "z", 9 * S, [], []), ("m", "z", 10 * S, [], [])]
    out = R.rated_buckets(points(spark, rows, HIST), Grid(41 * S, 41 * S, S), 100 * S).collect()
    got = {x.le: x.cum for x in out[0].buckets}
    x = [1 + 9 + 0 + 0, 1 + 9 + 4 + 2, 3 + 12 + 4 + 2, 3 + 13 + 6 + 2]
    y = [0, 0, 4, 4]
    assert [got[le] for le in (1.0, 5.0, 10.0, float("inf"))] == pytest.approx([i / 40 + k / 20 for i, k in zip(x, y)])


def test_delta_buckets_equal_their_running_total(spark):
    rng = random.Random(4)
    bounds, total, deltas, sums = [1.0, 2.0], [0, 0, 0], [], []
    for i in range(30):
        d = [rng.randint(0, 3) for _ in range(3)]
        total = [a + b for a, b in zip(total, d)]
        deltas.append(("m", "x", i * 7 * S, d, bounds))
        sums.append(("m", "x", i * 7 * S, total, bounds))
    grid = Grid(20 * S, 220 * S, 9 * S)
    one, two = (R.rated_bucket_quantile(points(spark, r, HIST), [0.5, 0.9], grid, 60 * S, temporality=t).orderBy("j", "q").collect()
                for r, t in ((deltas, "delta"), (sums, "cumulative")))
    assert one == two and len(one) > 30


def test_empty_and_too_many_bounds(spark):
    none = points(spark, [], HIST)
    assert R.rated_bucket_quantile(none, [0.5], Grid(0, S, S), S).count() == 0
    with pytest.raises(ValueError, match="bounds"):
        R.merged_bounds(points(spark, [("m", "x", 0, [0] * 4, [1.0, 2.0, 3.0])], HIST), most=2)


def test_otlp_points_tell_their_temporality(spark):
    import json

    from pulsegrid.sources import otlp

    num = [{"timeUnixNano": "1", "asDouble": 1.0}]
    hist = [{"timeUnixNano": "1", "count": "1", "bucketCounts": ["1"], "explicitBounds": []}]
    metrics = [{"name": "a", "sum": {"dataPoints": num, "aggregationTemporality": 1, "isMonotonic": True}},
               {"name": "b", "sum": {"dataPoints": num, "aggregationTemporality": 2}}, {"name": "c", "gauge": {"dataPoints": num}},
               {"name": "d", "histogram": {"dataPoints": hist, "aggregationTemporality": 1}}]
    req = {"resourceMetrics": [{"resource": {"attributes": []}, "scopeMetrics": [{"metrics": metrics}]}]}
    s, h = otlp.parse_otlp_metrics(spark.createDataFrame([(json.dumps(req),)], "j string"), "j")
    assert sorted(x.temporality or "" for x in s.collect()) == ["", "cumulative", "delta"]
    assert [x.temporality for x in h.collect()] == ["delta"]
