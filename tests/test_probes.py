"""Containment joins by the rarest run, probes as data, keyed left joins, sinks."""

import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.plan import left_join_keyed
from pulsegrid.operators import coverage as C
from pulsegrid.operators import probes as PR
from pulsegrid.operators import traces as T
from pulsegrid.plans import registry
from tests.conftest import SF_SMALL

@pytest.mark.parametrize("n", [1, 2, 8])
def test_containment_of_every_length(spark, n):
    rng = random.Random(5)
    words = ["the", "of"] * 6 + [f"w{i}" for i in range(9)]  # common openings, rare words behind them
    hay = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(60)] + [(60, None)]
    needles = []
    for k in range(1, 13):
        for _ in range(6):
            t = rng.choice([h for _, h in hay if h and len(h.split()) > k]).split()
            at = rng.randint(0, len(t) - k)
            text = " ".join(t[at:at + k])
            needles.append(text if rng.random() < 0.7 else text[1:] or text)
    needles += ["the of the nowhere of the", "w1 w1 w1 w1 w1"]
    got = C.contains_join(spark.createDataFrame(hay, "d long, t string"),
                          spark.createDataFrame(list(enumerate(needles)), "q long, s string"), "d", "t", "q", "s", n)
    want = {(i, j) for i, h in hay if h is not None for j, s in enumerate(needles) if s in h}
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_candidates_are_those_of_the_rarest_run(spark):
    hay = spark.createDataFrame([(i, f"a the of the and w{i} z") for i in range(200)], "d long, t string")
    needles = spark.createDataFrame([(0, "a the of the and w7 z")], "q long, s string")
    df = C.contains_join(hay, needles, "d", "t", "q", "s", 2)
    assert [tuple(r) for r in df.collect()] == [(7, 0)]


def test_one_finding_for_each_outcome(spark):
    q = registry.queries()
    assert {r.status for r in q["label_outcomes"](spark, SF_SMALL).collect()} == {"PASS", "FAIL", "WARN"}
    names = q["name_outcomes"](spark, SF_SMALL).collect()
    assert {r.detail for r in names} == {"known", "histogram_part", "infrastructure", "provided", "unverified"}
    probes = q["probe_selectors"](spark, SF_SMALL).collect()
    got = {(r.query.split()[0], r.status) for r in probes}
    assert {("metric", "PASS"), ("log", "PASS"), ("log", "FAIL"), ("trace", "PASS"), ("trace", "FAIL")} <= got


def test_probe_edges(spark):
    rows = [("prometheus", {"__name__": "up", "job": "a"}, "s1", 5, 2.0),
            ("prometheus", {"__name__": "up", "job": "b"}, "s2", 5, 1.0),
            ("prometheus", {"__name__": "up"}, "s3", 9, 7.0), ("tempo", {"duration": "12"}, "t1", 5, None)]
    sig = spark.createDataFrame(rows, "lang string, labels map<string,string>, sid string, ts_ns long, value double")
    eq = [("__name__", "=", "up")]
    cat = [("all", "prometheus", eq, 0, 10), ("before 9", "prometheus", eq, 0, 9), ("none", "prometheus", [("__name__", "=", "x")], 0, 10),
           ("absent", "prometheus", [("job", "=", "")], 0, 10), ("any", "prometheus", None, 0, 10),
           ("long", "tempo", [("duration", ">", "11")], 0, 10), ("longer", "tempo", [("duration", ">", "12")], 0, 10),
           ("text", "tempo", [("duration", "<", "x")], 0, 10), ("other", "loki", [], 0, 10)]
    got = {r.query: (r.n_series, r.n_rows, r.first_value, r.status) for r in PR.probe_selectors(
        sig, spark.createDataFrame(cat, f"query string, lang string, matchers {PR.MATCHERS}, start_ns long, end_ns long")).collect()}
    assert got == {"all": (3, 3, 1.0, "PASS"), "before 9": (2, 2, 1.0, "PASS"), "none": (0, 0, None, "FAIL"),
                   "absent": (1, 1, 7.0, "PASS"), "any": (3, 3, 1.0, "PASS"), "long": (1, 1, None, "PASS"),
                   "longer": (0, 0, None, "FAIL"), "text": (0, 0, None, "FAIL"), "other": (0, 0, None, "FAIL")}


def test_probe_plan_has_no_sort_aggregate_nor_nested_loop(spark):
    df = registry.queries()["probe_selectors"](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    probing = plan[:plan.find("rootName")] if "rootName" in plan else plan  # the roots of traces are a further step
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "SortAggregate" not in probing


def test_keyed_left_join_reads_its_left_side_once(spark, scratch):
    spark.range(2000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("k"), "id",
                             F.create_map(F.lit("a"), "id").alias("m")).write.parquet(f"{scratch}/l")
    left = spark.read.parquet(f"{scratch}/l")
    right = spark.range(0, 2000, 6).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = left_join_keyed(left, right, ["k"])
    assert out.columns == ["k", "id", "m", "v"]
    got = {r.id: (r.k, r.v) for r in out.collect()}
    assert got == {i: (i if i % 3 == 0 else None, 2 * i if i % 6 == 0 else None) for i in range(2000)}
    assert out._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 1


def test_root_predicates_need_their_columns(spark):
    spans = spark.createDataFrame([("t", "a", None, "root", 0, 1, {"service.name": "s"}), ("t", "b", "a", "leaf", 0, 1, {})],
                                  "trace_id string, span_id string, parent_id string, name string, start_ns long, "
                                  "end_ns long, res map<string,string>")
    got = T.select_spans(T.root_attributes(spans), [("rootName", "=", "root"), ("rootServiceName", "=", "s"),
                                                    ("spanID", "!=", "a"), ("traceID", "=", "t")])
    assert [r.span_id for r in got.collect()] == ["b"]


def test_probes_equal_brute_force_and_the_join_compares_no_matchers(spark):
    import re
    rng = random.Random(11)
    keys, ops = ["a", "b", "n"], ["=", "!=", "=~", "!~", ">", ">=", "<", "<="]
    rows = [(rng.choice(["x", "y"]), {k: rng.choice(["", "1", "2", "10", "z", "NaN"]) for k in keys if rng.random() < 0.7},
             f"s{i % 9}", i, float(i % 7)) for i in range(120)]
    cat = [(f"p{i % 50}", rng.choice(["x", "y", None]), [(rng.choice(keys), rng.choice(ops), rng.choice(["", "1", "2", "10", "z|1", "t"]))
            for _ in range(rng.randint(0, 4))], rng.randint(0, 40), rng.randint(30, 120)) for i in range(60)]
    num = lambda t: float(t) if re.fullmatch(r"[0-9]+|NaN", t or "") else None

    def meets(labels, k, op, w):
        v = labels.get(k, "")
        if op in "!=~" or op in ("!~", "=~"):
            hit = re.fullmatch(w, v) is not None if op[-1] == "~" else v == w
            return hit != (op[0] == "!")
        a, b = num(labels.get(k)), num(w)
        if a is None or b is None:
            return False
        a, b = [(1, 0) if x != x else (0, x) for x in (a, b)]  # NaN is the largest
        return {">": a > b, ">=": a >= b, "<": a < b, "<=": a <= b}[op]
    want = {}
    for q, lang, ms, lo, hi in cat:
        got = [r for r in rows if r[0] == lang and lo <= r[3] < hi and all(meets(r[1], *m) for m in ms)]
        want.setdefault(q, []).extend(got)
    df = PR.probe_selectors(
        spark.createDataFrame(rows, "lang string, labels map<string,string>, sid string, ts_ns long, value double"),
        spark.createDataFrame(cat, f"query string, lang string, matchers {PR.MATCHERS}, start_ns long, end_ns long"))
    assert {r.query: (r.n_series, r.n_rows, r.first_value) for r in df.collect()} == {
        q: (len({r[2] for r in g}), len(g), min(g, key=lambda r: r[3])[4] if g else None) for q, g in want.items()}
    joins = [line for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in line]
    assert joins and not any("RLIKE" in line.upper() or "forall" in line for line in joins)
