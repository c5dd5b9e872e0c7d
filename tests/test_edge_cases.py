"""Adversarial cases for the range / instant operators against a brute-force reading of the
semantics contract (SURVEY §2.0), plus lint and coverage fixtures."""

import json
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.labels import series_key
from pulsegrid.functions.time import Grid
from pulsegrid.operators import coverage as C
from pulsegrid.operators import lint as LT
from pulsegrid.operators import promql as pq
from pulsegrid.sources import corpus as S

S_NS = 1_000_000_000


def _samples(spark, rows):
    df = spark.createDataFrame(rows, "metric string, pod string, ts_ns long, value double")
    df = df.withColumn("labels", F.create_map(F.lit("pod"), F.col("pod")))
    return df.withColumn("series_id", series_key("metric", "labels"))


def brute_rate(points, t, r):
    """points: {(series): [(ts, v)]} deduped; window [t - r, t)."""
    out = {}
    for k, pts in points.items():
        w = sorted(p for p in pts if t - r <= p[0] < t)
        if len(w) < 2 or w[-1][0] == w[0][0]:
            continue
        inc = sum((b[1] - a[1]) if b[1] >= a[1] else b[1] for a, b in zip(w, w[1:]))
        out[k] = inc / ((w[-1][0] - w[0][0]) / S_NS)
    return out


def brute_instant(points, t, lb):
    out = {}
    for k, pts in points.items():
        w = [p for p in pts if t - lb <= p[0] < t]
        if w:
            out[k] = max(w)[1]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rate_and_instant_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for pod in ["a", "b", "c"]:
        ts = 0
        for _ in range(rnd.randint(0, 60)):
            ts += rnd.choice([1, 7, 30, 90, 400]) * S_NS
            v = float(rnd.randint(0, 20))
            rows.append(("m", pod, ts, v))
            if rnd.random() < 0.1:  # duplicate point: the larger value counts
                rows.append(("m", pod, ts, v + 1))
    rows.append(("m", "single", 100 * S_NS, 1.0))  # a single sample: never a rate
    df = _samples(spark, rows)
    pts = {}
    for m, pod, ts, v in rows:
        d = pts.setdefault(pod, {})
        d[ts] = max(v, d.get(ts, v))
    pts = {k: sorted(v.items()) for k, v in pts.items()}
    step, rng = 120 * S_NS, 600 * S_NS
    grid = Grid(0, 6000 * S_NS, step)
    got = {(r.labels["pod"], r.t): r.value for r in pq.rate(df, grid, rng).collect()}
    want = {}
    for j in range(grid.n_points):
        t = j * step
        for k, v in brute_rate(pts, t, rng).items():
            want[(k, t // S_NS)] = v
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-9)
    lb = 300 * S_NS
    gi = {(r.labels["pod"], r.t): r.value for r in pq.instant(df, grid, lb).collect()}
    wi = {}
    for j in range(grid.n_points):
        for k, v in brute_instant(pts, j * step, lb).items():
            wi[(k, j * step // S_NS)] = v
    assert gi == wi


def test_range_not_multiple_of_step(spark):
    rows = [("m", "a", k * 10 * S_NS, float(k)) for k in range(100)]
    df = _samples(spark, rows)
    grid = Grid(0, 1000 * S_NS, 60 * S_NS)
    got = {r.t: r.value for r in pq.increase(df, grid, 90 * S_NS).collect()}
    pts = {"a": [(k * 10 * S_NS, float(k)) for k in range(100)]}
    for t_s, v in got.items():
        w = [p for p in pts["a"] if t_s * S_NS - 90 * S_NS <= p[0] < t_s * S_NS]
        assert v == pytest.approx(sum(b[1] - a[1] for a, b in zip(w, w[1:])))


def test_empty_input(spark):
    df = _samples(spark, [])
    grid = Grid(0, 100 * S_NS, 10 * S_NS)
    assert pq.rate(df, grid, 30 * S_NS).count() == 0
    assert pq.instant(df, grid, 30 * S_NS).count() == 0


def test_matchers_absent_label_and_anchored_regex(spark):
    df = _samples(spark, [("m", "ab", 1, 1.0), ("m", "a", 2, 1.0)])
    df = df.union(df.limit(0))
    assert pq.select_series(df, "m", [("pod", "=~", "a")]).count() == 1  # anchored
    assert pq.select_series(df, "m", [("zone", "=", "")]).count() == 2  # absent label == ''
    assert pq.select_series(df, "m", [("pod", "!~", "a.*")]).count() == 0


# ---------------------------------------------------------------- corpus fixtures

def _dash(path, panels):
    return (path, json.dumps({"title": path, "panels": panels}))


def test_dashboard_walk_any_depth_and_lint(spark):
    tempo = {"type": "tempo", "uid": "tempo"}
    loki = {"type": "loki", "uid": "loki"}
    prom = {"type": "prometheus", "uid": "prometheus"}
    deep = {"type": "row", "panels": [{"type": "row", "panels": [
        {"id": 3, "datasource": tempo, "targets": [{"refId": "A", "query": '{resource.service.name=~"$svc"}'}]}]}]}
    docs = [
        _dash("a.json", [{"type": "row", "title": "no targets"}, deep,
                         {"id": 1, "datasource": {"uid": "prometheus"},
                          "targets": [{"refId": "A", "expr": "histogram_quantile(0.9, sum(x_bucket) by (handle))"},
                                      {"refId": "B", "expr": ""}]},
                         {"id": 2, "datasource": loki, "targets": [{"refId": "A", "expr": '{a="b"} | level="x"'}]}]),
        _dash("b.json", [{"id": 4, "datasource": tempo, "targets": [{"refId": "A", "query": "{span.kind=server}"}]},
                         {"id": 5, "datasource": prom,
                          "targets": [{"refId": "A", "expr": "histogram_quantile(0.5, sum(x_bucket) by (le))"}]},
                         {"id": 6, "datasource": loki,
                          "targets": [{"refId": "A", "expr": '{a="b"} | detected_level="x"'}]},
                         {"id": 7, "datasource": {"uid": "old-uid"}, "targets": []}]),
        ("c.json", '{"panels": ['),
    ]
    df = spark.createDataFrame(docs, "path string, json string")
    t = S.route_targets(S.dashboard_targets(df))
    assert t.filter(F.col("path") == "a.json").count() == 4  # deep tempo + 2 prom targets + loki
    assert S.dashboard_targets(df).filter(F.col("path") == "c.json").count() == 0
    f = LT.check_targets(spark, t).collect()
    fails = {(r.check, r.subject) for r in f if r.status == "FAIL"}
    assert ("traceql_variable_regex", "a.json") in fails
    assert ("promql_histogram_by_le", "a.json") in fails  # 'handle' contains 'le' but is not the le label
    assert ("logql_detected_level", "a.json") in fails
    assert not any(s == "b.json" for _, s in fails)  # near misses pass
    passes = {r.check for r in f if r.status == "PASS"}
    assert passes == {"traceql_unscoped_kind"}
    uids = {(r.subject, r.status, r.detail) for r in LT.check_uids(df, t).collect()}
    assert ("b.json", "FAIL", "old-uid") in uids and ("a.json", "PASS", "") in uids
    js = {r.subject: r.status for r in LT.check_json(df).collect()}
    assert js == {"a.json": "PASS", "b.json": "PASS", "c.json": "FAIL"}
    v = C.verdict(C.union_findings(LT.check_json(df), LT.check_targets(spark, t))).first().verdict
    assert v == "FAIL"


def test_fill_section_across_chunks(spark):
    lines = [("f", 0, "# Dashboard: one"), ("f", 1, "q1"), ("f", 5, "q2"), ("f", 7, "# Dashboard: two"),
             ("f", 12, "q3"), ("f", 30, "q4"), ("g", 3, "orphan"), ("g", 4, "# Dashboard: three"), ("g", 9, "q5")]
    df = spark.createDataFrame(lines, "file string, line_no long, line string")
    got = {(r.file, r.line_no): r.section for r in LT.fill_section(df, chunk=4).collect()}
    assert got[("f", 5)] == "one" and got[("f", 12)] == "two" and got[("f", 30)] == "two"
    assert got[("g", 3)] is None and got[("g", 9)] == "three"


def test_or_default_and_contains_join(spark):
    empty = spark.createDataFrame([], "attr string")
    d = spark.createDataFrame([("x",), ("y",)], "attr string")
    assert sorted(r.attr for r in C.or_default(empty, d).collect()) == ["x", "y"]
    some = spark.createDataFrame([("z",)], "attr string")
    assert [r.attr for r in C.or_default(some, d).collect()] == ["z"]
    hay = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"),
                                 (2, "xbeta gamma delta epsilon zeta eta theta iota kappay"), (3, "nothing here")],
                                "id long, text string")
    nd = spark.createDataFrame([(10, "beta gamma delta epsilon zeta eta theta iota kappa"), (11, "here")],
                               "nid long, text string")
    pairs = {(r.id, r.nid) for r in C.contains_join(hay, nd, "id", "text", "nid", "text", n=4).collect()}
    assert pairs == {(1, 10), (2, 10), (3, 11)}


def test_contains_join_matches_brute_force(spark):
    rnd = random.Random(7)
    words = ["al", "be", "ga", "de", "ep", "ze", "et", "th", "io", "ka", "la"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))) for i in range(40)]
    nds = []
    for j in range(60):  # substrings of documents of every token length, glued ends, and misses
        src = docs[rnd.randrange(len(docs))][1]
        if len(src) > 4 and rnd.random() < 0.8:
            a = rnd.randrange(len(src) - 2)
            b = min(len(src), a + rnd.randint(1, 45))
            nds.append((100 + j, src[a:b]))
        else:
            nds.append((100 + j, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 12)))))
    hay = spark.createDataFrame(docs, "id long, text string")
    nd = spark.createDataFrame(nds, "nid long, text string")
    got = {(r.id, r.nid) for r in C.contains_join(hay, nd, "id", "text", "nid", "text", n=4).collect()}
    want = {(i, j) for i, t in docs for j, x in nds if x in t}
    assert got == want and len(want) > 30


def test_label_coverage_equality_and_substring_modes(spark):
    labels = spark.createDataFrame([("service_name", "resource:service.name"), ("log_type", "attribute:log_type"),
                                    ("lvl", "builtin:severityText"), ("odd", "other:x")], "label string, source string")
    keys = spark.createDataFrame([("resource", "service.namespace"), ("attribute", "log_type")], "scope string, key string")
    builtin = spark.createDataFrame([("severityText",)], "field string")
    eq = {r.subject: r.status for r in C.label_coverage(labels, keys, builtin).collect()}
    sub = {r.subject: r.status for r in C.label_coverage(labels, keys, builtin, mode="substring").collect()}
    assert eq == {"service_name": "FAIL", "log_type": "PASS", "lvl": "PASS", "odd": "WARN"}
    assert sub["service_name"] == "PASS"  # 'service.name' occurs inside 'service.namespace'


def test_prom_name_rule(spark):
    from pulsegrid.functions.names import prom_name

    rows = [("http.server.request.duration", "s", False, "http_server_request_duration_seconds"),
            ("jvm.memory.used", "By", False, "jvm_memory_used_bytes"),
            ("jvm.cpu.recent_utilization", "1", False, "jvm_cpu_recent_utilization_ratio"),
            ("jvm.cpu.time", "s", True, "jvm_cpu_time_seconds_total"),
            ("jvm.thread.count", "{thread}", False, "jvm_thread_count"),
            ("jvm.class.loaded", "{class}", True, "jvm_class_loaded_total"),
            ("db.client.connections.wait_time", "ms", False, "db_client_connections_wait_time_milliseconds")]
    df = spark.createDataFrame(rows, "name string, unit string, mono boolean, want string")
    got = df.select(prom_name("name", "unit", "mono").alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


@pytest.mark.parametrize("seed", [11, 12])
def test_histogram_quantile_brute_force(spark, seed):
    from pulsegrid.functions import histograms as H

    rnd = random.Random(seed)
    bounds = [0.5, 1.0, 2.5, 5.0]
    rows = []
    for g in range(6):
        counts = [rnd.choice([0, 0, 1, 3, 7]) for _ in range(len(bounds) + 1)]
        rows.append(("m", g, 1, counts, bounds))
    hist = spark.createDataFrame(rows, "metric string, g long, ts_ns long, counts array<bigint>, bounds array<double>")
    got = {(r.g, r.q): r.value for r in H.histogram_quantile(hist, [0.25, 0.5, 0.9, 1.0], by=["g"]).collect()}
    for _, g, _, counts, bnds in rows:
        cum = [sum(counts[:i + 1]) for i in range(len(counts))]
        les = bnds + [float("inf")]
        for q in [0.25, 0.5, 0.9, 1.0]:
            tot = cum[-1]
            if tot == 0:
                want = None
            else:
                i = next(k for k, c in enumerate(cum) if c >= q * tot)
                if les[i] == float("inf"):
                    want = les[-2]
                else:
                    lo, lc = (0.0, 0) if i == 0 else (les[i - 1], cum[i - 1])
                    want = les[i] if cum[i] == lc else lo + (les[i] - lo) * (q * tot - lc) / (cum[i] - lc)
            if want is None:
                assert got[(g, q)] is None
            else:
                assert got[(g, q)] == pytest.approx(want)


def test_rules_at_any_depth(spark):
    import json

    from pulsegrid.sources.corpus import load_rules

    rule = {"alert": "A", "expr": "up == 0", "for": "5m", "labels": {"severity": "critical"}, "annotations": {"summary": "s"}}
    groups = [{"name": "g", "rules": [rule, {"record": "r", "expr": "sum(up)"}, {"alert": "no expression"}]}]
    docs = {"top": {"groups": groups}, "spec": {"kind": "PrometheusRule", "metadata": {"name": "m"}, "spec": {"groups": groups}},
            "deep": {"items": [{"spec": {"groups": groups}}]}, "both": {"groups": groups, "spec": {"inner": {"groups": groups}}},
            "bare": rule, "none": {"groups": [{"name": "g"}]}, "empty": {}}
    rows = [(k, json.dumps(v)) for k, v in docs.items()] + [("invalid", '{"groups": [{"name"'), ("null", None)]
    got = load_rules(spark.createDataFrame(rows, "path string, json string")).collect()
    two = [("A", "up == 0", 300 * 10 ** 9, "critical", {"summary": "s"}), ("r", "sum(up)", 0, None, None)]
    want = [(p, "g", *r) for p in ("top", "spec", "deep", "both", "both") for r in two] + [("bare", None, *two[0])]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


# ---------------------------------------------------------------- rules as a table

def test_rules_as_a_table(spark):
    from pulsegrid.functions.time import Grid
    from pulsegrid.operators import alerts as AL

    step = 60 * 10**9
    exprs = {"hot": 'temp{room="a", floor!~"b.*"} > 10', "any": "temp >= 5", "cold": 'temp{room=~"a|b"}<-1.5e1',
             "sum": "sum(temp) > 1", "none": None, "absent": 'temp{none=""} == 20', "part": 'temp{room=~"[a"} > 1 or x'}
    rules = spark.createDataFrame(
        [(k, e, (60 if k == "any" else 0) * 10**9, {"summary": "{{ $labels.room }}/{{$value}}/{{ $labels.no }}{{ other }}!"})
         for k, e in exprs.items()], "alert string, expr string, for_ns long, annotations map<string,string>")
    parsed = AL.comparison_rules(rules.withColumn("severity", F.lit("page")))
    assert {r.alert for r in parsed.filter("metric is null").collect()} == {"sum", "none", "part"}
    v = spark.createDataFrame([("temp", {"room": r}, f"s{r}", j, j * 60, x) for r, j, x in
                               [("a", 0, 20.0), ("a", 1, 20.0), ("a", 3, 6.0), ("b", 0, 4.0), ("b", 1, -20.0)]],
                              "metric string, labels map<string,string>, series_id string, j long, t long, value double")
    st = AL.rule_states(v, parsed, Grid(0, 10 * step, step))
    got = {(r.alert, r.labels["room"], r.j): r.state for r in st.collect()}
    assert {k: s for k, s in got.items() if k[0] == "hot"} == {("hot", "a", 0): "firing", ("hot", "a", 1): "firing", ("hot", "a", 3): "inactive"}
    assert [got["any", "a", j] for j in (0, 1, 3)] == ["pending", "firing", "pending"]
    assert got["cold", "b", 1] == "firing" and got["absent", "a", 0] == "firing" and got["absent", "b", 0] == "inactive"
    text = AL.rendered(F.col("annotations")["summary"], F.col("labels"), F.col("value"))
    assert st.filter("alert = 'hot' and j = 0").select(text.alias("x")).first().x == "a/20.0/!"


def test_rule_table_plan_does_not_grow_with_the_rules(spark):
    from pulsegrid.functions.time import Grid
    from pulsegrid.operators import alerts as AL

    v = spark.createDataFrame([("m", {"a": "1"}, "s", 0, 0, 1.0)],
                              "metric string, labels map<string,string>, series_id string, j long, t long, value double")
    sizes = []
    for n in (1, 1000):
        rules = spark.range(n).select(F.concat(F.lit("r"), "id").alias("alert"), F.lit('m{a="1"} > 0').alias("expr"),
                                      F.lit(0).cast("long").alias("for_ns"), F.lit("x").alias("severity"),
                                      F.create_map(F.lit("a"), F.lit("b")).alias("annotations"))
        st = AL.rule_states(v, AL.comparison_rules(rules), Grid(0, 10, 1))
        assert st.filter("state = 'firing'").count() == n
        sizes.append(len(st._jdf.queryExecution().optimizedPlan().toString().splitlines()))
    assert sizes[0] == sizes[1]


def test_rules_meet_the_rows_of_their_equality_labels(spark):
    from pulsegrid.functions.time import Grid
    from pulsegrid.operators import alerts as AL

    series = [{"user": u, "pod": p} for u in "123" for p in "ab"] + [{"user": "1"}, {"pod": "a"}, {}]
    v = spark.createDataFrame([("m", x, f"s{i}", 0, 0, 1.0) for i, x in enumerate(series)],
                              "metric string, labels map<string,string>, series_id string, j long, t long, value double")
    lists = {"one": [("user", "=", "1")], "two": [("pod", "=", "a"), ("user", "=", "2")], "none": [], "absent": [("pod", "=", "")],
             "both": [("user", "=", "1"), ("pod", "=", "")], "never": [("user", "=", "1"), ("user", "=", "2")],
             "twice": [("user", "=", "3"), ("user", "=", "3")], "other": [("user", "=", "1"), ("pod", "!=", "a")], "like": [("user", "=~", "[12]")]}
    rules = spark.createDataFrame([(k, "m", ms, ">", 0.0, 0, "x", {"a": "b"}) for k, ms in lists.items()],
                                  "alert string, metric string, matchers array<struct<label:string,op:string,value:string>>, op string, "
                                  "threshold double, for_ns long, severity string, annotations map<string,string>")
    test = {"=": lambda a, b: a == b, "!=": lambda a, b: a != b, "=~": lambda a, b: a in tuple(b.strip("[]"))}
    want = {(k, f"s{i}") for k, ms in lists.items() for i, x in enumerate(series)
            if all(test[op](x.get(label, ""), value) for label, op, value in ms)}
    st = AL.rule_states(v, rules, Grid(0, 10, 1))
    assert sorted((r.alert, r.series_id) for r in st.collect()) == sorted(want)
    # the join keys hold the values, so rules of one metric do not meet all of its rows
    join = next(line for line in st._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line)
    assert "SortMergeJoin" in join and join.count("eq_values") == 2


@pytest.mark.parametrize("name", ["otlp_spans", "span_attr_coverage", "metric_coverage"])
def test_requests_are_encoded_by_generated_code(spark, name):
    """Below ``from_json`` or a higher-order function the encoding would be interpreted a row."""
    from pulsegrid.plans import registry
    from tests.conftest import SF_SMALL

    plan = registry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    encoding = [line for line in plan if "StructsToJsonEvaluator" in line]
    assert encoding and not any("from_json" in line or "lambdafunction" in line for line in encoding)


def test_attributes_with_and_without_repeated_keys(spark):
    from pulsegrid.functions.labels import attributes_to_map
    from pulsegrid.sources.otlp import KV

    def kv(key, **value):
        return key, tuple(value.get(k) for k in ("s", "i", "b", "d"))
    rows = [[kv("a", s="1"), kv("b", i="2"), kv("c", b=True), kv("d", d=0.5), kv("e")], [kv("a", s="1"), kv("b", s="2"), kv("a", i="3")],
            [kv("a", s="1"), kv("a", b=False)], [kv(None, s="1"), kv("a", s="2")], [], None]
    got = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, a {KV}").select("i", attributes_to_map("a").alias("m"))
    assert [r.m for r in got.orderBy("i").collect()] == [
        {"a": "1", "b": "2", "c": "true", "d": "0.5", "e": None}, {"a": "3", "b": "2"}, {"a": "false"}, {"a": "2"}, {}, {}]


def test_corpus_is_read_once(spark, scratch):
    """Findings of all dashboard checks scan the documents a single time."""
    from pulsegrid.operators import lint
    from pulsegrid.sources import corpus

    deep = '{"rows": [{"panels": [{"panels": [{"panels": [{"id": 1, "datasource": {"type": "tempo", "uid": "x"},' \
           ' "targets": [{"query": "{ kind = 2 }"}]}]}]}]}]}'
    flat = '{"panels": [{"id": 2, "datasource": {"type": "loki", "uid": "loki"}, "targets": []}, {"id": 3}]}'
    path = f"{scratch}/docs"
    spark.createDataFrame([("a", deep), ("b", flat), ("c", "{"), ("d", None), ("e", "{}")], "path string, json string").write.parquet(path)
    rows = corpus.document_rows(spark.read.parquet(path))
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") <= 1
    assert sorted((r.path, r.valid, r.found, r.panel_id or 0) for r in rows.collect()) == [
        ("a", True, True, 1), ("b", True, True, 2), ("c", False, False, 0), ("d", False, False, 0), ("e", True, False, 0)]
    got = lint.corpus_findings(spark, rows)
    assert "FileScan" not in got._jdf.queryExecution().executedPlan().toString()
    bad = {(r.check, r.subject) for r in got.filter("status = 'FAIL'").collect()}
    assert bad == {("json_valid", "c"), ("json_valid", "d"), ("datasource_uid", "a"), ("traceql_unscoped_kind", "a")}
