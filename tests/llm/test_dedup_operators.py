"""SimHash and embedding near-dedup against brute force."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pulsegrid.llm import common, simhash, vectors
from tests.conftest import SF_SMALL


def _fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(n, pairs):
    up = list(range(n))

    def root(v):
        while up[v] != v:
            v = up[v]
        return v
    for a, b in pairs:
        up[max(root(a), root(b))] = min(root(a), root(b))
    return [root(v) for v in range(n)]


def test_near_is_exact():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2 ** 63, 150, dtype=np.uint64)
    x = np.concatenate([x, x ^ np.uint64(7), x ^ np.uint64(15 << 40), x ^ np.uint64(1)])
    for radius in (0, 1, 3, 5):
        a, b = simhash.near(x, x[:333], radius, list(range(64)))
        d = np.bitwise_count(x[:, None] ^ x[None, :333])
        assert set(zip(a.tolist(), b.tolist())) == set(zip(*[i.tolist() for i in np.nonzero(d <= radius)]))


@pytest.mark.parametrize("split", [4096, 8])
def test_components_against_brute_force(spark, monkeypatch, split):
    monkeypatch.setattr(simhash, "SPLIT", split)
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    base = "one two three four five six seven eight nine ten " * 6
    near = [(10_000 + i, base.replace("ten ", f"t{i} ", 1)) for i in range(60)]
    rows = near + [(None, None), (-5, ""), (-5, " \t"), (-9, "x"), (-8, "X"), (-7, "x y"), (-6, "Ünï cödé 🙂")]
    df = df.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = simhash.simhash(df.withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x"))).collect()
    data = [(r.doc_id, r.text) for r in df.collect()]
    want = {(i, f"{_fingerprint(t):016x}") for i, t in data}
    assert {(r.doc_id, r.fingerprint) for r in got} == want and len(got) == len(data)
    fp = np.array([int(r.fingerprint, 16) for r in got], "u8")
    d = np.bitwise_count(fp[:, None] ^ fp[None, :])
    roots = _components(len(got), zip(*np.nonzero(d <= 3)))
    low = {}
    for r, root in zip(got, roots):
        if r.doc_id is not None:
            low[root] = min(low.get(root, r.doc_id), r.doc_id)
    assert all(r.component_id == low.get(root) for r, root in zip(got, roots))
    kept = simhash.drop_near_duplicates(df).collect()
    assert len(kept) == len(set(roots)) and simhash.drop_near_duplicates(df).columns == df.columns


def test_components_of_chains(spark):
    n = 40
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in common.components(edges).collect()}
    assert all(got[i] == 0 for i in range(n + 1)) and got[100] == got[101] == 100


def _links(rows):
    good = [(i, lab, np.array(v, float)) for i, lab, v in rows
            if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (_, la, x) in enumerate(good):
        for b, (_, lb, y) in enumerate(good):
            if a != b and la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                out.append((a, b))
    return good, out


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows, n = [], 0
    for lab in (0, 1):
        for _ in range(150):
            v = rng.normal(size=16)
            for _ in range(rng.integers(1, 4)):
                rows.append((n, lab, (v + rng.normal(size=16) * 0.03).tolist()))
                n += 1
        v = rng.normal(size=16)
        rows += [(n + i, lab, (v + rng.normal(size=16) * 0.05).tolist()) for i in range(60)]
        n += 60
        rows += [(n + i, lab, [1.0] * 16) for i in range(20)]
        n += 20
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0] * 15 + [None]]
    rows += [(n + i, 0, v) for i, v in enumerate(odd)] + [(n + 50, None, [1.0] * 16), (n + 51, 0, [1.0] * 15)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("cls", F.lit("x"))
    got = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    good, links = _links([(i, lab, v) for i, lab, v in rows])
    count = {}
    for a, _ in links:
        count[good[a][0]] = count.get(good[a][0], 0) + 1
    roots = _components(len(good), links)
    comp = {good[k][0]: good[r][0] for k, r in enumerate(roots)}
    assert len(got) == len(rows)
    for i, _, _ in rows:
        assert got[i].n_links == count.get(i, 0)
        assert got[i].component_id == comp.get(i, i) and got[i].kept == (comp.get(i, i) == i)


def test_repeated_vectors_and_empty_table(spark):
    schema = "vec_id long, label int, embedding array<float>"
    df = spark.createDataFrame([(4, 1, [1.0, 2.0]), (4, 1, [1.0, 2.0]), (2, 1, [2.0, 4.0]), (None, 1, [1.0, 0.0])], schema)
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id) for r in vectors.near_vectors(df).collect())
    assert got == [(0, 0, None), (2, 2, 2), (4, 2, 2), (4, 2, 2)]
    assert vectors.near_vectors(spark.createDataFrame([], schema)).count() == 0
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash(none).count() == 0 and simhash.drop_near_duplicates(none).count() == 0


def _holds(got, rows):
    good, links = _links(rows)
    count = {}
    for a, _ in links:
        count[good[a][0]] = count.get(good[a][0], 0) + 1
    comp = {good[k][0]: good[r][0] for k, r in enumerate(_components(len(good), links))}
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == {i: (count.get(i, 0), comp[i]) for i, _, _ in rows}


def _group(rng, centre, n, spread):
    return [(centre + rng.normal(size=len(centre)) * spread).tolist() for _ in range(n)]


@pytest.mark.parametrize("cells", [200, 20])
def test_dense_groups_that_link_less_closely_than_inside(spark, monkeypatch, cells):
    monkeypatch.setattr(vectors, "CELL", cells)
    rng = np.random.default_rng(7)
    one, other = np.linalg.qr(rng.normal(size=(32, 2)))[0].T
    far = np.cos(0.174) * one + np.sin(0.174) * other
    vs = _group(rng, one, 100, 0.0025) + _group(rng, far, 100, 0.0025) + _group(rng, rng.normal(size=32), 30, 0.01)
    rows = [(i, 0, v) for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    assert [got[i].n_links for i in (0, 100)] == [199, 199]
    _holds(got, rows)


def test_links_between_components_of_full_lists(spark):
    rng = np.random.default_rng(8)
    one, other = np.linalg.qr(rng.normal(size=(32, 2)))[0].T
    far = np.cos(0.174) * one + np.sin(0.174) * other
    vs = _group(rng, one, 40, 0.0025) + _group(rng, far, 40, 0.0025)
    points = spark.createDataFrame([(i, 0, v) for i, v in enumerate(vs)], "cls long, group long, v array<double>")
    x = np.array(vs) / np.linalg.norm(vs, axis=1)[:, None]
    cos = x @ x.T - 2 * np.eye(80)
    near = [(a, int(b), float(cos[a, b]), p + 1) for a in range(80) for p, b in enumerate(np.argsort(-cos[a])[:vectors.K])]
    assert all(a // 40 == b // 40 for a, b, _, _ in near)
    graph = spark.createDataFrame(near, "a long, b long, cos double, place int")
    roots = spark.createDataFrame([(i, i // 40 * 40) for i in range(80)], "node long, root long")
    found = vectors.leaving(points, graph, roots, 0, 0.98).collect()
    assert found and all(r.a // 40 != r.b // 40 and cos[r.a, r.b] >= 0.98 for r in found)
    whole = roots.withColumn("root", F.lit(0).cast("long"))
    assert vectors.leaving(points, graph, whole, 0, 0.98) is None


@pytest.mark.parametrize("block", [1024, 64])
def test_lost_small_groups_are_seen_and_found(spark, monkeypatch, block):
    # a search that is blind to some classes: only the audit can tell, and only all pairs can help
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "SETS", 1)
    search = vectors.start
    monkeypatch.setattr(vectors, "start", lambda points, *a: search(points.filter(F.element_at("v", 1) > 0), *a))
    rng = np.random.default_rng(9)
    vs = _group(rng, np.array([3.0] + [0.0] * 15), 150, 0.05)
    for _ in range(20):
        v = rng.normal(size=16)
        v[0] = -3 - abs(v[0])
        vs += _group(rng, v, 2, 0.001)
    rows = [(i, 0, v) for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    assert all(got[i].n_links >= 1 for i in range(150, 190))
    _holds(got, rows)


def test_magnitudes_beyond_the_range_of_squares(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, 1, [1e200, 1e200]), (1, 1, [1e200, 1.01e200]), (2, 1, [1e-200, 1e-200]), (3, 1, [5e-324, 5e-324]),
            (4, 1, [1.0, 1.0]), (5, 1, [1e200, -1e200]), (6, 1, [inf, inf]), (7, 1, [nan, 1.0]), (8, 1, [0.0, 0.0]),
            (9, 1, [None, 1.0]), (10, 1, []), (11, None, [1e200, 1e200])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(df).collect()}
    assert got == {i: (4, 0) if i < 5 else (0, i) for i in range(12)}
