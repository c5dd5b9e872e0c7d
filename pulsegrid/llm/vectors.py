"""Embedding near-dedup by NN-descent.

Vectors link when their labels are equal and not null and their cosine, in double precision, is at
least ``THRESHOLD``. Vectors that are null, empty, zero, or hold null or non-finite components link
with nothing; vectors of different lengths do not link. Vectors whose largest component is beyond
1e100 or under 1e-100 are divided by it first, so that their squares neither overflow nor vanish.

* Equal vectors of one label are one class with a weight; only classes are compared.
* The neighbour graph starts from random-projection cells: hyperplane signs per label, as many as
  leave about ``CELL`` classes a cell; larger cells are dealt into parts. Each class keeps its
  ``K`` nearest.
* A round joins the graph with itself at every class: its neighbours and the classes it is a
  neighbour of are compared with each other, and lists improve. Rounds go on until hardly any list
  changes.
* Lists are cut to ``K``, links are not: each cell and each join also gives a spanning forest of
  all its pairs at the threshold, and components are formed from lists and forests together.
* A list full of links is saturated and can hide a link that leaves its component. So the classes
  with such lists are searched again, with lists of the nearest outside their own component, until
  no link between two components is found.
* The members of a component are compared with each other in blocks, exactly, keeping counts
  instead of pairs.
* The result is audited on up to ``AUDIT`` classes each without links, of components up to ``K``
  and of larger ones, against all classes: the share of groups whose sampled class has all its
  links, groups of all sizes alike. Below ``RECALL`` another set of projections and rounds follows.
* When ``SETS`` are used, or no sampled class has a link and so nothing is shown, all classes of a
  label are compared in blocks, exactly.

Repeated rows (equal id and vector) are vectors of their own and link with each other. A null id
takes part, but names no component while another row can. Empty tables give empty results.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, join_sized, settle

THRESHOLD = 0.98
K, CELL, BLOCK = 10, 200, 1024
AUDIT, RECALL, SETS = 256, 0.99, 4
MAX_ROUNDS, SETTLED = 4, 0.01


def classes(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, cls, group, v): usable rows have a class (hash of label and vector), the others null."""
    v = F.col(vector).cast("array<double>")
    top = F.array_max(F.transform(v, F.abs))
    good = (F.col(label).isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x))
            & (top > 0) & (top < float("inf")))
    # squares of components beyond these bounds leave the range of doubles
    scaled = F.when(((top > 1e100) & (top < float("inf"))) | ((top < 1e-100) & (top > 0)), F.transform(v, lambda x: x / top)).otherwise(v)
    rows = df.select(F.col(key).alias("id"), F.col(label).alias("label"), F.coalesce(good, F.lit(False)).alias("good"), v.alias("v"), scaled.alias("s"))
    rows = rows.select("id", "label", "good", F.when(F.col("good"), F.col("s")).otherwise(F.col("v")).alias("v"))
    # -0.0 and 0.0 are one value
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    return rows.select("id", F.when(F.col("good"), F.xxhash64("label", "v")).alias("cls"),
                       F.xxhash64("label", F.size("v")).alias("group"), "v")


def _runs(batches, keys: int):
    """(key, table of the other columns) for each run of equal leading columns, whatever the batch cuts."""
    import pyarrow as pa

    cur, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        lead = list(zip(*[batch.column(i).to_pylist() for i in range(keys)]))
        cuts = [i for i in range(1, len(lead)) if lead[i] != lead[i - 1]]
        for a, b in zip([0, *cuts], [*cuts, len(lead)]):
            if lead[a] != cur and held:
                yield cur, pa.Table.from_batches(held).combine_chunks()
                held = []
            cur = lead[a]
            held.append(batch.slice(a, b - a).select(names[keys:]))
    if held:
        yield cur, pa.Table.from_batches(held).combine_chunks()


def _matrix(column):
    """List column to a matrix of unit rows in double precision."""
    import numpy as np

    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    if hasattr(flat, "chunks"):
        flat = flat.chunk(0)
    x = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _gather(pieces, names, types):
    import numpy as np
    import pyarrow as pa

    cols = [np.concatenate(p) if p else np.zeros(0) for p in zip(*pieces)] if pieces else [np.zeros(0)] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(cols, types)], names)


def _forest(near):
    """(child, parent) places of a spanning forest of a symmetric relation."""
    import numpy as np

    child, parent, free = [np.zeros(0, "i8")], [np.zeros(0, "i8")], near.any(axis=1)
    for s in np.flatnonzero(free):
        stack, free[s] = [s] if free[s] else [], False
        while stack:
            u = stack.pop()
            new = np.flatnonzero(near[u] & free)
            free[new] = False
            child.append(new)
            parent.append(np.full(len(new), u))
            stack.extend(new)
    return np.concatenate(child), np.concatenate(parent)


_PAIRS = ["a", "b", "cos", "link"], ["i8", "i8", "f8", "?"]


def _linked(ids, cos, threshold):
    """Rows of ``_PAIRS``: a spanning forest of the pairs at the threshold."""
    import numpy as np

    child, parent = _forest(cos >= threshold)
    return ids[child], ids[parent], cos[child, parent], np.ones(len(child), bool)


def _pairs(keys: int, threshold: float, choose):
    """Per run of equal keys: the list entries that ``choose`` takes and the forest of links, of
    pairs with different roots only."""
    def run(batches):
        import numpy as np

        out, rows = [], 0
        for _, t in _runs(batches, keys):
            ids, root, x = t.column("cls").to_numpy(), t.column("root").to_numpy(), _matrix(t.column("v"))
            cos = x @ x.T
            cos[root[:, None] == root] = -2
            i, j = choose(cos, t)
            out.append((ids[i], ids[j], cos[i, j], np.zeros(len(i), bool)))
            out.append(_linked(ids, cos, threshold))
            rows += len(i) + len(out[-1][0])
            if rows > 200_000:
                yield _gather(out, *_PAIRS)
                out, rows = [], 0
        yield _gather(out, *_PAIRS)
    return run


def _nearest(cos, t):
    """Each member's K nearest within the cell."""
    import numpy as np

    k = min(K, len(cos) - 1)
    if not k:
        return np.zeros(0, "i8"), np.zeros(0, "i8")
    best = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    i, j = np.repeat(np.arange(len(cos)), k), best.ravel()
    real = cos[i, j] > -2
    return i[real], j[real]


def _better(cos, t):
    """Pairs above the first one's list end."""
    import numpy as np

    return np.nonzero(cos > t.column("least").to_numpy()[:, None])


def _top(pairs: DataFrame, k: int = K) -> DataFrame:
    """The k nearest that each class is in the list of; the window group limit cuts hubs before the shuffle."""
    w = Window.partitionBy("b").orderBy(F.desc("cos"), "a")
    return pairs.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def _lists(pairs: DataFrame) -> DataFrame:
    """(a, b, cos, link, new, place): the K nearest of each class, and all links of the forests."""
    pairs = pairs.groupBy("a", "b").agg(F.max("cos").alias("cos"), F.max("link").alias("link"), F.min("new").alias("new"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cos"), "b"))
    return settle(pairs.withColumn("place", place).filter((F.col("place") <= K) | F.col("link")))


def start(points: DataFrame, seed: int, threshold: float) -> DataFrame:
    """(a, b, cos, link): nearest neighbours and links within random-projection cells."""
    groups = points.groupBy("group").agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d"))
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / CELL))).cast("int")
    groups = settle(groups.select(F.col("group").alias("g"), bits.alias("bits")))
    wide = join_sized(points, groups, F.col("group") == F.col("g"), "inner")

    def side(b):
        # component of a hyperplane: a value in [-1, 1) that follows from seed, plane and place
        plane = F.transform("v", lambda x, i: x * ((F.pmod(F.xxhash64(F.lit(seed), b, i), F.lit(2001)) - 1000) / 1000))
        return F.when(F.aggregate(plane, F.lit(0.0), lambda a, x: a + x) > 0, "1").otherwise("0")
    code = F.array_join(F.transform(F.sequence(F.lit(0), F.col("bits")), side), "")
    cells = settle(wide.select("group", code.alias("code"), "cls", "root", "v"))
    full = settle(cells.groupBy("group", "code").agg(F.ceil(F.count("*") / BLOCK).alias("parts")).filter("parts > 1")
                  .select(F.col("group").alias("g"), F.col("code").alias("c"), "parts"))
    cells = join_sized(cells, full, (F.col("group") == F.col("g")) & (F.col("code") == F.col("c")))
    part = F.pmod(F.xxhash64("cls", F.lit(seed)), F.coalesce("parts", F.lit(1)))
    cells = cells.select("group", "code", part.alias("part"), "cls", "root", "v")
    return cells.repartition("group", "code", "part").sortWithinPartitions("group", "code", "part").mapInArrow(
        _pairs(3, threshold, _nearest), "a long, b long, cos double, link boolean")


def descend(points: DataFrame, first: DataFrame, threshold: float, also: DataFrame | None = None) -> DataFrame:
    """The graph after rounds of neighbours-of-neighbours joins; ``also`` (a, b) are neighbours that
    take part in the joins without being in a list."""
    graph = _lists(first.withColumn("new", F.lit(1)))
    for _ in range(MAX_ROUNDS):
        near = graph.filter(F.col("place") <= K)
        ends = near.groupBy("a").agg(F.count("*").alias("n"), F.min("cos").alias("low"))
        ends = ends.select(F.col("a").alias("e"), F.when(F.col("n") < K, -2.0).otherwise(F.col("low")).alias("least"))
        meet = (near.select(F.col("a").alias("at"), F.col("b").alias("m"))
                .unionByName(_top(near.drop("place")).select(F.col("b").alias("at"), F.col("a").alias("m")))
                .unionByName(near.select(F.col("a").alias("at"), F.col("a").alias("m"))))
        if also is not None:
            meet = meet.unionByName(also.select(F.col("a").alias("at"), F.col("b").alias("m")))
        known = points.select("cls", "root", "v").join(ends, F.col("cls") == F.col("e"), "left").drop("e").fillna(-2.0, ["least"])
        members = meet.distinct().join(known, F.col("m") == F.col("cls")).select("at", "cls", "root", "least", "v")
        found = members.repartition("at").sortWithinPartitions("at").mapInArrow(
            _pairs(1, threshold, _better), "a long, b long, cos double, link boolean")
        old = graph.select("a", "b", "cos", "link", F.lit(0).alias("new"))
        graph = _lists(old.unionByName(found.withColumn("new", F.lit(1))))
        n, new = graph.filter(F.col("place") <= K).agg(F.count("*"), F.sum("new")).first()
        if (new or 0) <= SETTLED * n:
            break
    return graph


def leaving(points: DataFrame, graph: DataFrame, roots: DataFrame, seed: int, threshold: float) -> DataFrame | None:
    """(a, b): links between different components of classes whose list is full of links; None: there are none."""
    near = graph.filter((F.col("place") <= K) & (F.col("cos") >= threshold))
    full = near.groupBy("a").agg(F.count("*").alias("n")).filter(F.col("n") >= K).select("a")
    rows = points.join(full, F.col("cls") == F.col("a"), "left_semi").join(roots, F.col("cls") == F.col("node"), "left")
    rows = settle(rows.select("cls", "group", "v", F.coalesce("root", "cls").alias("root")))
    many = rows.groupBy("group").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("group")
    rows = settle(rows.join(many, "group", "left_semi"))
    if rows.isEmpty():
        return None
    first = start(rows, seed, threshold).unionByName(start(rows, seed + 1, threshold))
    found = settle(descend(rows, first, threshold, near).filter(F.col("cos") >= threshold).select("a", "b"))
    return None if found.isEmpty() else found


def _blocks(rows: DataFrame, by: str) -> DataFrame:
    """(by, i, j, is_left, the other columns): each pair of blocks of the classes of equal ``by`` stands together."""
    sizes = settle(rows.groupBy(by).agg(F.ceil(F.count("*") / BLOCK).alias("cells")).withColumnRenamed(by, "r"))
    rest = [c for c in rows.columns if c != by]
    rows = join_sized(rows, sizes, F.col(by) == F.col("r"), "inner").drop("r")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cls"), F.col("cells"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)))
    rows = rows.select(by, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                       (F.col("own") <= F.col("other")).alias("is_left"), *rest)
    keys = [by, "i", "j"]
    return rows.repartition(*keys).sortWithinPartitions(*keys)


def exact(points: DataFrame, threshold: float) -> DataFrame:
    """(a, b): a spanning forest of the links of each pair of blocks of a group; all pairs are compared."""
    def run(batches):
        import numpy as np

        out, rows = [], 0
        for (_, i, j), t in _runs(batches, 3):
            left, ids, x = t.column("is_left").to_numpy(), t.column("cls").to_numpy(), _matrix(t.column("v"))
            if i == j:
                near = x @ x.T >= threshold
                np.fill_diagonal(near, False)
            else:
                near = np.zeros((len(ids), len(ids)), bool)
                near[np.ix_(left, ~left)] = x[left] @ x[~left].T >= threshold
                near |= near.T
            child, parent = _forest(near)
            out.append((ids[child], ids[parent]))
            rows += len(child)
            if rows > 200_000:
                yield _gather(out, ["a", "b"], ["i8", "i8"])
                out, rows = [], 0
        yield _gather(out, ["a", "b"], ["i8", "i8"])

    return _blocks(points.select("group", "cls", "v"), "group").mapInArrow(run, "a long, b long")


def within(points: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """(cls, links): for every class the weight of the other classes of its component at the threshold.

    A component is compared with itself in pairs of blocks; each pair gives counts, not pairs."""
    rows = points.join(roots, F.col("cls") == F.col("node")).select("root", "cls", "n", "v")

    def count(batches):
        import numpy as np

        out = []
        for (_, i, j), t in _runs(batches, 3):
            left, ids, n = t.column("is_left").to_numpy(), t.column("cls").to_numpy(), t.column("n").to_numpy()
            x = _matrix(t.column("v"))
            near = (x @ x.T if i == j else x[left] @ x[~left].T) >= threshold
            if i == j:
                np.fill_diagonal(near, False)
                out.append((ids, near @ n))
            else:
                out += [(ids[left], near @ n[~left]), (ids[~left], n[left] @ near)]
            if len(out) > 1000:
                yield _gather(out, ["cls", "links"], ["i8", "i8"])
                out = []
        yield _gather(out, ["cls", "links"], ["i8", "i8"])

    got = _blocks(rows, "root").mapInArrow(count, "cls long, links long")
    return got.groupBy("cls").agg(F.sum("links").alias("links"))


def audit(points: DataFrame, roots: DataFrame, counts: DataFrame, threshold: float) -> float | None:
    """Share of the groups that ``counts`` has whole, estimated from sampled classes that have links;
    None: no sampled class has any.

    Up to ``AUDIT`` classes of smallest hash are taken of each kind (no component, up to ``K`` classes,
    more), so the sample is bounded; all classes are read. A class stands for the classes of its kind
    and counts as one of its true links and itself, which makes groups of all sizes alike."""
    import numpy as np

    sizes = roots.groupBy("root").agg(F.count("*").alias("size"))
    kind = F.when(F.col("size").isNull(), 0).when(F.col("size") <= K, 1).otherwise(2)
    kinds = settle(points.select("cls").join(roots, F.col("cls") == F.col("node"), "left").join(sizes, "root", "left")
                   .select("cls", kind.alias("kind")))
    total = {r[0]: r[1] for r in kinds.groupBy("kind").agg(F.count("*")).collect()}
    weight = {}
    for k, n in total.items():
        some = kinds.filter(F.col("kind") == k).orderBy(F.xxhash64("cls"), "cls").limit(AUDIT).collect()
        weight.update({r[0]: n / len(some) for r in some})
    sample = points.filter(F.col("cls").isin(list(weight))).select("cls", "group", "v").collect()
    if not sample:
        return 1.0
    ids, groups = np.array([r[0] for r in sample]), np.array([r[1] for r in sample])
    vectors = [np.array(r[2]) / np.linalg.norm(r[2]) for r in sample]

    def true(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            cls, group, n = (batch.column(i).to_numpy() for i in range(3))
            total, many = np.zeros(len(ids), "i8"), np.zeros(len(ids), "i8")
            for g in np.unique(group):
                mine, rows = np.flatnonzero(groups == g), np.flatnonzero(group == g)
                if len(mine):
                    x = _matrix(batch.column(3).take(_places(rows)))
                    near = (np.array([vectors[k] for k in mine]) @ x.T >= threshold) & (ids[mine][:, None] != cls[rows])
                    total[mine] += near @ n[rows]
                    many[mine] += near.sum(axis=1)
            yield _gather([(ids, total, many)], ["c", "links", "many"], ["i8", "i8", "i8"])

    real = points.select("cls", "group", "n", "v").mapInArrow(true, "c long, links long, many long").groupBy("c").agg(
        F.sum("links").alias("links"), F.sum("many").alias("many"))
    seen = real.filter("many > 0").join(counts.select("cls", F.col("links").alias("found")), F.col("c") == F.col("cls"), "left")
    seen = seen.select("c", "links", "many", F.coalesce("found", F.lit(0))).collect()
    share = [(weight[c] / (many + 1), found == links) for c, links, many, found in seen]
    return sum(w for w, right in share if right) / sum(w for w, _ in share) if share else None


def _places(rows):
    import pyarrow as pa

    return pa.array(rows)


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = THRESHOLD) -> DataFrame:
    """(key, n_links, component_id, kept): one row for each row of ``df``."""
    rows = classes(df, key, vector, label)
    slim = settle(rows.select("id", "cls"))
    points = settle(rows.filter("cls is not null").groupBy("cls", "group", "v").agg(F.count("*").alias("n")))
    own = points.withColumn("root", F.col("cls"))
    graph = links = None
    for seed in range(SETS):
        first = start(own, 2 * seed, threshold).unionByName(start(own, 2 * seed + 1, threshold))
        if graph is not None:
            first = first.unionByName(graph.select("a", "b", "cos", "link"))
        graph = descend(own, first, threshold)
        more, step = graph.filter(F.col("cos") >= threshold).select("a", "b"), 0
        while more is not None:
            links = more if links is None else links.unionByName(more)
            roots = settle(components(links))
            more, step = leaving(points, graph, roots, 2 * (SETS * (step + 1) + seed), threshold), step + 1
        counts = settle(within(points, roots, threshold))
        share = audit(points, roots, counts, threshold)
        if share is None or share >= RECALL:
            break
    if share is None or share < RECALL:
        logging.getLogger(__name__).warning("near_vectors: share of whole groups %s, all pairs are compared", share)
        roots = settle(components(exact(points, threshold)))
        counts = settle(within(points, roots, threshold))
    per = slim.filter("cls is not null").groupBy("cls").agg(F.min("id").alias("low"), F.count("*").alias("n"))
    per = per.join(roots, F.col("cls") == F.col("node"), "left").select("cls", "low", "n", F.coalesce("root", "cls").alias("root"))
    per = settle(per.join(counts, "cls", "left"))
    low = per.groupBy("root").agg(F.min("low").alias("component_id"))
    table = per.join(low, "root").select(F.col("cls").alias("c"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "component_id")
    out = slim.filter("cls is not null").join(table, F.col("cls") == F.col("c")).select("id", "links", "component_id")
    out = out.unionByName(slim.filter("cls is null").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(key), F.col("links").alias("n_links"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
