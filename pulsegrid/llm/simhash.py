"""SimHash near-dedup with bit-sliced comparison.

Fingerprints: words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lowered, shingles of ``shingle``
words joined by spaces (repeats included; fewer words: the whole sequence), each hashed by XXH64
(seed 42). A fingerprint bit is 1 if it is set in over half of the hashes. A text without words
(null, empty or blank) has fingerprint zero and links like any other.

Links: fingerprints at ``radius`` or fewer differing bits. Equal fingerprints are first merged, so
copies cost nothing further. Candidates are exact: 64 bits in ``radius + 2`` bands, two fingerprints
within the radius agree in at least two whole bands, so every pair of bands is a bucket key. In a
bucket the fingerprints are stored as bit planes, 64 lanes to a machine word; distances to a query
are counted for 64 lanes at once by carry-save adders, band bits that agree are skipped, and a
block whose 64 lanes have all passed the radius is abandoned. Buckets over ``SPLIT`` rows are dealt
into cells, and cell pairs are compared by separate tasks, so no bucket is one task's work and
none is cut. A comparison gives a spanning forest of its links, not all pairs; the components are
those of all links.

Null ids take part, but name no component while another row can. Rows that share an id are
documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import components, fresh, settle

SHINGLE, RADIUS = 3, 3
SPLIT = 4096


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number."""
    import numpy as np
    import xxhash

    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    n = len(words)
    if n < shingle:
        hashes = [h(b" ".join(words), 42)]
    else:
        body, ends, at = b" ".join(words), [], -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        starts = [0, *[e + 1 for e in ends]]
        hashes = [h(body[a:b], 42) for a, b in zip(starts, ends[shingle - 1:])]
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at:at + (1 << 16)], "<u8")
        count += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * count > len(hashes)).astype("u1")
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprints as signed longs (the same 64 bits)."""
    import pandas as pd

    def many(texts):
        import numpy as np
        import pandas as pd

        values = [fingerprint_of(t, shingle) for t in texts]
        return pd.Series(np.array(values, "u8").view("i8"), dtype="int64")

    many.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return pandas_udf(many, "long")(F.coalesce(text, F.lit("")))


def bands(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of radius + 2 bands over 64 bits."""
    n = radius + 2
    cuts = [round(i * 64 / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def keyed(fps: DataFrame, radius: int) -> DataFrame:
    """(table, key, fp): one row for each pair of bands."""
    def band(at, width):
        return F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1))
    cells = bands(radius)
    keys = [F.struct(F.lit(t).alias("table"), (F.shiftleft(band(*cells[i]), cells[j][1]) + band(*cells[j])).alias("key"))
            for t, (i, j) in enumerate(combinations(range(len(cells)), 2))]
    return fps.select("fp", F.inline(F.array(*keys)))


def near(left, right, radius: int, order: list[int]):
    """For each of ``left`` the places in ``right`` within the radius: two index arrays.

    ``right`` is transposed into bit planes of 64-lane words. The counters ones and twos and the
    overflow word are updated plane by plane with carry-save logic; (query, word) blocks whose
    overflow covers all lanes are dropped every few planes."""
    import numpy as np

    lanes = -(-len(right) // 64) * 64
    rows = np.zeros((lanes, 8), "u1")
    rows[:len(right)] = right.view("u1").reshape(-1, 8)
    bits = np.unpackbits(rows, axis=1, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")).view("<u8")  # 64 x words
    n_bits = (radius + 1).bit_length()
    hits_q, hits_r = [], []
    step = max(1, (1 << 18) // planes.shape[1])
    for at in range(0, len(left), step):
        part = left[at:at + step]
        q, w = (x.ravel() for x in np.indices((len(part), planes.shape[1])))
        count = [np.zeros(len(q), "u8") for _ in range(n_bits)]
        over = np.zeros(len(q), "u8")
        for done, b in enumerate(order):
            flip = np.where((part >> np.uint64(b)) & np.uint64(1), ~np.uint64(0), np.uint64(0))
            carry = planes[b][w] ^ flip[q]
            for k in range(n_bits):
                carry, count[k] = carry & count[k], carry ^ count[k]
            over |= carry
            if done % 8 == 7 or done == len(order) - 1:
                alive = ~(over | _above(count, radius))
                keep = alive != 0
                if not keep.all():
                    q, w, over, alive = q[keep], w[keep], over[keep], alive[keep]
                    count = [c[keep] for c in count]
                if not len(q):
                    break
        if len(q):
            found = np.unpackbits(alive.view("u1").reshape(-1, 8), axis=1, bitorder="little")
            block, lane = np.nonzero(found)
            r = w[block] * 64 + lane
            real = r < len(right)
            hits_q.append(q[block][real] + at)
            hits_r.append(r[real])
    none = np.zeros(0, "i8")
    return (np.concatenate(hits_q), np.concatenate(hits_r)) if hits_q else (none, none)


def _above(count, radius: int):
    """Lanes whose counter exceeds the radius, by comparing bit by bit."""
    import numpy as np

    more, same = np.zeros_like(count[0]), ~np.zeros_like(count[0])
    for k in reversed(range(len(count))):
        if radius >> k & 1:
            same &= count[k]
        else:
            more |= same & count[k]
            same &= ~count[k]
    return more


def _forest(left, right, radius: int, skip: set[int]):
    """Edges (a, b) of a spanning forest over the links between two arrays of fingerprints."""
    import numpy as np

    order = [b for b in range(64) if b not in skip]
    a, b = near(left, right, radius, order)
    x, y = left[a], right[b]
    apart = x != y
    parent: dict[int, int] = {}

    def root(v):
        while parent.setdefault(v, v) != v:
            parent[v] = v = parent[parent[v]]
        return v
    edges = []
    for u, v in zip(np.maximum(x, y)[apart].tolist(), np.minimum(x, y)[apart].tolist()):
        ru, rv = root(u), root(v)
        if ru != rv:
            parent[ru] = rv
            edges.append((u, v))
    return edges


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that are within the radius."""
    rows = keyed(fps, radius)
    full = rows.groupBy("table", "key").agg(F.count("*").alias("n")).filter("n > 1")
    rows = rows.join(full, ["table", "key"]).withColumn("cells", F.ceil(F.col("n") / SPLIT).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("cells")).cast("int")
    met = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    met = met.select("table", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     (F.col("own") <= F.col("other")).alias("is_left"), "fp")
    pairs = list(combinations(range(radius + 2), 2))
    spans = bands(radius)

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        def done(key, parts):
            table, _, i, j = key
            skip = {b for k in pairs[table] for b in range(spans[k][0], sum(spans[k]))}
            left = np.array(parts[True], "i8").view("u8")
            right = left if i == j else np.array(parts[False], "i8").view("u8")
            return _forest(left, right, radius, skip)

        cur, parts, edges = None, {True: [], False: []}, []
        for batch in batches:
            for *key, is_left, fp in zip(*[c.to_pylist() for c in batch.columns]):
                if key != cur:
                    if cur is not None:
                        edges += done(cur, parts)
                    cur, parts = key, {True: [], False: []}
                parts[is_left].append(fp)
            if len(edges) > 50_000:
                yield _edges(pa, edges)
                edges = []
        if cur is not None:
            edges += done(cur, parts)
        yield _edges(pa, edges)

    group = ["table", "key", "i", "j"]
    # the cost is comparisons, not bytes: a set number keeps small rows from being laid into one task
    parts = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return met.repartition(parts, *group).sortWithinPartitions(*group).mapInArrow(compare, "a long, b long")


def _edges(pa, edges):
    import numpy as np

    both = np.array(edges, "u8").reshape(-1, 2).view("i8")
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _rooted(marked: DataFrame, fp: str, radius: int) -> DataFrame:
    """(fp, root): the component of each distinct fingerprint, named by one of its fingerprints."""
    distinct = settle(marked.select(F.col(fp).alias("fp")).distinct())
    roots = components(links(distinct, radius))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash(df: DataFrame, key: str = "doc_id", text: str = "text",
            shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(key, fingerprint, component_id) of every row; component_id is the smallest id reachable."""
    slim = settle(df.select(F.col(key).alias("id"), fingerprints(F.col(text), shingle).alias("fp")))
    roots = _rooted(slim, "fp", radius)
    per_fp = slim.groupBy("fp").agg(F.min("id").alias("low"))
    named = settle(per_fp.join(roots, "fp"))
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    table = named.select("fp", "root").join(low, "root").select(F.col("fp").alias("f"), "component_id")
    out = slim.join(table, F.col("fp") == F.col("f"), "left")
    return out.select(F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text",
                         shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component: that of the smallest id, then of the smallest row hash."""
    fp, h, root, low, least = fresh(df, "sim_fp", "sim_hash", "sim_root", "sim_low", "sim_least")
    marked = df.withColumn(fp, fingerprints(F.col(text), shingle)).withColumn(
        h, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    slim = settle(marked.select(F.col(key).alias("id"), F.col(fp).alias("fp"), F.col(h).alias("h")))
    roots = settle(_rooted(slim, "fp", radius))
    # the smallest (id, row hash) of each component, in two partial aggregates; null ids come last
    ids = slim.groupBy("fp", "id").agg(F.min("h").alias("h")).join(roots, "fp")
    lows = ids.groupBy("root").agg(F.min("id").alias("low")).withColumnRenamed("root", "r")
    chosen = ids.join(lows, (F.col("root") == F.col("r")) & F.col("id").eqNullSafe(F.col("low"))).groupBy("root").agg(
        F.first("low").alias("low"), F.min("h").alias("h"))
    chosen = settle(chosen.select(F.col("h").alias(least)).distinct())
    kept = df.withColumn(h, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).join(
        chosen, F.col(h) == F.col(least), "left_semi")
    return kept.dropDuplicates([h]).select(*[f"`{c}`" for c in df.columns])
