"""Line dedup, sharding, quality rules, mixing: edge cases and brute force."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import line_dedup as lines
from pulsegrid.llm import mixing, quality, sharding
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows, clashing columns."""
    long = "\n".join(f"line {i} of a very long text" for i in range(20_000))
    rows = [(None, None, None), (1, "", "a"), (1, "", "a"), (2, None, "a"), (3, " \n\t", None), (4, long, "b"),
            (5, "menu\nfirst", "a"), (6, "menu \nsecond", "a"), (7, "menu\nmenu\nthird", "a"), (8, "a b c a b c", "b")]
    df = docs(spark, rows)
    for c in ("n_words", "kept", "part", "n_lines", "size", "h", "words", "cell", "component_id", "score"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def test_lines_over_the_ratio_go(spark):
    rows = [(i, f"menu\nbody {i}\n  menu  ", "a") for i in range(6)] + [(9, "menu\nbody", "b")]
    got = {r.doc_id: r for r in lines.line_dedup(docs(spark, rows), min_pages=5).collect()}
    assert got[0].text == "body 0" and got[0].n_dropped == 2 and got[0].n_lines == 3
    assert got[9].text == "menu\nbody" and got[9].n_dropped == 0


def test_line_counts_once_a_page(spark):
    rows = [(0, "x\nx\nx\nx\nx\nx", "a")] + [(i, f"y{i}", "a") for i in range(1, 9)]
    assert lines.line_dedup(docs(spark, rows)).agg(F.sum("n_dropped")).first()[0] == 0


def test_long_drop_lists_are_not_broadcast(spark):
    rows = [(i, "\n".join(f"menu {k}" for k in range(3000)) + f"\nbody {i}", "a") for i in range(6)]
    wide = docs(spark, rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for most, hint in (("20000", False), ("40000", True)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
            d = lines.line_dedup(wide)
            assert ("strategy=broadcast" in d._jdf.queryExecution().logical().toString()) == hint
            assert {r.doc_id: r.text for r in d.collect()} == {i: f"body {i}" for i in range(6)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_operators_take_odd_rows(spark, odd):
    n = odd.count()
    d = lines.line_dedup(odd, min_pages=3)
    assert d.count() == n and d.filter("text is null").count() == 2
    assert {r.doc_id: r.text for r in d.collect()}[5] == "first"
    q = quality.quality(odd)
    assert q.count() == n and q.filter("n_words = 0 and base_failed and not kept").count() == 5
    s = sharding.shard(odd, limit=1000)
    assert s.count() == n and s.agg(F.sum("n_bytes")).first()[0] == odd.agg(
        F.sum(F.octet_length("text"))).first()[0]
    m = mixing.mix(odd)
    assert m.count() == n and m.filter("size = 0 and taken <> 0").count() == 0
    assert mixing.mixed_documents(odd).columns == odd.columns


@pytest.mark.parametrize("op", [lines.line_dedup, quality.quality, sharding.shard, mixing.mix, mixing.mixed_documents])
def test_empty_tables(spark, op):
    assert op(docs(spark, [])).count() == 0


def test_shards_fit_and_split_only_when_over(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    limit = 20_000
    s = sharding.shard(df, limit=limit)
    by = s.groupBy("shard_depth", "shard_prefix", "part").agg(
        F.sum("n_bytes").alias("b"), F.count("*").alias("n"), F.max("shard_bytes").alias("told")).collect()
    assert all(r.b == r.told for r in by)
    assert all(r.b <= limit or r.n == 1 for r in by)
    whole = s.select("n_bytes", sharding.hash60(F.col("doc_id")).alias("h")).collect()
    for r in by:  # the parent bucket was over the limit
        if r.shard_depth:
            up = r.shard_depth - 1
            assert sum(x.n_bytes for x in whole if x.h >> (60 - up) == r.shard_prefix >> 1) > limit


def test_repeated_keys_are_dealt_into_parts(spark):
    df = spark.range(500).select(F.lit(7).cast("long").alias("doc_id"), F.lit("x" * 100).alias("text"))
    by = sharding.shard(df, limit=2000).groupBy("part").agg(F.sum("n_bytes").alias("b")).collect()
    assert sum(r.b for r in by) == 50_000 and all(r.b <= 2000 for r in by)


def _base(text):
    text = text or ""
    w = WORD.findall(text)
    g = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = Counter(g)
    cover = {i + k for i, x in enumerate(g) if c[x] > 1 for k in range(3)}
    ls = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(map(text.count, "#*$%&|<>")), len(ls) - len(set(ls)), len(cover)


def test_base_features_against_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = docs(spark, [(-1, "a b c a b c a", "s"), (-2, "x\x0by\x0cz x y z\n\nx\n x \nx", "s"), (-3, None, "s"),
                         (-4, "é é é é | # ² 🙂 🙂 🙂 🙂", "s"), (-5, "a a a", "s")])
    both = df.select("doc_id", "text", "lang").unionByName(extra.select("doc_id", "text", "lang"))
    texts = {r.doc_id: r.text for r in both.collect()}
    for r in quality.quality(both).collect():
        want = _base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_divergence_keeps_good_and_drops_junk(spark):
    d = "/root/testdata/sf0.01"
    q = quality.quality(spark.read.parquet(f"{d}/documents.parquet")).filter("not base_failed")
    got = q.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r.quality: r.kept for r in got}
    assert share[1] == 1.0 and share.get(0, 0) < 0.1


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 10, 257, 1000):
        p = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3).cast("long"), 1)).collect()
        assert sorted(x[0] for x in p) == list(range(n))


def _water(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        target = {s: most * sizes[s] if s in capped else rest * w[s] / sum(w[x] for x in free) for s in names}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


def test_targets_against_plain_water_filling(spark):
    for sizes in ({"a": 100, "b": 10, "c": 1, "d": 500, None: 3}, {"a": 5}, {"b": 0, "a": 7, "ä": 9, "Z": 1}):
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        assert got == pytest.approx(_water(sizes))


def test_mix_meets_targets_and_agrees_with_reruns(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = mixing.mix(df).join(df.select("doc_id", "source"), "doc_id")
    first, again = sorted(map(tuple, rows.collect())), sorted(map(tuple, rows.repartition(3).collect()))
    assert first == again
    assert rows.filter("taken > 3 * size").count() == 0
    for r in rows.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("want")).collect():
        assert r.t == int(r.want)
    texts = mixing.mixed_documents(df)
    words = texts.groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD))).alias("w"))
    off = rows.join(words, "doc_id", "left").filter(F.coalesce("w", F.lit(0)) != F.col("taken"))
    assert off.count() == 0


def test_slots_are_permutations(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    _, at = mixing.placed(df)
    s = mixing.slots(at["plan"]).toPandas()
    assert sorted(s.place) == list(range(len(s)))
    assert not s.duplicated(["rank", "pass", "block"]).any()


def test_shards_draw_the_slots_that_are_read(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 16)
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    _, at = mixing.placed(df)
    s = mixing.slots(at["plan"]).toPandas()
    assert sorted(s.place) == list(range(len(s))) and (s.place // 16 == s.shard).all()
    for _, one in s.sort_values(["shard", "slot"]).groupby("rank"):  # numbered shard by shard
        assert list(one.slot) == list(range(len(one)))
    # drawn counts scatter round the shares, and full shards hold all their slots
    full = s[s.shard < s.shard.max()]
    assert (full.groupby("shard").size() == 16).all()
    share = s.groupby("rank").size() / len(s)
    counts = full.groupby(["shard", "rank"]).size().unstack(fill_value=0)
    assert abs(counts.mean() / 16 - share).max() < 0.05 and counts.var().max() > 0
    got = mixing.mix(df)
    assert got.filter("(taken > 0) <> (first_shard is not null) or first_shard > last_shard").count() == 0
    assert got.agg(F.max("last_shard")).first()[0] <= s.shard.max()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "shard" in plan


def test_mix_of_empty_and_wordless_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], empty.schema)
    assert mixing.mix(empty).count() == 0
    assert {(r.doc_id, r.taken, r.first_shard) for r in mixing.mix(blank).collect()} == {(1, 0, None), (2, 0, None)}
