"""Importance resampling, filter audit, byte-level BPE: brute force, the library, edge cases."""

import hashlib
import math
import random
import re
import zlib
from itertools import permutations

import duckdb
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import bpe, filter_audit, resampling
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "a", 0) for i, t, lang in rows], SCHEMA)


ODD = [(None, None, None), (1, "", "en"), (1, "", "en"), (2, None, None), (3, " \n\t\x0b", "de"), (4, "word " * 40_000, "en"),
       (5, "Ünïcode ÉCOLE école 中文 12", "fr"), (6, "A#B " * 30, "en"), (None, "A#B " * 30, "en"), (7, "A#B " * 30, None)]


@pytest.fixture(scope="module")
def odd(spark):
    df = docs(spark, ODD)
    for c in ("rank", "SCORE", "weight", "n_features", "r_words", "r_buckets", "part_no", "ids", "bpe_words", "n_tokens", "mask", "key"):
        df = df.withColumn(c, F.lit("clash"))
    return df


# -- resampling ------------------------------------------------------------------------------------

def plain_features(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), [zlib.crc32(g.encode()) % resampling.BUCKETS for g in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def plain_resample(rows, target):
    k, scanned = resampling.BUCKETS, [plain_features(t) for _, t in rows]
    s, t = [0] * k, [0] * k
    for counts, lists in ((s, [f for _, f in scanned]), (t, [plain_features(x)[1] for x in target])):
        for f in lists:
            for b in f:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + k) / ((s[b] + 1) * (sum(t) + k)))) for b in range(k)]
    out = []
    for (i, _), (n_words, f) in zip(rows, scanned):
        w = math.floor(sum(gain[b] for b in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    place = {id(r): n for n, r in enumerate(able[:25 * len(able) // 100], 1)}
    return sorted(((*r[:4], place.get(id(r))) for r in out), key=str)


def test_resample_equals_brute_force(spark):
    rng = random.Random(5)
    vocab = ["alpha", "Beta", "gamma3", "délta", "中文", "x-y", "e.g.", "THE", "of", "a"]
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 60)))) for i in range(300)]
    target = [" ".join(rng.choices(vocab[:4], k=30)) for _ in range(20)] + [None, ""]
    want = plain_resample(rows, target)
    df = docs(spark, [(i, t, "en") for i, t in rows]).repartition(7)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(df, goal).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    assert any(r[4] for r in want)


def test_resample_takes_odd_rows(spark, odd):
    goal = spark.createDataFrame([("word école",)], "text string")
    got = resampling.resample(odd, goal).collect()
    assert len(got) == len(ODD) and "text" not in got[0].asDict() and got[0]["mask"] == "clash"
    want = {i: plain_features(t) for i, t, _ in ODD if i is not None}
    assert {r.doc_id: r.n_features for r in got if r.doc_id is not None} == {i: len(f) for i, (_, f) in want.items()}
    assert sorted(r["rank"] for r in got if r["rank"]) == [1]  # 25 % of the four texts of 20 words
    empty = resampling.resample(odd.limit(0), goal)
    assert empty.count() == 0 and {"n_features", "weight", "score", "rank"} <= set(empty.columns)
    assert resampling.resample(odd, goal.limit(0)).count() == len(ODD)


def test_longer_ngrams_continue_the_hash():
    words, got = resampling.Scanner(3, 1 << 20)(b"One two, three  four")
    grams = ["one", "one two", "one two three", "two", "two three", "two three four", "three", "three four", "four"]
    assert words == 4 and got.tolist() == [zlib.crc32(g.encode()) % (1 << 20) for g in grams]


def test_places_are_global_without_one_task(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id").repartition(5)
    got = resampling.numbered(df, [F.desc("k"), F.col("id")], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 1001))
    assert [(r.k, r.id) for r in got] == sorted(((i % 7, i) for i in range(1000)), key=lambda x: (-x[0], x[1]))


# -- filter audit ----------------------------------------------------------------------------------

def plain_audit(rows, marks):
    texts = [(i, t or "", p or "") for i, t, p in rows]
    kinds = []
    for i, t, p in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": i is not None and any(j is not None and j < i and t == u for j, u, _ in texts)}
        kinds.append((p, {f for f in fails if fails[f]}, *marks.get(i, (0, 0))))
    out = []
    for part in {p for p, *_ in kinds}:
        mine = [k[1:] for k in kinds if k[0] == part]
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                prior = set(order[:step - 1])
                gone = [k for k in mine if f in k[0] and not k[0] & prior]
                out.append((part, "".join(order), step, sum(not k[0] & (prior | {f}) for k in mine), len(gone),
                            sum(f in k[0] and bool(k[0] & prior) for k in mine), sum(k[0] == {f} for k in mine),
                            sum(k[1] for k in gone), sum(k[2] for k in gone), sum(120 // len(k[0]) for k in mine if f in k[0])))
    return sorted(out)


def audit(spark, df, marks, path, files):
    df.repartition(files).write.parquet(path)
    labels = spark.createDataFrame([(i, q, t) for i, (q, t) in marks.items()], "doc_id long, quality int, toxic int")
    return sorted(tuple(r) for r in filter_audit.filter_audit(spark, path, labels).collect())


def test_audit_equals_brute_force_whatever_the_batches(spark, scratch):
    rng = random.Random(2)
    pool = [" ".join(rng.choices("a b c d e f g # A1 %".split() + [f"w{k}" for k in range(300)], k=rng.choice([0, 5, 210, 260])))
            for _ in range(25)]
    rows = [(i, rng.choice(pool), rng.choice(["en", "de", None])) for i in rng.sample(range(1000), 120)]
    rows += rows[:5] + [(None, pool[0], "en"), (2000, None, "fr")]
    marks = {i: (rng.randint(0, 1), rng.randint(0, 1)) for i, _, _ in rows[:80] if i is not None}
    want = plain_audit(rows, marks)
    for files in (1, 9):
        assert audit(spark, docs(spark, rows), marks, f"{scratch}/d{files}", files) == want


def test_audit_joins_and_shuffles_no_text(spark, scratch, monkeypatch):
    """With labels too many to broadcast, whole texts would be shuffled to meet them."""
    spark.createDataFrame([(i, f"text {i % 3} " * 300, "en") for i in range(9)], "doc_id long, text string, lang string").write.parquet(f"{scratch}/d")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(9)], "doc_id long, quality int, toxic int")
    kind, joined = type(labels), []
    join = kind.join
    monkeypatch.setattr(kind, "join", lambda self, *a, **k: (joined.append(self.columns), join(self, *a, **k))[1])
    monkeypatch.setattr(filter_audit, "BATCHES", 2)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = filter_audit.mask_counts(spark, f"{scratch}/d", labels)
        got = sorted((r["mask"], r.good, r.n) for r in counts.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == [(2, 0, 2), (2, 1, 1), (18, 0, 3), (18, 1, 3)]
    assert joined and not any("text" in columns for columns in joined)


def test_smaller_ids_in_later_batches_retract(spark, scratch):
    for n, i in enumerate((9, 5, 7, 1)):  # one file a batch, in order of writing
        docs(spark, [(i, "same text", "en")]).coalesce(1).write.mode("append").parquet(f"{scratch}/d")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    counts = filter_audit.mask_counts(spark, f"{scratch}/d", labels, batches=4)
    assert sorted((r["mask"], r.good, r.n) for r in counts.collect()) == [(1, 1, 1), (17, 0, 3)]


def test_audit_takes_odd_rows(spark, odd, scratch):
    got = audit(spark, odd, {1: (1, 1)}, f"{scratch}/odd", 3)
    assert got == plain_audit(ODD, {1: (1, 1)})
    assert audit(spark, odd.limit(0), {1: (1, 1)}, f"{scratch}/none", 1) == []


# -- byte-level BPE --------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def random_texts(n=250):
    rng = random.Random(3)
    letters = ["a", "b", "e", "n", "t", "é", "ß", "中", "文", "😀", " ", "\n", "\t", " ", " ", "'s", "'ll", "12", "٣", "--", "==",
               "\x1c", "\x85", "́", "ﬃ", "‍", "x", "Ā", "ÿ", "\x00", '"', "\\"]
    return ["".join(rng.choices(letters, k=rng.randint(1, 100))) for _ in range(n)]


@pytest.mark.parametrize("frequent", [0, 2000])
def test_bpe_equals_the_library(spark, library, frequent):
    own = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF_SMALL}/documents.parquet' LIMIT 60").fetchall()]
    texts = [None, "", " ", "a" * 5000, "=" * 3001 + " " * 700 + "x", "\n\n \n a  b", *random_texts(), *own]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = bpe.round_trip(df, RANKS, P.PATTERN, frequent=frequent).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_long_words_fold_alike(spark, library):
    rng = random.Random(8)
    words = ["".join(rng.choices("etaoinshrdlu", k=n)) for n in (30, 63, 64, 65, 66, 90, 200)]
    words += ["ab" * 40, "aab" * 30, "é" * 50, "abcabcab" * 11]
    codec = bpe.Codec(RANKS, P.PATTERN)
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", codec.merge(F.col("w")).alias("ids")).collect()
    for r in got:
        assert r.ids == ",".join(map(str, library.encode_ordinary(r.w)))


def test_bpe_takes_odd_rows_and_decodes(spark, odd):
    codec = bpe.Codec(RANKS, P.PATTERN)
    out = codec.encode(odd, frequent=10)
    assert out.schema["ids"].dataType.simpleString() == "array<int>" and "bpe_words" in out.columns
    got = out.select("text", codec.decode(F.col("ids")).alias("raw")).collect()
    assert len(got) == len(ODD) and all(bytes(r.raw) == (r.text or "").encode() for r in got)
    assert bpe.round_trip(odd.limit(0), RANKS, P.PATTERN).count() == 0
    assert spark.range(1).select(codec.decode(F.lit(None).cast("array<int>")).alias("x")).first().x == b""


def test_bpe_plan_holds_no_words_and_driver_gets_none(spark, monkeypatch):
    """The query once collected frequent words and kept them as a literal of its plan."""
    df = spark.createDataFrame([(i, f"zxqv{i} wvut{i % 7} üqx") for i in range(3000)], "doc_id long, text string")
    kind = type(df)
    monkeypatch.setattr(kind, "collect", lambda self: pytest.fail("rows were collected"))
    out = bpe.round_trip(df, RANKS, P.PATTERN)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "zxqv" not in plan and "Exchange hash" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("remember", [0, 1, 3, 100])
def test_any_memo_gives_the_library_ids(library, remember):
    rng = random.Random(4)
    one = bpe.Merger(RANKS)
    words = ["".join(rng.choices("abenté中ß ", k=rng.randint(1, 90))) for _ in range(300)] + ["é" * 700, "ab" * 2000]
    for w in words * 2:
        assert one.ids(w, remember) == library._core_bpe.encode_single_piece(w.encode())
    assert len(one.memo) <= remember
