"""Mixing sources to target weights (DataFrame expressions only).

The words of a source, its documents in hash order, form one stream that is cut into blocks of a
fixed length. The mix is a sequence of slots, each holding one block:

* Targets: sources in code-point order (null last) weigh 1, 2, 3, repeating, and share all words
  by weight; a target stops at ``max_passes`` times its source and the excess is shared anew by
  weight until none is above.
* A source's slots read whole passes over its blocks, then a last part pass over whole blocks
  with the final slot cut short, so that it takes exactly its target (rounded down).
* The output is a sequence of shards of ``SHARD_SLOTS`` slots. How many slots of each source a shard
  holds is drawn: a pseudorandom permutation deals all slots to shards, which is a multinomial draw
  conditioned on the totals, so that the targets are met. A source's slots are numbered shard by
  shard: the drawn counts say where in its stream each shard goes on.
* Within a pass, slot i reads block perm(i): a pseudorandom permutation per source and pass
  (swap-or-not rounds, which permute any range without search or sort). Blocks join by index.
* Everything follows from the rows and ``seed``: reruns agree.

Null or wordless texts have size 0 and are never taken. Repeated rows are documents of their own
(rows equal in id and size are ordered by their other columns). Null ids are ordered like the
empty text. Empty tables give empty results. Result columns replace columns of the same names.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.plan import with_columns_once
from .common import WORD, fresh, hash60, join_sized, settle, word_list

BLOCK = 128
MAX_PASSES = 3
WEIGHTS = (1, 2, 3)
SHARD_SLOTS = 4096
SEED = 17
ROUNDS = 12
_CHUNK = 1 << 13


def permuted(i: Column, n: Column, key: Column, seed: int) -> Column:
    """A pseudorandom permutation of [0, n) at ``i``: swap-or-not, ``ROUNDS`` rounds.

    A round pairs x with (k - x) mod n and swaps the two or not by a hash bit of the larger."""
    def step(x, r):
        y = F.pmod(F.pmod(F.xxhash64(key, r, F.lit(seed)), n) - x, n)
        return F.when(F.xxhash64(F.greatest(x, y), key, r, F.lit(seed)) % 2 == 0, x).otherwise(y)
    return F.aggregate(F.array(*[F.lit(r) for r in range(ROUNDS)]), i.cast("long"), step)


def targets(sizes: DataFrame, weights=WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size, rank, target) from (source, source_size), one row a source.

    Sources that reach their cap are the first ones in the order of cap per weight; the water
    level is read from running sums in that order. One row a source goes through one task."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = sizes.select("source", "source_size", rank.cast("long").alias("rank"), w.cast("long").alias("w"))
    s = s.withColumn("cap", F.col("source_size") * max_passes)
    order = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("rest", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    s = s.withColumn("rest_w", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    free = F.col("cap") * F.col("rest_w") >= F.col("rest") * F.col("w")
    s = s.withColumn("level", F.struct("rest", "rest_w")).withColumn(
        "at", F.min(F.when(free, F.struct(F.row_number().over(order).alias("n"), "rest", "rest_w"))).over(everything))
    share = F.col("at.rest") * F.col("w") / F.col("at.rest_w")
    target = F.when(F.col("at").isNull() | (F.row_number().over(order) < F.col("at.n")), F.col("cap").cast("double"))
    return s.select("source", "source_size", "rank", target.otherwise(share).alias("target"))


def placed(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> tuple[DataFrame, dict]:
    """``df`` with size, source rank, source size, target and the place of its first word in the source's stream.

    The running sum is split over 4096 hash buckets a source, so a hot source spreads."""
    size, rank, name, total, target, start, bucket, at, base = fresh(
        df, "mix_size", "mix_rank", "mix_source", "mix_total", "mix_target", "mix_start", "mix_bucket", "mix_at", "mix_base")
    n = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")
    sized = df.withColumn(size, n).withColumn(at, hash60(F.col(key)))
    sized = sized.withColumn(bucket, F.shiftright(at, 48))
    cells = settle(sized.groupBy(F.col(source).alias("source"), F.col(bucket).alias("bucket"))
                   .agg(F.sum(size).alias("words")))
    plan = settle(targets(cells.groupBy("source").agg(F.sum("words").alias("source_size"))))
    plan_ = plan.select(F.col("source").alias(name), F.col("rank").alias(rank),
                        F.col("source_size").alias(total), F.col("target").alias(target))
    starts = cells.join(plan.select(F.col("source").alias("s"), "rank"), F.col("source").eqNullSafe(F.col("s")))
    starts = settle(starts.select("rank", "bucket", F.coalesce(F.sum("words").over(
        Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")))
    rank2, bucket2 = fresh(df, "mix_rank2", "mix_bucket2")
    wide = join_sized(sized, plan_, F.col(source).eqNullSafe(F.col(name)))
    wide = join_sized(wide, starts.select(F.col("rank").alias(rank2), F.col("bucket").alias(bucket2),
                                          F.col("base").alias(base)),
                      (F.col(rank) == F.col(rank2)) & (F.col(bucket) == F.col(bucket2)))
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    w = Window.partitionBy(rank, bucket).orderBy(at, key, size, tie).rowsBetween(Window.unboundedPreceding, -1)
    wide = wide.withColumn(start, F.col(base) + F.coalesce(F.sum(size).over(w), F.lit(0)))
    return wide.drop(name, bucket, at, base, rank2, bucket2), {
        "size": size, "rank": rank, "source_size": total, "target": target, "start": start, "plan": plan}


def shard_counts(plan: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(rank, shard, n, first, lower, and the source's numbers): slots of each source drawn for each
    output shard, the source's slots in the shards before it, and the shard's slots of lower ranks.

    Draws are made in chunks that are dealt out first and counted before the shuffle, so that a hot
    source spreads; its running sum is taken within groups of shards, then over the groups."""
    size, n_blocks = F.col("source_size"), F.ceil(F.col("source_size") / block).cast("long")
    whole = F.floor(F.col("target")).cast("long")
    runs = plan.filter("source_size > 0").select(
        "rank", size.alias("size"), n_blocks.alias("blocks"), F.floor(whole / size).cast("long").alias("passes"),
        F.pmod(whole, size).alias("rest"))
    runs = runs.withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / block))
    order = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("slots").over(order), F.lit(0)))
    runs = settle(runs.withColumn("all", F.sum("slots").over(Window.partitionBy())).filter("slots > 0"))
    chunks = runs.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / _CHUNK))))
    parts = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = chunks.repartition(parts, "rank", "chunk").select("rank", "all", F.explode(F.sequence(
        F.col("before") + F.col("chunk") * _CHUNK,
        F.col("before") + F.least((F.col("chunk") + 1) * _CHUNK, F.col("slots")) - 1)).alias("x"))
    place = permuted(F.col("x"), F.col("all"), F.lit(-1).cast("long"), seed)
    drawn = settle(dealt.select("rank", F.floor(place / SHARD_SLOTS).cast("long").alias("shard"))
                   .groupBy("rank", "shard").agg(F.count("*").alias("n")))
    drawn = drawn.withColumn("group", F.floor(F.col("shard") / SHARD_SLOTS).cast("long"))

    def running(keys, by, n):
        return F.coalesce(F.sum(n).over(Window.partitionBy(*keys).orderBy(by).rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))

    groups = drawn.groupBy("rank", "group").agg(F.sum("n").alias("m")).select(
        "rank", "group", running(["rank"], "group", "m").alias("past"))
    drawn = drawn.join(groups, ["rank", "group"]).withColumn(
        "first", F.col("past") + running(["rank", "group"], "shard", "n"))
    drawn = drawn.withColumn("lower", running(["shard"], "rank", "n"))  # at most a shard's slots
    return drawn.select("rank", "shard", "n", "first", "lower").join(runs.drop("slots", "before"), "rank")


def slots(plan: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(rank, pass, slot, block, words, place, shard): every slot of the mix, whole words of its block's start.

    Within a shard places are dealt by a permutation of its own."""
    size = F.col("size")
    one = shard_counts(plan, block, seed).withColumn("slot", F.explode(F.sequence(  # at most a shard's slots
        F.col("first"), F.col("first") + F.col("n") - 1)))
    done = F.floor(F.col("slot") / F.col("blocks")).cast("long")
    i = F.col("slot") - done * F.col("blocks")
    part = done == F.col("passes")  # the last, part pass: whole blocks only, then what is left of the rest
    full = F.floor(size / block).cast("long")
    one = with_columns_once(one, {
        "pass": done, "i": i, "key": F.col("rank") * 64 + done,
        "tail": part & (i >= full), "span": F.greatest(F.when(part, full).otherwise(F.col("blocks")), F.lit(1)),
        "words": F.when(part, F.least(F.lit(block), F.col("rest") - i * block)).otherwise(F.lit(block)).cast("long")})
    read = F.when(F.col("tail"), F.col("i")).otherwise(permuted(F.col("i"), F.col("span"), F.col("key"), seed))
    start = F.col("shard") * SHARD_SLOTS
    place = start + permuted(F.col("lower") + F.col("slot") - F.col("first"),
                             F.least(F.lit(SHARD_SLOTS).cast("long"), F.col("all") - start), -1 - F.col("shard"), seed)
    return one.select("rank", "pass", "slot", read.alias("block"), "words", place.alias("place"), "shard")


def overlaps(wide: DataFrame, at: dict, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(rank, start, lo, pass, words, shard): what each slot takes of each document it meets.

    Documents and slots are joined by (source, block index); a document is known by its place."""
    docs = wide.filter(F.col(at["size"]) > 0).select(
        F.col(at["rank"]).alias("rank"), F.col(at["start"]).alias("start"), F.col(at["size"]).alias("size"))
    end = F.col("start") + F.col("size")
    pieces = docs.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / block).cast("long"), F.floor((end - 1) / block).cast("long"))))
    lo = F.greatest(F.col("start"), F.col("block") * block)
    hi = F.least(end, (F.col("block") + 1) * block)
    # slots grow with the words, though they are made from a small table: never a broadcast
    met = pieces.join(slots(at["plan"], block, seed).hint("merge"), ["rank", "block"])
    words = F.least(hi, F.col("block") * block + F.col("words")) - lo
    return met.select("rank", "start", (lo - F.col("start")).alias("lo"), "pass", "shard",
                      words.alias("words")).filter("words > 0")


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(key, size, source_size, target, taken, first_shard, last_shard): one row for each row of ``df``;
    the lowest and highest output shard that holds words of it (null: none)."""
    slim = df.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(source).alias("source"))
    wide, at = placed(slim, "id", "text", "source")
    wide = settle(wide.select("id", *[F.col(at[c]).alias(c) for c in ("size", "rank", "source_size", "target", "start")]))
    own = {c: c for c in ("size", "rank", "source_size", "target", "start")} | {"plan": at["plan"]}
    taken = overlaps(wide, own, block, seed).groupBy("rank", "start").agg(
        F.sum("words").alias("taken"), F.min("shard").alias("first_shard"), F.max("shard").alias("last_shard"))
    met = wide.filter("size > 0").join(taken, ["rank", "start"], "left").unionByName(
        wide.filter("size = 0").withColumn("taken", F.lit(0).cast("long")), allowMissingColumns=True)
    return met.select(F.col("id").alias(key), "size", "source_size", "target",
                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_shard", "last_shard")


def mixed_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                    block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The mix as rows of ``df``'s columns: one row per document and pass that takes words of it.

    A pass that takes all words keeps the text as it is; a pass that takes some keeps those,
    joined by spaces."""
    wide, at = placed(df, key, text, source)
    segs, r2, s2 = fresh(wide, "mix_segments", "mix_rank_", "mix_start_")
    wide = settle(wide)
    runs = overlaps(wide, at, block, seed).groupBy("rank", "start", "pass").agg(
        F.sort_array(F.collect_list(F.struct("lo", "words"))).alias("segments"))
    runs = runs.select(F.col("rank").alias(r2), F.col("start").alias(s2), F.col("segments").alias(segs))
    met = wide.filter(F.col(at["size"]) > 0).join(
        runs, (F.col(at["rank"]) == F.col(r2)) & (F.col(at["start"]) == F.col(s2)))
    taken = F.aggregate(segs, F.lit(0).cast("long"), lambda a, s: a + s["words"])
    some = F.transform(F.array(word_list(F.col(text))), lambda w: F.array_join(F.flatten(F.transform(
        segs, lambda s: F.slice(w, (s["lo"] + 1).cast("int"), s["words"].cast("int")))), " "))[0]
    new = F.when(taken == F.col(at["size"]), F.col(text)).otherwise(some)
    return met.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in df.columns])
