"""Importance resampling towards a target distribution of hashed n-grams.

* Scanning: A-Z becomes lower case, every run of separators one space, and one overlapped regex scan
  (a look-behind for the word's start, one group a further word) gives the spans of all n-grams
  that begin at each word; their bytes are hashed by CRC-32 (a longer n-gram continues the CRC of the
  shorter). Words are runs of 0-9, a-z and everything beyond ASCII.
* A text's buckets are kept as two bytes a feature (or four, beyond 65,536 buckets) in a table of
  the shared folder, so that texts are scanned once. Bucket counts are added up in each task, then
  over all rows; gains are one number a bucket.
* Draw: Gumbel noise from a checksum of the id makes the draw a ranking; the ranking is a range
  sort whose parts are numbered with the counts of the parts before them, never one task.

* Null and empty texts have no features: weight 0. Null ids draw the noise of the empty text; they
  rank behind other ids among ties. Repeated rows each count, and each can be drawn; ties beyond the
  id are broken by an arbitrary order. An empty table gives an empty result; an empty target
  gives gains from smoothing alone.
* Texts are scanned whole, one at a time. Result columns replace columns of the same names; other
  columns but the text are kept.
"""

from __future__ import annotations

import math
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, scratch_path, settle

NGRAMS = 2
BUCKETS = 10_000
SEED = 7
MIN_WORDS = 20
PERCENT = 25
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                 for c in range(256))


def _pattern(n: int) -> bytes:
    """A word at its start, and up to ``n`` - 1 following words in nested optional groups."""
    tail = b""
    for _ in range(n - 1):
        tail = rb"(?:( [^ ]++)" + tail + rb")?"
    return rb"(?<![^ ])([^ ]++)" + tail


class Scanner:
    """Number of words and feature buckets of a text."""

    def __init__(self, n: int, buckets: int):
        import regex

        self.find, self.n, self.buckets = regex.compile(_pattern(n)).finditer, n, buckets

    def __call__(self, raw: bytes | None):
        import numpy as np

        words = (raw or b"").translate(_LETTERS).split()
        groups, crc, out = tuple(range(1, self.n + 1)), zlib.crc32, []
        for m in self.find(b" ".join(words), overlapped=True):
            code = 0
            for part in m.group(*groups) if self.n > 1 else (m[1],):
                if part is None:
                    break
                code = crc(part, code)
                out.append(code)
        return len(words), np.array(out, dtype=np.uint32) % np.uint32(self.buckets)


def scan(df: DataFrame, text: str = "text", n: int = NGRAMS, buckets: int = BUCKETS) -> tuple[DataFrame, dict[str, str]]:
    """``df`` without its text, with number of words and bucket list under free names, in a table of
    the shared folder."""
    names = fresh(df, "r_words", "r_buckets")
    kind = "uint16" if buckets <= 1 << 16 else "uint32"
    keep = [f for f in df.schema.fields if f.name != text]

    def scanned(batches):
        one = Scanner(n, buckets)
        for batch in batches:
            raw = batch.column(batch.num_columns - 1).cast(pa.binary())
            got = [one(x.as_py()) for x in raw]
            made = [pa.array([w for w, _ in got], pa.int64()), pa.array([b.astype(kind).tobytes() for _, b in got], pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], *names])

    # columns travel under numbered names: names that differ in case only are told apart
    schema = T.StructType([*[T.StructField(f"c{i}", f.dataType) for i, f in enumerate(keep)],
                           T.StructField(names[0], T.LongType()), T.StructField(names[1], T.BinaryType())])
    slim = df.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(keep)], F.col(f"`{text}`").alias("t"))
    path = scratch_path(df.sparkSession, "ngram-buckets")
    slim.mapInArrow(scanned, schema).write.parquet(path)
    rows = df.sparkSession.read.schema(schema).parquet(path)
    return (rows.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(keep)], *names),
            {"words": names[0], "buckets": names[1], "kind": kind})


def bucket_counts(rows: DataFrame, at: dict[str, str], buckets: int = BUCKETS) -> list[int]:
    """Features in each bucket over all rows: added up a task, then a bucket (one number a bucket
    reaches the driver)."""
    kind = at["kind"]

    def counted(batches):
        import numpy as np

        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.bincount(np.frombuffer(x.as_py(), dtype=kind), minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(total)], ["bucket", "n"])

    sums = rows.select(at["buckets"]).mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    got = dict(sums.filter("n > 0").collect())
    return [got.get(i, 0) for i in range(buckets)]


def gains(target: list[int], corpus: list[int]) -> list[int]:
    """Thousandths of the log ratio of smoothed bucket shares, rounded down."""
    k, t_all, s_all = len(corpus), sum(target), sum(corpus)
    return [math.floor(1000 * math.log((float(t + 1) * float(s_all + k)) / (float(s + 1) * float(t_all + k))))
            for t, s in zip(target, corpus)]


def weights(rows: DataFrame, at: dict[str, str], gain: list[int]) -> DataFrame:
    """``rows`` with n_features and weight instead of their bucket lists."""
    keep = [f for f in rows.schema.fields if f.name != at["buckets"]]
    kind = at["kind"]

    def weighed(batches):
        import numpy as np

        table = np.array(gain, dtype=np.int64)
        for batch in batches:
            found = [np.frombuffer(x.as_py(), dtype=kind) for x in batch.column(batch.num_columns - 1)]
            made = [pa.array([len(b) for b in found], pa.int64()),
                    pa.array([int(table[b].sum()) // len(b) if len(b) else 0 for b in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], "n", "w"])

    schema = T.StructType([*[T.StructField(f"c{i}", f.dataType) for i, f in enumerate(keep)],
                           T.StructField("n", T.LongType()), T.StructField("w", T.LongType())])
    slim = rows.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(keep)], F.col(at["buckets"]).alias("b"))
    out = slim.mapInArrow(weighed, schema)
    made = ("n_features", "weight")
    return out.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(keep) if f.name.lower() not in made],
                      F.col("n").alias("n_features"), F.col("w").alias("weight"))


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` with the number (from 1) of every row in the given order in column ``name``.

    Rows are range-sorted and settled; a part's numbers begin after the rows of the parts before it,
    whose counts (one a part) are all that reaches the driver."""
    part, place = fresh(df, "part_no", "place")
    laid = settle(df.orderBy(*order).select("*", F.spark_partition_id().alias(part), F.monotonically_increasing_id().alias(place)))
    before, total = [0, 0], 0
    for p, size in sorted(laid.groupBy(part).count().collect()):
        before += [p, total]
        total += size
    starts = F.map_from_arrays(F.from_json(F.lit(str(before[2::2] or [0])), "array<int>"),
                               F.from_json(F.lit(str(before[3::2] or [0])), "array<bigint>"))
    # monotonically_increasing_id: the part's number in the upper bits, its row's place in the lower 33
    number = F.try_element_at(starts, F.col(part)) + F.col(place).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return laid.withColumn(name, number.cast("long")).drop(part, place)


def resample(df: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", id_col: str = "doc_id",
             n: int = NGRAMS, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT,
             seed: int = SEED) -> DataFrame:
    """Every row of ``df`` (without its text) with n_features, weight, score and rank; ``percent`` of
    the rows with ``min_words`` words are drawn, the others have a null rank."""
    rows, at = scan(df, text, n, buckets)
    wanted, wanted_at = scan(target.select(target_text), target_text, n, buckets)
    gain = gains(bucket_counts(wanted, wanted_at, buckets), bucket_counts(rows, at, buckets))
    out = weights(rows, at, gain)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256),
                           1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    keep = [f"`{c}`" for c in out.columns if c.lower() not in ("score", "rank")]
    out = settle(out.select(*keep, (F.col("weight") + noise).cast("long").alias("score")))
    long_enough = F.col(at["words"]) >= min_words
    n_drawn = out.filter(long_enough).count() * percent // 100
    order = numbered(out.filter(long_enough), [F.desc("score"), F.col(f"`{id_col}`").asc_nulls_last()], "rank")
    order = order.withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")))
    return order.unionByName(out.filter(~long_enough).withColumn("rank", F.lit(None).cast("long"))).drop(at["words"])
