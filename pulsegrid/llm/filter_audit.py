"""Filter interaction audit by incremental retraction.

All files of the table are read as available-now micro-batches (at most ``BATCHES`` of equal file
counts). In each batch a task gives every text its failure mask (one bit a filter, the texts read
as bytes) and its SHA-256; only these, the id and the part meet the labels, so that no text is shuffled
whatever the size of the labels. A task then combines equal texts: the row of the smallest id stands
for them, the others fail the duplicate filter for certain and are only counted. State keyed by the text's SHA-256 keeps the
smallest id seen and what was counted for it; texts share a state entry by hash bucket (about 20,000
texts each, so that buckets grow in number and not in size). A smaller id in a later batch (or another
task) retracts the earlier row's mask from the part counters and counts it again with the duplicate bit.
Counter changes are appended to a table of the shared folder (exactly once, by the file sink's log);
their sums are the number of documents for each (part, mask, labels), from which every order's
counts follow. A hot text is one row a task in the state's shuffle.

Filters, in bit order A to E: under 200 words; under half the words distinct; over 3 % of the
characters A-Z; any of ``#$%&*|``; identical to the text of a smaller id.

* Null texts are empty, and equal to each other. Texts are read whole.
* Null ids: neither smaller nor larger than any id, so a row without an id never fails E and makes
  no other row fail it. Rows that repeat an id and its text do not fail E against each other.
* A null part is the empty string. Labels of a repeated id: 1 if any row has 1.
* An empty table gives an empty result. The table's other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_path

FILTERS = "ABCDE"
MIN_WORDS = 200
BATCHES = 4
_SYMBOLS = b"#$%&*|"
_UPPER = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))  # bytes that begin no character
_DUPLICATE = 1 << 4
_HELD = 50_000  # distinct texts a task combines before it passes them on
_BUCKET_TEXTS = 20_000  # texts a bucket of the state holds, about
_MARK = "id bigint, part string, key binary, mask int"
_ROW = "bucket int, key binary, id bigint, part string, good int, toxic int, mask int, n bigint, sure boolean"
_CHANGE = "part string, mask int, good int, toxic int, n bigint"
_COUNTER = ["part", "mask", "good", "toxic"]
_HELD_COLUMNS = ["key", "id", *_COUNTER, "n"]


def text_mask(raw: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = raw.split()  # bytes split at the space and 0x09-0x0D only
    chars = len(raw) - (0 if raw.isascii() else len(raw) - len(raw.translate(None, _CONTINUED)))
    upper = len(raw) - len(raw.translate(None, _UPPER))
    return (len(words) < MIN_WORDS) + 2 * (100 * len(set(words)) < 50 * len(words)) + 4 * (100 * upper > 3 * chars) \
        + 8 * (len(raw.translate(None, _SYMBOLS)) != len(raw))


def _bucket(key: bytes, n: int) -> int:
    return int.from_bytes(key[:4], "big") % n


def _marked(batches: Iterable[pa.RecordBatch]):
    """Key and mask of each row's text, without the text."""
    for batch in batches:
        raws = [text.as_py() or b"" for text in batch.column(2).cast(pa.binary())]
        keys = pa.array([hashlib.sha256(raw).digest() for raw in raws], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), keys, pa.array(map(text_mask, raws), pa.int32())],
                                         [c.split()[0] for c in _MARK.split(", ")])


def _combined(batches: Iterable[pa.RecordBatch], n_buckets: int):
    """One row for each text, smallest id and its labels, and counts of the rows that surely repeat it."""
    texts: dict[bytes, list] = {}  # text -> smallest id, mask, rows of that id by (part, good, toxic)
    sure: Counter = Counter()      # rows by (part, good, toxic, mask)

    def rows():
        out = [(_bucket(key, n_buckets), key, i, *labels, mask, n, False)
               for key, (i, mask, own) in texts.items() for labels, n in own.items()]
        out += [(_bucket(hashlib.sha256(k[0].encode()).digest(), n_buckets), b"", 0, *k, n, True) for k, n in sure.items()]
        texts.clear()
        sure.clear()
        kinds = [pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()]
        cols = zip(*out) if out else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          [c.split()[0] for c in _ROW.split(", ")])

    for batch in batches:
        for i, part, good, toxic, key, mask in zip(*(batch.column(c).to_pylist() for c in range(6))):
            labels = (part, good, toxic)
            if i is None:
                sure[(*labels, mask)] += 1
                continue
            held = texts.get(key)
            if held is None:
                texts[key] = [i, mask, Counter({labels: 1})]
            elif i == held[0]:
                held[2][labels] += 1
            elif i > held[0]:
                sure[(*labels, held[1] | _DUPLICATE)] += 1
            else:
                for k, n in held[2].items():
                    sure[(*k, held[1] | _DUPLICATE)] += n
                texts[key] = [i, held[1], Counter({labels: 1})]
        if len(texts) >= _HELD:
            yield rows()
    yield rows()


def _changes(key, frames, state):
    """Counter changes by one bucket's rows: of each text the rows of the smallest id count without
    the duplicate bit, and what counted so for a larger id before is retracted and counted with it."""
    new = pd.concat(list(frames))
    held = pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists else new.iloc[:0][_HELD_COLUMNS]
    texts = pd.concat([held, new.loc[~new.sure, _HELD_COLUMNS]])
    texts = texts.groupby(["key", "id", *_COUNTER], as_index=False).n.sum()
    later = texts.id > texts.groupby("key").id.transform("min")
    kept = texts[~later]
    texts = texts.assign(mask=texts["mask"].where(~later, texts["mask"] | _DUPLICATE))
    parts = [texts[[*_COUNTER, "n"]], new.loc[new.sure, [*_COUNTER, "n"]], held[[*_COUNTER, "n"]].assign(n=-held.n)]
    out = pd.concat(parts).groupby(_COUNTER, as_index=False).n.sum()
    table, sink = pa.Table.from_pandas(kept, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    state.update((sink.getvalue().to_pybytes(),))
    yield out[out.n != 0]


def _pattern(path: str) -> str:
    """A glob pattern of exactly this path: the file source reads single files by pattern only."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def mask_counts(spark: SparkSession, path: str, labels: DataFrame, text: str = "text", id_col: str = "doc_id",
                part: str = "lang", batches: int = BATCHES) -> DataFrame:
    """(part, mask, good, toxic, n): documents of the Parquet table at ``path`` by part, failed
    filters and labels, from one available-now stream over its files."""
    table = spark.read.parquet(path)
    per_batch = max(1, -(-len(table.inputFiles()) // batches))
    marks = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    docs = (spark.readStream.schema(table.schema).option("maxFilesPerTrigger", per_batch).parquet(_pattern(path))
            .select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                    F.col(f"`{text}`").alias("text")))
    docs = docs.mapInArrow(_marked, _MARK)
    docs = docs.join(marks, F.col("id") == F.col("label_id"), "left").select(
        "id", "part", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), "key", "mask")
    n_buckets = max(64, -(-table.count() // _BUCKET_TEXTS))
    changes = docs.mapInArrow(lambda batches: _combined(batches, n_buckets), _ROW).groupBy("bucket").applyInPandasWithState(
        _changes, _CHANGE, "texts binary", "append", "NoTimeout")
    out = scratch_path(spark, "filter-audit")
    query = (changes.writeStream.format("parquet").option("path", f"{out}/changes")
             .option("checkpointLocation", f"{out}/stream").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(_CHANGE).parquet(f"{out}/changes").groupBy("part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n")).filter("n <> 0")


def order_report(counts: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, from the counts of ``mask_counts``.

    Counts collapse to one row a part with a number for each mask first; the 600 rows a part are
    then expressions of that row."""
    n_masks = 1 << len(FILTERS)

    def by_mask(value):
        return F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, value)), F.lit(0)) for m in range(n_masks)])
    wide = counts.groupBy("part").agg(by_mask(F.col("n")).alias("n"), by_mask(F.col("n") * F.col("good")).alias("g"),
                                      by_mask(F.col("n") * F.col("toxic")).alias("t"))
    # each filter's removals over all orders: a document failing k filters falls to each in 1/k of them
    orders = ["".join(p) for p in permutations(FILTERS)]
    shares = [[len(orders) // m.bit_count() if m >> f & 1 else 0 for m in range(n_masks)] for f in range(len(FILTERS))]
    wide = wide.withColumn("shapley_by", F.array(*[sum((F.col("n")[m] * s for m, s in enumerate(row) if s), F.lit(0)) for row in shares]))
    rows = wide.withColumn("filter_order", F.explode(F.split(F.lit(" ".join(orders)), " ")))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))

    def bits(letters):
        return F.aggregate(F.split(letters, ""), F.lit(0), lambda a, c: a + F.when(c == "", 0).otherwise(
            F.pow(F.lit(2), F.instr(F.lit(FILTERS), c) - 1).cast("int")))
    rows = rows.withColumn("own", bits(F.substring("filter_order", F.col("step"), F.lit(1))))
    rows = rows.withColumn("before", bits(F.substring("filter_order", F.lit(1), F.col("step") - 1)))
    own, before = F.col("own"), F.col("before")

    def over(column, keep):
        return F.aggregate(F.transform(column, lambda n, m: F.when(keep(m), n).otherwise(F.lit(0))), F.lit(0).cast("long"),
                           lambda a, x: a + x)

    def removed(m):
        return (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) == 0)
    return rows.select(
        "part", "filter_order", "step",
        over("n", lambda m: m.bitwiseAND(own.bitwiseOR(before)) == 0).alias("kept"),
        over("n", removed).alias("removed"),
        over("n", lambda m: (m.bitwiseAND(own) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        over("n", lambda m: m == own).alias("unique_fails"),
        over("g", removed).alias("good_lost"), over("t", removed).alias("toxic_lost"),
        F.element_at("shapley_by", F.instr(F.lit(FILTERS), F.substring("filter_order", F.col("step"), F.lit(1))).cast("int"))
        .cast("long").alias("shapley"))


def filter_audit(spark: SparkSession, path: str, labels: DataFrame, **names) -> DataFrame:
    """The report of ``order_report`` for the Parquet table at ``path``."""
    return order_report(mask_counts(spark, path, labels, **names))
