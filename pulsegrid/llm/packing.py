"""Best-fit packing of documents into sequences, in bulk-synchronous rounds.

Documents are cut into pieces of at most ``capacity`` tokens (only longer ones are cut, the last
piece may be shorter), and the pieces go into as few sequences as best-fit decreasing finds.

Lengths and gaps are whole numbers up to ``capacity``, and pieces of one length, like gaps of one
size, are interchangeable. So the rounds work on size classes and ranks:

* Range sort: every piece gets its rank among the pieces of its length (distributed: numbered
  within 256 hash cells a length, plus the cells' running counts).
* Successor sweep: from the longest class down, a class is matched with the smallest gap that
  holds it, whole runs of sequences at once; a gap takes as many as fit before the next one is
  tried, as sequential best fit would. If no gap holds it, new sequences open.
* Conflicts are resolved by rank: rank r of the class takes place r of the run.
* The gaps of the run shrink and form new classes, and the next round begins.

The class counts (at most ``capacity`` numbers, whatever the data) go to the driver, and the
matched runs come back as a table that each piece looks up by (length, rank). Rows never do.

Null text is empty: one piece that holds the end id alone. Repeated rows and repeated ids are
documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_sized, settle
from .tokens import END_ID, encoder

CAPACITY = 4096
_CELLS = 256


def token_pieces(df: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(key, piece, start, length, ids_crc32) of every document, end id included."""
    kind = df.schema[key].dataType.simpleString()

    def cut(batches):
        import pyarrow as pa

        end, step, enc = end_id.to_bytes(4, "little"), 4 * capacity, encoder(path)
        for batch in batches:
            keys, rows = [], []
            names = batch.column(0)
            for k, ids in enumerate(enc.encode(batch.column(1).to_pylist())):
                ids += end
                for p, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    keys.append(k)
                    rows.append((p, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(keys, pa.int64())), pa.array(cols[0], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in cols[1:]]], ["key", "piece", "start", "length", "ids_crc32"])

    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        cut, f"key {kind}, piece int, start long, length long, ids_crc32 long")
    return out.withColumnRenamed("key", key)


def sweep(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first sequence, pieces a sequence, offset) of best-fit decreasing.

    ``counts``: pieces by length. Gaps are kept as runs of sequences by gap size; ``sizes`` has a
    bit for each gap size in use."""
    gaps: dict[int, list[tuple[int, int]]] = {}
    runs, sizes, opened = [], 0, 0
    for length in sorted((n for n in counts if n > 0), reverse=True):
        rank, left = 0, counts[length]
        while left:
            above = sizes >> length
            if above:
                gap = length + (above & -above).bit_length() - 1
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    sizes &= ~(1 << gap)
            else:
                gap = capacity
                first, n = opened, -(-left // (capacity // length))
                opened += n
            per = gap // length
            take = min(left, n * per)
            runs.append((length, rank, take, first, per, capacity - gap))
            whole, over = divmod(take, per)
            for at, many, size in ((first, whole, gap - per * length),
                                   (first + whole, int(over > 0), gap - over * length),
                                   (first + whole + (over > 0), n - whole - (over > 0), gap)):
                if many and size:
                    gaps.setdefault(size, []).append((at, many))
                    sizes |= 1 << size
            rank, left = rank + take, left - take
    return runs


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset; every length is 1 to ``capacity``."""
    spark = pieces.sparkSession
    tie = F.xxhash64(*pieces.columns)
    numbered = pieces.withColumn("pack_cell", F.pmod(tie, F.lit(_CELLS)))
    w = Window.partitionBy(length, "pack_cell").orderBy(tie, *pieces.columns)
    numbered = settle(numbered.withColumn("pack_rank", F.row_number().over(w) - 1))
    cells = numbered.groupBy(F.col(length).alias("pack_length"), F.col("pack_cell").alias("pack_c")).agg(
        F.count("*").alias("n"))
    base = F.sum("n").over(Window.partitionBy("pack_length").orderBy("pack_c"))
    cells = settle(cells.withColumn("pack_base", base - F.col("n")))
    counts = {r[0]: r[1] for r in cells.groupBy("pack_length").agg(F.sum("n")).collect()}  # at most `capacity` rows
    runs: dict[int, list] = {}
    for size, *run in sweep(counts, capacity):
        runs.setdefault(size, []).append(tuple(run))
    table = spark.createDataFrame(
        list(runs.items()), "pack_of long, pack_runs array<struct<first:long, n:long, seq:long, per:long, at:long>>")
    placed = join_sized(numbered, cells.drop("n"),
                        (F.col(length) == F.col("pack_length")) & (F.col("pack_cell") == F.col("pack_c")), "inner")
    placed = placed.withColumn("pack_rank", F.col("pack_rank") + F.col("pack_base"))
    placed = placed.join(F.broadcast(table), F.col(length) == F.col("pack_of"))  # bounded by `capacity`
    rank = F.col("pack_rank")
    run = F.filter("pack_runs", lambda r: (r["first"] <= rank) & (rank < r["first"] + r["n"]))[0]
    placed = placed.withColumn("pack_run", run)
    at = rank - F.col("pack_run.first")
    per = F.col("pack_run.per")
    return placed.select(*pieces.columns, (F.col("pack_run.seq") + F.floor(at / per)).alias("sequence_id"),
                         (F.col("pack_run.at") + F.pmod(at, per) * F.col(length)).alias("offset"))
