"""Token-id files by plane shuffling.

Documents are written in ascending id order (null ids first), each as its token ids and an end
id. A file is

    magic | blocks ... | documents | index | length of the index (8 bytes) | magic

* A block holds ``BLOCK`` ids (the last of a file fewer) of four little-endian bytes, transposed
  into four byte planes; each plane is compressed by zstandard on its own. The high planes of
  small ids are constant and vanish.
* The documents part holds their ids and token counts as byte planes in the same way.
* The index is JSON: place and compressed sizes of each block's planes, so that a reader can
  fetch any block alone.

Tasks write files under names of their own attempt and return what they wrote; that list, settled
in the shared folder, is the only way to the files, so those of lost or repeated attempts are never
read. Writing goes through Arrow's file systems to the URI given (the shared checkpoint folder).

Ids of documents must be whole numbers. Null text is empty (the end id alone). Repeated rows are
documents of their own. An empty table gives no file and an empty result.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_path, settle
from .tokens import END_ID, encoder

MAGIC = b"PLANES01"
BLOCK = 1 << 16
LEVEL = 3
FILES = "part long, uri string, n_docs long, n_ids long, n_bytes long"


def to_planes(data: bytes, width: int) -> list[bytes]:
    """Byte planes of fixed-width values, each compressed."""
    import numpy as np
    import zstandard

    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    return [pack(p.tobytes()) for p in np.frombuffer(data, "u1").reshape(-1, width).T]


def from_planes(planes: list[bytes]) -> bytes:
    import numpy as np
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return np.stack([np.frombuffer(unpack(p), "u1") for p in planes], axis=1).tobytes()


class PlaneWriter:
    """Writes one file; holds a block of ids and the documents' numbers, never all ids."""

    def __init__(self, out):
        self.out, self.at, self.pending, self.index = out, 0, bytearray(), []
        self.ids, self.counts, self.n_ids = [], [], 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _planes(self, data: bytes, width: int) -> dict:
        planes, at = to_planes(data, width), self.at
        for p in planes:
            self._put(p)
        return {"at": at, "sizes": [len(p) for p in planes]}

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.n_ids += len(ids) // 4
        self.pending += ids
        while len(self.pending) >= 4 * BLOCK:
            self._block(4 * BLOCK)

    def _block(self, n: int) -> None:
        self.index.append(self._planes(bytes(self.pending[:n]), 4) | {"n": n // 4})
        del self.pending[:n]

    def close(self) -> None:
        import numpy as np

        if self.pending:
            self._block(len(self.pending))
        docs = {"n": len(self.ids),
                "null": [i for i, x in enumerate(self.ids) if x is None] if self.ids and self.ids[0] is None else [],
                "ids": self._planes(np.array([x or 0 for x in self.ids], "<i8").tobytes(), 8),
                "counts": self._planes(np.array(self.counts, "<u8").tobytes(), 8)}
        index = json.dumps({"blocks": self.index, "docs": docs}).encode()
        self._put(index + len(index).to_bytes(8, "little") + MAGIC)


class PlaneReader:
    """Reads one file: documents in order, a block at a time."""

    def __init__(self, src, size: int):
        self.src = src
        src.seek(size - 16)
        tail = src.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a plane file")
        src.seek(size - 16 - (n := int.from_bytes(tail[:8], "little")))
        self.index = json.loads(src.read(n))

    def _planes(self, entry: dict) -> bytes:
        self.src.seek(entry["at"])
        return from_planes([self.src.read(n) for n in entry["sizes"]])

    def block(self, k: int) -> bytes:
        return self._planes(self.index["blocks"][k])

    def documents(self):
        """(doc id, ids as bytes) of each document."""
        import numpy as np

        docs = self.index["docs"]
        if not docs["n"]:
            return
        null = set(docs["null"])
        ids = np.frombuffer(self._planes(docs["ids"]), "<i8").tolist()
        counts = np.frombuffer(self._planes(docs["counts"]), "<u8").tolist()
        buffer, k = bytearray(), 0
        for i, (doc_id, n) in enumerate(zip(ids, counts)):
            while len(buffer) < 4 * n:
                buffer += self.block(k)
                k += 1
            yield None if i in null else doc_id, bytes(buffer[:4 * n])
            del buffer[:4 * n]


def write_token_files(df: DataFrame, path: str, out: str | None = None, key: str = "doc_id",
                      text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Writes the files below ``out`` (default: a new folder in the shared one); FILES, one row a file.

    Rows are range-partitioned by id; text hash and row place follow as further range keys, so that
    one id on very many rows still spreads. Tokens are made after the only shuffle."""
    out = out or scratch_path(df.sparkSession, "token-files")

    def write(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        part, writer, sink, uri = TaskContext.get().partitionId(), None, None, ""
        for batch in batches:
            if batch.num_rows and writer is None:
                uri = f"{out}/part-{part:06d}-{uuid.uuid4().hex}.planes"
                where, name = fs.FileSystem.from_uri(uri)
                where.create_dir(name.rsplit("/", 1)[0], recursive=True)
                sink = where.open_output_stream(name)
                writer = PlaneWriter(sink)
            ids = encoder(path).encode(batch.column(1).to_pylist())
            for doc_id, one in zip(batch.column(0).to_pylist(), ids):
                writer.add(doc_id, one + end_id.to_bytes(4, "little"))
        if writer is not None:
            writer.close()
            sink.close()
            row = [part, uri, len(writer.ids), writer.n_ids, writer.at]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], [c.split()[0] for c in FILES.split(", ")])

    slim = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    slim = slim.withColumn("h", F.xxhash64("text")).withColumn("m", F.monotonically_increasing_id())
    ranged = slim.repartitionByRange("id", "h", "m").sortWithinPartitions("id", "h", "m")
    return settle(ranged.select("id", "text").mapInArrow(write, FILES))


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files listed in ``files``."""
    def read(batches):
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            for uri, size, at in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                where, name = fs.FileSystem.from_uri(uri)
                with where.open_input_file(name) as src:
                    rows = []
                    for doc_id, ids in PlaneReader(src, size).documents():
                        rows.append((doc_id, at, len(ids) // 4, zlib.crc32(ids)))
                        at += len(ids) // 4
                        if len(rows) == 10_000:
                            yield _rows(pa, rows)
                            rows = []
                    yield _rows(pa, rows)

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    at = settle(files.withColumn("at", F.coalesce(F.sum("n_ids").over(before), F.lit(0))))
    n = max(1, at.count())
    return at.select("uri", "n_bytes", "at").repartition(n, "uri").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(pa, rows: list[tuple]):
    cols = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                      ["doc_id", "start", "n_tokens", "ids_crc32"])


def token_files(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the documents' files and returns the digest read back from them, keyed ``key``."""
    return read_token_files(write_token_files(df, path, key=key, text=text)).withColumnRenamed("doc_id", key)
