"""Byte-level BPE encoding and decoding.

A rank file (``.tiktoken``: base64 piece and rank a line) gives pieces and ranks. A text is cut into
pre-tokens by the file's pattern, in the plan. The distinct pre-tokens of an Arrow batch are encoded
once inside its task, and their ids are laid out again for every occurrence; a worker remembers a
bounded number of short ones from batch to batch. So no text is shuffled, nothing that grows with the
corpus is broadcast or sent to the driver, and a plan holds no table of words.

A pre-token that is a piece of the file has its rank as its one id. Any other starts from single
bytes and merges the leftmost adjacent pair of lowest rank until none has a rank; a heap of pairs
keeps this at n log n for words of any length.

* Null and empty texts have no ids; they decode to no bytes. Texts are encoded whole.
* Which words a worker remembers never changes ids.
* Repeated rows each get their row. An empty table gives an empty result.
* Result columns replace columns of the same names; other columns are kept, whatever their names.
* The pattern's character classes are those of the JVM's Unicode tables; characters assigned later
  than these fall into the pattern's symbol class.
"""

from __future__ import annotations

import base64
import heapq
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.plan import with_columns_once
from .common import fresh

FREQUENT = 100_000  # distinct words a worker remembers; beyond it the memo starts anew
SHORT = 64          # characters; longer words are never remembered


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def _byte_text(piece: bytes) -> str:
    """One character (below U+0100) for each byte."""
    return piece.decode("latin-1")


class Merger:
    """Ids of single words; one per worker and rank file."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.memo: dict[str, list[int]] = {}

    def ids(self, word: str, remember: int) -> list[int]:
        """Ids of a non-empty word."""
        found = self.memo.get(word)
        if found is None:
            found = self._merged(word.encode("utf-8"))
            if len(word) <= SHORT and remember:
                if len(self.memo) >= remember:
                    self.memo.clear()
                self.memo[word] = found
        return found

    def _merged(self, word: bytes) -> list[int]:
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        # parts by their first byte: where each ends (0: merged into an earlier one), where the one before begins
        n, rank_of = len(word), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n))
        pairs = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of(word[i:i + 2])) is not None]
        heapq.heapify(pairs)
        while pairs:
            _, i, stop = heapq.heappop(pairs)
            middle = end[i]
            if not middle or middle == n or end[middle] != stop:
                continue  # one of the two was merged since
            end[i], end[middle], before[stop] = stop, 0, i
            for first, last in ((i, end[stop] if stop < n else 0), (before[i], stop)):
                if first >= 0 and last and (r := rank_of(word[first:last])) is not None:
                    heapq.heappush(pairs, (r, first, last))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i:end[i]]])
            i = end[i]
        return out


_MERGERS: dict[str, Merger] = {}


def merger(path: str) -> Merger:
    if path not in _MERGERS:
        _MERGERS[path] = Merger(path)
    return _MERGERS[path]


def ids_of_words(path: str, words: Column, remember: int = FREQUENT) -> Column:
    """Ids of each row's words (an array of non-empty strings), one word after another."""
    def encode(rows):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        one = merger(path)
        coded = rows.flatten().dictionary_encode()  # a batch's distinct words, and which stands where
        ids = [one.ids(w, remember) for w in coded.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, ids), "int64", len(ids))
        at = np.asarray(coded.indices)
        own = pa.ListArray.from_arrays(pa.array(_starts(sizes), "int32"), pa.array([i for x in ids for i in x], "int32"))
        n_words = np.asarray(pc.fill_null(pc.list_value_length(rows), 0))
        ends = _starts(sizes[at])[_starts(n_words)]
        return pa.ListArray.from_arrays(pa.array(ends, "int32"), own.take(coded.indices).flatten())

    def _starts(sizes):
        import numpy as np

        return np.concatenate([[0], np.cumsum(sizes, dtype="int64")])

    import pyarrow as pa

    encode.__annotations__ = {"rows": pa.Array, "return": pa.Array}
    return F.arrow_udf(encode, "array<int>")(words)


class Codec:
    """Encoding and decoding expressions for one rank file and pattern."""

    def __init__(self, path: str, pattern: str):
        self.path = path
        self.pattern = "(?U)" + pattern  # white space as Unicode has it
        ranks = read_ranks(path)
        by_id: list[str | None] = [None] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            by_id[rank] = _byte_text(piece)
        self._pieces = F.from_json(F.lit(json.dumps(by_id)), "array<string>")

    def words(self, text: Column) -> Column:
        """Pre-tokens of a text in order (null: none)."""
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(0))

    def merge(self, word: Column) -> Column:
        """Ids of one non-empty word as decimal text joined by commas."""
        return id_text(ids_of_words(self.path, F.array(word)))

    def encode(self, df: DataFrame, text: str = "text", frequent: int = FREQUENT, ids: str = "ids") -> DataFrame:
        """``df`` with the ids of every whole text as an array of ints; ``frequent``: words a worker remembers."""
        words, made = fresh(df, "bpe_words", "bpe_ids")
        out = with_columns_once(df, {words: self.words(F.col(f"`{text}`"))})
        out = out.withColumn(made, ids_of_words(self.path, F.col(words), frequent))
        return out.select(*[f"`{c}`" for c in df.columns if c.lower() != ids.lower()], F.col(made).alias(ids))

    def encode_text(self, df: DataFrame, text: str = "text", frequent: int = FREQUENT, ids: str = "ids") -> DataFrame:
        """``df`` with the ids of every whole text as decimal text joined by commas."""
        return self.encode(df, text, frequent, ids).withColumn(ids, id_text(F.col(f"`{ids}`")))

    def decode(self, ids: Column) -> Column:
        """The bytes that an array of ids stands for (null: none), its pieces one after another."""
        pieces = F.transform(F.coalesce(ids, F.array().cast("array<int>")), lambda i: F.get(self._pieces, i))
        return F.encode(F.array_join(pieces, ""), "ISO-8859-1")


def id_text(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), ",")


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """``df`` with n_tokens, ids_sha256 (of the decimal ids, joined by commas) and decoded_sha256."""
    codec = Codec(path, pattern)
    made = ["n_tokens", "ids_sha256", "decoded_sha256"]
    ids, = fresh(df, "bpe_id_list")
    out = codec.encode(df, text, frequent, ids)
    return out.select(*[f"`{c}`" for c in df.columns if c.lower() not in made],
                      F.size(ids).cast("long").alias("n_tokens"),
                      F.sha2(id_text(F.col(ids)).cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(codec.decode(F.col(ids)), 256).alias("decoded_sha256"))
