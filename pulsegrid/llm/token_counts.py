"""Token counts by the whole-token shortcut.

For a byte-level tokenizer whose pre-tokenizer is the library's own pattern:

* Offline, once per vocabulary file: every vocabulary entry is turned back into text and encoded
  alone by the library; those that come out as their own single id are proven whole tokens.
* A pre-token found among them counts 1. Only the rest is merged, by the library, and remembered.
* Texts are walked by white-space chunks (a chunk and the one space or line feed before it): where
  no two white-space characters meet, no pre-token reaches over a chunk, so a chunk's count is the
  sum over its pre-tokens and is itself remembered. Other texts, and texts that name an added
  token, are split by the library's own pre-tokenizer or encoded whole.

Null text is empty (0 bytes, 0 tokens). Other columns are kept; the result columns replace
columns of the same names. An empty table gives an empty result.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .tokens import MEMO, byte_letters, disputed, lettered, load, simple

LIMIT = 1024


# Fixed value: the pattern of the library's byte-level pre-tokenizer.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def proven_whole(path: str, tok=None) -> frozenset[str]:
    """Vocabulary entries, as text, that the library encodes alone as their own one id."""
    tok, letters = tok or load(path), {c: b for b, c in byte_letters().items()}
    with open(path, encoding="utf-8") as f:
        conf = json.load(f)
    added = {t["content"] for t in conf.get("added_tokens", [])}
    texts, ids = [], []
    for piece, i in conf["model"]["vocab"].items():
        if piece not in added and all(c in letters for c in piece):
            try:
                texts.append(bytes(letters[c] for c in piece).decode("utf-8"))
                ids.append(i)
            except UnicodeDecodeError:  # a part of a character is never a pre-token
                pass
    got = tok.encode_batch(texts, add_special_tokens=False)
    return frozenset(t for t, i, e in zip(texts, ids, got) if e.ids == [i])


class Counter:
    """Counts tokens of texts; one per worker and vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        pre = conf.get("pre_tokenizer") or {}
        self.plain = (conf.get("normalizer") is None and pre.get("type") == "ByteLevel"
                      and not pre.get("add_prefix_space") and pre.get("use_regex", True))
        import regex

        self.tok, self.find = load(path), regex.compile(_PATTERN).findall
        self.added = [t["content"] for t in conf.get("added_tokens", [])]
        self.whole = proven_whole(path, self.tok) if self.plain else frozenset()
        self.merged: dict[str, int] = {}
        self.chunks: dict[str, int] = {}

    def _by_pieces(self, text: str) -> int:
        if simple(text) and not disputed(text):
            pieces = self.find(text)
        else:
            pieces = [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]
        total = 0
        for p in pieces:
            if p in self.whole:
                total += 1
                continue
            n = self.merged.get(p)
            if n is None:
                if len(self.merged) > MEMO:
                    self.merged.clear()
                n = self.merged[p] = len(self.tok.model.tokenize(lettered(p)))
            total += n
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.plain or any(a in text for a in self.added):
            return len(self.tok.encode(text, add_special_tokens=False).ids)
        if not _even(text):
            return self._by_pieces(text)
        # "\n" + text: every chunk then begins with its line feed (kept) or its space (cut off by split)
        chunks, memo = ("\n" + text).replace("\n", " \n")[1:].split(" "), self.chunks
        try:
            return sum([memo[c] for c in chunks]) - 1
        except KeyError:
            if len(memo) > MEMO:
                memo.clear()
            for c in chunks:
                if c not in memo:
                    memo[c] = self._by_pieces(c if c[0] == "\n" else " " + c)
            return sum([memo[c] for c in chunks]) - 1


def _even(text: str) -> bool:
    """Whether white space is single spaces and line feeds between other characters."""
    return text.split() == text.replace("\n", " ").split(" ")


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(text: Column, path: str) -> Column:
    """Tokens of each text, as the library's ids of the file at ``path``."""
    def count(texts):
        one = counter(path).count
        return texts.map(one).astype("int64")

    import pandas as pd

    count.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return pandas_udf(count, "long")(F.coalesce(text, F.lit("")))


def token_counts(df: DataFrame, path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``df`` with n_bytes, n_tokens and over_limit."""
    made = ["n_bytes", "n_tokens", "over_limit"]
    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in made]
    out = df.select(*keep, n_bytes.alias("n_bytes"), count_tokens(F.col(text), path).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
