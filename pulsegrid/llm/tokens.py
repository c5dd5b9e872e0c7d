"""Token ids of whole texts, as the tokenizers library gives them, with a memo of white-space chunks.

For a tokenizer file whose pre-tokenizer drops white space and whose normalizer works character by
character (the constants below), the ids of a text are the ids of its white-space chunks one after
another, special strings included: no piece of the pattern reaches over white space. Each distinct
chunk goes through the library once per worker. Other files, and texts with one of the few
characters that Python and the pattern disagree on, are encoded whole by the library.
"""

from __future__ import annotations

import json
import os
import struct

# The pre-tokenizer pattern and normalizer kinds for which chunks are independent.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_DISPUTED = "\x1c\x1d\x1e\x1f\u180e"  # white space to one of Python and the pattern only
MEMO = 600_000  # chunks kept by a worker; beyond it the memo starts anew
END_ID = 1


def load(path: str):
    """A tokenizer of the library, without its own threads (Spark's tasks are the parallelism)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def chunks_independent(path: str) -> bool:
    """Whether the file's texts may be encoded chunk by chunk."""
    with open(path, encoding="utf-8") as f:
        conf = json.load(f)
    pre = (conf.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    norm = [n.get("type") for n in (conf.get("normalizer") or {}).get("normalizers", [])]
    added = all(not t["normalized"] and not t["lstrip"] and not t["rstrip"] and not t["single_word"]
                for t in conf.get("added_tokens", []))
    return (added and norm == _NORMALIZERS and pre[0].get("pattern") == {"Regex": _PATTERN}
            and pre[0].get("behavior") == "Removed" and bool(pre[0].get("invert")))


def disputed(text: str) -> bool:
    return any(c in text for c in _DISPUTED)


def byte_letters() -> dict[int, str]:
    """The usual byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = byte_letters()


def lettered(piece: str) -> str:
    """A pre-token in the byte-level alphabet, as the model takes it."""
    return piece.encode("utf-8").decode("latin-1").translate(_LETTERS)


def simple(chunk: str) -> bool:
    """Latin characters only (below the combining marks), on which all Unicode versions agree."""
    return chunk.isascii() or max(chunk) < "\u0250"


class Encoder:
    """Texts to ids as little-endian unsigned 32-bit bytes.

    A chunk of Latin characters that was not seen yet is split by the file's pattern, and only
    pieces that were not seen yet go through the library's merges; other chunks go whole."""

    def __init__(self, path: str):
        import regex

        self.tok, self.by_chunk, self.memo, self.pieces = load(path), chunks_independent(path), {}, {}
        self.model, self.find = self.tok.model, regex.compile(_PATTERN).findall

    def _ids(self, texts: list[str]) -> list[bytes]:
        got = self.tok.encode_batch(texts, add_special_tokens=False)
        return [pack(e.ids) for e in got]

    def _chunk(self, chunk: str) -> bytes:
        if "<|" in chunk or not simple(chunk):
            return self._ids([chunk])[0]
        out = []
        for piece in self.find(chunk.lower()):
            ids = self.pieces.get(piece)
            if ids is None:
                if len(self.pieces) > MEMO:
                    self.pieces.clear()
                ids = self.pieces[piece] = pack([t.id for t in self.model.tokenize(lettered(piece))])
            out.append(ids)
        return b"".join(out)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        for i, text in enumerate(texts):
            if not text:
                continue
            if not self.by_chunk or disputed(text):
                out[i] = self._ids([text])[0]
                continue
            chunks, memo = text.split(), self.memo
            try:
                out[i] = b"".join([memo[c] for c in chunks])
            except KeyError:
                if len(memo) > MEMO:
                    memo.clear()
                for c in chunks:
                    if c not in memo:
                        memo[c] = self._chunk(c)
                out[i] = b"".join([memo[c] for c in chunks])
        return out


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker process's encoder for a file; its memo lives on between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
