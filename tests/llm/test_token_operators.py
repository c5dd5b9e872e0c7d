"""Token ids, counts, files and packing against the library and brute force."""

import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.llm import packing, token_counts, token_files, tokens
from tests.conftest import SF_SMALL

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", "  a  b\n\n c ", "<|endoftext|> x<|startoftext|>y", "x\x1cy z", "İstanbul ΣΑΣ ὀδός’s it's", "é ́a",
       "你好 世界。123 ½ ² Ⅷ", "\n", "a\n", "\na", " a", "a\tb", "don't DON'T 'S's", "a\u0085b　c", "🙂🙂 x",
       "I'LL '", "\n\n\na  \n b", "x" * 3000, "ab " * 2000, "<|endoftext|>", "a<|endoftext|>b\nc", "᠎ a"]


@pytest.fixture(scope="module")
def table(spark):
    own = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = [(-1 - i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (5, None), (5, None), (3, "again")]
    return own.unionByName(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("n_tokens", F.lit("x"))


@pytest.fixture(scope="module")
def library(table):
    tok = tokens.load(WORDS)
    return [(r.doc_id, tok.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in table.collect()]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_chunks_give_the_library_ids():
    assert tokens.chunks_independent(WORDS) and not tokens.chunks_independent(BYTES)
    tok, enc = tokens.load(WORDS), tokens.Encoder(WORDS)
    for text in ODD:
        assert np.frombuffer(enc.encode([text])[0], "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


CHARS = st.text(st.sampled_from("abE é'sdlm.,!1²½ß \n\t<|>_- ́Σ你"), max_size=40)
_ENC, _COUNT = tokens.Encoder(WORDS), token_counts.Counter(BYTES)
_TOK, _BTOK = tokens.load(WORDS), tokens.load(BYTES)


@settings(max_examples=300, deadline=None)
@given(CHARS)
def test_random_texts(text):
    assert np.frombuffer(_ENC.encode([text])[0], "<u4").tolist() == _TOK.encode(text, add_special_tokens=False).ids
    assert _COUNT.count(text) == len(_BTOK.encode(text, add_special_tokens=False).ids)


def test_whole_tokens_are_proven():
    assert len(_COUNT.whole) > 45_000 and " the" in _COUNT.whole
    assert "<|endoftext|>" not in _COUNT.whole


def test_counts_of_the_table(table):
    want = sorted((r.doc_id is not None, r.doc_id or 0, len((r.text or "").encode()),
                   len(_BTOK.encode(r.text or "", add_special_tokens=False).ids)) for r in table.collect())
    got = token_counts.token_counts(table, BYTES, limit=100)
    assert got.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"]
    rows = got.collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in rows)


def test_files_round_trip(table, library):
    got = token_files.token_files(table, WORDS).collect()
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(
        ((i, len(x), _crc(x)) for i, x in library), key=key)
    rows = sorted(got, key=lambda r: r.start)
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    ids = [r.doc_id for r in rows]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])


def test_file_format_reads_any_block():
    out = io.BytesIO()
    w = token_files.PlaneWriter(out)
    rng = np.random.default_rng(0)
    data = [(i, rng.integers(0, 49408, n).astype("<u4").tobytes()) for i, n in enumerate([0, 5, 200_000, 1, 70_000])]
    for i, ids in data:
        w.add(i, ids)
    w.close()
    r = token_files.PlaneReader(out, len(out.getvalue()))
    assert list(r.documents()) == data
    assert r.block(2) == b"".join(x for _, x in data)[8 * token_files.BLOCK:12 * token_files.BLOCK]
    with pytest.raises(ValueError):
        token_files.PlaneReader(io.BytesIO(b"x" * 40), 40)


def test_pieces_are_gapless_and_fit(table, library):
    cap = 512
    rows = packing.pack(packing.token_pieces(table, WORDS, capacity=cap), capacity=cap).collect()
    want = sorted((i is not None, i or 0, p, at, len(x[at:at + cap]), _crc(x[at:at + cap]))
                  for i, x in library for p, at in enumerate(range(0, len(x), cap)))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for seq in by.values():
        at = 0
        for offset, length in sorted(seq):
            assert offset == at
            at += length
        assert at <= cap


def _best_fit(lengths, cap):
    gaps = []
    for x in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= x]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - x)
        else:
            gaps.append(cap - x)
    return sorted(gaps)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_sweep_is_best_fit_decreasing(lengths):
    runs = packing.sweep({x: lengths.count(x) for x in set(lengths)}, 50)
    used = {}
    for length, _, n, first, per, _ in runs:
        for t in range(n):
            used[first + t // per] = used.get(first + t // per, 0) + length
    assert sorted(50 - x for x in used.values()) == _best_fit(lengths, 50)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.token_pieces(none, WORDS)).count() == 0
    assert token_files.token_files(none, WORDS).count() == 0
    assert token_counts.token_counts(none, BYTES).count() == 0
