"""Wavelet shards and byte-level BPE against the tokenizer libraries."""

import base64
import hashlib
import time
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablehouse.llm import byte_bpe, wavelet

WORDS, RANKS = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def tik():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


CODER, ENCODER = byte_bpe.ByteBPE(RANKS, P.PATTERN), wavelet.Words(WORDS)
ODD = ["", None, "a\x1cb \x1d\x85 c", "x   b  c    d\x1c  e", "J̌ Jİ ΣΑΣ", "don't we'll I'M _a_b__ 12ab ²½",
       "<|endoftext|> a<|startoftext|>b", "hello <|endoftext|> there", "x<|startoftext|>y", "<|ENDOFTEXT|> <|EndOfText|>z", "a <|endoftext|", "你好 世界 \U0001f642", "a" * 5000, "aa aaa " * 50, " \n\n \t x  "]


def check(texts, library, tik):
    column = pa.array(texts, pa.string())
    ids, at = CODER.encode(column)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [tik.encode_ordinary(t or "") for t in texts]
    assert CODER.decode(ids).tobytes() == "".join(t or "" for t in texts).encode()
    ids, n = ENCODER.encode(column, 2)
    ends = np.cumsum(n)
    assert [ids[e - k:e].tolist() for e, k in zip(ends, n)] == [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_odd_texts(library, tik):
    check(ODD, library, tik)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=60), min_size=1, max_size=4))
def test_any_text(library, tik, texts):
    check(texts, library, tik)


def test_long_pieces(library, tik):
    """Runs without a break: the heap does the merges of the matrix, in time that grows with the length."""
    rng = np.random.default_rng(5)
    letters = ["".join(map(chr, rng.integers(97, 123, n))) for n in (1023, 1024, 1025, 3000)]
    check([*letters, "a" * 4001, "ab" * 1500, "é" * 700, "=" * 2500, "你好" * 400, "the" * 900], library, tik)
    raw = [CODER.byte_id[np.frombuffer(x.encode(), np.uint8)] for x in (*letters, "a" * 999)]
    for row in raw:
        want, _ = CODER._merge(row[None, :].copy(), np.array([len(row)]))
        assert CODER._merge_long(row).tolist() == want.tolist()
    words = (b for b in tik.token_byte_values() if b.isalpha() and b.islower())
    mega = b"".join(list(words)[:20_000] * 10)[: 1 << 20].decode()
    begin = time.perf_counter()
    ids, _ = CODER.encode(pa.array([mega]))
    assert time.perf_counter() - begin < 60
    assert CODER.decode(ids).tobytes() == mega.encode()
    assert ids.tolist() == tik.encode_ordinary(mega)


def test_memo_starts_anew(monkeypatch, library, tik):
    from tablehouse.llm.common import Memo

    monkeypatch.setattr(Memo, "MOST", 10)
    for _ in range(3):
        check(["one two three four five six seven eight nine ten eleven twelve", "b c d"], library, tik)


def test_memo_grows():
    from tablehouse.llm.common import Memo, seeded

    memo = Memo()
    memo.forget(16)
    keys = seeded(100, 1)
    at, n = memo.lookup(keys, lambda first: (first.astype(np.int32), np.ones(len(first), np.int64)))
    assert memo.ids[at].tolist() == list(range(100)) and (n == 1).all()


@pytest.mark.parametrize("size", [1, 2, 511, 512, 513, 5000])
def test_shard_queries(size):
    ids = np.random.default_rng(size).integers(0, 40, size) ** 2 % 701
    shard = wavelet.Shard(size, *wavelet.planes_of(ids))
    assert (shard.sequence() == ids).all()
    some = range(0, size, max(1, size // 40))
    assert [shard.access(i) for i in some] == [ids[i] for i in some]
    for token in {*ids[:20].tolist(), 3, 100_000}:
        where = np.flatnonzero(ids == token).tolist()
        assert shard.occurrences(token) == where and shard.count(token) == len(where)
        assert shard.rank(token, size // 2) == sum(w < size // 2 for w in where)
        assert shard.count(token, size // 3, size) == sum(w >= size // 3 for w in where)
    with pytest.raises(IndexError):
        shard.access(size)
    with pytest.raises(IndexError):
        shard.select(int(ids[0]), size)


def expected_shards(rows, library):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_wavelet_round_trip(docs, odd, library):
    for frame in (docs, odd):
        rows = [(r.doc_id, r.text) for r in frame.collect()]
        found = sorted(map(tuple, wavelet.round_trip(frame, WORDS).collect()), key=lambda r: r[1])
        assert found == expected_shards(rows, library)


def test_several_shards(spark, docs, library, tmp_path):
    wavelet.write_shards(docs, WORDS, str(tmp_path / "s"), shard_tokens=2000)
    shards = wavelet.read_shards(spark, str(tmp_path / "s"))
    assert shards.count() > 20
    found = sorted(map(tuple, wavelet.documents(shards).collect()), key=lambda r: r[1])
    assert found == expected_shards([(r.doc_id, r.text) for r in docs.collect()], library)


def test_bpe_round_trip(docs, odd, tik):
    for frame in (docs, odd):
        want = sorted(((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
                       for r in frame.collect() for ids in [tik.encode_ordinary(r.text or "")]), key=str)
        assert sorted(map(tuple, byte_bpe.round_trip(frame, RANKS, P.PATTERN).collect()), key=str) == want


def test_bpe_columns(odd, tik):
    tokens = byte_bpe.encode(odd, RANKS, P.PATTERN)
    assert sorted(len(r.ids) for r in tokens.collect()) == sorted(len(tik.encode_ordinary(r.text or "")) for r in odd.collect())
    data = byte_bpe.decode(tokens, RANKS, P.PATTERN)
    assert sorted(bytes(r.data) for r in data.collect()) == sorted((r.text or "").encode() for r in odd.collect())


def test_bad_ids():
    with pytest.raises(ValueError):
        CODER.decode(np.array([50_256]))


def test_no_rows(none):
    assert wavelet.round_trip(none, WORDS).count() == 0
    assert byte_bpe.round_trip(none, RANKS, P.PATTERN).count() == 0
