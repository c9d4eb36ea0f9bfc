"""Operator 7: removal of every repeated passage of at least `k` words.

Words are maximal runs of bytes other than space and the control characters 9 to 13.  Each
window of `k` consecutive words of a document has a Rabin-Karp hash; a window whose sequence
also starts anywhere else is repeated, and every word that lies in one goes.

How the windows are counted: documents are dealt to chunks by a hash of id and text.  A chunk
sorts its window hashes, keeps one of each with a flag for those it holds several times, and
sends them in ranges of the hash, 8 bytes and a flag bit a window.  Each range is counted in
one place over all chunks, and every chunk gets a bit for each hash it sent, in its own order:
repeated or not.  The chunk then merges its repeated windows into maximal intervals.  So each
window crosses the network once, and the way back costs one bit.  A sequence that a third of
all documents share reaches the counting once per chunk.  The number of chunks and ranges
follows the bytes of the input; ranges of a uniform hash are even.

Defined cases: null texts have no words; documents of fewer than `k` words lose nothing; copies
(also repeated rows) remove each other entirely, the first one included; windows are judged on
the input; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehouse.llm.common import CHUNK_BYTES, fit, not_space, prepare, utf8, window_hashes, word_hashes

K = 35
CHUNK_TEXT = 6 << 20  # bytes of text in a chunk, on average
RANGE_WINDOWS = 1 << 20  # hashes counted in one place, on average


def _parts(texts: list, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts with at most `most` characters together; a longer one comes alone."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def _windows(texts: list, k: int) -> np.ndarray:
    """Hashes of all windows of a chunk's texts, in their order."""
    out = [np.empty(0, np.uint64)]
    for a, b in _parts(texts):
        data, off = utf8(pa.array(texts[a:b], pa.large_string()))
        hashes, rows, _, _ = word_hashes(data, off, not_space())
        out.append(window_hashes(hashes, rows, k)[0])
    return np.concatenate(out)


def _ranges(hashes: np.ndarray, n: int) -> np.ndarray:
    """Borders, in sorted hashes, of n equal ranges of the hash values."""
    step = ((1 << 64) + n - 1) // n
    cuts = np.array([min(i * step, (1 << 64) - 1) for i in range(1, n)], dtype=np.uint64)
    return np.concatenate(([0], np.searchsorted(hashes, cuts), [len(hashes)])).astype(np.int64)


def _sent(pdf: pd.DataFrame, k: int, n_ranges: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["doc_id", "text"], kind="stable")
    hashes = _windows(pdf["text"].tolist(), k)
    hashes.sort()
    first = np.ones(len(hashes), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    at = np.flatnonzero(first)
    several = np.diff(np.concatenate((at, [len(hashes)]))) > 1
    hashes = hashes[at]
    cuts = _ranges(hashes, n_ranges)
    rows = [(pdf["chunk"].iloc[0], r, hashes[a:b].tobytes(), np.packbits(several[a:b]).tobytes())
            for r, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]
    return pd.DataFrame(rows, columns=["chunk", "range", "hashes", "several"])


def _counted(pdf: pd.DataFrame) -> pd.DataFrame:
    """For every chunk of a range: which of its hashes are repeated, in any chunk or in it."""
    parts = [np.frombuffer(x, np.uint64) for x in pdf["hashes"]]
    several = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(p)).astype(bool) for x, p in zip(pdf["several"], parts, strict=True)]
    every = np.sort(np.concatenate(parts))
    twice = every[1:][every[1:] == every[:-1]]
    more = np.unique(np.concatenate([twice, *[p[s] for p, s in zip(parts, several, strict=True)]]))
    rows = []
    for chunk, r, p in zip(pdf["chunk"], pdf["range"], parts, strict=True):
        at = np.minimum(np.searchsorted(more, p), max(len(more) - 1, 0))
        hit = more[at] == p if len(more) else np.zeros(len(p), bool)
        rows.append((chunk, r, np.packbits(hit).tobytes() if hit.any() else b""))
    return pd.DataFrame(rows, columns=["chunk", "range", "bits"])


def _removed(docs: pd.DataFrame, marks: pd.DataFrame, k: int, n_ranges: int) -> Iterator[tuple]:
    """(id, number of words, intervals of removed words, kept words) of a chunk's documents."""
    docs = docs.sort_values(["doc_id", "text"], kind="stable")
    texts = docs["text"].tolist()
    hashes = np.unique(_windows(texts, k))
    cuts, hit = _ranges(hashes, n_ranges), np.zeros(len(hashes), bool)
    for r, bits in zip(marks["range"], marks["bits"], strict=True):
        if len(bits):
            a, b = cuts[r], cuts[r + 1]
            hit[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
    hashes = hashes[hit]
    ids = docs["doc_id"].tolist()
    for a, b in _parts(texts):
        data, off = utf8(pa.array(texts[a:b], pa.large_string()))
        words, rows, starts, ends = word_hashes(data, off, not_space())
        found, at = window_hashes(words, rows, k)
        if len(hashes):
            place = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            at = at[hashes[place] == found]
        else:
            at = at[:0]
        steps = np.zeros(len(words) + 1, np.int32)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + k, -1)  # a window ends within its row
        gone = np.cumsum(steps[:-1]) > 0
        raw = data.tobytes()
        for i in range(a, b):
            lo, hi = rows[i - a], rows[i - a + 1]
            g = gone[lo:hi]
            text = raw[off[i - a] : off[i - a + 1]]
            if not g.any():
                kept = b" ".join(text.split())
                yield ids[i], int(hi - lo), [], kept
                continue
            s, e = starts[lo:hi][~g].tolist(), ends[lo:hi][~g].tolist()
            edge = np.flatnonzero(np.diff(np.concatenate(([False], g, [False])).astype(np.int8))).tolist()
            yield ids[i], int(hi - lo), [{"first": x, "last": y - 1} for x, y in zip(edge[::2], edge[1::2], strict=True)], b" ".join([raw[x:y] for x, y in zip(s, e, strict=True)])


def remove_repeats(docs: DataFrame, k: int = K, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, the removed intervals of words, and the kept text.

    With `digest` the kept text is given as its SHA-256.
    """
    spark = prepare(docs.sparkSession)
    # ids travel as text: pandas would turn a column of integers with nulls into floats
    texts = fit(docs, doc_id="string", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    size = texts.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    chunks, ranges = size // CHUNK_TEXT + 1, size // 6 // RANGE_WINDOWS + 1
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(chunks, spread) if size > CHUNK_TEXT else chunks
    dealt = texts.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    sent = dealt.groupBy("chunk").applyInPandas(lambda pdf: _sent(pdf, k, ranges), "chunk int, range int, hashes binary, several binary")
    marks = sent.groupBy("range").applyInPandas(_counted, "chunk int, range int, bits binary")

    def finish(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for doc_id, n, spans, kept in _removed(left, right, k, ranges):
            kept = hashlib.sha256(kept).hexdigest() if digest else kept.decode()
            rows.append((doc_id, n, sum(x["last"] - x["first"] + 1 for x in spans), spans, kept))
        return pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "spans", "kept"])

    return dealt.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInPandas(
        finish, "doc_id string, n_words long, n_removed long, spans array<struct<first:int,last:int>>, kept string"
    ).withColumn("doc_id", F.col("doc_id").cast("long"))


SQL = r"""
with w as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
p as (select r, ws, unnest(range(1, len(ws) - 33)) as i from w where len(ws) >= 35),
s as (select r, i, count(*) over (partition by ws[i:i+34]) as n from p),
g as (select distinct r, i + o as word from s, unnest(range(0, 35)) t(o) where n > 1),
k as (select r, list(word) as gone from g group by r),
f as (select w.doc_id, w.ws, list_filter(range(1, len(w.ws) + 1), lambda x: not coalesce(list_contains(k.gone, x), false)) as kept
      from w left join k using (r))
select doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - len(kept) as bigint) as n_removed,
  sha256(array_to_string(list_transform(kept, lambda x: ws[x]), ' ')) as kept_sha256
from f
"""
