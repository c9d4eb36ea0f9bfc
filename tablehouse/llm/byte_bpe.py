"""Operator 5: byte-level BPE encoding and decoding in padded numpy matrices.

A text falls into chunks of white space and what follows; no piece of the pattern crosses from
one to the next.  The pattern cuts each chunk that the worker's memo does not know yet.  The
pieces of new chunks go into buckets by length, one padded matrix of token ids each.  In every
round each row of a matrix merges its leftmost pair of least rank; ranks come from a hashed
table of pairs (open addressing in numpy arrays).  Rows without a pair to merge leave the
matrix, and rows close the gap that a merge leaves, so the matrix narrows by one column a
round.  A round costs the width of the matrix, so a piece of over `LONG` bytes (a run of letters
without a break) does the same merges in the same order from a heap of (rank, place), in
n log n steps.  Decoding gathers the bytes of the ids from one flat vocabulary array.

Defined cases: a null text is encoded as empty and decodes to nothing; repeated rows are
encoded each; very long pieces go through the heap one by one; an empty table gives an empty
result.  Invalid ids raise ValueError on decoding.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehouse.llm.common import Memo, fit, gather, mix, once, prepare, slices, utf8, word_hashes

NO = np.int64(1 << 40)
LONG = 1 << 10  # bytes of a piece that a matrix holds


class PairTable:
    """(left id, right id) -> rank of the merged token; linear probing, at most half full."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.mask = np.uint64((1 << max(4, int(2 * len(left)).bit_length())) - 1)
        self.keys = np.full(int(self.mask) + 1, -1, np.int64)
        self.ranks = np.full(int(self.mask) + 1, NO, np.int64)
        todo = (left.astype(np.int64) << 32) | right
        slot = self._slot(todo)
        while len(todo):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = todo[free]  # of several for one slot, the last one gets it
            mine = self.keys[slot] == todo
            self.ranks[slot[mine]] = rank[mine]
            todo, slot, rank = todo[~mine], (slot[~mine] + 1) & int(self.mask), rank[~mine]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (mix(key.astype(np.uint64)) & self.mask).astype(np.int64)

    def as_dict(self) -> dict[int, int]:
        """The same by left id * 2**32 + right id, for single lookups."""
        held = self.keys >= 0
        return dict(zip(self.keys[held].tolist(), self.ranks[held].tolist(), strict=True))

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        slot = self._slot(key)
        out = self.ranks[slot]
        held = self.keys[slot]
        again = np.flatnonzero((held != key) & (held >= 0))
        out[held != key] = NO
        while len(again):
            slot[again] = (slot[again] + 1) & int(self.mask)
            held = self.keys[slot[again]]
            done = held == key[again]
            out[again[done]] = self.ranks[slot[again[done]]]
            again = again[~done & (held >= 0)]
        return out


class ByteBPE:
    """Encoder and decoder for one rank file and pattern."""

    def __init__(self, path: str, pattern: str):
        self.split = regex.compile(pattern).findall
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.size = max(ranks.values()) + 1
        vocabulary = [b""] * self.size
        for token, rank in ranks.items():
            vocabulary[rank] = token
        self.start = np.concatenate(([0], np.cumsum([len(t) for t in vocabulary]))).astype(np.int64)
        self.flat = np.frombuffer(b"".join(vocabulary), np.uint8)
        decimal = [b" %d" % i for i in range(self.size)]
        self.decimal_start = np.concatenate(([0], np.cumsum([len(t) for t in decimal]))).astype(np.int64)
        self.decimal_flat = np.frombuffer(b"".join(decimal), np.uint8)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # every cut of a token into two tokens merges to it: the rank of a pair is that of its bytes together
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, rank = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self.pairs = PairTable(left, right, rank)
        self.ranks = ranks
        self.single: dict[int, int] = {}
        self.memo = Memo()

    # -- pieces

    def _merge(self, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All merges in a padded matrix of ids; the ids of its rows on end, and how many each has."""
        out, width = rows.copy(), lengths.copy()
        who = np.arange(len(rows))
        while rows.shape[1] > 1 and len(who):
            rank = self.pairs.get(rows[:, :-1].ravel(), rows[:, 1:].ravel()).reshape(len(rows), -1)
            rank[np.arange(rank.shape[1])[None, :] >= (lengths - 1)[:, None]] = NO
            best = rank.argmin(axis=1)  # the leftmost of the least
            least = rank[np.arange(len(rows)), best]
            go = least < NO
            done = who[~go]
            out[done, : rows.shape[1]] = rows[~go]
            width[done] = lengths[~go]
            rows, lengths, who, best, least = rows[go], lengths[go], who[go], best[go], least[go]
            rows[np.arange(len(rows)), best] = least
            column = np.arange(rows.shape[1] - 1)[None, :]
            rows = np.where(column > best[:, None], rows[:, 1:], rows[:, :-1])
            lengths = lengths - 1
        out[who, : rows.shape[1]] = rows
        width[who] = lengths
        return out[np.arange(out.shape[1])[None, :] < width[:, None]], width

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        """All merges of one long row; a token stays at the place of its first byte."""
        self.single = self.single or self.pairs.as_dict()
        find, n = self.single.get, len(ids)
        ranks = self.pairs.get(ids[:-1], ids[1:])
        ranks[ranks == NO] = -1
        at = np.flatnonzero(ranks >= 0)
        heap = (ranks[at] << 32 | at).tolist()
        heapify(heap)
        token = array("i", ids.astype(np.int32).tobytes())
        rank = array("i", np.append(ranks, -1).astype(np.int32).tobytes())  # of the pair that begins here
        before = array("i", np.arange(-1, n - 1, dtype=np.int32).tobytes())
        after = array("i", np.arange(1, n + 1, dtype=np.int32).tobytes())
        while heap:
            key = heappop(heap)
            r, i = key >> 32, key & 0xFFFFFFFF
            if rank[i] != r:
                continue  # one of the two has been merged since
            j = after[i]
            token[i], token[j], rank[j] = r, -1, -1
            after[i] = k = after[j]
            rank[i] = -1
            if k < n:
                before[k] = i
                rank[i] = new = find(r << 32 | token[k], -1)
                if new >= 0:
                    heappush(heap, new << 32 | i)
            h = before[i]
            if h >= 0:
                rank[h] = new = find(token[h] << 32 | r, -1)
                if new >= 0:
                    heappush(heap, new << 32 | h)
        out = np.frombuffer(token, np.int32)
        return out[out >= 0]

    def pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces on end, and where each begins; bucket by bucket."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        size = np.array([len(r) for r in raw], np.int64)
        whole = np.fromiter((self.ranks.get(r, -1) for r in raw), np.int32, len(raw))  # a token itself: no merges
        order = np.argsort(size, kind="stable")
        order = np.concatenate((order[whole[order] >= 0], order[whole[order] < 0]))
        at = int((whole >= 0).sum())
        made, count = [whole[order[:at]]], np.ones(len(raw), np.int64)
        sizes = size[order]
        while at < len(order):
            if sizes[at] > LONG:  # this one and all that follow
                for i in order[at:].tolist():
                    made.append(self._merge_long(self.byte_id[np.frombuffer(raw[i], np.uint8)]))
                    count[i] = len(made[-1])
                break
            longest = size[order[at]] if size[order[at]] <= 16 else 1 << int(size[order[at]] - 1).bit_length()
            to = at + int(np.searchsorted(sizes[at:], longest, "right"))
            to = min(to, at + (1 << 19) // int(longest))
            part = order[at:to]
            flat = self.byte_id[np.frombuffer(b"".join([raw[i] for i in part]), np.uint8)]
            rows = np.zeros((len(part), int(size[part].max())), np.int32)
            rows[np.arange(rows.shape[1])[None, :] < size[part][:, None]] = flat
            ids, n = self._merge(rows, size[part])
            made.append(ids)
            count[part] = n
            at = to
        flat = np.concatenate(made)
        where = np.zeros(len(raw), np.int64)
        where[order] = np.concatenate(([0], np.cumsum(count[order])[:-1]))
        return flat[gather(where, count)], np.concatenate(([0], np.cumsum(count)))

    # -- texts

    def _chunks(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the chunks, and the number of chunks before each text."""
        space = np.zeros(256, bool)
        space[[0x20, *range(0x09, 0x0E)]] = True
        white = space[data]
        start = white.copy()
        start[1:] &= ~white[:-1]
        # other white space may belong to the run: no cut after it (some other characters of its blocks share this)
        lead = np.zeros(256, bool)
        lead[[0xC2, 0xE1, 0xE2, 0xE3, *range(0x1C, 0x20)]] = True
        near = np.flatnonzero(lead[data])
        if len(near):
            pair = data[near].astype(np.int64) << 8 | data[np.minimum(near + 1, len(data) - 1)]
            control = data[near] < 0x20
            start[np.minimum(near[control] + 1, len(data) - 1)] = False
            two = near[np.isin(pair, (0xC285, 0xC2A0))]
            three = near[np.isin(pair, (0xE19A, 0xE280, 0xE281, 0xE380))]
            for at in (two + 2, three + 3):
                start[at[at < len(data)]] = False
        rows = off[:-1]
        start[rows[rows < off[1:]]] = True
        starts = np.flatnonzero(start)
        return starts, np.searchsorted(starts, off)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and where each text begins (one entry more than texts)."""
        data, off = utf8(column)
        starts, rows = self._chunks(data, off)
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(len(off), np.int64)
        ends = np.append(starts[1:], len(data))
        # every byte counts, so a chunk is hashed as one word that begins where the chunk begins
        hashes = word_hashes(data, off, np.ones(256, bool), starts)[0]
        raw = data.tobytes()

        def learn(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            cut = [self.split(raw[a:b].decode()) for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            distinct = list(set().union(*cut))
            ids, at = self.pieces(distinct)
            number = dict(zip(distinct, range(len(distinct)), strict=True))
            piece = np.array([number[p] for c in cut for p in c], np.int64)
            n = at[piece + 1] - at[piece]
            of = np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], np.cumsum([len(c) for c in cut])))]
            return ids[gather(at[piece], n)], np.diff(of)

        at, n = self.memo.lookup(hashes, learn)
        return self.memo.ids[gather(at, n)], np.concatenate(([0], np.cumsum(n)))[rows]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids, and through `bytes_at` where each id's bytes begin."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("an id is outside the vocabulary")
        return self.flat[gather(self.start[ids], self.start[ids + 1] - self.start[ids])]

    def bytes_at(self, ids: np.ndarray) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.start[ids + 1] - self.start[ids])))

    def decimals(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each id as a space and its decimal digits, on end, and where each begins."""
        n = self.decimal_start[ids + 1] - self.decimal_start[ids]
        return self.decimal_flat[gather(self.decimal_start[ids], n)], np.concatenate(([0], np.cumsum(n)))


def _coder(path: str, pattern: str) -> ByteBPE:
    return once(f"bpe {path} {pattern}", lambda: ByteBPE(path, pattern))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every text."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, at = coder.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))], names=["doc_id", "ids"])

    return fit(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes that `ids` stand for."""
    prepare(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, pattern)
        for batch in batches:
            rows = [coder.decode(np.array(x or [], np.int64)).tobytes() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.binary())], names=["doc_id", "data"])

    return fit(tokens, doc_id="long", ids="array<int>").mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document the digests of its ids and of what they decode to.

    Encoder and decoder run in one pass, so the ids do not leave the task.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path, pattern)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                ids, at = coder.encode(part.column("text"))
                digits, digit_at = coder.decimals(ids)
                data, data_at = coder.decode(ids), coder.bytes_at(ids)
                digits, data = digits.tobytes(), data.tobytes()
                a, b = digit_at[at].tolist(), data_at[at].tolist()
                sha = [[hashlib.sha256(raw[x + skip : y]).hexdigest() for x, y in zip(e[:-1], e[1:], strict=True)]
                       for raw, e, skip in ((digits, a, 1), (data, b, 0))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(at), pa.int64()), pa.array(sha[0], pa.string()), pa.array(sha[1], pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return fit(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
