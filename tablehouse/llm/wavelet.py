"""Operator 1: token ids in wavelet-matrix shards.

Documents are dealt by ranges of doc_id, so shard order is document order.  Each task encodes
its documents and closes a shard when it holds `SHARD_TOKENS` ids; a document stays whole, so
a longer one makes a longer shard.  A shard is one row of a Parquet file written by Spark
(its committer keeps one copy of every shard, whatever tasks are lost or run twice):

    shard     long    number of the range * 2**32 + place in it: ascending, not dense
    ids       binary  doc_id of each document, 8 bytes little-endian; `null_ids` flags the nulls
    lengths   binary  number of ids of each document, 8 bytes
    n         long    number of ids
    planes    array<binary>  a plane of bits for each bit of an id, the highest first;
                      the order of a plane is that of the one before, zeros before ones
    ranks     array<binary>  for each plane the number of ones before each block of 512 bits
    zeros     array<long>    the number of zeros of each plane

The planes are packed by the file's zstd.  `Shard` answers access, rank, select, count and
occurrences from the planes alone; `sequence` restores all ids in one sweep from the lowest
plane upwards.

Defined cases: null texts are encoded as empty and consist of the end id; equal doc_ids and
repeated rows are kept, in order of their text; null doc_ids come first; an empty table gives
no shard and an empty result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablehouse.llm.common import Memo, fit, gather, not_space, once, prepare, scratch, slices, utf8, word_hashes

END_ID = 2
SHARD_TOKENS = 1 << 20
BLOCK = 512
SCHEMA = "shard long, n long, ids binary, null_ids binary, lengths binary, planes array<binary>, ranks array<binary>, zeros array<long>"


# ---- a shard ---------------------------------------------------------------------------


def planes_of(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[int]]:
    """The planes, block ranks and zero counts of a sequence of ids."""
    depth = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    now = ids.astype(np.uint16 if depth <= 16 else np.uint32)
    planes, ranks, zeros = [], [], []
    for bit in range(depth - 1, -1, -1):
        ones = (now & now.dtype.type(1 << bit)) != 0
        packed = np.packbits(ones, bitorder="little")
        planes.append(packed.tobytes())
        full = np.zeros(-(-len(packed) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
        full[: len(packed)] = packed
        count = np.bitwise_count(full.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.int64)
        ranks.append(np.concatenate(([0], np.cumsum(count))).astype(np.int64).tobytes())
        low = now[np.flatnonzero(~ones)]  # by place: faster than by flags where these are mixed
        zeros.append(len(low))
        now = np.concatenate((low, now[np.flatnonzero(ones)]))
    return planes, ranks, zeros


class Shard:
    """Queries on the planes of one shard."""

    def __init__(self, n: int, planes: list[bytes], ranks: list[bytes], zeros: list[int]):
        self.n, self.zeros, self.depth = n, zeros, len(planes)
        self.planes = [np.frombuffer(p, np.uint8) for p in planes]
        self.ranks = [np.frombuffer(r, np.int64) for r in ranks]

    def bit(self, plane: int, at: int) -> int:
        return int(self.planes[plane][at >> 3] >> (at & 7) & 1)

    def ones(self, plane: int, at: int) -> int:
        """Ones before position `at` of a plane."""
        block = at // BLOCK
        part = self.planes[plane][block * (BLOCK // 8) : (at + 7) // 8]
        count = int(np.bitwise_count(part).sum())
        if at & 7 and len(part):
            count -= (int(part[-1]) >> (at & 7)).bit_count()
        return int(self.ranks[plane][block]) + count

    def _find(self, plane: int, k: int, one: bool) -> int:
        """Position of the k-th (from 0) one or zero of a plane."""
        ranks = self.ranks[plane]
        before = ranks if one else np.minimum(np.arange(len(ranks)) * BLOCK, self.n) - ranks
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self.planes[plane][block * (BLOCK // 8) : (block + 1) * (BLOCK // 8)], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == one)[k - int(before[block])])

    def access(self, at: int) -> int:
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for p in range(self.depth):
            one = self.bit(p, at)
            value = value << 1 | one
            before = self.ones(p, at)
            at = self.zeros[p] + before if one else at - before
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        if token >> self.depth or token < 0:
            return 0, 0
        for p in range(self.depth):
            a, b = self.ones(p, lo), self.ones(p, hi)
            lo, hi = (self.zeros[p] + a, self.zeros[p] + b) if token >> (self.depth - 1 - p) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, at: int) -> int:
        """How often `token` occurs before position `at`."""
        lo, hi = self._range(token, 0, at)
        return hi - lo

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        lo, hi = self._range(token, lo, self.n if hi is None else hi)
        return hi - lo

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of `token`."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        at = lo + k
        for p in range(self.depth - 1, -1, -1):
            one = bool(token >> (self.depth - 1 - p) & 1)
            at = self._find(p, at - self.zeros[p] if one else at, one)
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def sequence(self) -> np.ndarray:
        """All ids in their order."""
        kind = np.uint16 if self.depth <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for p in range(self.depth - 1, -1, -1):
            ones = np.unpackbits(self.planes[p], count=self.n, bitorder="little").view(bool)
            up = np.empty_like(now)
            up[~ones] = now[: self.zeros[p]]
            up[ones] = now[self.zeros[p] :] | kind(1 << (self.depth - 1 - p))
            now = up
        return now


# ---- encoding --------------------------------------------------------------------------


class Words:
    """A tokenizers file applied to whole texts, each distinct word once per memo.

    The file's pattern drops white space and treats what stands between as separate words, so
    a text may be cut there.  New words go to the library many at a time, set apart by the
    end-of-text token, which it finds before anything else.  Texts that hold the string of a special
    token themselves go to the library as they are, each on its own.  ASCII letters are lower-cased
    beforehand, as the file does, unless what follows might be a combining mark.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.plain, self.marked = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.special = sorted((t.content, i) for i, t in self.plain.get_added_tokens_decoder().items())
        self.begin = os.path.commonprefix([mark for mark, _ in self.special])  # one search for all of them
        self.lower = np.arange(256, dtype=np.uint8)
        if "Lowercase" in self.plain.to_str():
            self.lower[65:91] += 32
        self.memo = Memo()

    def _apart(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words on end, and the number of each."""
        mark, mark_id = self.special[0]
        mine = [s.encode() for s, _ in self.special]
        odd = [i for i, w in enumerate(words) if b"<" in w and any(m in w for m in mine)]
        texts = [w.decode() for w in words]
        for i in odd:
            texts[i] = ""
        lines = [mark.join([*texts[i : i + 512], ""]) for i in range(0, len(texts), 512)]
        ids = np.concatenate([np.array(e.ids, np.int32) for e in self.marked.encode_batch_fast(lines, add_special_tokens=False)])
        ends = np.flatnonzero(ids == mark_id)
        counts = np.diff(np.concatenate(([-1], ends))) - 1
        assert len(ends) == len(words)
        ids = np.delete(ids, ends)
        if odd:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i in odd:
                parts[i] = np.array(self.plain.encode(words[i].decode(), add_special_tokens=False).ids, np.int32)
            ids, counts = np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, counts

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, each followed by `end_id`, and the number of each."""
        held = np.array(pc.match_substring(column, self.begin).fill_null(False).to_numpy(zero_copy_only=False))
        for i in np.flatnonzero(held):
            held[i] = any(mark in column[i].as_py() for mark, _ in self.special)
        if not held.any():
            return self._ordinary(column, end_id)
        ids, n = self._ordinary(pc.if_else(pa.array(held), pa.scalar("", column.type), column), end_id)
        parts = np.split(ids, np.cumsum(n)[:-1])
        for i in np.flatnonzero(held):
            parts[i] = np.array([*self.marked.encode(column[i].as_py(), add_special_tokens=False).ids, end_id], np.int32)
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def _ordinary(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without strings of special tokens; such strings that lower-casing makes are ordinary text."""
        data, off = utf8(column)
        if len(data):
            low = self.lower[data]
            mark = np.flatnonzero(data[1:] >= 0xCC)  # what comes before a possible combining mark stays
            low[mark] = data[mark]
            data = low
        hashes, rows, starts, ends = word_hashes(data, off, not_space())
        raw = data.tobytes()
        at, n = self.memo.lookup(hashes, lambda first: self._apart([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]))
        ids = self.memo.ids[gather(at, n)]
        upto = np.concatenate(([0], np.cumsum(n)))[rows[1:]]
        return np.insert(ids, upto, end_id), np.diff(np.concatenate(([0], upto))) + 1


def _shard_row(number: int, ids: list[np.ndarray], docs: list, lengths: list[np.ndarray]) -> dict:
    flat = np.concatenate(ids)
    planes, ranks, zeros = planes_of(flat)
    return {"shard": number, "n": len(flat), "ids": np.array([d or 0 for d in docs], "<i8").tobytes(),
            "null_ids": np.packbits([d is None for d in docs]).tobytes() if None in docs else b"",
            "lengths": np.concatenate(lengths).astype("<i8").tobytes(), "planes": planes, "ranks": ranks, "zeros": zeros}


def write_shards(docs: DataFrame, path: str, folder: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode the documents in ascending doc_id order into shards below `folder`."""
    spark = prepare(docs.sparkSession)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = fit(docs, doc_id="long", text="string").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    kind = pa.schema([("shard", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("null_ids", pa.binary()), ("lengths", pa.binary()),
                      ("planes", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())), ("zeros", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = once(f"words {path}", lambda: Words(path))
        number = TaskContext.get().partitionId() << 32
        ids, names, lengths, held = [], [], [], 0
        for batch in batches:
            for part in slices(batch, "text", min(1 << 20, shard_tokens)):
                got, n = coder.encode(part.column("text"), end_id)
                ids.append(got.astype(np.uint16 if not len(got) or got.max() < 1 << 16 else np.int32))
                names += part.column("doc_id").to_pylist()
                lengths.append(n)
                held += len(got)
                if held >= shard_tokens:
                    yield pa.RecordBatch.from_pylist([_shard_row(number, ids, names, lengths)], kind)
                    number, ids, names, lengths, held = number + 1, [], [], [], 0
        if names:
            yield pa.RecordBatch.from_pylist([_shard_row(number, ids, names, lengths)], kind)

    ordered.mapInArrow(run, SCHEMA).write.option("compression", "zstd").parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(spark).read.schema(SCHEMA).parquet(folder)


def starts(shards: DataFrame) -> DataFrame:
    """For each shard the number of ids in all shards before.

    Running totals over the shards of a range and over ranges; the latter are as many rows as
    the writing job had partitions.
    """
    counts = shards.select("shard", "n").withColumn("range", F.shiftright("shard", 32))
    total = counts.groupBy("range").agg(F.sum("n").alias("of_range"))
    before = total.select("range", (F.sum("of_range").over(Window.orderBy("range")) - F.col("of_range")).alias("ranges_before"))
    inside = counts.select("shard", "range", (F.sum("n").over(Window.partitionBy("range").orderBy("shard")) - F.col("n")).alias("shards_before"))
    return inside.join(before, "range").select("shard", (F.col("ranges_before") + F.col("shards_before")).alias("shard_start"))


def documents(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and CRC-32 of the ids (4 bytes little-endian each), from the planes.

    The planes are read where they lie; only what is known of each document moves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda c, row=row: batch.column(c)[row].as_py()
                shard = Shard(get("n"), get("planes"), get("ranks"), get("zeros"))
                ids = shard.sequence().astype("<u4")
                lengths, names = np.frombuffer(get("lengths"), "<i8"), np.frombuffer(get("ids"), "<i8")
                ends = np.cumsum(lengths)
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * (b - n) : 4 * b]) for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                nulls = np.unpackbits(np.frombuffer(get("null_ids"), np.uint8), count=len(names)).astype(bool) if get("null_ids") else None
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(names), get("shard"))), pa.array(names, pa.int64(), mask=nulls), pa.array(ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    found = shards.mapInArrow(run, "shard long, doc_id long, start long, n_tokens long, ids_crc32 long")
    return found.join(starts(shards), "shard").select("doc_id", (F.col("start") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Write the shards to the shared folder, read them back and report every document."""
    folder = scratch(docs.sparkSession, "wavelet")
    write_shards(docs, path, folder, end_id)
    return documents(read_shards(docs.sparkSession, folder))
