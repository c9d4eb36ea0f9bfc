"""Shared helpers: vectorised word and window hashes, batches, intermediate tables.

Hashes are 64 bit: among n different items one collision is expected with probability
n*n / 2**65 (5e-4 for the 135 million windows of a 0.5 GB table).
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tablehouse.session import scratch, tune

M64 = (1 << 64) - 1
CHUNK_BYTES = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that the operators rely on: small Arrow batches bound a worker's memory."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(key: str, make: Callable):
    """A value made once per Python worker process, however many tasks it runs."""
    kept = sys.modules.setdefault("_tablehouse_llm_kept", types.ModuleType("_tablehouse_llm_kept"))
    if not hasattr(kept, key):
        setattr(kept, key, make())
    return getattr(kept, key)


# ---- numbers ---------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit integers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse, self.n = base, pow(base, -1, 1 << 64), 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            most = max(n, 1 << 16, min(2 * self.n, CHUNK_BYTES))
            # a task that is stopped here must not leave a count without its powers to the next one
            self.up, self.down = _powers(self.base, most), _powers(self.inverse, most)
            self.n = most
        return self.up, self.down


BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def seeded(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random unsigned 64-bit integers."""
    with np.errstate(over="ignore"):
        return mix(mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(BYTE_BASE) + np.uint64(seed)))


# ---- texts -----------------------------------------------------------------------------


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column (null: empty) and where each row begins; n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return flat[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most `most` bytes of text together; a longer row comes alone."""
    _, off = utf8(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def byte_runs(data: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes for which `inside` holds, cut at row borders."""
    ok = inside[data]
    first, last = ok.copy(), ok.copy()
    first[1:] &= ~ok[:-1]
    last[:-1] &= ~ok[1:]
    rows = off[1:-1]
    rows = rows[(rows > 0) & (rows < len(data))]
    first[rows] = ok[rows]
    last[rows - 1] = ok[rows - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def letters_digits() -> np.ndarray:
    """Byte classes of normalised words: ASCII letters and digits and every byte above 127."""
    inside = np.zeros(256, bool)
    inside[128:] = True
    for a, b in ((48, 58), (65, 91), (97, 123)):
        inside[a:b] = True
    return inside


def not_space() -> np.ndarray:
    """Byte classes of plain words: all but space and the control characters 9 to 13."""
    inside = np.ones(256, bool)
    inside[[0x20, *range(0x09, 0x0E)]] = False
    return inside


def word_hashes(data: np.ndarray, off: np.ndarray, inside: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash of each word, first word of each row (n + 1 of them), byte starts and ends.

    Words are the runs of `inside`, or, where `starts` is given, what lies between two starts.
    """
    starts, ends = byte_runs(data, off, inside) if starts is None else (starts, np.append(starts[1:], len(data)))
    up, down = once("byte_powers", lambda: Powers(BYTE_BASE)).upto(len(data))
    if len(starts):
        value = seeded(256, 11)
        value[~inside] = 0
        value = value[data]
        value *= up[: len(data)]
        sums = np.add.reduceat(value, starts)
        hashes = mix(sums * down[starts])
    else:
        hashes = np.empty(0, np.uint64)
    return hashes, np.searchsorted(starts, off), starts, ends


def window_hashes(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of every k consecutive words of a row, and their first words."""
    n = len(hashes)
    if n < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    up, down = once("word_powers", lambda: Powers(WORD_BASE)).upto(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    at = np.arange(n - k + 1)
    left = np.repeat(rows[1:], np.diff(rows))[: n - k + 1]  # end of the row that a word belongs to
    at = at[at + k <= left]
    return mix((sums[at + k] - sums[at]) * down[at]), at


def gather(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The indexes start[i] .. start[i] + n[i] - 1 of all i, one after the other."""
    some = np.flatnonzero(n)
    if not len(some):
        return np.empty(0, np.int64)
    s, m = start[some], n[some]
    step = np.ones(int(m.sum()), np.int64)
    step[0] = s[0]
    step[np.cumsum(m)[:-1]] = s[1:] - s[:-1] - m[:-1] + 1
    return np.cumsum(step)


class Memo:
    """Ids of the words seen so far, by the word's hash; open addressing in numpy arrays."""

    SLOTS, MOST = 1 << 21, 900_000

    def __init__(self):
        self.forget()

    def forget(self, slots: int = SLOTS) -> None:
        self.slots, self.keys, self.value, self.n = slots, np.zeros(slots, np.uint64), np.zeros(slots, np.int32), 0
        self.ids, self.at = np.empty(1 << 16, np.int32), np.zeros(1 << 14, np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, -1 for unknown ones."""
        mask = np.uint64(self.slots - 1)
        slot = (hashes & mask).astype(np.int64)
        held = self.keys[slot]
        out = np.where(held == hashes, self.value[slot], -1)
        again = np.flatnonzero((held != hashes) & (held != 0))
        while len(again):
            slot[again] = (slot[again] + 1) & (self.slots - 1)
            held = self.keys[slot[again]]
            hit = held == hashes[again]
            out[again[hit]] = self.value[slot[again[hit]]]
            again = again[~hit & (held != 0)]
        return out

    def add(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """New, distinct words with their ids on end."""
        end = int(self.at[self.n])
        while end + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        while self.n + len(hashes) + 1 > len(self.at):
            self.at = np.concatenate((self.at, np.zeros_like(self.at)))
        self.ids[end : end + len(ids)] = ids
        self.at[self.n + 1 : self.n + 1 + len(hashes)] = end + np.cumsum(counts)
        todo, value = hashes, np.arange(self.n, self.n + len(hashes), dtype=np.int32)
        slot = (todo & np.uint64(self.slots - 1)).astype(np.int64)
        while len(todo):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = todo[free]  # of several for one slot, the last one gets it
            mine = self.keys[slot] == todo
            self.value[slot[mine]] = value[mine]
            todo, value, slot = todo[~mine], value[~mine], (slot[~mine] + 1) & (self.slots - 1)
        self.n += len(hashes)

    def lookup(self, hashes: np.ndarray, learn: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Where each word's ids begin in `ids`, and how many; `learn(first places)` gives the ids of new words."""
        hashes = np.where(hashes == 0, np.uint64(1), hashes)
        if self.n > self.MOST:
            self.forget()
        word = self.find(hashes)
        new = np.flatnonzero(word < 0)
        if len(new):
            fresh, first = np.unique(hashes[new], return_index=True)
            if self.n + len(fresh) > self.slots // 2:  # a very long row: start anew with room for it
                self.forget(max(self.SLOTS, 4 << int(len(fresh)).bit_length()))
                return self.lookup(hashes, learn)
            self.add(fresh, *learn(new[first]))
            word[new] = self.find(hashes[new])
        return self.at[word], self.at[word + 1] - self.at[word]


def spare(df: DataFrame, name: str) -> str:
    """`name`, or it with underscores, so that no column of `df` has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def fit(df: DataFrame, **kinds: str) -> DataFrame:
    """The named columns cast to what an operator works on; other columns are left out."""
    from pyspark.sql import functions as F

    return df.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in kinds.items()])
