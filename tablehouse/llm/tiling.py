"""Operator 10: benchmark decontamination by greedy string tiling.

Documents and benchmark items are sequences of lower-cased words.  Karp-Rabin hashes of every
`k` consecutive words find the seeds that a document shares with an item.  Only seeds at which
a common stretch begins (the words before them differ) are listed; running hashes say how long
each stretch is.  So two runs of one repeated word give a stretch per place, not one per pair
of places.  For each document and item with a common seed, the longest unmarked match is
marked again and again until none of at least `k` words is left; tiles never overlap, in the
document nor in the item, and are compared word by word.  The share of an item's words that
lie in tiles is its coverage, whatever the order of the tiles.

The benchmark is the query set.  It is held against all documents in blocks: items are dealt to
buckets by a hash, and buckets are put together up to `BLOCK_WORDS` words, so what is sent to
the tasks has a bound (but for a single item that is longer); a larger benchmark takes more
blocks.  Documents are not shuffled, and each is read whole in one task.

Defined cases: null texts and items are empty and match nothing; items of fewer than `k`
words can't be tiled and are never reported; a document that holds an item several times is
reported once, repeated rows once each; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehouse.llm.common import WORD_BASE, Powers, fit, gather, letters_digits, once, prepare, slices, utf8, window_hashes, word_hashes

K, COVERAGE, BLOCK_WORDS = 5, 0.5, 2_000_000
STARTS = 1 << 20  # stretches looked at together; those of one document stay together
SCHEMA = "doc_id long, item_id long, item_words long, covered long, coverage double, tiles array<struct<item_word:int,doc_word:int,words:int>>"


@dataclass
class Items:
    ids: list
    words: np.ndarray  # hashes, item after item
    rows: np.ndarray  # first word of each item
    sums: np.ndarray  # running hashes of `words`
    seeds: np.ndarray  # distinct, sorted
    bounds: np.ndarray  # where the places of each seed begin
    prior: np.ndarray  # distinct words before a seed, sorted
    codes: np.ndarray  # of each place: seed and word before it, sorted
    place: np.ndarray  # first words
    sieve: np.ndarray


def _lower_words(column: pa.Array):
    data, off = utf8(pc.utf8_lower(column.cast(pa.large_string())))
    hashes, rows, _, _ = word_hashes(data, off, letters_digits())
    return hashes, rows


def _running(hashes: np.ndarray) -> np.ndarray:
    up, _ = once("word_powers", lambda: Powers(WORD_BASE)).upto(len(hashes) + 1)
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=out[1:])
    return out


def _common(x: np.ndarray, i: np.ndarray, y: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words are the same from place i and place j on, at most `most`; from running hashes x and y."""
    _, down = once("word_powers", lambda: Powers(WORD_BASE)).upto(max(len(x), len(y)))
    low, high = np.zeros(len(i), np.int64), most.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        a, b, mid = i[open_], j[open_], (low[open_] + high[open_] + 1) // 2
        same = (x[a + mid] - x[a]) * down[a] == (y[b + mid] - y[b]) * down[b]
        low[open_[same]] = mid[same]
        high[open_[~same]] = mid[~same] - 1
        open_ = open_[low[open_] < high[open_]]
    return low


def _before(hashes: np.ndarray, rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before each place, and which places begin a row and have none."""
    first = np.zeros(len(hashes) + 1, bool)
    first[rows[:-1]] = True
    return hashes[np.maximum(at - 1, 0)], first[at]


def items_of(ids: list, texts: list, k: int) -> Items:
    hashes, rows = _lower_words(pa.array(texts, pa.large_string()))
    windows, at = window_hashes(hashes, rows, k)
    word, none = _before(hashes, rows, at)
    prior = np.unique(word[~none])
    number = np.where(none, 0, np.searchsorted(prior, word) + 1)
    seeds, group = np.unique(windows, return_inverse=True)
    codes = group * (len(prior) + 1) + number
    order = np.argsort(codes, kind="stable")
    sieve = np.zeros(1 << 20, bool)
    sieve[seeds & np.uint64((1 << 20) - 1)] = True
    bounds = np.concatenate(([0], np.cumsum(np.bincount(group, minlength=len(seeds))))).astype(np.int64)
    return Items(ids, hashes, rows, _running(hashes), seeds, bounds, prior, codes[order], at[order], sieve)


def _greedy(doc: np.ndarray, item: np.ndarray, i: np.ndarray, j: np.ndarray, n: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Tiles (i, j, words), longest first, from maximal matches of n words at item word i and document word j.

    Ties go to the match that begins first in the item, then in the document.
    """
    heap = list(zip((-n).tolist(), i.tolist(), j.tolist(), strict=True))
    heapq.heapify(heap)
    in_item, in_doc, out, left = np.zeros(len(item), bool), np.zeros(len(doc), bool), [], len(item)
    while heap and left >= k:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = ~(in_item[a : a + n] | in_doc[b : b + n]) & (item[a : a + n] == doc[b : b + n])
        if free.all():
            in_item[a : a + n] = in_doc[b : b + n] = True
            out.append((a, b, n))
            left -= n
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([0], free, [0]))))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if e - s >= k:
                heapq.heappush(heap, (s - e, a + s, b + s))
    return out


def tiles(doc: np.ndarray, item: np.ndarray, i: np.ndarray, j: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of two sequences from seed matches (item word i, document word j)."""
    start = (i == 0) | (j == 0) | (item[i - 1] != doc[j - 1])
    i, j = i[start], j[start]
    n = _common(_running(item), i, _running(doc), j, np.minimum(len(item) - i, len(doc) - j))
    return _greedy(doc, item, i, j, n, k)


def _rows(items: Items, batch: pa.RecordBatch, k: int, least: float) -> Iterator[tuple[int, dict]]:
    """(row of the batch, finding) for each item that a document covers."""
    hashes, rows = _lower_words(batch.column("text"))
    windows, at = window_hashes(hashes, rows, k)
    at = at[maybe := np.flatnonzero(items.sieve[windows & np.uint64((1 << 20) - 1)])]
    if not len(at):
        return
    group = np.minimum(np.searchsorted(items.seeds, windows[maybe]), len(items.seeds) - 1)
    known = items.seeds[group] == windows[maybe]
    at, group = at[known], group[known]
    # places of the seed but those with the same word before it: there the stretch began earlier
    word, none = _before(hashes, rows, at)
    number = np.searchsorted(items.prior, word)
    other = none.copy()
    if len(items.prior):
        other |= items.prior[np.minimum(number, len(items.prior) - 1)] != word
    else:
        other[:] = True
    left, right = items.bounds[group], items.bounds[group + 1]
    code = group * (len(items.prior) + 1) + number + 1
    cut, back = np.searchsorted(items.codes, code, "left"), np.searchsorted(items.codes, code, "right")
    cut, back = np.where(other, left, cut), np.where(other, left, back)
    total = (cut - left) + (right - back)
    row = np.searchsorted(rows, at, "right") - 1
    ends = np.cumsum(np.bincount(row, total, len(rows) - 1)).astype(np.int64)
    running, first = _running(hashes), 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + STARTS, "right")))
        some = slice(*np.searchsorted(row, (first, last)))
        first = last
        place = items.place[np.concatenate((gather(left[some], (cut - left)[some]), gather(back[some], (right - back)[some])))]
        word = np.concatenate((np.repeat(at[some], (cut - left)[some]), np.repeat(at[some], (right - back)[some])))
        if len(word):
            yield from _covered(items, batch, hashes, rows, running, word, place, k, least)


def _covered(items: Items, batch: pa.RecordBatch, hashes: np.ndarray, rows: np.ndarray, running: np.ndarray,
             word: np.ndarray, place: np.ndarray, k: int, least: float) -> Iterator[tuple[int, dict]]:
    """Findings from the beginnings of common stretches: word of the batch, word of the block."""
    row, owner = np.searchsorted(rows, word, "right") - 1, np.searchsorted(items.rows, place, "right") - 1
    n = _common(items.sums, place, running, word, np.minimum(items.rows[owner + 1] - place, rows[row + 1] - word))
    order = np.lexsort((owner, row))
    row, owner, place, word, n = row[order], owner[order], place[order], word[order], n[order]
    cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(owner) != 0)) + 1
    heads, tails = np.concatenate(([0], cut)), np.concatenate((cut, [len(row)]))
    size = (items.rows[1:] - items.rows[:-1])[owner[heads]]
    enough = np.add.reduceat(n, heads) >= least * size  # even apart from each other, the others cover too little
    ids = batch.column("doc_id")
    for a, b, n_item in zip(heads[enough].tolist(), tails[enough].tolist(), size[enough].tolist(), strict=True):
        r, o = int(row[a]), int(owner[a])
        found = _greedy(hashes[rows[r] : rows[r + 1]], items.words[items.rows[o] : items.rows[o + 1]],
                        place[a:b] - items.rows[o], word[a:b] - rows[r], n[a:b], k)
        covered = sum(m for _, _, m in found)
        if covered >= least * n_item:
            yield r, {"doc_id": ids[r].as_py(), "item_id": items.ids[o], "item_words": n_item, "covered": covered, "coverage": covered / n_item,
                      "tiles": [{"item_word": x, "doc_word": y, "words": m} for x, y, m in found]}


def _blocks(benchmark: DataFrame, k: int) -> Iterator[Items]:
    """The benchmark in blocks of bounded size; its words are counted as the tiling cuts them."""
    n_words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))
    sized = fit(benchmark, item_id="long", text="string").withColumn("n", n_words.cast("long"))
    total = sized.agg(F.sum("n").alias("n")).first().n or 0
    buckets = 4 * (total // BLOCK_WORDS) + 1
    sized = sized.withColumn("bucket", F.pmod(F.xxhash64("item_id", "text"), F.lit(buckets)))
    blocks, filled = [[]], 0
    for r in sized.groupBy("bucket").agg(F.sum("n").alias("n")).orderBy("bucket").collect():
        if blocks[-1] and filled + r.n > BLOCK_WORDS:
            blocks.append([])
            filled = 0
        blocks[-1].append(r.bucket)
        filled += r.n
    for block in blocks:
        got = sized.filter(F.col("bucket").isin(block)).select("item_id", "text").collect()
        yield items_of([r.item_id for r in got], [r.text for r in got], k)


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = K, least: float = COVERAGE) -> DataFrame:
    """A row per document and benchmark item whose coverage reaches `least`, with the tiles."""
    spark = prepare(docs.sparkSession)
    texts, out = fit(docs, doc_id="long", text="string"), None
    for items in _blocks(benchmark, k):
        shared = spark.sparkContext.broadcast(items)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tile = pa.struct([("item_word", pa.int32()), ("doc_word", pa.int32()), ("words", pa.int32())])
            schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int64()), ("covered", pa.int64()),
                                ("coverage", pa.float64()), ("tiles", pa.list_(tile))])
            for batch in batches:
                for part in slices(batch, "text"):
                    yield pa.RecordBatch.from_pylist([r for _, r in _rows(shared.value, part, k, least)], schema)

        found = texts.mapInArrow(scan, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, k: int = K, least: float = COVERAGE) -> DataFrame:
    """`docs`, all columns, without the rows whose text covers an item; no shuffle."""
    spark = prepare(docs.sparkSession)
    for items in _blocks(benchmark, k):
        shared = spark.sparkContext.broadcast(items)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    keep = np.ones(part.num_rows, bool)
                    keep[[i for i, _ in _rows(shared.value, part, k, least)]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(scan, docs.schema)
    return docs
