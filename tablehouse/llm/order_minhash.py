"""Operator 2: near duplicates by Order MinHash, verified by banded alignment.

Texts are sequences of lower-cased words (letters and digits).  Their k-mers are five words
in a row; the n-th occurrence of a k-mer counts as a k-mer of its own.  Each of `SKETCHES`
sketches orders the k-mers by a hash of its own, takes the `PICKS` least and keeps them in the
order of the text, so two texts share a sketch if the same k-mers are least and come in the
same order.  Texts that share one of the sketches are candidates.

Candidates are verified by alignment of their words, inserting and deleting, in a band: two
texts are near if at least `SIMILARITY` of the longer one's words align.  Such an alignment
never leaves the diagonal by more than (1 - SIMILARITY) of the longer text's words, so the
band loses nothing.  The alignment is bit-parallel, one integer operation per word.

How groups stay cheap: texts equal as word sequences are one node.  A bucket (texts with a
common sketch) is linked as a star, each text with the bucket's least node; this is what links
a large group of copies.  Texts that fail against that node make the next star, `ROUNDS` times.
Alignment distance is a metric: a left-over that is further from a star's centre than two times
the limit can't be near any text of the star.  One that is closer meets the texts of the star,
unless both are in one class by then; so do the left-overs of the last round each other.  Two
texts align in no more words than they have in common, each as often as in both, so pairs with
fewer in common than a near pair aligns are not even made.  No near pair of a bucket is left in
two classes, and no pairs within a star are made.  Classes are
the connected components, found by alternating large-star and small-star steps on tables in
the shared folder.

A pair whose k-mers overlap by j shares a sketch with a probability of about 1 - (1 - j**3)**24:
more than 99.9999 % at an overlap of 0.8, 99.9 % at 0.63 (similarity 0.95, edits spread evenly),
84 % at 0.42 (similarity 0.9); several copies of one text help each other.

Defined cases: null and word-less texts are one class; texts of fewer than five words are one
k-mer; the class id is the least doc_id of the class (nulls last; null if all are null);
repeated rows fall into one class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tablehouse.llm.common import WORD_BASE, fit, letters_digits, mix, prepare, seeded, slices, spare, stored, utf8, window_hashes, word_hashes

K, PICKS, SKETCHES, SIMILARITY, ROUNDS = 5, 3, 24, 0.8, 3
BLOCK = 256


# ---- texts -----------------------------------------------------------------------------


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of a column, and the first word of each row."""
    data, off = utf8(pc.utf8_lower(column.cast(pa.large_string())))
    return word_hashes(data, off, letters_digits())[:2]


def node_keys(hashes: np.ndarray, rows: np.ndarray) -> list[bytes]:
    """16 bytes for each row's word sequence: two hashes of the whole, each with the length."""
    n = np.diff(rows)
    out = []
    for base, salt in ((0x9E3779B97F4A7C15, 1), (0xC2B2AE3D27D4EB4F, 2)):
        place = np.arange(len(hashes), dtype=np.uint64) - np.repeat(rows[:-1], n).astype(np.uint64)
        value = mix(hashes ^ mix(place * np.uint64(base) + np.uint64(salt)))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))
        out.append(mix(sums[rows[1:]] - sums[rows[:-1]] + n.astype(np.uint64) * np.uint64(base)))
    pairs = np.stack(out, axis=1).astype(">u8")
    return [p.tobytes() for p in pairs]


def labelled(kmers: np.ndarray, row: np.ndarray) -> np.ndarray:
    """K-mer hashes that also tell the occurrence within the row."""
    own = mix(kmers ^ mix(row.astype(np.uint64) + np.uint64(77)))
    line = np.sort(own)
    twice = np.unique(line[1:][line[1:] == line[:-1]])
    out = kmers.copy()
    if len(twice):
        place = np.minimum(np.searchsorted(twice, own), len(twice) - 1)
        at = np.flatnonzero(twice[place] == own)
        order = at[np.argsort(own[at], kind="stable")]
        group = np.concatenate(([0], np.flatnonzero(np.diff(own[order].view(np.int64)) != 0) + 1))
        first = np.repeat(group, np.diff(np.concatenate((group, [len(order)]))))
        out[order] = mix(kmers[order] + (np.arange(len(order)) - first).astype(np.uint64) * np.uint64(WORD_BASE))
    return out


def sketch(kmers: np.ndarray, marked: np.ndarray, sketches: int, picks: int) -> np.ndarray:
    """The order-sensitive sketches of one text, as hashes that tell the sketch apart."""
    if not len(kmers):
        return np.empty(0, np.int64)
    odd, salt = seeded(sketches, 3) | np.uint64(1), seeded(sketches, 4)
    if len(kmers) <= picks:
        chosen = np.broadcast_to(np.arange(len(kmers)), (1, len(kmers)))
    else:
        chosen = np.empty((sketches, picks), np.int64)
        step = max(1, (1 << 21) // len(kmers))
        for a in range(0, sketches, step):
            order = (marked[None, :] ^ salt[a : a + step, None]) * odd[a : a + step, None]
            chosen[a : a + step] = np.argpartition(order, picks - 1, axis=1)[:, :picks]
        chosen.sort(axis=1)
    weight = seeded(picks, 5) | np.uint64(1)
    keys = (mix(kmers[chosen]) * weight[: chosen.shape[1]]).sum(axis=1, dtype=np.uint64)
    return mix(keys ^ salt[: len(keys)]).view(np.int64)


def _scan(k: int, picks: int, sketches: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, rows = words_of(part.column("text"))
                kmers, at = window_hashes(hashes, rows, k)
                owner = np.searchsorted(rows, at, "right") - 1
                marked = labelled(kmers, owner)
                cuts = np.searchsorted(owner, np.arange(part.num_rows + 1))
                lists = []
                for r in range(part.num_rows):
                    a, b = cuts[r], cuts[r + 1]
                    if a == b and rows[r] < rows[r + 1]:  # shorter than k: one k-mer of all its words
                        whole = window_hashes(hashes[rows[r] : rows[r + 1]], np.array([0, rows[r + 1] - rows[r]]), rows[r + 1] - rows[r])[0]
                        lists.append(sketch(whole, whole, sketches, picks))
                    else:
                        lists.append(sketch(kmers[a:b], marked[a:b], sketches, picks))
                ends = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
                flat = np.concatenate(lists) if lists else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(node_keys(hashes, rows), pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                                 names=["doc_id", "node", "sketches"])

    return run


def _word_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            hashes, rows = words_of(part.column("text"))
            low = (hashes & np.uint64(0xFFFFFFFF)).astype("<u4")
            words = [low[a:b].tobytes() for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(node_keys(hashes, rows), pa.binary()), pa.array(words, pa.binary())], names=["node", "words"])


# ---- alignment -------------------------------------------------------------------------


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Most words that align in order when no pair of them is further than `band` off the diagonal."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    if head == n:
        return n
    rest = n - head
    differ = np.flatnonzero(a[len(a) - rest :][::-1] != b[len(b) - rest :][::-1])
    tail = int(differ[0]) if len(differ) else rest
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    places: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        places[w] = places.get(w, 0) | (1 << i)
    full = (1 << len(a)) - 1
    window = (1 << (2 * band + 1)) - 1
    v = full
    for j, w in enumerate(b.tolist()):
        match = places.get(w)
        if match is None:
            continue
        match &= window << (j - band) if j >= band else window >> (band - j)
        u = v & match
        v = ((v + u) | (v - u)) & full
    return head + tail + len(a) - v.bit_count()


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far = 2 * similarity - 1  # within twice the limit: 2 * aligned >= far * (both lengths)
        for batch in batches:
            size, both = [[], []], []
            for x, y in zip(batch.column("a_words"), batch.column("b_words"), strict=True):
                x, y = (np.frombuffer(t.as_buffer(), "<u4") for t in (x, y))
                total, short = len(x) + len(y), min(len(x), len(y))
                size[0].append(len(x))
                size[1].append(len(y))
                both.append(aligned(x, y, int(total - far * total) + 1) if 2 * short >= far * total else 0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *(pa.array(c, pa.int64()) for c in (*size, both))], names=["a", "b", "na", "nb", "n"])

    return run


def verify(pairs: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) with their distance (words that don't align), `near`, and `close`: within twice the limit."""
    left = pairs.join(words.select(F.col("node").alias("a"), F.col("words").alias("a_words")), "a")
    both = left.join(words.select(F.col("node").alias("b"), F.col("words").alias("b_words")), "b")
    done = both.select("a", "b", "a_words", "b_words").mapInArrow(_verify(similarity), "a binary, b binary, na long, nb long, n long")
    return done.select("a", "b", F.col("nb").alias("words"), (F.col("na") + F.col("nb") - 2 * F.col("n")).alias("distance"),
                       (F.col("n") >= similarity * F.greatest("na", "nb")).alias("near"), (2 * F.col("n") >= (2 * similarity - 1) * (F.col("na") + F.col("nb"))).alias("close"))


def bag(words: np.ndarray) -> np.ndarray:
    """The words with the number of their occurrence, so that none comes twice; two texts have those in common that both bags hold."""
    line = np.sort(words).astype(np.uint64)
    nth = np.arange(len(line)) - np.searchsorted(line, line)
    return ((line << np.uint64(32)) | nth.astype(np.uint64)).view(np.int64)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "words"):
            lists = [bag(np.frombuffer(t.as_buffer(), "<u4")) for t in part.column("words")]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))], names=["node", "bag"])


def _may_be_near(similarity: float) -> Column:
    """Whether texts a and b (columns x_words, x_far, x_bag) can be near, by the triangle inequality and by their words.

    x_far holds the distance of x from each centre that both were held against, null where it is
    beyond twice the limit.
    """
    longer, shorter = F.greatest("a_words", "b_words"), F.least("a_words", "b_words")
    most = shorter + longer - 2 * similarity * longer
    apart = F.zip_with("a_far", "b_far", lambda x, y: F.coalesce(F.abs(x - y) <= most, F.lit(True)))
    common = F.size(F.array_intersect("a_bag", "b_bag"))
    return (shorter >= similarity * longer) & F.forall(apart, lambda ok: ok) & (common >= similarity * longer)


# ---- classes ---------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in an edge (a, b): the least node that it is connected with."""
    spark = edges.sparkSession
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        # large star: every larger neighbour goes to the least of the neighbourhood
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: the smaller neighbours and the node itself go to the least of them
        large = stored(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        now = stored(small, "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _roots_apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) whose nodes are not known to be connected."""
    of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return both.filter(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).drop("a_root", "b_root")


def connected(marks: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """(node, root) of all nodes with a near candidate; `marks`: node, sketches, one row per node."""
    keys = marks.select("node", F.explode("sketches").alias("key"))
    several = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    left = stored(keys.join(several, "key"), "buckets")
    texts = stored(words.join(left.select("node").distinct(), "node", "left_semi"), "words")
    rounds, left = [], left.withColumn("far", F.array().cast("array<long>"))
    for _ in range(ROUNDS):
        centres = left.groupBy("key").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "centre")
        rays = left.join(centres, "key").filter("node <> centre")
        judged = stored(verify(rays.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), texts, similarity), "judged")
        state = rays.join(judged.withColumnsRenamed({"a": "centre", "b": "node"}), ["centre", "node"])
        state = stored(state.withColumn("far", F.concat("far", F.array(F.when(F.col("close"), F.col("distance"))))), "stars")
        rounds.append((judged, state))
        left = state.filter("not near").select("key", "node", "far")
        if left.isEmpty():
            break
    roots = stored(components(reduce(DataFrame.unionByName, [judged.filter("near").select("a", "b") for judged, _ in rounds])), "roots")
    tried = reduce(DataFrame.unionByName, [judged.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")) for judged, _ in rounds])
    rest = stored(_open_pairs([state for _, state in rounds], roots, texts, similarity).join(tried, ["a", "b"], "left_anti"), "rest")
    return roots if rest.isEmpty() else _merged(roots, verify(rest, texts, similarity).filter("near").select("a", "b"))


def _open_pairs(rounds: list[DataFrame], roots: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of a bucket in different classes that neither a distance nor their words rule out.

    Left-overs of the last round meet each other; those close to a star meet its texts.  A large star
    is met by blocks of `BLOCK` left-overs, as its rows carry bags and should not be split by bytes.
    """
    star, what = ["round", "key", "centre"], ["node", "words", "far", "root"]
    every = reduce(DataFrame.unionByName, [state.withColumn("round", F.lit(i)) for i, state in enumerate(rounds)]).withColumn("root", F.lit(None).cast("binary"))
    close = every.filter("not near and close").withColumnsRenamed({"centre": "a", "node": "b"})
    loose = _roots_apart(close, roots).withColumnsRenamed({"a": "centre", "b": "node"}).select(*star, *what)
    over = rounds[-1].filter("not near").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    over = over.withColumns({"round": F.lit(len(rounds)), "centre": F.lit(bytearray())}).select(*star, *what)
    loose = stored(loose.unionByName(over), "loose")
    blocks = loose.groupBy(star).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    every = every.filter("near").select(*star, *what).unionByName(loose.filter(F.col("round") == len(rounds)))
    inner = stored(every.join(blocks, star), "inner")
    met = loose.select("node").unionByName(inner.select("node")).distinct()
    bags = stored(texts.join(met, "node", "left_semi").mapInArrow(_bags, "node binary, bag array<long>"), "bags")
    outer = loose.join(blocks, star).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    held = inner.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = [*star, "block"]

    def side(frame: DataFrame, x: str) -> DataFrame:
        names = {"node": x, **{c: f"{x}_{c}" for c in ("words", "far", "root", "bag", *group)}}
        return frame.join(bags.hint("merge"), "node").select(*names).withColumnsRenamed(names).repartition(*[f"{x}_{c}" for c in group])

    same = reduce(Column.__and__, [F.col(f"a_{c}") == F.col(f"b_{c}") for c in group])
    apart = F.col("a_root").isNull() | ((F.col("a") < F.col("b")) & (F.col("a_root") != F.col("b_root")))
    pairs = side(outer, "a").join(side(held, "b"), same & apart & _may_be_near(similarity))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _merged(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) after further edges."""
    of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    lifted = edges.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    above = stored(components(lifted), "roots")
    alone = above.join(roots, "node", "left_anti").select("node", F.col("node").alias("root"))
    every = roots.unionByName(alone).join(above.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    return every.select("node", F.coalesce("top", "root").alias("root"))


def classes(docs: DataFrame, similarity: float = SIMILARITY, k: int = K, picks: int = PICKS, sketches: int = SKETCHES) -> DataFrame:
    """doc_id, node (16 bytes that stand for the words), class_id and n_class of every row."""
    prepare(docs.sparkSession)
    texts = fit(docs, doc_id="long", text="string")
    marks = stored(texts.mapInArrow(_scan(k, picks, sketches), "doc_id long, node binary, sketches array<long>"), "sketches")
    words = texts.select("text").mapInArrow(_word_scan, "node binary, words binary").dropDuplicates(["node"])
    found = connected(marks.dropDuplicates(["node"]).select("node", "sketches"), words, similarity)
    rows = marks.select("doc_id", "node").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = stored(rows.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n_class")), "classes")
    return rows.join(ids, "root").select("doc_id", "node", "root", "class_id", "n_class")


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """`docs`, all columns, with one row of each class: of least doc_id, then node; a null id only if there is no other."""
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    own, kept, kept_id = spare(docs, "own_node"), spare(docs, "kept_node"), spare(docs, "kept_id")
    best = classes(docs, **settings).groupBy("root").agg(F.min(rank).alias("b")).select(F.col("b.doc_id").alias(kept_id), F.col("b.node").alias(kept))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                keys = node_keys(*words_of(part.column("text")))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys, pa.binary())], names=[*part.schema.names, own])

    marked = docs.mapInArrow(add, StructType([*docs.schema.fields, StructField(own, BinaryType())]))
    same = (F.col(own) == F.col(kept)) & F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id))
    return marked.join(best, same).dropDuplicates([kept, kept_id]).select(*[F.col(f"`{c}`") for c in docs.columns])
