"""Operator 9: SpotSigs fingerprints.

A signature is an anchor (a very common word) with the `CHAIN` content words that follow it,
common words between them skipped.  To fixed lists of four languages, `common_words` adds the
words that most documents of a language (without one: of a source) hold, counted over all
documents.  With these lists every `CHAIN` consecutive words are a signature, too, where no
anchor stands in the `GAP` words before.  The set of a text's signatures is its fingerprint, written
as 10 hexadecimal digits each, ascending.  The likeness of two fingerprints is the Jaccard
overlap of the sets.

`near_pairs` finds all pairs of at least a given likeness: sets fall into partitions by their
length, a set meets only its own partition and the next, there only through the signatures of
its prefix (rarest first), and the lengths bound the overlap before it is counted.

`neighbours` compares every document with an edited copy of itself and with the document of
the next doc_id.  Documents are dealt by ranges of doc_id and move once; a range's last
document meets the first of the next range in a second, small step (two rows per range).

Defined cases: null texts are empty; a text without a signature (with the lists of `common_words`: of
fewer than `CHAIN` words) has one signature for all its words, so equal texts have equal fingerprints and likeness 1, other such texts 0; equal
doc_ids and repeated rows follow each other in order of text; null doc_ids come first; a
single document is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from functools import partial
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablehouse.llm.common import fit, letters_digits, mix, prepare, seeded, slices, utf8, word_hashes

CHAIN, GAP = 3, 12
# derived lists: words in at least this share of a group's documents, groups of at least so many documents, words a group, words in all
SHARE, LEAST, ANCHORS_EACH, COMMON_EACH, WORDS_ALL = 0.2, 50, 8, 24, 1 << 14
# fixed values: anchors, and further common words that are no content, of four languages
ANCHORS = "the a an is was are that le la les une est der die das ist ein eine el los un es una".split()
COMMON = ("of and to in for on with at by it be as or from this have not but they you we des de du et en au pour dans que qui sur avec par pas il "
          "und zu den dem des im von mit auf für sich nicht auch als an y que del por con para se no su al lo como más").split()


def _fixed(words: list[str]) -> np.ndarray:
    data, off = utf8(pa.array(sorted(set(words)), pa.large_string()))
    return np.sort(word_hashes(data, off, letters_digits())[0])


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each group hold a word, a batch at a time."""
    for batch in batches:
        for part in slices(batch, "text"):
            data, off = utf8(pc.utf8_lower(part.column("text").cast(pa.large_string())))
            hashes, rows, _, _ = word_hashes(data, off, letters_digits())
            row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
            order = np.lexsort((hashes, row))
            row, hashes = row[order], hashes[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
            groups = part.column("place").dictionary_encode()
            code, hashes = groups.indices.to_numpy(zero_copy_only=False)[row[new]], hashes[new]
            order = np.lexsort((hashes, code))
            code, hashes = code[order], hashes[order]
            new = np.ones(len(code), bool)
            new[1:] = (code[1:] != code[:-1]) | (hashes[1:] != hashes[:-1])
            first = np.flatnonzero(new)
            held = np.diff(np.append(first, len(code)))
            yield pa.RecordBatch.from_arrays([groups.dictionary.take(pa.array(code[first])), pa.array(hashes[first].view(np.int64)), pa.array(held, pa.int64())], names=["place", "word", "held"])


def common_words(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of anchors and of all common words, ascending: the fixed lists and the most common words of each language or source."""
    prepare(docs.sparkSession)
    place = F.coalesce(*[F.col(c).cast("string") for c in ("lang", "source") if c in docs.columns], F.lit(""))
    texts = docs.select(F.col("text").cast("string").alias("text"), place.alias("place")).filter("text is not null")
    sizes = texts.groupBy("place").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST)
    held = texts.mapInArrow(_holders, "place string, word long, held long").groupBy("place", "word").agg(F.sum("held").alias("held"))
    share = held.join(sizes, "place").select("place", "word", (F.col("held") / F.col("n")).alias("share")).filter(F.col("share") >= SHARE)
    anchors, common, count = [_fixed(ANCHORS)], [_fixed(ANCHORS + COMMON)], {}
    for r in share.orderBy(F.desc("share"), "place", "word").limit(WORDS_ALL).collect():
        i = count[r.place] = count.get(r.place, 0) + 1
        word = np.array([r.word], np.int64).view(np.uint64)
        if i <= COMMON_EACH:
            common.append(word)
        if i <= ANCHORS_EACH:
            anchors.append(word)
    return np.unique(np.concatenate(anchors)), np.unique(np.concatenate(common))


def signatures(column: pa.Array, lists: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct signatures (40 bits) of each text, ascending, and where each text's begin."""
    data, off = utf8(pc.utf8_lower(column.cast(pa.large_string())))
    hashes, rows, _, _ = word_hashes(data, off, letters_digits())
    anchors, common = lists or (_fixed(ANCHORS), _fixed(ANCHORS + COMMON))
    is_in = lambda x, s: s[np.minimum(np.searchsorted(s, x), len(s) - 1)] == x
    plain = is_in(hashes, common)
    content = np.flatnonzero(~plain)
    at = np.flatnonzero(is_in(hashes, anchors))
    row = np.searchsorted(rows, at, "right") - 1
    first = np.searchsorted(content, at, "right")
    full = first + CHAIN <= np.searchsorted(content, rows[row + 1])
    at, row, first = at[full], row[full], first[full]
    weight = seeded(CHAIN + 2, 9) | np.uint64(1)
    value = hashes[at] * weight[0]
    for c in range(CHAIN):
        value = value + hashes[content[first + c]] * weight[c + 1]
    if lists:  # stretches without one: chains of consecutive words
        of, spot = np.repeat(np.arange(len(rows) - 1), np.diff(rows)), np.arange(len(hashes))
        anchor = np.full(len(hashes), -1)
        anchor[at] = at
        anchor = np.maximum.accumulate(anchor)
        chain = np.flatnonzero((spot + CHAIN <= rows[of + 1]) & ((anchor < rows[of]) | (spot - anchor > GAP)))
        linked = np.zeros(len(chain), np.uint64) + weight[CHAIN + 1]
        for c in range(CHAIN):
            linked = linked + hashes[chain + c] * weight[c]
        row, value = np.concatenate((row, of[chain])), np.concatenate((value, linked))
    # texts without any: all their words in order
    none = np.flatnonzero(np.bincount(row, minlength=len(column)) == 0)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes + mix(np.arange(len(hashes), dtype=np.uint64) - np.repeat(rows[:-1], np.diff(rows)).astype(np.uint64))), dtype=np.uint64)))
    whole = sums[rows[none + 1]] - sums[rows[none]] + weight[CHAIN + 1] * np.diff(rows)[none].astype(np.uint64)
    row = np.concatenate((row, none))
    value = mix(np.concatenate((value, whole))) >> np.uint64(24)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[keep], value[keep]
    return value, np.searchsorted(row, np.arange(len(column) + 1))


def text_of(values: np.ndarray, at: np.ndarray) -> list[str]:
    raw = values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes().hex()
    return [raw[10 * a : 10 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def likeness(values: np.ndarray, at: np.ndarray, others: np.ndarray, others_at: np.ndarray) -> np.ndarray:
    """Jaccard overlap of the i-th set of one list with the i-th of the other."""
    n, m = np.diff(at), np.diff(others_at)
    tag = lambda v, k: v | np.repeat(np.arange(len(k), dtype=np.uint64), k) << np.uint64(40)
    common = np.intersect1d(tag(values, n), tag(others, m), assume_unique=True)
    shared = np.bincount((common >> np.uint64(40)).astype(np.int64), minlength=len(n))
    return shared / (n + m - shared)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, the signatures and the fingerprint text of every document."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, at = signatures(part.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, pa.array(text_of(values, at), pa.string())], names=["doc_id", "signatures", "fingerprint"])

    return fit(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, signatures array<long>, fingerprint string")


def near_pairs(prints: DataFrame, tau: float) -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, print) and pairs (a, b, likeness) of different prints with a likeness of at least `tau`."""
    members = prints.select("doc_id", F.sha2("fingerprint", 256).alias("print"), "signatures")
    sets = members.dropDuplicates(["print"]).select("print", "signatures", F.size("signatures").alias("n"))
    each = sets.select("print", "n", F.explode("signatures").alias("s"))
    often = each.groupBy("s").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # position of each shared signature in its set, rarest first; a signature of one set alone pairs with nothing
    by_rarity = Window.partitionBy("print").orderBy("df", "s")
    alone = each.join(often, "s").groupBy("print", "n").agg(F.count(F.lit(1)).alias("shared"))
    ranked = each.join(often, "s").join(alone, ["print", "n"]).withColumn("i", F.row_number().over(by_rarity) + F.col("n") - F.col("shared"))
    prefix = ranked.filter(F.col("i") <= F.col("n") - F.ceil(F.lit(tau) * F.col("n")) + 1)
    part = F.floor(F.log(F.col("n")) / math.log(1 / tau))
    left = prefix.select(F.col("print").alias("a"), F.col("n").alias("na"), "s", part.alias("p"))
    right = prefix.select(F.col("print").alias("b"), F.col("n").alias("nb"), "s", F.explode(F.array(part, part - 1, part + 1)).alias("p"))
    pairs = left.join(right, ["s", "p"]).filter((F.col("a") < F.col("b")) & (F.least("na", "nb") >= F.lit(tau) * F.greatest("na", "nb"))).select("a", "b").distinct()
    full = pairs.join(sets.select(F.col("print").alias("a"), F.col("signatures").alias("x")), "a").join(sets.select(F.col("print").alias("b"), F.col("signatures").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return members.select("doc_id", "print"), full.withColumn("likeness", common / (F.size("x") + F.size("y") - common)).filter(F.col("likeness") >= tau).select("a", "b", "likeness")


# ---- each document against its edited text and its successor ------------------------------

FOUND = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edited(text: str, following: str) -> str:
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut] if cut else text


def compared(ids: list, texts: list[str], following: list[str], lists: tuple[np.ndarray, np.ndarray] | None = None) -> pa.RecordBatch:
    edited = [_edited(t, f) for t, f in zip(texts, following, strict=True)]
    own, other, after = (signatures(pa.array(x, pa.large_string()), lists) for x in (texts, edited, following))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
         pa.array(text_of(*own), pa.string()), pa.array(text_of(*other), pa.string()), pa.array(likeness(*own, *other), pa.float64()), pa.array(likeness(*own, *after), pa.float64())],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _inside(batches: Iterator[pa.RecordBatch], lists: tuple[np.ndarray, np.ndarray] | None) -> Iterator[pa.RecordBatch]:
    """Every document but the last of each range, with the one after it."""
    held = None
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            ids, texts, parts = (part.column(c).to_pylist() for c in ("doc_id", "text", "part"))
            if held:
                ids, texts, parts = [held[0], *ids], [held[1], *texts], [held[2], *parts]
            go = [i for i in range(len(ids) - 1) if parts[i] == parts[i + 1]]
            if go:
                yield compared([ids[i] for i in go], [texts[i] for i in go], [texts[i + 1] for i in go], lists)
            held = (ids[-1], texts[-1], parts[-1])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last document of each range."""
    held, kind = None, pa.schema([("part", pa.int32()), ("last", pa.bool_()), ("doc_id", pa.int64()), ("text", pa.string())])
    for batch in batches:
        parts = batch.column("part").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(parts)]
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            get = lambda i, last, batch=batch: {"part": batch.column("part")[i].as_py(), "last": last, "doc_id": batch.column("doc_id")[i].as_py(), "text": batch.column("text")[i].as_py()}
            if held and held["part"] != int(parts[a]):
                rows.append(held)
                held = None
            if held is None:
                rows.append(get(a, False))
            held = get(b - 1, True)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kind)
    if held:
        yield pa.RecordBatch.from_pylist([held], kind)


def _finish(batches: Iterator[pa.RecordBatch], lists: tuple[np.ndarray, np.ndarray] | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield compared(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")), lists)


def neighbours(docs: DataFrame, lists: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """Every document against its edited text and the document of the next doc_id (the last: the first); `lists` as from `common_words`."""
    spark = prepare(docs.sparkSession)
    texts = fit(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # borders of 4 n ranges: a bounded list of ids
    borders = np.unique(texts.select("doc_id").dropna().approxQuantile("doc_id", [i / (4 * n) for i in range(1, 4 * n)], 0.0005) or [0.0]).astype(np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, ids.to_numpy(), "right") + 1)

    part = F.when(F.col("doc_id").isNull(), 0).otherwise(range_of(F.coalesce("doc_id", F.lit(0))))
    dealt = texts.withColumn("part", part).repartition(n, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "text")
    ends = dealt.mapInArrow(_ends, "part int, last boolean, doc_id long, text string")
    first = ends.filter("not last").select("part", F.col("text").alias("following"))
    order = Window.orderBy("part")  # one row per range
    before = first.select("part", F.coalesce(F.lag("part").over(order), F.max("part").over(Window.partitionBy())).alias("of"))
    first = first.join(before, "part").select(F.col("of").alias("part"), "following")
    pairs = ends.filter("last").join(first, "part").select("doc_id", "text", "following")
    return dealt.mapInArrow(partial(_inside, lists=lists), FOUND).unionByName(pairs.mapInArrow(partial(_finish, lists=lists), FOUND))
