"""Operator 6: language identification with hyperdimensional profiles.

Every letter has a fixed random vector of `DIM` values +1 and -1; white space and all other
characters count as one blank.  The vector of three letters in a row is the product of the
first, permuted twice, the second, permuted once, and the third.  A text's vector is the sum
of the vectors of its n-grams; a language's prototype is the sum over its training texts.  A
text gets the language whose prototype has the largest cosine with it.

Texts are counted, not walked: a batch is reduced to (text, n-gram, count), one vector is
made per distinct n-gram, and counts times vectors is a matrix product.  Vectors and counts
exist for `STEP` n-grams at a time, so a slice with many different letters needs no more than
others; a text of n characters takes some 70 n bytes, as it is counted whole.  Training sums
count over all labelled texts; what leaves a task is one vector per language, and their sum
is taken in Spark.  The number of languages is checked against `MAX_LANGUAGES` before the
prototypes are sent to the tasks.

Defined cases: a text that is null or has no letter is `und` with score 0; texts of one or two
letters are padded by the blanks around them; ties go to the language that sorts first; if
there is no labelled text, everything is `und`; repeated rows are predicted each; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tablehouse.llm.common import fit, mix, once, prepare, slices

DIM, MAX_LANGUAGES, UNKNOWN = 1024, 2000, "und"
ROWS = 256  # texts in one matrix product
STEP = 2048  # n-grams in one matrix product


def letter_vector(code: int) -> np.ndarray:
    """The fixed vector of a code point; 0 is the blank."""
    with np.errstate(over="ignore"):
        words = mix(mix(np.arange(DIM // 64, dtype=np.uint64) + np.uint64(code * (DIM // 64))) + np.uint64(0x51ED270B))
    return (np.unpackbits(words.view(np.uint8)).astype(np.int8) * 2 - 1)[:DIM]


class Letters:
    """Numbers for the letters seen by a worker, in order of first sight, and their vectors."""

    def __init__(self):
        self.number = np.zeros(0x110000, np.int32)  # 0: blank or not seen yet
        self.seen = np.zeros(0x110000, bool)
        self.vectors = np.zeros((1, DIM), np.int8)
        self.vectors[0] = letter_vector(0)

    def of(self, codes: np.ndarray) -> np.ndarray:
        new = np.unique(codes[~self.seen[codes]])
        if len(new):
            self.seen[new] = True
            fresh = [c for c in new.tolist() if chr(c).isalpha()]
            if fresh:
                self.number[fresh] = np.arange(len(self.vectors), len(self.vectors) + len(fresh))
                self.vectors = np.concatenate((self.vectors, [letter_vector(c) for c in fresh]))
        return self.number[codes]


class Grams:
    """The vectors of n-grams, one a row, made for those that are asked for."""

    def __init__(self, vectors: np.ndarray, codes: np.ndarray):
        self.vectors, self.codes = vectors, codes

    def __len__(self) -> int:
        return len(self.codes)

    def __getitem__(self, some: slice) -> np.ndarray:
        v, k, codes = self.vectors, len(self.vectors), self.codes[some]
        return np.roll(v[codes // (k * k)], 2, axis=1) * np.roll(v[codes // k % k], 1, axis=1) * v[codes % k]

    def __array__(self, dtype=None, copy=None) -> np.ndarray:
        return self[:].astype(dtype or np.int8)


def ngrams(letters: Letters, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, Grams, np.ndarray]:
    """(text, n-gram column, count) of a batch, the vectors of the n-gram columns, and which texts have a letter."""
    joined = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    raw = "\n".join(joined.to_pylist()) + "\n"
    codes = np.frombuffer(raw.encode("utf-32-le"), np.uint32)
    number = letters.of(codes).astype(np.int64)
    length = pc.utf8_length(joined).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    row = np.repeat(np.arange(len(texts)), length)
    has = np.zeros(len(texts), bool)
    has[row[number > 0]] = True
    k = len(letters.vectors)
    # a run of blanks is one blank
    keep = np.ones(len(number), bool)
    keep[1:] = (number[1:] > 0) | (number[:-1] > 0) | (row[1:] != row[:-1])
    number, row = number[keep], row[keep]
    before = np.concatenate(([0], number[:-1]))
    before[1:][row[1:] != row[:-1]] = 0
    after = np.concatenate((number[1:], [0]))
    after[:-1][row[1:] != row[:-1]] = 0
    middle = number > 0
    gram = (before[middle] * k + number[middle]) * k + after[middle]
    pair, count = np.unique(row[middle] * k**3 + gram, return_counts=True)
    row, gram = pair // k**3, pair % k**3
    distinct, column = np.unique(gram, return_inverse=True)
    return row, column, count.astype(np.float32), Grams(letters.vectors, distinct), has


def bundle(row: np.ndarray, column: np.ndarray, count: np.ndarray, n: int, table: Grams) -> np.ndarray:
    """For each of n rows the sum of its n-grams' vectors times their counts."""
    out = np.zeros((n, DIM), np.float32)
    order = np.argsort(column, kind="stable")
    row, column, count = row[order], column[order], count[order]
    for a in range(0, len(table), STEP):
        some = slice(*np.searchsorted(column, (a, a + STEP)))
        width = min(STEP, len(table) - a)
        counts = np.bincount(row[some] * width + column[some] - a, count[some], n * width).reshape(n, width)
        out += counts.astype(np.float32) @ table[a : a + width].astype(np.float32)
    return out


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and unit prototypes from all rows with text and lang."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = once("hd letters", Letters), {}
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                row, column, count, table, _ = ngrams(letters, part.column("text"))
                names = part.column("lang").to_pylist()
                which = {name: i for i, name in enumerate(dict.fromkeys(names))}
                of = np.array([which[x] for x in names])[row] if len(names) else row
                made = bundle(of, column, count, len(which), table)
                for name, i in which.items():
                    sums[name] = sums.get(name, 0) + made[i].astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([x.tolist() for x in sums.values()])], names=["lang", "profile"])

    labelled = fit(docs, text="string", lang="string").dropna()
    made = labelled.mapInArrow(run, "lang string, profile array<double>")
    # whole numbers, so the order of addition does not matter
    cells = made.select("lang", F.posexplode("profile").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    rows = cells.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("p")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not rows:
        return [], np.zeros((0, DIM), np.float32)
    matrix = np.array([[c.x for c in r.p] for r in rows], np.float64).reshape(len(rows), -1)
    some = np.abs(matrix).sum(axis=1) > 0
    matrix = matrix[some]
    return [r.lang for r, ok in zip(rows, some, strict=True) if ok], (matrix / np.linalg.norm(matrix, axis=1, keepdims=True)).astype(np.float32)


def predict_batch(letters: Letters, texts: pa.Array, langs: list[str], prototypes: np.ndarray) -> tuple[list[str], np.ndarray]:
    out, score = [], np.zeros(len(texts))
    for at in range(0, len(texts), ROWS):
        row, column, count, table, has = ngrams(letters, texts.slice(at, ROWS))
        if not len(langs):
            out += [UNKNOWN] * len(has)
            continue
        vectors = bundle(row, column, count, len(has), table)
        norm = np.linalg.norm(vectors, axis=1)
        cosine = (vectors @ prototypes.T) / np.where(norm > 0, norm, 1)[:, None]
        best = cosine.argmax(axis=1)
        out += [langs[b] if h else UNKNOWN for b, h in zip(best.tolist(), has.tolist(), strict=True)]
        score[at : at + len(has)] = np.where(has, np.clip(cosine[np.arange(len(has)), best], 0, 1), 0)
    return out, score


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """All columns of `docs` with lang_pred and score; reads nothing but the text."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    schema = StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = once("hd letters", Letters)
        langs, prototypes = shared.value
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                names, score = predict_batch(letters, part.column("text"), langs, prototypes)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(score)], names=[*part.schema.names, "lang_pred", "score"])

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)


def keep_known(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """`docs`, all columns, without the rows that are predicted `und`."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = once("hd letters", Letters)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                names, _ = predict_batch(letters, part.column("text"), *shared.value)
                yield part.filter(pa.array([n != UNKNOWN for n in names], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """Every fifth document by the CRC-32 of its id as text; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))

