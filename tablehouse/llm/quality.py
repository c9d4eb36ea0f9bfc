"""Operator 12: quality scores by a Gaussian kernel on document statistics.

    statistics  per text the `STATISTICS` below, from whole texts, written once to the shared folder
    features    `FEATURES` random Fourier features cos(w.x + b) of the standardised statistics, w
                normal with the kernel's width, approximate a Gaussian kernel; values are integers in units of 1 / UNIT
    fit         each task sums its rows of the normal equations, the sums are added up
                in Spark; integers, so that the model does not depend on the order.  Ridge on the labelled rows of folds 0 and 1
    calibrate   raw scores of the labelled rows of fold 3, counted on a fixed grid of steps, made
                isotonic by pooling neighbours; scores between two pools are interpolated

The fold is the CRC-32 of doc_id as text modulo 4; fold 2 is held out.  All labelled rows are
used.  Memory: a task holds one text's words and a matrix of FEATURES + 2 columns; the driver the summed
matrix and at most GRID * (HIGH - LOW) + 1 steps.

Defined cases: null and empty texts have statistics 0 and are scored like others; a document's label is
the one most of its label rows have, a tie is none; labels other than 0 and 1, and of null doc_ids, are none;
repeated rows are scored (and learned) each; null doc_ids are not held out and have no label.  Without any
labelled row to learn from the score is 0.5; without one to calibrate on it is the raw score, cut to 0 and 1.
Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehouse.llm.common import fit, not_space, prepare, slices, stored, utf8, window_hashes, word_hashes

STATISTICS = (
    "log_words", "word_length", "upper", "digits", "marks", "loud", "symbols", "blanks", "breaks", "beyond_ascii", "entropy",
    "no_letter", "capital_words", "title_words", "distinct_words", "top_word", "repeated_triples", "line_length", "repeated_lines", "ended_lines")
FEATURES, WIDTH, UNIT, RIDGE, SEED = 256, 6.0, 1 << 12, 1e-3, 12
GRID, LOW, HIGH = 4096, -0.5, 1.5
THRESHOLD = 0.7


def _classes() -> np.ndarray:
    """Which bytes count for what: one column per class of bytes."""
    names = ("letter", "upper", "lower", "digit", "mark", "loud", "symbol", "blank", "break", "beyond", "char")
    table = {n: np.zeros(256) for n in names}
    table["upper"][65:91] = table["lower"][97:123] = table["digit"][48:58] = 1
    table["letter"][65:91] = table["letter"][97:123] = table["letter"][192:] = table["beyond"][192:] = 1
    for name, bytes_ in (("mark", b".,;:?'\"-()"), ("loud", b"!"), ("symbol", b"#$%&*+/<=>@[\\]^_`{|}~"), ("blank", b" \t\r\n\x0b\x0c"), ("break", b"\n")):
        table[name][list(bytes_)] = 1
    table["char"][:] = 1
    table["char"][128:192] = 0
    return np.stack([table[n] for n in names], 1)


def _runs(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: how many different values, and how often the most frequent one occurs."""
    if not len(row):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (value[1:] != value[:-1]))))
    often, most = np.diff(np.append(first, len(row))), np.zeros(n)
    np.maximum.at(most, row[first], often)
    return np.bincount(row[first], minlength=n).astype(float), most


def statistics(column: pa.Array) -> np.ndarray:
    """The statistics of each text, a row per text."""
    data, off = utf8(column)
    n = len(column)
    share = lambda a, b: np.divide(a, b, out=np.zeros(n), where=b > 0)
    of = np.repeat(np.arange(n), np.diff(off))
    seen = np.bincount(of * 256 + data, minlength=n * 256).reshape(n, 256)
    letter, upper, lower, digit, mark, loud, symbol, blank, breaks, beyond, chars = (seen @ _classes()).T
    total = np.diff(off).astype(float)
    part = seen / np.maximum(total, 1)[:, None]
    entropy = -(part * np.log2(part, out=np.zeros_like(part), where=part > 0)).sum(1) / 8

    hashes, rows, starts, ends = word_hashes(data, off, not_space())
    words, row = np.diff(rows).astype(float), np.repeat(np.arange(n), np.diff(rows))
    per_row = lambda flags: np.bincount(row[flags], minlength=n).astype(float)
    within = lambda bytes_: np.add.reduceat(bytes_[data], starts) if len(starts) else np.zeros(0)
    is_upper, is_lower = np.zeros(256, np.int64), np.zeros(256, np.int64)
    is_upper[65:91] = is_lower[97:123] = 1
    is_letter = is_upper + is_lower
    is_letter[192:] = 1
    letters, uppers, lowers = within(is_letter), within(is_upper), within(is_lower)
    distinct, top = _runs(row, hashes, n)
    triples, at = window_hashes(hashes, rows, 3)
    n_triples = np.bincount(row[at], minlength=n).astype(float)
    different, _ = _runs(row[at], triples, n)

    inside = np.ones(256, bool)
    inside[10] = False
    line_hashes, line_rows, line_starts, line_ends = word_hashes(data, off, inside)
    lines, line_row = np.diff(line_rows).astype(float), np.repeat(np.arange(n), np.diff(line_rows))
    own_lines, _ = _runs(line_row, line_hashes, n)
    closing = np.zeros(256, bool)
    closing[list(b".!?:;\"")] = True
    ended = np.bincount(line_row[closing[data[line_ends - 1]]], minlength=n).astype(float) if len(line_ends) else np.zeros(n)
    out = [
        np.log1p(words) / 10, np.log1p(share(chars - blank, words)) / 4, share(upper, letter), share(digit, chars), share(mark, chars), share(loud, chars),
        share(symbol, chars), share(blank, chars), share(breaks, chars), share(beyond, chars), entropy, share(per_row(letters == 0), words),
        share(per_row((uppers > 1) & (lowers == 0)), words), share(per_row(is_upper[data[starts]] > 0), words), share(distinct, words), share(top, words),
        share(n_triples - different, n_triples), np.log1p(share(chars - breaks, lines)) / 8, share(lines - own_lines, lines), share(ended, lines)]
    return np.stack(out, 1)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = statistics(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(list(found), pa.list_(pa.float64()))], names=["doc_id", "found"])


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every document."""
    prepare(docs.sparkSession)
    return fit(docs, doc_id="long", text="string").mapInArrow(_measure, "doc_id long, found array<double>")


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def majority(labels: DataFrame) -> DataFrame:
    """doc_id and label, 0 or 1, of every document whose label rows don't balance."""
    votes = fit(labels, doc_id="long", quality="int").filter("doc_id is not null and quality in (0, 1)")
    return votes.groupBy("doc_id").agg(F.sum(2 * F.col("quality") - 1).alias("vote")).filter("vote != 0").select("doc_id", (F.col("vote") > 0).cast("int").alias("label"))


class Kernel:
    """Random Fourier features of statistics."""

    def __init__(self, mean: list[float], spread: list[float]):
        self.mean, self.spread = np.array(mean), np.array(spread)
        rng = np.random.default_rng(SEED)
        self.w, self.b = rng.standard_normal((len(mean), FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES)

    def features(self, found: np.ndarray) -> np.ndarray:
        """Integers in units of 1 / UNIT as doubles, a constant last."""
        x = np.clip((found - self.mean) / self.spread, -8, 8)
        return np.concatenate((np.rint(np.cos(x @ self.w + self.b) * UNIT), np.full((len(x), 1), float(UNIT))), 1)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


def _equations(kernel: Kernel) -> Callable:
    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2), np.int64)
        for batch in batches:
            z = kernel.features(matrix(batch.column("found")))
            y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
            total += (z.T @ np.concatenate((z, y[:, None]), 1)).astype(np.int64)  # below 2^53 for a batch: exact
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total), pa.list_(pa.int64()))], names=["line", "sums"])
    return equations


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for line, sums in zip(batch.column("line").to_pylist(), batch.column("sums")):
            values = sums.values.to_numpy()
            held[line] = held[line] + values if line in held else values.copy()
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(list(held.values()), pa.list_(pa.int64()))], names=["line", "sums"])


def pooled(x: np.ndarray, total: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: places (weighted means of x) and values of the pools, ascending."""
    pools: list[list[float]] = []
    for at, s, m in zip(x, total, n):
        pools.append([at * m, s, m])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    p = np.array(pools).reshape(-1, 3)
    return p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]


class Model:
    """Kernel, ridge weights and isotonic steps; without weights every score is 0.5."""

    def __init__(self, kernel: Kernel | None = None, weights: np.ndarray | None = None):
        self.kernel, self.weights, self.steps = kernel, weights, None

    def raw(self, found: np.ndarray) -> np.ndarray:
        return self.kernel.features(found) @ self.weights

    def score(self, found: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(found), 0.5)
        raw = self.raw(found)
        return np.interp(raw, *self.steps) if self.steps else np.clip(raw, 0, 1)


def ridge(sums: np.ndarray) -> np.ndarray:
    """Weights of the features (in their integer units) from the summed normal equations."""
    a = sums[:, :-1].astype(float) / UNIT**2 * 2 / FEATURES
    b = sums[:, -1].astype(float) / UNIT * np.sqrt(2 / FEATURES)
    n = sums[-1, -2] / UNIT**2
    penalty = np.full(len(a), RIDGE * n)
    penalty[-1] = 1e-9 * n
    return np.linalg.solve(a + np.diag(penalty), b) * np.sqrt(2 / FEATURES) / UNIT


def _grid(model: Model) -> Callable:
    def grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(matrix(batch.column("found"))), LOW, HIGH)
            yield pa.RecordBatch.from_arrays([pa.array(np.rint(raw * GRID).astype(np.int32)), batch.column("label")], names=["step", "label"])
    return grid


def train(measured: DataFrame, labels: DataFrame) -> Model:
    """The model from `measure` rows (a stored table, it is read thrice) and label rows outside the held-out fold."""
    prepare(measured.sparkSession)
    known = measured.join(majority(labels), "doc_id").withColumn("fold", fold(F.col("doc_id"))).filter("fold != 2")
    known = stored(known.select("doc_id", "found", "label", "fold"), "labelled")
    learn, check = known.filter("fold < 2"), known.filter("fold = 3")
    columns = [F.col("found")[i] for i in range(len(STATISTICS))]
    r = learn.agg(*[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    if r[0] is None:
        return Model()
    k = len(columns)
    kernel = Kernel([round(v, 9) for v in r[:k]], [max(round(v, 9), 1e-3) for v in r[k:]])
    parts = learn.select("found", "label").mapInArrow(_equations(kernel), "line int, sums array<long>")
    lines = parts.repartition("line").mapInArrow(_add_up, "line int, sums array<long>").collect()
    sums = np.zeros((FEATURES + 1, FEATURES + 2), np.int64)
    for line in lines:
        sums[line.line] = line.sums
    model = Model(kernel, ridge(sums))
    steps = check.select("found", "label").mapInArrow(_grid(model), "step int, label int").groupBy("step").agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("n"))
    found = sorted(steps.collect(), key=lambda s: s.step)
    if found:
        model.steps = pooled(*(np.array(c, float) for c in zip(*((s.step / GRID, s.ones, s.n) for s in found))))
    return model


def score(measured: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every `measure` row."""
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(matrix(batch.column("found"))))], names=["doc_id", "score"])

    found = measured.mapInArrow(scores, "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a model of the labelled ones outside the held-out fold."""
    measured = stored(measure(docs), "statistics")
    return score(measured, train(measured, labels))
