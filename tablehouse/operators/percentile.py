"""Exact percentiles by distributed selection."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL = 4096     # a rank's interval with so many values or fewer is fetched
PIVOTS = 32      # quantiles of a sketch per interval and round
SALTS = 64       # groups that partial counts and sketches are first put together in


@dataclass
class Interval:
    """Values above `low` and not above `high`; `before` values lie below them."""

    low: float
    high: float
    before: int
    n: int


def slot(value: Column, pivots: list[float]) -> Column:
    """How many of the ascending pivots lie below a value, by halving steps."""
    marks = F.array(*[F.lit(p) for p in pivots])

    def step(at: Column, width: Column) -> Column:
        return F.when(F.get(marks, at + width - 1) < value, at + width).otherwise(at)

    return F.aggregate(F.array(*[F.lit(1 << i) for i in range(len(pivots).bit_length() - 1, -1, -1)]), F.lit(0), step)


def _within(values: DataFrame, intervals: list[Interval]) -> DataFrame:
    """Values of disjoint, ascending intervals with `i`, their interval's place."""
    edges = sorted({e for x in intervals for e in (x.low, x.high)})
    place = {edges.index(x.low) + 1: i for i, x in enumerate(intervals)}
    at = slot(F.col("v"), edges)
    which = F.coalesce(*[F.when(F.col("_at") == s, F.lit(i)) for s, i in place.items()])
    return values.select("v", at.alias("_at")).select("v", which.alias("i")).where("i is not null")


def _salted(rows: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    return rows.groupBy(*keys, (F.spark_partition_id() % SALTS).alias("_salt")).agg(*aggs)


def _pivots(values: DataFrame, intervals: list[Interval]) -> list[list[float]]:
    """Quantiles of each interval from mergeable sketches, each with the number before it, so that a frequent value gets an interval of its own."""
    sketches = _salted(_within(values, intervals), ["i"], F.kll_sketch_agg_double("v").alias("s"))
    whole = sketches.groupBy("i").agg(F.kll_merge_agg_double("s").alias("s"))
    ranks = F.array(*[F.lit(r / PIVOTS) for r in range(1, PIVOTS)])
    found = {r.i: r.q for r in whole.select("i", F.kll_sketch_get_quantile_double("s", ranks).alias("q")).collect()}
    return [sorted({e for q in found[i] for e in (math.nextafter(q, -math.inf), q) if x.low < e < x.high}) for i, x in enumerate(intervals)]


def _split(values: DataFrame, intervals: list[Interval]) -> list[Interval]:
    """The intervals cut at new pivots, with exact counts."""
    parts = []
    for x, inner in zip(intervals, _pivots(values, intervals)):
        edges = [x.low, *inner, x.high]
        parts.append([Interval(a, b, 0, 0) for a, b in zip(edges, edges[1:])])
    flat = [p for group in parts for p in group]
    counted = _salted(_within(values, flat), ["i"], F.count(F.lit(1)).alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
    for r in counted.groupBy("i").agg(F.sum("n").alias("n"), F.min("a").alias("a"), F.max("b").alias("b")).collect():
        # the values themselves are the closest bounds
        flat[r.i].n, flat[r.i].low, flat[r.i].high = r.n, math.nextafter(r.a, -math.inf), r.b
    for x, group in zip(intervals, parts):
        at = x.before
        for p in group:
            p.before, at = at, at + p.n
    return [p for p in flat if p.n]


def exact_percentiles(df: DataFrame, col: str, ps: list[float]) -> DataFrame:
    """Linear-interpolated percentiles of a numeric column: rows (p, value); nulls and NaN don't count.

    Each round cuts the intervals that hold a wanted rank at quantiles of a sketch of their
    values and counts the parts, until a rank's interval is one value or at most `SMALL`
    values, which are fetched.  The sketch only says where to cut, the counts are exact.  No
    task gets all values, whatever their spread; an empty column gives no rows.
    """
    values = df.select(F.col(col).cast("double").alias("v")).where("v is not null and not isnan(v)")
    ends = [r for r in _salted(values, [], F.count(F.lit(1)).alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).collect()]
    n = sum(r.n for r in ends)
    if not n:
        return df.sparkSession.createDataFrame([], "p double, value double")
    ranks = sorted({r for p in ps for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))})
    intervals = [Interval(math.nextafter(min(r.a for r in ends), -math.inf), max(r.b for r in ends), 0, n)]
    at: dict[int, float] = {}
    while True:
        wanted = []
        for x in intervals:
            mine = [r for r in ranks if x.before <= r < x.before + x.n]
            if mine and math.nextafter(x.low, math.inf) == x.high:
                at.update(dict.fromkeys(mine, x.high))
            elif mine:
                wanted.append(x)
        large = [x for x in wanted if x.n > SMALL]
        if not large:
            break
        intervals = _split(values, large) + [x for x in wanted if x.n <= SMALL]
        intervals.sort(key=lambda x: x.before)
    if wanted:
        rows = _within(values, wanted).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).collect()
        for i, x in enumerate(wanted):
            below = x.before
            for r in sorted((r for r in rows if r.i == i), key=lambda r: r.v):
                at.update({k: r.v for k in ranks if below <= k < below + r.n})
                below += r.n
    out = []
    for p in ps:
        k = p * (n - 1)
        low, high = math.floor(k), math.ceil(k)
        out.append((float(p), at[low] if low == high else at[low] * (high - k) + at[high] * (k - low)))
    return df.sparkSession.createDataFrame(out, "p double, value double")
