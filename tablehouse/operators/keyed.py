"""Per-key picks and rolling day windows, as aggregations that combine map-side.

A window would bring all rows of a hot key to one task; `max_by`/`min_by` keep one
candidate per key and task instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], by: str, cols: list[str]) -> DataFrame:
    """The row with the greatest `by` per key; ties go to the greatest remaining columns."""
    best = F.max(F.struct(F.col(by), *[F.col(c) for c in cols])).alias("_b")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_b.{c}") for c in cols])


def top1(df: DataFrame, keys: list[str], order: list[Column], cols: list[str]) -> DataFrame:
    """The first row per key in ascending order of `order`; negate a number for descending."""
    names = [f"_o{i}" for i in range(len(order))]
    best = F.min(F.struct(*[o.alias(n) for o, n in zip(order, names)], *cols)).alias("_b")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_b.{c}").alias(c) for c in cols])


def _in_reach(daily: DataFrame, days: int, first_dt: str, last_dt: str) -> DataFrame:
    """Rows any of the run days looks back to; the literal bounds prune partitions of `dt`."""
    low = F.date_sub(F.to_date(F.lit(first_dt)), days).cast("string")
    return daily.where((F.col("dt") >= low) & (F.col("dt") <= F.lit(last_dt)))


def _points(rows: DataFrame, keys: list[str], start, end, sums: list[str], last_dt: str) -> DataFrame:
    """Per key and day: by how much the running values change that day."""
    sign = F.inline(F.array(
        F.struct(start.alias("p"), F.lit(1).alias("sign")), F.struct(end.alias("p"), F.lit(-1).alias("sign"))))
    return rows.select(*keys, *sums, sign).where(F.col("p") <= F.to_date(F.lit(last_dt))).groupBy(*keys, "p").agg(
        F.sum("sign").alias("_rows"), *[F.sum(F.col("sign") * F.coalesce(c, F.lit(0))).alias(c) for c in sums])


def _intervals(points: DataFrame, keys: list[str], cols: list[str], last_dt: str) -> DataFrame:
    """Runs of days [p, q] over which the running values of a key stay the same."""
    w = Window.partitionBy(*keys).orderBy("p")
    until = F.coalesce(F.date_sub(F.lead("p").over(w), 1), F.to_date(F.lit(last_dt)))
    past = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return points.select(*keys, "p", until.alias("q"), *[F.sum(c).over(past).alias(c) for c in cols])


def _per_run_day(intervals: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    days = intervals.select(*keys, *cols, F.explode(F.sequence("p", "q")).alias("dt"))
    return days.withColumn("dt", F.col("dt").cast("string"))


def rolling_sum(daily: DataFrame, keys: list[str], sums: list[str], days: int, first_dt: str,
                last_dt: str) -> DataFrame:
    """Sums per key over d - days .. d for each run day d in [first_dt, last_dt].

    A key gives a row for the run days whose window holds any of its rows; the result's
    `dt` is the run day.  A daily row adds its values on its day and takes them back when it
    leaves the window, so the work grows with the daily rows and with the result, not with
    the length of the window.  A single run day is a plain aggregation.
    """
    rows = _in_reach(daily, days, first_dt, last_dt)
    if first_dt == last_dt:
        total = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_rows"), *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in sums])
        return total.drop("_rows").withColumn("dt", F.lit(last_dt))
    day = F.to_date("dt")
    points = _points(rows, keys, F.greatest(day, F.to_date(F.lit(first_dt))), F.date_add(day, days + 1), sums, last_dt)
    runs = _intervals(points, keys, ["_rows", *sums], last_dt).where(F.col("_rows") > 0)
    return _per_run_day(runs, keys, sums)


def rolling_distinct(daily: DataFrame, keys: list[str], item: str, days: int, first_dt: str, last_dt: str,
                     name: str) -> DataFrame:
    """Different items per key over the same windows: an item counts from the day it comes
    into the window until its last row has left."""
    rows = _in_reach(daily, days, first_dt, last_dt)
    if first_dt == last_dt:
        return rows.groupBy(*keys).agg(F.count_distinct(item).alias(name)).withColumn("dt", F.lit(last_dt))
    day = F.to_date("dt")
    points = _points(rows, [*keys, item], F.greatest(day, F.to_date(F.lit(first_dt))), F.date_add(day, days + 1), [], last_dt)
    present = _intervals(points, [*keys, item], ["_rows"], last_dt).where(F.col("_rows") > 0).drop("_rows")
    present = present.withColumnsRenamed({"p": "_from", "q": "_to"})
    changes = _points(present, keys, F.col("_from"), F.date_add("_to", 1), [], last_dt)
    runs = _intervals(changes, keys, ["_rows"], last_dt).where(F.col("_rows") > 0).withColumnRenamed("_rows", name)
    return _per_run_day(runs, keys, [name])


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def top_counts(df: DataFrame, col: str, k: int, name: str = "n") -> DataFrame:
    """The k most frequent values, ties by value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), col).limit(k)


def first_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows per key.  Spark trims each map task to n rows per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
