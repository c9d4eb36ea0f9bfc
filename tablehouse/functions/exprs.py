"""Small column expressions shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HAND = ["dt", "sztoken", "nround"]


def num(c, to: str = "double") -> Column:
    """Number from text; null where the text is not a number (ANSI casts would raise)."""
    return (F.col(c) if isinstance(c, str) else c).try_cast(to)


def pick_col(df: DataFrame, *candidates: str) -> Column:
    """First of the candidate columns the frame has, ignoring case."""
    have = {c.lower(): c for c in df.columns}
    for name in candidates:
        if name.lower() in have:
            return F.col(have[name.lower()])
    raise ValueError(f"none of {candidates} is among {df.columns}")


def ratio(a, b, digits: int | None = None) -> Column:
    """a / b as double, null where b is zero or null, rounded on request."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    q = F.try_divide(a.cast("double"), b.cast("double"))
    return q if digits is None else F.round(q, digits)


def sum_if(pred: Column, value) -> Column:
    return F.sum(F.when(pred, value))


def any_if(pred: Column) -> Column:
    """1 if any row of the group meets the predicate, else 0."""
    return F.max(F.when(pred, 1).otherwise(0))


def non_empty(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != "")


def in_list(c, values, negate: bool = False) -> Column:
    """IN / NOT IN; a null input meets neither."""
    hit = (F.col(c) if isinstance(c, str) else c).isin(*values)
    return ~hit if negate else hit


def day_of(c) -> Column:
    return F.substring(c, 1, 10)


def days_before(dt, n: int) -> Column:
    """Day text n days before another day text."""
    dt = F.lit(dt) if isinstance(dt, str) else dt
    return F.date_sub(F.to_date(dt), n).cast("string")


def seconds(c) -> Column:
    """Epoch seconds of 'yyyy-MM-dd HH:mm:ss' text, null where it does not parse."""
    return F.unix_timestamp(F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")))


def local_day(ms, zone: str = "Asia/Shanghai") -> Column:
    """Calendar day in a time zone of epoch milliseconds; today where the input is null."""
    stamp = F.coalesce(F.timestamp_millis(ms), F.current_timestamp())
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), stamp.cast("timestamp_ntz")), "yyyy-MM-dd")


def number_list(text) -> Column:
    """'[0,-5,0]' (a JSON list or the same as text) to array<string>."""
    text = F.col(text) if isinstance(text, str) else text
    return F.split(F.regexp_replace(text, r"[\[\]]", ""), ",")


def percent_text(c) -> Column:
    """Two digits, exact halves to the even one (Java's own format rounds them up)."""
    return F.format_string("%.2f%%", F.bround(c * 100, 2))


def cut_after(c, keyword: str) -> Column:
    """Text after the last occurrence of a keyword."""
    return F.substring_index(c, keyword, -1)


def is_subset(a, b) -> Column:
    return F.size(F.array_except(a, b)) == 0


def all_different(a) -> Column:
    return F.size(F.array_distinct(a)) == F.size(a)
