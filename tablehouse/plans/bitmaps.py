"""Look-backs from a small table of exact bitmaps, a few rows per day.

A day's players are bitmaps of 32,768 ids each, written as the day's partition.  A night adds its
own day and reads a row per day and bitmap; a day that is run again changes its own rows only.
Bitmaps of several days are put together by OR, so players count once however many days they played.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehouse.functions.exprs import days_before


def day_players(result: DataFrame, who: str = "brobot = 0", id_col: str = "nplayerid") -> DataFrame:
    """(dt, bucket, bits): the players of each day; built map-side, so a busy day is no large group."""
    rows = result.where(who).where(F.col(id_col).isNotNull())
    return rows.groupBy("dt", F.bitmap_bucket_number(id_col).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("bits"))


def players_over(bitmaps: DataFrame, first_dt: str, last_dt: str, days: int = 30, name: str = "month_real_player_cnt") -> DataFrame:
    """Different players over d - days .. d for each run day d from first_dt to last_dt that has any."""
    day, low, high = F.to_date("dt"), F.to_date(F.lit(first_dt)), F.to_date(F.lit(last_dt))
    rows = bitmaps.where((F.col("dt") >= days_before(first_dt, days)) & (F.col("dt") <= last_dt))
    first, last = F.greatest(day, low), F.least(F.date_add(day, days), high)
    runs = rows.select("bucket", "bits", F.explode(F.sequence(first, last)).alias("run"))
    whole = runs.groupBy("run", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return whole.groupBy(F.col("run").cast("string").alias("dt")).agg(F.sum("n").alias(name))
