"""Bucketed tables need no exchange; bitmaps of a day are replaced by that day alone."""

from pyspark.sql import functions as F

from tablehouse import queries
from tablehouse.fixtures import Fixtures
from tablehouse.plans import bitmaps


def test_no_exchange_on_the_hand(spark, sf_dir):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries.hands_of_both(*queries._bucketed(Fixtures(spark, sf_dir)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "Exchange " not in plan and "SortMergeJoin" in plan
    assert plan.count("PartitionFilters: [isnotnull(dt") >= 2


def test_bitmaps(spark):
    rows = [("2024-01-01", i, 0) for i in (1, 2, 40_000, -5, 2**40)] + [("2024-01-03", i, 0) for i in (2, 3)] + [("2024-01-02", 9, 1), ("2024-01-02", None, 0)]
    days = bitmaps.day_players(spark.createDataFrame(rows, "dt string, nplayerid long, brobot int"))
    assert {r.dt for r in days.collect()} == {"2024-01-01", "2024-01-03"}
    count = lambda n: {r.dt: r.month_real_player_cnt for r in bitmaps.players_over(days, "2024-01-01", "2024-01-05", n).collect()}
    assert count(30) == {"2024-01-01": 5, "2024-01-02": 5, "2024-01-03": 6, "2024-01-04": 6, "2024-01-05": 6}
    assert count(1) == {"2024-01-01": 5, "2024-01-02": 5, "2024-01-03": 2, "2024-01-04": 2}
    assert bitmaps.players_over(days.filter(F.lit(False)), "2024-01-01", "2024-01-05").count() == 0
