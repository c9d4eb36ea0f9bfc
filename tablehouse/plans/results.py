"""Result tables: game results, win/lose counts, profit in currency units.

Every function handles all days it is given at once, with `dt` as a key; the nightly
run passes one day's increment, a backfill passes a range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehouse.functions.exprs import HAND, day_of, num, sum_if
from tablehouse.operators.keyed import latest

KEY_COLUMNS = ["ngametype", "sztoken", "nplayerid", "nround", "gameresult",
               "createtime", "starttime", "endtime", "dt"]
SIGNS = {"win": lambda c: c > 0, "tie": lambda c: c == 0, "lose": lambda c: c < 0}

MICRO, MILLI = 1_000_000, 1_000


def scored(score: DataFrame, gold: DataFrame, robot: DataFrame) -> DataFrame:
    """Cash and gold rows created on their own day, with the robot's flag and version.

    The two sources are unioned first so the robot table is joined once; it may hold
    the same hand on several days, of which the latest counts.
    """
    rows = (
        score.select(*KEY_COLUMNS).unionByName(gold.select(*KEY_COLUMNS))
        .withColumn("create_dt", day_of("createtime"))
        .where(F.col("create_dt") == F.col("dt"))
    )
    keys = ["sztoken", "nround", "nplayerid"]
    known = latest(
        robot.withColumnRenamed("playerid", "nplayerid"), keys, "dt", ["brobot", "robotversion"]
    ).withColumn("brobot", num("brobot", "int"))
    return rows.join(known, keys, "left")


def game_result(score: DataFrame, gold: DataFrame, robot: DataFrame) -> DataFrame:
    return scored(score, gold, robot).select(
        "ngametype", "sztoken", "nplayerid", "nround", "gameresult",
        F.coalesce("brobot", F.lit(0)).alias("brobot"),
        F.coalesce("robotversion", F.lit("0")).alias("robotversion"),
        "createtime", "starttime", "endtime", "create_dt", "dt",
    )


def _per_hand(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key and hand: which signs occurred, and the sums by sign.

    Counting these rows replaces four distinct counts over one group, which Spark would
    run by copying every input row four times; it also leaves a hot key spread over its
    hands in the first shuffle.
    """
    r = F.col("gameresult")
    flags = [F.max(F.when(p(r), 1).otherwise(0)).alias(f"{n}_f") for n, p in SIGNS.items()]
    sums = [sum_if(p(r), r).alias(f"{n}_s") for n, p in SIGNS.items()]
    return rows.groupBy(*dict.fromkeys(keys + HAND)).agg(*flags, *sums, F.sum(r).alias("all_s"))


def _hand_counts() -> list:
    return [F.sum(f"{n}_f").alias(f"{n}_cnt") for n in SIGNS] + [F.count(F.lit(1)).alias("total_cnt")]


def win_lose_round(rows: DataFrame) -> DataFrame:
    """Hands won, tied and lost per player, game type and robot flag."""
    keys = ["nplayerid", "ngametype", "brobot", "dt"]
    rows = rows.withColumn("brobot", F.coalesce("brobot", F.lit(0)))
    zeros = ["total_robot_round", "total_human_round", "win_robot_round", "win_human_round",
             "lose_to_robot_round", "lose_to_human_round"]
    return (
        _per_hand(rows, keys).groupBy(*keys).agg(*_hand_counts())
        .withColumns({z: F.lit(0) for z in zeros})
    )


def robot_win_lose(rows: DataFrame) -> DataFrame:
    """Hands and score sums per day, robot flag, version and game type."""
    keys = ["create_dt", "brobot", "robotversion", "ngametype", "dt"]
    rows = rows.withColumn("brobot", F.coalesce("brobot", F.lit(0)))
    sums = [F.coalesce(F.sum(f"{n}_s"), F.lit(0)).alias(f"{n}_score") for n in SIGNS]
    total = F.coalesce(F.sum("all_s"), F.lit(0)).alias("total_score")
    return _per_hand(rows, keys).groupBy(*keys).agg(*_hand_counts(), *sums, total)


def _profit(rows: DataFrame, keys: list[str], pnl: str, unit: int) -> DataFrame:
    """Sum of profit, of gains and of losses and the number of tables, per key.

    Sums stay integers until the last step, so they do not depend on row order.  The
    first level is per table, which spreads a hot player over the tables.
    """
    p = F.col(pnl)
    per_table = rows.groupBy(*keys, "sztoken").agg(
        F.sum(p).alias("t"), sum_if(p >= 0, p).alias("w"), sum_if(p < 0, p).alias("l"))
    return per_table.groupBy(*keys).agg(
        *[F.round(F.sum(c).cast("double") / F.lit(float(unit)), 2).alias(n)
          for c, n in (("t", "total_score"), ("w", "win_score"), ("l", "lose_score"))],
        F.count(F.lit(1)).alias("total_sztoken"),
    )


def _with_flag(totals: DataFrame, user: DataFrame) -> DataFrame:
    flags = user.select("nplayerid", "dt", num("brobot", "int").alias("brobot"))
    return totals.join(flags, ["nplayerid", "dt"])


def tournament_profit(info: DataFrame, match: DataFrame, user: DataFrame) -> DataFrame:
    """Game type 400: reward less entry fee, or minus the fee."""
    fee = num(F.get_json_object("szrulejson", "$.joinFeeUcoin"), "bigint")
    tables = (
        info.where((F.col("ngametype") == 400) & (day_of("createtime") == F.col("dt")))
        .select("dt", "sztoken", "szroomname", "createtime", fee.alias("fee"),
                num(F.get_json_object("szrulejson", "$.awards[0].award"), "bigint").alias("award"))
        .distinct()
    )
    wins = match.where("ngametype = 400").select("dt", "sztoken", "nplayerid", "reward")
    reward = F.when(F.col("reward") > 0, F.col("reward")).otherwise(0)
    rows = tables.join(wins, ["dt", "sztoken"]).withColumn("pnl", reward - F.col("fee"))
    return _with_flag(_profit(rows, ["nplayerid", "dt"], "pnl", MICRO), user).withColumn(
        "ngametype", F.lit(400))


def cash_profit(info: DataFrame, score: DataFrame, user: DataFrame, types=(79, 74)) -> DataFrame:
    """Score in milli-units over the table's ratio, rounded to 4 digits per table and player."""
    tables = info.where(F.col("ngametype").isin(*types)).select("dt", "sztoken", "ucoinratio").distinct()
    rows = score.where(
        F.col("ngametype").isin(*types) & (day_of("createtime") == F.col("dt"))
    ).select("dt", "sztoken", "nplayerid", "ngametype", "nscore")
    # per table and player before the ratio is looked up: the ratio is one value per row of `tables`
    rows = rows.groupBy("dt", "sztoken", "nplayerid", "ngametype").agg(F.sum("nscore").alias("nscore"))
    rated = (
        rows.join(tables, ["dt", "sztoken"], "left")
        .groupBy("dt", "sztoken", "nplayerid", "ngametype")
        .agg(F.round(F.sum(F.col("nscore").cast("double") / F.lit(float(MILLI))
                           / F.coalesce("ucoinratio", F.lit(1))), 4).alias("pnl"))
        # 4 digits as an integer: later sums are exact
        .withColumn("pnl", F.round(F.col("pnl") * 10_000).cast("bigint"))
    )
    keys = ["nplayerid", "ngametype", "dt"]
    return _with_flag(_profit(rated, keys, "pnl", 10_000), user)


def gold_profit(gold: DataFrame) -> DataFrame:
    rows = gold.where(day_of("createtime") == F.col("dt")).withColumn("brobot", num("brobot", "int"))
    return _profit(rows, ["nplayerid", "ngametype", "brobot", "dt"], "gameresult", MILLI)


def win_lose_u(info, match, score, gold, user) -> DataFrame:
    """Daily profit per player and game type in currency units."""
    parts = [tournament_profit(info, match, user), cash_profit(info, score, user), gold_profit(gold)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    zero = lambda name: F.lit(0).alias(name)
    return rows.select(
        "nplayerid", "ngametype", "brobot", "total_score", "win_score", "lose_score",
        zero("win_robot_score"), zero("win_human_score"), zero("lose_to_human_score"),
        zero("lose_to_robot_score"), "total_sztoken", zero("total_robot_sztoken"),
        zero("total_human_sztoken"), "dt",
    )
