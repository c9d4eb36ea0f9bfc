"""Playing-style tags and the player profile.

Both look back over several days.  They first reduce each day to one row per player
(and game type or hour) and then add the days of a window up, so several run days cost
one pass over the detail.  A hand belongs to one day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablehouse.functions import rules
from tablehouse.functions.exprs import HAND, any_if, day_of, non_empty, num, ratio, seconds, sum_if
from tablehouse.operators.joins import full, semi, star
from tablehouse.operators.keyed import rolling_distinct, rolling_sum, top1
from tablehouse.plans.risk import suspects

RAISES = ["raise", "allin"]
LATER = ["flop", "turn", "river"]


def style_hands(action: DataFrame, fold_labels=("Fold",)) -> DataFrame:
    """One row per hand and player with the counts the style tags need."""
    stage, bet = F.col("stage"), F.col("betaction")
    base = (
        action.where(bet.isNotNull() & (bet != "init"))
        .select(*HAND, "playerid", "json_index", "action", "stage", "betaction").distinct()
    )
    raised = bet.isin(*RAISES)
    early = (stage == "preflop") & raised
    count = lambda p: F.sum(F.when(p, 1).otherwise(0))
    hands = base.groupBy(*HAND, "playerid").agg(
        any_if((stage == "preflop") & bet.isin("call", *RAISES)).alias("is_vpip"),
        any_if(early).alias("is_pfr"),
        count(early).alias("n_early"), F.min(F.when(early, F.col("json_index"))).alias("first_early"),
        any_if((stage == "flop") & raised).alias("flop_raise"),
        count(stage.isin(*LATER) & raised).alias("aggressive"),
        count(stage.isin(*LATER) & bet.isin("call", "check")).alias("passive"),
        count(bet.isin(*fold_labels)).alias("folds"), count(bet == "allin").alias("allins"),
        F.count(F.lit(1)).alias("actions"),
    )
    # a re-raise: any preflop raise but the hand's first.  One row per player is left here.
    opening = F.min("first_early").over(Window.partitionBy(*HAND))
    again = (F.col("n_early") > 1) | (F.col("first_early") > opening)
    return hands.select(
        *HAND, "playerid", "is_vpip", "is_pfr", F.when(again, 1).otherwise(0).alias("is_3bet"),
        (F.col("is_pfr") * F.col("flop_raise")).alias("is_cbet"),
        "aggressive", "passive", "folds", "allins", "actions",
    )


def player_style(action: DataFrame, first_dt: str, last_dt: str, days: int = 7,
                 fold_labels=("Fold",)) -> DataFrame:
    """Style tags per player for each run day, over the run day and `days` days before."""
    sums = ["is_vpip", "is_pfr", "is_3bet", "is_cbet", "aggressive", "passive", "folds", "allins", "actions"]
    daily = style_hands(action, fold_labels).groupBy("dt", "playerid").agg(
        F.count(F.lit(1)).alias("hands"), *[F.sum(c).alias(c) for c in sums])
    s = rolling_sum(daily, ["playerid"], ["hands", *sums], days, first_dt, last_dt)
    # a player with exactly one action has no action rates
    total = F.when(F.col("actions") != 1, F.col("actions"))
    aggression = F.when(F.col("passive") > 0, ratio("aggressive", "passive"))
    style = rules.playing_style(
        F.col("hands"), ratio("is_vpip", "hands"), ratio("is_pfr", "is_vpip"),
        ratio("is_3bet", "is_vpip"), aggression, ratio("folds", total))
    return s.select(
        "playerid", F.col("hands").alias("total_hands"),
        ratio("is_vpip", "hands", 4).alias("vpip"), ratio("is_pfr", "hands", 4).alias("pfr"),
        ratio("is_3bet", "is_vpip", 4).alias("three_bet_pct"),
        F.coalesce(ratio("is_cbet", "is_pfr", 4), F.lit(0.0)).alias("cbet_pct"),
        F.round(aggression, 4).alias("af"), ratio("allins", total, 4).alias("allin_frequency"),
        ratio("folds", total, 4).alias("fold_rate"), style.alias("playing_style"),
        rules.data_quality(F.col("hands"), F.col("actions")).alias("data_quality"), "dt",
    )


def versus_robot(result: DataFrame, first_dt: str, last_dt: str, days: int = 30,
                 min_hands: int = 10, by_hand: bool = False) -> DataFrame:
    """Results of humans in hands with a robot.

    Equal results of a player on one day and game type count once; `by_hand` counts hands.
    """
    human = result.where((F.col("brobot") == 0) & F.col("nplayerid").isNotNull())
    with_robot = result.where("brobot = 1").select(*HAND).distinct()
    what = ["nplayerid", "gameresult", "ngametype", "create_dt", "dt"]
    met = semi(human, with_robot, HAND).select(*(dict.fromkeys(what + HAND) if by_hand else what)).distinct()
    r = F.col("gameresult")
    daily = met.groupBy("dt", "nplayerid").agg(
        F.count(F.lit(1)).alias("vs_hands"), sum_if(r > 0, 1).alias("vs_wins"),
        F.sum(r).alias("vs_sum"), sum_if(F.col("ngametype") == 450, 1).alias("vs_high"))
    every = human.select(*HAND, "nplayerid").distinct().groupBy("dt", "nplayerid").agg(
        F.count(F.lit(1)).alias("all_hands"))
    both = full([daily, every], ["dt", "nplayerid"])
    names = ["vs_hands", "vs_wins", "vs_sum", "vs_high", "all_hands"]
    t = rolling_sum(both, ["nplayerid"], names, days, first_dt, last_dt).where(F.col("vs_hands") >= min_hands)
    win, avg, share = ratio("vs_wins", "vs_hands"), ratio("vs_sum", "vs_hands"), ratio("vs_hands", "all_hands")
    return t.select(
        "dt", "nplayerid", F.col("vs_hands").alias("total_hands_vs_bot"),
        F.round(win, 4).alias("win_rate_vs_bot"), F.round(avg, 2).alias("avg_profit_vs_bot"),
        ratio("vs_high", "vs_hands", 4).alias("high_stakes_ratio"), F.round(share, 4).alias("bot_hands_ratio"),
        rules.vs_robot_label(win, avg, share).alias("player_profile_label"))


def preferred_game(result: DataFrame, first_dt: str, last_dt: str, days: int = 30) -> DataFrame:
    daily = (
        result.where("nplayerid is not null and ngametype is not null")
        .select(*HAND, "nplayerid", "ngametype").distinct()
        .groupBy("dt", "nplayerid", "ngametype").agg(F.count(F.lit(1)).alias("rounds"))
    )
    counts = rolling_sum(daily, ["nplayerid", "ngametype"], ["rounds"], days, first_dt, last_dt)
    best = top1(counts, ["dt", "nplayerid"], [-F.col("rounds"), F.col("ngametype")], ["ngametype", "rounds"])
    return best.withColumnsRenamed({"ngametype": "preferred_gametype", "rounds": "preferred_game_rounds"})


def activity(result: DataFrame, first_dt: str, last_dt: str, days: int = 30) -> DataFrame:
    """Active days, mean minutes per round, and the hour with most rounds."""
    known = result.where("nplayerid is not null")
    played = known.where(non_empty("createtime")).select(
        "dt", "nplayerid", day_of("createtime").alias("game_date")).distinct()
    window = (days, first_dt, last_dt)
    active = rolling_distinct(played, ["nplayerid"], "game_date", *window, "active_days")
    length = seconds("endtime") - seconds("starttime")
    lengths = known.select("dt", "nplayerid", length.alias("s")).where("s > 0").groupBy("dt", "nplayerid").agg(
        F.sum("s").alias("s"), F.count(F.lit(1)).alias("n"))
    mean = rolling_sum(lengths, ["nplayerid"], ["s", "n"], *window).select(
        "dt", "nplayerid", F.round(ratio("s", "n") / F.lit(60.0), 2).alias("avg_round_duration_mins"))
    hourly = known.where(non_empty("starttime")).groupBy(
        "dt", "nplayerid", num(F.substring("starttime", 12, 2), "int").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"))
    hours = rolling_sum(hourly, ["nplayerid", "hour"], ["n"], *window)
    peak = top1(hours, ["dt", "nplayerid"], [-F.col("n"), F.col("hour")], ["hour"]).withColumnRenamed(
        "hour", "peak_active_hour")
    return full([active, mean, peak], ["dt", "nplayerid"]).withColumn(
        "activity_level", rules.activity_level(F.col("active_days")))


def player_profile(user: DataFrame, member: DataFrame, style: DataFrame, result: DataFrame,
                   collusion: DataFrame, first_dt: str, last_dt: str, days: int = 30,
                   by_hand: bool = False) -> DataFrame:
    """All tags of every user in the snapshot of each run day."""
    key = ["dt", "nplayerid"]
    span = (F.col("dt") >= first_dt) & (F.col("dt") <= last_dt)
    base = user.where(span).select(
        *key, F.col("szcreatetime").alias("regtime"), num("brobot", "int").alias("brobot"),
        "preloginip", "prelogintime")
    name = top1(member.where(span), key, [F.col("nclubid"), F.col("sznickname")], ["sznickname", "nclubid"])
    tags = style.where(span).withColumnRenamed("playerid", "nplayerid").drop("total_hands")
    risk = suspects(collusion.where(span)).select("dt", F.col("playerid").alias("nplayerid"), F.lit(1).alias("risk"))
    window = (first_dt, last_dt, days)
    rows = star(base, [
        name, tags, preferred_game(result, *window), activity(result, *window), risk,
        versus_robot(result, *window, by_hand=by_hand),
    ], key)
    # fixed values: what an absent tag becomes
    defaults = {
        "sznickname": "unknown", "nclubid": -1, "allin_frequency": 0.0, "fold_rate": 0.0,
        "playing_style": "Insufficient Data", "data_quality": "insufficient",
        "preferred_gametype": -1, "preferred_game_rounds": 0, "active_days": 0,
        "avg_round_duration_mins": 0.0, "peak_active_hour": -1, "activity_level": "silent",
        "total_hands_vs_bot": 0, "win_rate_vs_bot": 0.0, "avg_profit_vs_bot": 0.0,
        "high_stakes_ratio": 0.0, "bot_hands_ratio": 0.0, "player_profile_label": "No Bot Games",
    }
    return rows.na.fill(defaults).select(
        "nplayerid", "regtime", "brobot", "preloginip", "prelogintime", "sznickname", "nclubid",
        "vpip", "pfr", "three_bet_pct", "cbet_pct", "af", "allin_frequency", "fold_rate",
        "playing_style", "data_quality", "preferred_gametype", "preferred_game_rounds",
        "active_days", "avg_round_duration_mins", "peak_active_hour", "activity_level",
        rules.collusion_status(F.col("risk")).alias("collusion_status"),
        "total_hands_vs_bot", "win_rate_vs_bot", "avg_profit_vs_bot", "high_stakes_ratio",
        "bot_hands_ratio", "player_profile_label", "dt",
    )
