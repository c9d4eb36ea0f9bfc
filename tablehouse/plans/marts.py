"""Admin marts: small daily tables for reporting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehouse.functions import rules
from tablehouse.functions.exprs import HAND, any_if, day_of, num, ratio, sum_if
from tablehouse.operators.joins import anti, semi, star
from tablehouse.operators.keyed import rolling_sum
from tablehouse.plans.risk import shared_ip_players, suspects


def _count(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def new_users(user: DataFrame) -> DataFrame:
    """Human users of a day's snapshot who are not in the snapshot of the day before."""
    human = user.where(F.col("brobot").cast("string") == "0").select("dt", "nplayerid").distinct()
    next_day = F.date_add(F.to_date("dt"), 1).cast("string")
    return anti(human, human.select(next_day.alias("dt"), "nplayerid"), ["dt", "nplayerid"])


def abnormal_winners(result: DataFrame, rate: float = 0.8, rounds: int = 10) -> DataFrame:
    hands = result.groupBy(*HAND, "nplayerid").agg(any_if(F.col("gameresult") > 0).alias("won"))
    return hands.groupBy("dt", "nplayerid").agg(
        F.count(F.lit(1)).alias("round_cnt"), F.sum("won").alias("win_round_cnt"),
    ).where((F.col("round_cnt") >= rounds) & (ratio("win_round_cnt", "round_cnt") >= rate))


def monthly_players(result: DataFrame, first_dt: str, last_dt: str, days: int = 30) -> DataFrame:
    daily = result.where("brobot = 0").select("dt", "nplayerid").distinct()
    return rolling_sum(daily, ["nplayerid"], [], days, first_dt, last_dt).groupBy("dt").agg(
        F.count("nplayerid").alias("month_real_player_cnt"))


def preset_kpis(preset: DataFrame, result: DataFrame) -> DataFrame:
    """Interventions per day: hands, players, rewarded players, rewarded players who won."""
    won = result.groupBy(*HAND, "nplayerid").agg(any_if(F.col("gameresult") > 0).alias("won"))
    rows = preset.where("bpreset = 'true'").select(
        "dt", "sztoken", num("nround", "bigint").alias("nround"), num("nplayerid", "bigint").alias("nplayerid"),
        (num("presettype") == 2).alias("reward"),
    ).join(won, [*HAND, "nplayerid"], "left")
    player = rows.groupBy("dt", "nplayerid").agg(
        any_if(F.col("reward")).alias("r"), any_if(F.col("reward") & (F.col("won") == 1)).alias("w"))
    per_day = player.groupBy("dt").agg(
        F.count("nplayerid").alias("preset_player_cnt"), F.sum("r").alias("reward_player_cnt"),
        F.sum("w").alias("reward_win_round_cnt"))
    hands = _count(rows.select(*HAND).distinct(), ["dt"], "preset_round_cnt")
    return hands.join(per_day, "dt")


def daily_overview(result: DataFrame, user: DataFrame, preset: DataFrame, collusion: DataFrame,
                   first_dt: str, last_dt: str, days: int = 30) -> DataFrame:
    """Fifteen indicators per day; `days` is the look-back of the monthly players.

    One pass per hand gives round counts and the robots' share: a hand counts for the
    robots if it has a human and a robot, as a win if the robots together gained.
    """
    day = result.where((F.col("dt") >= first_dt) & (F.col("dt") <= last_dt))
    robot, human = F.col("brobot") == 1, F.col("brobot") == 0
    mixed = (F.col("human") == 1) & (F.col("robot") == 1)
    totals = (
        day.groupBy(*HAND).agg(any_if(human).alias("human"), any_if(robot).alias("robot"),
                               sum_if(robot, F.col("gameresult")).alias("profit"))
        .groupBy("dt").agg(
            F.count(F.lit(1)).alias("round_cnt"), F.count_if(mixed).alias("robot_round_cnt"),
            F.count_if(mixed & (F.col("profit") > 0)).alias("robot_win_round_cnt"))
    )
    active = _count(day.where(human & F.col("nplayerid").isNotNull()).select("dt", "nplayerid").distinct(),
                    ["dt"], "day_real_player_cnt")
    parts = [
        active, monthly_players(result, first_dt, last_dt, days),
        _count(new_users(user), ["dt"], "new_player_cnt"), preset_kpis(preset, result),
        _count(suspects(collusion), ["dt"], "collusion_player_cnt"),
        _count(shared_ip_players(collusion), ["dt"], "same_ip_player_cnt"),
        _count(abnormal_winners(day), ["dt"], "abnormal_high_win_player_cnt"),
    ]
    zeros = ["day_real_player_cnt", "month_real_player_cnt", "new_player_cnt", "preset_round_cnt",
             "preset_player_cnt", "reward_player_cnt", "reward_win_round_cnt", "collusion_player_cnt",
             "same_ip_player_cnt", "abnormal_high_win_player_cnt"]
    return star(totals, parts, ["dt"]).na.fill(0, zeros).select(
        "dt", "round_cnt", "robot_round_cnt", ratio("robot_round_cnt", "round_cnt", 6).alias("robot_round_pct"),
        "robot_win_round_cnt", ratio("robot_win_round_cnt", "robot_round_cnt", 6).alias("robot_win_round_pct"),
        *zeros)


def _robot_hands(result: DataFrame) -> DataFrame:
    """Robots' profit per hand, game type and version, on hands with a human."""
    with_human = result.where("brobot = 0").select(*HAND).distinct()
    robots = result.where("brobot = 1").groupBy(*HAND, "ngametype", "robotversion").agg(
        F.sum("gameresult").alias("profit"))
    return semi(robots, with_human, HAND)


def robot_stats(result: DataFrame, first_dt: str | None = None, last_dt: str | None = None,
                days: int = 0) -> DataFrame:
    """Robot results by version and game type per day, or over `days` days up to each run day.

    The 90-day report is days=90: the window is open below, so it spans 90 days.
    """
    keys = ["dt", "robotversion", "ngametype"]
    daily = _robot_hands(result).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_round_cnt"),
        F.count_if(F.col("profit") > 0).alias("win_round_cnt"), F.sum("profit").alias("gameresult"))
    if days:
        sums = ["total_round_cnt", "win_round_cnt", "gameresult"]
        daily = rolling_sum(daily, keys[1:], sums, days - 1, first_dt, last_dt)
    return daily.select(
        "dt", F.lit(1).alias("brobot"), "robotversion", "ngametype", "total_round_cnt", "win_round_cnt",
        F.lit(0).alias("total_player_cnt"), F.lit(0).alias("win_player_cnt"), "gameresult")


def active_hours(scored: DataFrame) -> DataFrame:
    """Players and rounds per game type, day and hour; only rows without robot information."""
    return (
        scored.where("brobot is null")
        .groupBy("ngametype", day_of("createtime").alias("start_dt"),
                 F.substring("createtime", 12, 2).alias("start_dt_hr"))
        .agg(F.count_distinct("nplayerid").alias("player_cnt"),
             F.count_distinct("sztoken", "nround").alias("round_cnt"))
    )


def activity_tags(result: DataFrame, first_dt: str, last_dt: str, days: int = 30) -> DataFrame:
    """Players per activity bucket of the days they played in the window."""
    daily = result.where("brobot = 0").select("dt", "nplayerid", F.lit(1).alias("n")).distinct()
    per_player = rolling_sum(daily, ["nplayerid"], ["n"], days, first_dt, last_dt)
    tag = rules.activity_level(F.col("n"), rules.ACTIVITY_TAGS)
    return per_player.groupBy("dt", tag.alias("active_tag")).agg(F.count("nplayerid").alias("player_cnt"))


def preset_overview(preset: DataFrame) -> DataFrame:
    return preset.groupBy(
        "dt", "ngametype", F.coalesce("inventiontype", F.lit("no_preset")).alias("inventiontype"),
    ).agg(F.count_distinct("sztoken", "nround").alias("round_cnt"),
          F.count_distinct("nplayerid").alias("player_cnt"))


def preset_result(preset: DataFrame, gold: DataFrame, score: DataFrame) -> DataFrame:
    """How rewarded players fared: hands and players per intervention, game type and outcome."""
    key = [*HAND, "nplayerid", "ngametype"]
    rows = preset.where((F.col("bpreset") == "true") & (num("presettype") == 2)).select(
        "dt", "sztoken", num("nround", "bigint").alias("nround"), num("nplayerid", "bigint").alias("nplayerid"),
        num("ngametype", "int").alias("ngametype"), num("brobot", "int").alias("brobot"), "inventiontype",
    ).where(F.col("ngametype").isin(420, 450))
    results = (
        score.where("ngametype = 420").select(*key, "gameresult")
        .unionByName(gold.where("ngametype = 450").select(*key, "gameresult"))
    )
    play = rules.outcome(F.col("brobot"), F.col("gameresult"))
    return (
        rows.join(results, key, "left")
        .groupBy("dt", "inventiontype", "ngametype", play.alias("play_result"))
        .agg(F.count_distinct("sztoken", "nround").alias("round_cnt"),
             F.count_distinct("nplayerid").alias("player_cnt"))
    )


def profile_mart(profile: DataFrame) -> DataFrame:
    return profile.where("active_days > 0")


# fixed values: key pattern, value and seconds to live (-1: for ever) per flag
FLAGS = {"new_user": ("new_user:%s", 1, -1), "suspect_user": ("suspect_user:%s", 3, 172800)}


def flag_export(players: DataFrame, flag: str, id_col: str = "nplayerid") -> DataFrame:
    """Key/value rows with their life time, ready for any key-value sink."""
    pattern, value, ttl = FLAGS[flag]
    expires = F.when(F.lit(ttl >= 0), F.date_add(F.to_date("dt"), max(ttl, 0) // 86400).cast("string"))
    return players.select(
        F.format_string(pattern, F.col(id_col).cast("string")).alias("key"), F.lit(value).alias("value"),
        F.lit(ttl).alias("ttl"), expires.alias("expires_at"), "dt").distinct()


def all_flags(user: DataFrame, collusion: DataFrame, snapshot: bool = False) -> DataFrame:
    """Both flags.  New users are those the day before lacks; `snapshot` takes every user instead."""
    fresh = user.select("dt", "nplayerid").distinct() if snapshot else new_users(user)
    return flag_export(fresh, "new_user").unionByName(
        flag_export(suspects(collusion), "suspect_user", "playerid"))
