"""Collusion pairs, shared login addresses, and score extremes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehouse.functions.exprs import HAND, day_of, days_before, non_empty, ratio
from tablehouse.functions.rules import SUSPECT_DEFAULT, is_suspect
from tablehouse.operators.joins import pairs

# fixed values: columns of the pair table that are always zero
PLACEHOLDERS = [f"player{i}_{c}" for i in (1, 2)
                for c in ("aggressive", "agr_pct", "call", "call_pct", "fold", "fold_pct")]


def recent_ips(user: DataFrame, days: int = 30) -> DataFrame:
    """Login addresses per day and player, where the last login is within `days` of the day.

    The user snapshot holds one address per player and day, so the list is short.
    """
    seen = day_of("prelogintime")
    return (
        user.where((seen >= days_before(F.col("dt"), days)) & (seen <= F.col("dt"))
                   & non_empty("preloginip"))
        .groupBy("dt", "nplayerid").agg(F.collect_set("preloginip").alias("ips"))
    )


def pair_stats(result: DataFrame) -> DataFrame:
    """Per day and player pair: hands and tables together, hands either one won, net result."""
    won = (F.col("gameresult_1") > 0) | (F.col("gameresult_2") > 0)
    ids = ["nplayerid_1", "nplayerid_2"]
    per_hand = pairs(result, HAND, "nplayerid", ["gameresult"]).groupBy(*HAND, "_i", "_j", *ids).agg(
        F.sum(won.cast("int")).alias("wins"),
        F.sum(F.col("gameresult_1") + F.col("gameresult_2")).alias("net"))
    players = [F.col("nplayerid_1").alias("player1_id"), F.col("nplayerid_2").alias("player2_id")]
    return per_hand.groupBy("dt", *players).agg(
        F.count(F.lit(1)).alias("total_games"), F.count_distinct("sztoken").alias("total_desk"),
        F.sum("wins").alias("win_games"), F.sum("net").alias("total_gameresult"),
    )


def collusion_pairs(result: DataFrame, user: DataFrame, ip_days: int = 30) -> DataFrame:
    """Pairs of players who shared hands on a day, with shares of their hands and addresses."""
    hands = (
        result.select(*HAND, "nplayerid").distinct()
        .groupBy("dt", "nplayerid").agg(F.count(F.lit(1)).alias("games"))
    )
    # one dimension per player and day, joined once per side
    player = hands.join(recent_ips(user, ip_days), ["dt", "nplayerid"], "left")

    def of(side: int) -> DataFrame:
        return player.select(
            "dt", F.col("nplayerid").alias(f"player{side}_id"),
            F.col("games").alias(f"games{side}"), F.col("ips").alias(f"ips{side}"))

    shared = F.array_sort(F.array_intersect("ips1", "ips2"))
    same = F.col("total_games")
    rows = (
        pair_stats(result).join(of(1), ["dt", "player1_id"]).join(of(2), ["dt", "player2_id"])
        .withColumn("shared", F.when(F.size(shared) > 0, shared))
    )
    return rows.select(
        "player1_id", "player2_id", "total_games", "total_desk", "win_games",
        ratio("win_games", "total_games", 4).alias("win_rate"), "total_gameresult",
        same.alias("same_cnt"), ratio(same, "games1", 9).alias("player1_same_rate"),
        ratio(same, "games2", 9).alias("player2_same_rate"),
        *[F.lit(0).alias(c) for c in PLACEHOLDERS],
        F.when(F.col("shared").isNotNull(), F.size("shared").cast("bigint")).alias("shared_ip_cnts"),
        F.col("shared").alias("shared_ip"), "dt",
    )


def players_of(pair_rows: DataFrame) -> DataFrame:
    """Distinct players of either side, per day."""
    return pair_rows.select("dt", F.explode(F.array("player1_id", "player2_id")).alias("playerid")).distinct()


def suspects(pair_rows: DataFrame, limits=SUSPECT_DEFAULT) -> DataFrame:
    return players_of(pair_rows.where(is_suspect(limits)))


def able_rows(result: DataFrame, same: int) -> DataFrame:
    """Rows of players with at least `same` hands on the day: nobody else can share so many with anyone."""
    hands = result.select(*HAND, "nplayerid").distinct().groupBy("dt", "nplayerid").agg(F.count(F.lit(1)).alias("games"))
    return result.join(hands.where(F.col("games") >= same), ["dt", "nplayerid"])


def suspects_from_results(result: DataFrame, limits=SUSPECT_DEFAULT) -> DataFrame:
    """`suspects` straight from the results: players who can't reach the bound of shared hands go before any pair is made."""
    able = able_rows(result, limits[0])
    games = able.select("dt", "nplayerid", "games").distinct()
    rows = pair_stats(able).where((F.col("total_games") >= limits[0]) & (F.col("total_desk") >= limits[3]))
    for side in (1, 2):
        rows = rows.join(games.select("dt", F.col("nplayerid").alias(f"player{side}_id"), F.col("games").alias(f"games{side}")), ["dt", f"player{side}_id"])
    same = F.col("total_games")
    return suspects(rows.select(
        "dt", "player1_id", "player2_id", same.alias("same_cnt"), ratio("win_games", "total_games", 4).alias("win_rate"), "total_desk",
        ratio(same, "games1", 9).alias("player1_same_rate"), ratio(same, "games2", 9).alias("player2_same_rate")), limits)


def shared_ip_players(pair_rows: DataFrame) -> DataFrame:
    return players_of(pair_rows.where("shared_ip_cnts is not null"))


def score_extremes(users: DataFrame, scores: DataFrame, keys: list[str], id_col: str = "nplayerid",
                   default: float = 0.0) -> DataFrame:
    """Highest and lowest historical score per table of at least two players.

    A player without a score counts with the default; ties go to the smallest id.
    """
    seated = users.select(*keys, id_col, "ngametype").distinct()
    s = F.coalesce("score", F.lit(default))
    rows = seated.join(scores.select(id_col, "ngametype", "score"), [id_col, "ngametype"], "left")
    low = F.min(F.struct(s.alias("s"), F.col(id_col).alias("p")))
    high = F.min(F.struct((-s).alias("s"), F.col(id_col).alias("p")))
    return (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("players"), high.alias("h"), low.alias("l"))
        .where("players >= 2")
        .select(*keys, "players", F.col("h.p").alias("high_id"), (-F.col("h.s")).alias("high_score"),
                F.col("l.p").alias("low_id"), F.col("l.s").alias("low_score"),
                (F.col("h.s") == -F.col("l.s")).alias("all_equal"))
    )
