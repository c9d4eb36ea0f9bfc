"""Ordered classification rules.  Labels and cut points are fixed values of the data products."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: messages that concern one seat
SEAT_ACTIONS = [
    "S2CDelayOpTime", "S2CGiveUp", "S2CStatePlayerOp", "S2CBuyInsure", "S2CDealTwiceOp",
    "S2CPushBet", "S2CShowHandCard", "S2CShowMyCard", "S2CStateBuyInsure", "S2CUpdateScore",
]
# fixed values: messages that are not actions
META_MESSAGES = ["RoomInfos", "SeatInfos"]
# fixed values: label per state code
BET_STATES = {1: "none", 2: "check", 3: "call", 4: "raise", 5: "allin", 6: "fold"}
INSURE_STATES = {
    1: "ins_none", 2: "ins_buy", 3: "ins_giveup", 4: "ins_buying",
    5: "ins_bupai_invalid", 6: "ins_auto_buy",
}

# fixed values: raise sizes as action classes
RAISE_CLASSES = ["fold", "check_call", "raise_half_pot", "raise_3_4_pot", "raise_pot",
                 "raise_3_2_pot", "raise_double_pot", "all_in"]

SUSPECT_DEFAULT = (20, 0.7, 0.75, 3)


def chain(*cases, default=None) -> Column:
    """First matching (condition, value) pair."""
    (c0, v0), *rest = cases
    out = reduce(lambda w, cv: w.when(cv[0], cv[1]), rest, F.when(c0, v0))
    return out if default is None else out.otherwise(default)


def code_label(code, labels: dict) -> Column:
    return chain(*[(code == k, F.lit(v)) for k, v in labels.items()])


def bet_action(action, bet_state, insure_state) -> Column:
    return (
        F.when(action == "S2CBuyInsure", code_label(insure_state, INSURE_STATES))
        .when(action == "S2CStateGameStart", "init")
        .when(action == "S2CGiveUp", "Fold")
        .otherwise(code_label(bet_state, BET_STATES))
    )


def street(board) -> Column:
    """Street from the comma-separated board."""
    n = F.size(F.split(board, ","))
    return chain((n == 3, "flop"), (n == 4, "turn"), (n == 5, "river"), default="preflop")


def data_quality(hands, actions) -> Column:
    return chain(
        ((hands >= 100) & (actions >= 200), "high"),
        ((hands >= 50) & (actions >= 100), "medium"),
        ((hands >= 10) & (actions >= 20), "low"),
        default="insufficient",
    )


def playing_style(hands, vpip, pfr_of_vpip, threebet_of_vpip, aggression, fold_rate) -> Column:
    """Style label; the arguments after `hands` are unrounded rates, null where undefined."""
    tight, loose = vpip <= 0.20, vpip > 0.20
    return chain(
        (hands < 10, "Insufficient Data"),
        ((vpip > 0.35) & (aggression > 3.0), "Maniac (超激进)"),
        (tight & (pfr_of_vpip >= 0.60) & (threebet_of_vpip >= 0.25), "Strong TAG (高3-bet紧凶)"),
        ((vpip > 0.25) & (pfr_of_vpip < 0.30) & (aggression < 1.0), "Calling Station (跟注站)"),
        (fold_rate > 0.60, "Nit (过度弃牌)"),
        (tight & (pfr_of_vpip >= 0.60), "Tight-Aggressive (TAG)"),
        (loose & (pfr_of_vpip >= 0.50), "Loose-Aggressive (LAG)"),
        (tight & (pfr_of_vpip < 0.60), "Tight-Passive (TP)"),
        (loose & (pfr_of_vpip < 0.50), "Loose-Passive (LP)"),
        default="Unclassified",
    )


def activity_level(days, labels=("high", "medium", "low", "silent")) -> Column:
    return chain((days >= 5, labels[0]), (days >= 3, labels[1]), (days >= 1, labels[2]),
                 default=labels[3])


ACTIVITY_TAGS = ("high", "mid", "low", "silenct")


def vs_robot_label(win_rate, avg_profit, robot_share) -> Column:
    return chain(
        ((win_rate > 0.60) & (avg_profit > 0), "Exploiter (剥削者)"),
        ((win_rate < 0.40) & (avg_profit < 0), "Struggling (挣扎者)"),
        (win_rate.between(0.40, 0.60), "Balanced (平衡型)"),
        (robot_share > 0.8, "Bot Hunter (猎人)"),
        default="Unclassified",
    )


def is_suspect(limits=SUSPECT_DEFAULT) -> Column:
    """Predicate on collusion-pair rows."""
    same, win, share, desks = limits
    return (
        (F.col("same_cnt") >= same)
        & (F.col("win_rate") >= win)
        & ((F.col("player1_same_rate") >= share) | (F.col("player2_same_rate") >= share))
        & (F.col("total_desk") >= desks)
    )


def collusion_status(player) -> Column:
    return F.when(player.isNotNull(), "collusion_suspected").otherwise("normal")


def outcome(robot, result) -> Column:
    return chain(
        ((robot == 1) & (result >= 0), "robot_good_win"),
        ((robot == 1) & (result < 0), "robot_good_lose"),
        ((robot == 0) & (result >= 0), "human_good_win"),
        ((robot == 0) & (result < 0), "human_good_lose"),
    )


def raise_bucket(action, num, pot) -> Column:
    """Class 0..7 of an action code (0 fold, 1 check or call, 2 raise, 3 all-in) and its size."""
    def part(times: float) -> Column:
        return F.floor(pot * times)

    return chain(
        (action == 0, 0), (action == 1, 1), (action == 3, 7),
        (num < part(0.75), 2), (num < pot, 3), (num < part(1.5), 4), (num < pot * 2, 5),
        default=6,
    )


def simple_action(action) -> Column:
    """-1 forced bet, 0 fold, 1 anything else."""
    return chain((action < 0, -1), (action == 0, 0), default=1)


def board_street(n) -> Column:
    """Street number from the count of public cards."""
    return chain((n == 0, 0), (n == 3, 1), (n == 4, 2), default=3)
