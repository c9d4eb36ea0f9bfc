"""The derived inputs reach every label and branch: what the registered queries show at sf0.01.

The SQL side is read, which the other tests hold equal to the Spark side.
"""

import pytest
from compare import connect

import __spark_entry__ as entry

SQLS = entry.oracle_sql()

STYLES = {"Insufficient Data", "Maniac (超激进)", "Strong TAG (高3-bet紧凶)", "Calling Station (跟注站)", "Nit (过度弃牌)",
          "Tight-Aggressive (TAG)", "Loose-Aggressive (LAG)", "Tight-Passive (TP)", "Loose-Passive (LP)", "Unclassified"}
LABELS = [
    ("player_style", "playing_style", STYLES),
    ("player_style", "data_quality", {"high", "medium", "low", "insufficient"}),
    ("player_profile", "playing_style", STYLES),
    ("player_profile", "player_profile_label", {"Bot Hunter (猎人)", "Unclassified"}),
    ("player_profile", "collusion_status", {"normal", "collusion_suspected"}),
    ("player_profile_7d", "activity_level", {"high", "medium", "low", "silent"}),
    ("player_profile_7d", "player_profile_label",
     {"No Bot Games", "Exploiter (剥削者)", "Struggling (挣扎者)", "Balanced (平衡型)"}),
    ("activity_tags_7d", "active_tag", {"high", "mid", "low"}),
    ("player_action", "betaction",
     {None, "init", "Fold", "none", "check", "call", "raise", "allin", "fold", "ins_none", "ins_buy", "ins_giveup", "ins_buying",
      "ins_bupai_invalid", "ins_auto_buy"}),
    ("player_action", "stage", {"preflop", "flop", "turn", "river"}),
    ("showdown_winners", "category", set(range(1, 10))),
    ("showdown_short", "category", set(range(1, 10))),
    ("showdown_audit", "finding", {"mismatch", "duplicate"}),
    ("equity_audit", "finding", {"mismatch", "duplicate"}),
    ("score_extremes", "all_equal", {False, True}),
    ("flag_export", "value", {1, 3}),
    ("raise_bucket", "bucket", set(range(8))),
    ("preset_result", "play_result", {"robot_good_win", "robot_good_lose", "human_good_win", "human_good_lose"}),
]


@pytest.fixture(scope="module")
def con():
    return connect("/root/testdata/sf0.01")


def values(con, query: str, column: str) -> set:
    return {r[0] for r in con.sql(f'select distinct "{column}" from ({SQLS[query]}) q').fetchall()}


@pytest.mark.parametrize("query, column, labels", LABELS, ids=[f"{q}-{c}" for q, c, _ in LABELS])
def test_every_label_occurs(con, query, column, labels):
    assert values(con, query, column) >= labels


def test_every_figure_occurs(con):
    """No figure of the daily overview is zero on all days."""
    rel = con.sql(SQLS["daily_overview"])
    sums = con.sql("select " + ", ".join(f'sum("{c}")' for c in rel.columns if c != "dt") + f" from ({SQLS['daily_overview']}) q").fetchall()[0]
    assert all(sums)


def test_rows_leave_windows(con):
    short, long = (con.sql(f"select sum(total_round_cnt) from ({SQLS[q]}) q").fetchall()[0][0] for q in ("robot_stats_7d", "robot_stats_90d"))
    assert short < long
    assert con.sql(f"select count(*) from ({SQLS['player_profile_7d']}) a join ({SQLS['player_profile']}) b using (dt, nplayerid) "
                   "where a.active_days < b.active_days").fetchall()[0][0] > 0


def test_ties_filters_and_hands(con):
    def one(text: str):
        return con.sql(text).fetchall()[0][0]

    assert one(f"select sum(tie_cnt) from ({SQLS['win_lose_round']}) q") > 0
    assert one(f"select sum(tie_cnt) from ({SQLS['robot_win_lose']}) q") > 0
    kept, every = (one(f"select count(*) from ({SQLS[q]}) q") for q in ("profile_mart", "player_profile"))
    assert 0 < kept < every
    assert one(f"select count(*) from ({SQLS['player_profile']}) q where preloginip is null or preloginip = ''") > 0
    assert one(f"select count(distinct (hand_class)) from ({SQLS['preflop_equity']}) q") > 160
    assert one(f"select count(*) from ({SQLS['preflop_equity']}) q where substr(hand_class, 1, 1) = substr(hand_class, 2, 1)") > 0
    bets = con.sql(f"select min(hands), max(hands) from ({SQLS['player_bet_stats']}) q").fetchall()[0]
    assert bets[0] < 128 == bets[1]
