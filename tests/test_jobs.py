"""Hand-made cases for the jobs."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablehouse.operators.keyed import rolling_distinct, rolling_sum
from tablehouse.plans import actions, evaluate, jsonlog, marts, results, risk, tags

LOG = ("id bigint, ngametype int, nplayerid int, sztoken string, nround int, nwinscore bigint, nscore bigint, "
       "sztitle string, szhandcard string, szcarddata string, createtime string, dt string")
DAY = "2024-01-05"


def log(spark, *texts, player=1):
    rows = [(i, 79, player, "t", i, 0, 0, "", "", x, f"{DAY} 10:00:00", DAY) for i, x in enumerate(texts)]
    return spark.createDataFrame(rows, LOG)


def msg(name, **data):
    return {"name": name, "data": data}


def test_explode_keeps_positions(spark):
    text = json.dumps([{"name": "a", "data": {"x": 1}}, 5, {"name": "b", "data": [1, 2]}])
    rows = jsonlog.explode_log(log(spark, text, "notjson", "[]", None)).orderBy("json_index").collect()
    assert [(r.json_index, r.name, r.data) for r in rows] == [(0, "a", '{"x":1}'), (2, "b", "[1,2]")]
    assert json.loads(rows[0].carddata) == {"name": "a", "data": '{"x":1}', "json_index": "0"}


def test_explode_with_repeated_keys(spark):
    text = '[{"name": "a", "json_index": 9, "name": "b", "data": 1}, 7]'
    frame = log(spark, text, "notjson", "[]", None)
    rows = jsonlog.explode_log(frame).collect()
    assert [(r.json_index, r.name, r.data, r.carddata) for r in rows] == [(0, "b", "1", '{"name":"b","data":"1","json_index":"0"}')]
    left = jsonlog.rejected(frame).orderBy("id").collect()
    assert [(r.id, r.json_index, r.rejected) for r in left] == [(0, 1, "7"), (1, None, "notjson"), (3, None, None)]


def test_messages_from_carddata(spark):
    exploded = jsonlog.explode_log(log(spark, json.dumps([msg("SeatInfos", data=[{"nPlayerId": 7, "seat": 2}])])))
    again = jsonlog.seat_info(exploded.drop("json_index", "name", "data"))
    assert again.exceptAll(jsonlog.seat_info(exploded)).count() == 0 and again.count() == 1


def test_seat_payload_shapes(spark):
    seats = [{"nPlayerId": 7, "seat": 2}, {"nPlayerId": 8, "seat": 3}]
    bare, wrapped = json.dumps([{"name": "SeatInfos", "data": seats}]), json.dumps([msg("SeatInfos", data=seats)])
    rows = jsonlog.seat_info(jsonlog.explode_log(log(spark, bare, wrapped))).collect()
    by_hand = {n: {(r.playerid, r.seat) for r in rows if r.nround == n} for n in (0, 1)}
    assert by_hand[0] == by_hand[1] == {("7", "2"), ("8", "3")}


def hand(listed):
    wrap = (lambda x: json.dumps(x, separators=(",", ":"))) if listed else (lambda x: x)
    return json.dumps([
        {"name": "SeatInfos", "data": [{"nPlayerId": 11, "seat": 1}, {"nPlayerId": 12, "seat": 2}]},
        msg("S2CStateGameStart", seatCurBets=wrap([5, 10]), smallBlindSeat=1, bigBlindSeat=2, poolScore=15),
        msg("S2CStatePlayerOp", curSeat=1, minBetScore=10, seatBetState=4, betScore=30, poolScore=45),
        msg("S2CStateDealCard", commonCards=wrap([1, 2, 3])),
        msg("S2CBuyInsure", seat=2, score=20, state=2),
        msg("S2CGiveUp", seat=1),
        msg("S2CStateConclude", insureWinLos=wrap([0, -5])),
    ])


def action_rows(spark, text, fill="last", copies=1):
    logs = log(spark, text)
    for _ in range(copies - 1):
        logs = logs.unionByName(log(spark, text, player=2))
    dwd = jsonlog.explode_log(logs)
    score = spark.createDataFrame([("t", 0, 11, 100, DAY), ("t", 0, 12, -100, DAY)],
                                  "sztoken string, nround int, nplayerid int, gameresult bigint, dt string")
    return actions.player_action(dwd, jsonlog.seat_info(dwd), score, fill).orderBy("json_index").collect()


def test_player_action(spark):
    rows = action_rows(spark, hand(False))
    view = [(r.json_index, r.playerid, r.action, r.betaction, r.stage) for r in rows]
    assert view == [
        (1, "11", "S2CStateGameStart", "init", "preflop"), (2, "12", "S2CStateGameStart", "init", "preflop"),
        (3, "11", "S2CStatePlayerOp", "raise", "preflop"),
        (4, "11", "S2CStateDealCard", None, "flop"), (5, "12", "S2CStateDealCard", None, "flop"),
        (6, "12", "S2CBuyInsure", "ins_buy", "flop"), (7, "11", "S2CGiveUp", "Fold", "flop"),
        (8, "11", "S2CStateConclude", None, "flop"), (9, "12", "S2CStateConclude", None, "flop"),
    ]
    assert [r.poolscore for r in rows] == [5, 15, 45, 45, 15, 15, 45, 45, 15]
    assert rows[0].betscore == 5 and rows[1].seatcurbet == 10 and rows[2].betscore == 30
    assert rows[0].minbetscore == 10 and rows[1].minbetscore is None
    assert [r.predealct for r in rows] == [0, 0, 0, 1, 1, 1, 1, 1, 1]
    bought = rows[5]
    assert (bought.isinsure, bought.isjumpinsure, bought.score) == (1, 1, 20.0)
    # filled back: the insurance outcome and payment reach the player's earlier rows
    assert [r.insurewinscores for r in rows if r.playerid == "12"] == [15.0] * 4
    assert {r.gameresult for r in rows if r.playerid == "11"} == {100}


def test_lists_as_text_and_copies_of_a_log(spark):
    assert action_rows(spark, hand(True)) == action_rows(spark, hand(False)) == action_rows(spark, hand(False), copies=2)


@pytest.mark.parametrize("fill", ["last", "first"])
def test_hot_hands_give_the_same(spark, sf_dir, fill):
    """Hands cut into pieces: as windows over whole hands."""
    from tablehouse.fixtures import Fixtures

    fx = Fixtures(spark, sf_dir)
    dwd = jsonlog.explode_log(fx.hand_log.where("dt <= '2024-01-03'"))
    seats = jsonlog.seat_info(dwd)
    plain = actions.player_action(dwd, seats, fx.result, fill).collect()
    cut = actions.player_action(dwd, seats, fx.result, fill, rows=5).collect()
    assert Counter(map(str, plain)) == Counter(map(str, cut)) and len(plain) > 100


def test_fill_variants(spark):
    text = json.dumps([
        {"name": "SeatInfos", "data": [{"nPlayerId": 11, "seat": 1}]},
        msg("S2CUpdateScore", seat=1), msg("S2CStatePlayerOp", curSeat=1, minBetScore=7),
        msg("S2CUpdateScore", seat=1), msg("S2CStatePlayerOp", curSeat=1, minBetScore=9)])
    assert [r.minbetscore for r in action_rows(spark, text)] == [9, 7, 7, 9]
    assert [r.minbetscore for r in action_rows(spark, text, "first")] == [7, 7, 7, 9]


SCORE = ("ngametype int, sztoken string, nplayerid int, nround int, gameresult bigint, createtime string, "
         "starttime string, endtime string, dt string")


def score_row(token, rnd, result, player=1, kind=79, dt=DAY, created=DAY):
    t = f"{created} 10:00:00"
    return (kind, token, player, rnd, result, t, t, f"{created} 10:05:00", dt)


def test_hands_are_composite_keys(spark):
    rows = spark.createDataFrame([score_row("t1", 2, 5), score_row("t", 12, 5)], SCORE).withColumn("brobot", F.lit(0))
    assert results.win_lose_round(rows).first().total_cnt == 2


def test_game_result(spark):
    score = spark.createDataFrame([score_row("a", 1, 5), score_row("a", 2, 5, created="2024-01-04")], SCORE)
    gold = spark.createDataFrame([score_row("b", 1, -5, kind=450)], SCORE)
    robot = spark.createDataFrame(
        [(1, "a", 1, "old", 0, "2024-01-04"), (1, "a", 1, "new", 1, DAY)],
        "playerid int, sztoken string, nround int, robotversion string, brobot int, dt string")
    rows = {r.sztoken: r for r in results.game_result(score, gold, robot).collect()}
    assert len(rows) == 2  # the row created on another day is left out
    assert (rows["a"].brobot, rows["a"].robotversion) == (1, "new")
    assert (rows["b"].brobot, rows["b"].robotversion) == (0, "0")


def test_null_robot_flag_is_one_group(spark):
    rows = spark.createDataFrame([score_row("a", 1, 5), score_row("a", 2, -5)], SCORE).withColumns({
        "brobot": F.when(F.col("nround") == 1, 0), "robotversion": F.lit(None).cast("string"), "create_dt": F.col("dt")})
    out = results.robot_win_lose(rows).collect()
    assert len(out) == 1 and (out[0].win_cnt, out[0].lose_cnt, out[0].total_score) == (1, 1, 0)


ACTION = "sztoken string, nround int, playerid int, json_index int, action string, stage string, betaction string, dt string"


def act(i, player, bet, stage="preflop", rnd=0, dt=DAY):
    return ("t", rnd, player, i, "S2CStatePlayerOp", stage, bet, dt)


def test_style(spark):
    rows = [act(1, 1, "raise"), act(2, 1, "raise"), act(3, 2, "call"), act(4, 1, "raise", "flop"), act(5, 3, "Fold"),
            act(6, 4, "fold"), act(7, 4, "check", "turn")]
    out = {r.playerid: r for r in tags.player_style(spark.createDataFrame(rows, ACTION), DAY, DAY).collect()}
    assert out[1].three_bet_pct == 1.0  # an own re-raise counts
    assert (out[1].vpip, out[1].pfr, out[1].cbet_pct) == (1.0, 1.0, 1.0)
    assert out[3].fold_rate is None and out[3].allin_frequency is None  # one action only
    assert out[4].fold_rate == 0.0  # only the give-up label is a fold
    assert out[1].playing_style == "Insufficient Data" and out[1].data_quality == "insufficient"
    both = tags.player_style(spark.createDataFrame(rows, ACTION), DAY, DAY, fold_labels=("Fold", "fold"))
    assert both.where("playerid = 4").first().fold_rate == 0.5


def test_rolling(spark):
    rows = [(f"2024-01-{1 + i * i % 19:02d}", i % 3, i, f"v{i % 4}") for i in range(40)]
    df = spark.createDataFrame(rows, "dt string, k int, n int, v string")
    for first, last in (("2024-01-04", "2024-01-25"), ("2024-01-09", "2024-01-09")):
        for days in (0, 2, 30):
            want = {}
            for d in range(int(first[-2:]), int(last[-2:]) + 1):
                for k in range(3):
                    hit = [r for r in rows if r[1] == k and d - days <= int(r[0][-2:]) <= d]
                    if hit:
                        want[f"2024-01-{d:02d}", k] = (sum(r[2] for r in hit), len({r[3] for r in hit}))
            sums = {(r.dt, r.k): r.n for r in rolling_sum(df, ["k"], ["n"], days, first, last).collect()}
            kinds = {(r.dt, r.k): r.c for r in rolling_distinct(df, ["k"], "v", days, first, last, "c").collect()}
            assert sums == {k: v[0] for k, v in want.items()}
            assert kinds == {k: v[1] for k, v in want.items()}


def test_empty_times(spark):
    rows = spark.createDataFrame([score_row("a", 1, 5)], SCORE).withColumn("starttime", F.lit(""))
    out = tags.activity(rows.withColumn("brobot", F.lit(0)), DAY, DAY).first()
    assert (out.active_days, out.avg_round_duration_mins, out.peak_active_hour) == (1, None, None)


def test_overview_without_robots(spark):
    result = spark.createDataFrame([score_row("a", 1, 5)], SCORE).withColumns({"brobot": F.lit(0), "robotversion": F.lit("0")})
    user = spark.createDataFrame([(1, "0", DAY)], "nplayerid int, brobot string, dt string")
    preset = spark.createDataFrame([], "sztoken string, nround string, nplayerid string, bpreset string, presettype string, dt string")
    pairs = risk.collusion_pairs(result, user.withColumns({"prelogintime": F.lit(DAY), "preloginip": F.lit("1.1.1.1")}))
    row = marts.daily_overview(result, user, preset, pairs, DAY, DAY).first()
    assert (row.round_cnt, row.robot_round_cnt, row.robot_win_round_pct, row.new_player_cnt) == (1, 0, None, 1)


def test_flags(spark):
    user = spark.createDataFrame(
        [(1, "0", "2024-01-04"), (1, "0", DAY), (2, "0", DAY), (3, "1", DAY)], "nplayerid int, brobot string, dt string")
    out = {(r.key, r.dt): r for r in marts.flag_export(marts.new_users(user), "new_user").collect()}
    assert set(out) == {("new_user:1", "2024-01-04"), ("new_user:2", DAY)}
    s = spark.createDataFrame([(DAY, 9)], "dt string, playerid int")
    row = marts.flag_export(s, "suspect_user", "playerid").first()
    assert (row.key, row.value, row.ttl, row.expires_at) == ("suspect_user:9", 3, 172800, "2024-01-07")


def test_suspect_rule(spark):
    cols = "same_cnt int, win_rate double, player1_same_rate double, player2_same_rate double, total_desk int, player1_id int, player2_id int, dt string"
    rows = [(20, 0.7, 0.75, 0.0, 3, 1, 2, DAY), (19, 0.9, 0.9, 0.9, 9, 3, 4, DAY), (20, 0.7, 0.7, 0.74, 3, 5, 6, DAY)]
    assert {r.playerid for r in risk.suspects(spark.createDataFrame(rows, cols)).collect()} == {1, 2}


def test_bet_stats_padding_and_history(spark):
    hands = spark.createDataFrame([(1, h, h, 2, 2 * h) for h in range(5)] + [(2, 9, 9, 2, 4)],
                                  "playerid int, hand int, ord int, small_blind int, payoff int")
    acts = spark.createDataFrame([(1, 4, "preflop", 1, 10), (1, 4, "preflop", -1, 99), (1, 3, "flop", 0, 0)],
                                 "playerid int, hand int, stage string, act int, num int")
    out = {r.playerid: r for r in evaluate.player_bet_stats(hands, acts, ["hand"], n=2).collect()}
    assert (out[1].hands, out[1].payoff_mean, out[1].preflop_bet_mean, out[1].flop_fold_rate) == (2, 3.5, 2.5, 0.5)
    assert out[2].hands == 1 and out[2].payoff_mean == -1.0


def test_deal_lines_round_trip(spark):
    deals = spark.sql("""select 't' as sztoken, 1 as nround, 79 as gametype, 10 as smallblind,
      array(named_struct('nplayerid', 1, 'seat', 1, 'score', 5, 'brobot', 0), named_struct('nplayerid', 2, 'seat', 2, 'score', 6, 'brobot', 1)) as users,
      array(named_struct('nplayerid', 1, 'cards', array(17, 18), 'presettype', 2)) as handcards, array(33, 34) as commoncards,
      true as bpreset, 'x' as inventiontype, '2024-01-05' as dt""")
    rows = jsonlog.flatten_deals(deals)
    got = {r.nplayerid: r for r in rows.collect()}
    assert (got[1].cards, got[1].presettype, got[2].cards, got[2].presettype, got[2].redisscore) == ([17, 18], 2, [], None, 0.0)
    back = {r.nplayerid: r for r in jsonlog.card_preset(jsonlog.deal_lines(rows)).collect()}
    assert (back["1"].handcards, back["1"].startscore, back["2"].handcards, back["2"].bpreset) == ("[17,18]", "5", "[]", "true")


def test_raise_bucket(spark):
    cases = [(0, 0, 100, 0), (1, 50, 100, 1), (3, 500, 100, 7), (2, 74, 100, 2), (2, 75, 100, 3), (2, 100, 100, 4),
             (2, 150, 100, 5), (2, 200, 100, 6), (2, 6, 9, 3), (2, 5, 9, 2)]
    df = spark.createDataFrame([c[:3] for c in cases], "act int, num int, pot int")
    assert [r.bucket for r in actions.raise_buckets(df).collect()] == [c[3] for c in cases]


def test_gate_uses_unrounded_values(spark):
    rows = [("m", "b0", 0.00004 * 3, 3, 0.0), ("n", "b0", 0.0, 3, 0.0)]
    report = spark.createDataFrame(rows, "agent0 string, agent1 string, total_payoffs double, hands long, mbb_h double")
    assert [r.agent0 for r in evaluate.baseline_gate(report, ["b0"], 0.03).collect()] == ["m"]
