"""The registered queries once more, as SQL for DuckDB over the same tables.

Each text is written from the definition of its result: facts per hand first, labels as small
tables of bounds, long tables of figures turned into columns at the end.  The two sides share
the texts of the derived input views, the list of preflop rates, and the parameters of the
queries; all other fixed values are repeated here.
"""

from __future__ import annotations

from tablehouse.fixtures import FIRST_DT, LAST_DT, with_views
from tablehouse.functions.preflop import PREFLOP_RATES
from tablehouse.queries import BET_HANDS, DIRTY, GATE, catalogue_sql

# fixed values: messages of one seat, messages that are no actions, raise classes
SEAT_ACTIONS = ("S2CDelayOpTime", "S2CGiveUp", "S2CStatePlayerOp", "S2CBuyInsure", "S2CDealTwiceOp",
                "S2CPushBet", "S2CShowHandCard", "S2CShowMyCard", "S2CStateBuyInsure", "S2CUpdateScore")
META_MESSAGES = ("RoomInfos", "SeatInfos")
RAISE_CLASSES = ("fold", "check_call", "raise_half_pot", "raise_3_4_pot", "raise_pot",
                 "raise_3_2_pot", "raise_double_pot", "all_in")

ORACLE: dict[str, str] = {}


def names(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


RUN = f"""run as (select cast(cast(d as date) as string) as run_dt
  from (select unnest(generate_series(date '{FIRST_DT}', date '{LAST_DT}', interval 1 day)) as d))"""


def window(days: int, alias: str = "t") -> str:
    return f"{alias}.dt <= run_dt and {alias}.dt >= cast(cast(run_dt as date) - {days} as string)"


# ---- hand logs -----------------------------------------------------------------------

DWD = """dwd as (
  select id, ngametype as gametype, nplayerid as playerid, sztoken, nround, nwinscore as winscore, nscore as score,
    cast(i as int) as json_index, json_extract_string(szcarddata, '$['||i||'].name') as name,
    cast(json_extract(szcarddata, '$['||i||'].data') as varchar) as data, createtime, dt
  from (select *, unnest(range(cast(json_array_length(szcarddata) as bigint))) as i
        from @v_hand_log where json_valid(szcarddata)) x
  where json_type(szcarddata, '$['||i||']') = 'OBJECT')"""

SEAT = """seat as (
  select distinct createdate, sztoken, nround, gametype, json_extract_string(js, '$['||k||'].nPlayerId') as playerid,
    json_extract_string(js, '$['||k||'].seat') as seat, dt
  from (select *, unnest(range(cast(json_array_length(js) as bigint))) as k
    from (select substr(createtime, 1, 10) as createdate, sztoken, nround, gametype, dt,
        case when substr(data, 1, 1) = '[' then data else cast(json_extract(data, '$.data') as varchar) end as js
      from dwd where name = 'SeatInfos' and playerid <> 0) a) b)"""

ORACLE["explode_log"] = f"""with {DWD}
select id, gametype, playerid, sztoken, nround, winscore, score, json_index, name, data,
  cast(json_object('name', name, 'data', data, 'json_index', cast(json_index as varchar)) as varchar) as carddata,
  createtime, dt from dwd"""

ORACLE["seat_info"] = f"with {DWD}, {SEAT} select * from seat"

# the log is materialized: without that DuckDB 2.0 ends with an internal error in this join
ORACLE["robot_info"] = f"""with logs as materialized (select * from @v_hand_log), {DWD.replace('@v_hand_log', 'logs')}
select d.playerid, sztoken, nround, data ->> '$.modelVersion' as robotversion, u.brobot, d.dt
from dwd d join @v_user u on u.dt = d.dt and u.nplayerid = d.playerid where name = 'ModelVer'"""


def _action(back: str) -> str:
    """One row per message and hearer.  A gap takes the value of the greatest earlier message,
    else that of the hearer's least ('first') or greatest ('last') message with a value."""
    number = lambda c, kind="int": f"try_cast(data ->> '$.{c}' as {kind})"
    listed = lambda c: f"string_split(translate(data ->> '$.{c}', '[]', ''), ',')"
    hearer = "partition by dt, sztoken, nround, playerid"
    so_far = lambda c: f"arg_max({c}, json_index) over ({hearer} order by json_index rows unbounded preceding)"

    def known(c: str, way: str = back) -> str:
        pick = "arg_max" if way == "last" else "arg_min"
        return f"coalesce({so_far(c)}, {pick}({c}, json_index) over ({hearer}))"

    at_seat = lambda c: f"try_cast(trim({c}[cast(seat as int)]) as int)"
    return f"""with {DWD}, {SEAT},
said as (select distinct dt, sztoken, nround, json_index, name as action, name in ({names(SEAT_ACTIONS)}) as personal,
    case name when 'S2CStatePlayerOp' then data ->> '$.curSeat' when 'S2CStateBuyInsure' then data ->> '$.seatInfos[0].seat'
      else data ->> '$.seat' end as speaker,
    {number('minBetScore')} as least, {number('maxBetScore')} as most, {number('minAddScore')} as step,
    {number('seatBetState')} as seatbetstate, {number('betScore')} as own_bet, {number('seatCurBet')} as own_total,
    {number('poolScore')} as pot, {number('score', 'double')} as amount, {number('state')} as state,
    case when name = 'S2CStateDealCard' then translate(data ->> '$.commonCards', '[]', '') end as board,
    case when name = 'S2CStateConclude' then {listed('insureWinLos')} end as outcomes,
    case when name = 'S2CStateGameStart' then {listed('seatCurBets')} end as stakes,
    {number('smallBlindSeat')} as small_seat, {number('bigBlindSeat')} as big_seat
  from dwd where playerid <> 0 and name not in ({names(META_MESSAGES)})),
heard as (select m.* exclude (board), s.createdate, s.gametype, s.playerid, s.seat, case when not personal then board end as board,
    {at_seat('stakes')} as stake, nullif({at_seat('outcomes')}, 0) as outcome,
    case when {at_seat('stakes')} is null then 9 when small_seat = cast(seat as int) then 0 when big_seat = cast(seat as int) then 1 else 9 end as blind
  from said m join seat s using (dt, sztoken, nround) where not personal or speaker = seat),
paid as (select *, case when action = 'S2CBuyInsure' then
    sum(amount) filter (where action = 'S2CBuyInsure' and amount <> 0) over ({hearer}, seat) end as premium from heard),
whole as (select *, {known('least')} as k_least, {known('most')} as k_most, {known('step')} as k_step, {known('outcome')} as k_outcome,
    {known('premium', 'last')} as k_premium, {so_far('pot')} as k_pot, {so_far('board')} as commoncard,
    row_number() over (partition by dt, sztoken, nround order by json_index,
      case when blind = 9 then cast(playerid as int) else blind end, cast(seat as int)) as place,
    coalesce(sum(stake) filter (where blind < 9) over (partition by dt, sztoken, nround), 0) as blinds from paid),
told as (select *, len(list_distinct(list(commoncard) over ({hearer}, seat order by json_index))) as boards,
    len(string_split(commoncard, ',')) as open_cards, action = 'S2CStateGameStart' as opening from whole),
cash as (select distinct dt, sztoken, nround, cast(nplayerid as string) as playerid, gameresult from @v_score),
insure_state(state, insure_label) as (values (1, 'ins_none'), (2, 'ins_buy'), (3, 'ins_giveup'), (4, 'ins_buying'),
  (5, 'ins_bupai_invalid'), (6, 'ins_auto_buy')),
bet_state(seatbetstate, bet_label) as (values (1, 'none'), (2, 'check'), (3, 'call'), (4, 'raise'), (5, 'allin'), (6, 'fold')),
street(open_cards, stage) as (values (3, 'flop'), (4, 'turn'), (5, 'river'))
select createdate, sztoken, nround, playerid, seat, cast(place as int) as json_index, k_least as minbetscore, k_most as maxbetscore,
  k_step as minaddscore, action, seatbetstate, if(opening, stake, own_bet) as betscore, if(opening, stake, own_total) as seatcurbet,
  cast(case when blind = 0 then stake when blind = 1 then blinds when place > 1 then k_pot else if(opening, stake, own_bet) end as bigint) as poolscore,
  cast(boards as int) as predealct, commoncard, coalesce(stage, 'preflop') as stage, gameresult,
  cast(coalesce(premium > 0, false) or action = 'S2CStateBuyInsure' as int) as isjumpinsure,
  cast(coalesce(premium > 0, false) as int) as isinsure, premium as score, k_outcome + k_premium as insurewinscores,
  case when opening then 'init' when action = 'S2CGiveUp' then 'Fold' when action = 'S2CBuyInsure' then insure_label else bet_label end as betaction,
  gametype, dt
from told left join cash using (dt, sztoken, nround, playerid) left join insure_state using (state)
left join bet_state using (seatbetstate) left join street using (open_cards)"""


ORACLE["player_action"] = _action("last")
ORACLE["player_action_first"] = _action("first")
HOT_DWD = DWD.replace("dwd as (", "log as (", 1) + """,
dwd as (select * replace (if(id // 2 % 2 = 0, id // 2 * 100 + json_index, json_index) as json_index, if(id // 2 % 2 = 0, 'hot', sztoken) as sztoken,
    if(id // 2 % 2 = 0, 0, nround) as nround, if(id // 2 % 2 = 0, '2024-01-10', dt) as dt)
  from log where id // 2 % 2 = 1 or id // 2 = 0 or name <> 'SeatInfos')"""
ORACLE["player_action_hot"] = _action("last").replace(DWD, HOT_DWD).replace(
    "len(list_distinct(list(commoncard) over (partition by dt, sztoken, nround, playerid, seat order by json_index)))",
    "count(distinct commoncard) over (partition by dt, sztoken, nround, playerid, seat order by json_index)")

ORACLE["card_preset"] = "select " + ", ".join(
    f"{'cast(json_extract(tstr, ' if f in ('cards', 'commoncards') else 'json_extract_string(tstr, '}'$.{f}')"
    f"{' as varchar)' if f in ('cards', 'commoncards') else ''} as {c}"
    for f, c in {
        "szToken": "sztoken", "nround": "nround", "gametype": "ngametype", "smallblind": "smallblind",
        "nplayerid": "nplayerid", "seat": "seat", "score": "startscore", "brobot": "brobot", "cards": "handcards",
        "commoncards": "commoncards", "bPreset": "bpreset", "inventionType": "inventiontype",
        "presetType": "presettype", "redisScore": "redisscore"}.items()) + ", dt from @v_deal_log"

ORACLE["flatten_deals"] = """
select r.sztoken, r.nround, r.ngametype as gametype, 10 as smallblind, r.nplayerid, r.seat, r.gameresult as score, r.brobot,
  case when r.seat = 6 then '' else concat(cast(r.seat as string), ',', cast(r.seat + 20 as string)) end as cards,
  concat(cast(r.hand % 40 as string), ',41,42,43,44') as commoncards, r.hand % 4 = 0 as bpreset,
  case when r.hand % 4 = 0 then 'score_rank' end as inventiontype,
  case r.seat when 1 then 1 when 2 then 2 end as presettype, cast(0 as double) as redisscore, r.dt
from @v_result r"""

ORACLE["log_ingest"] = """
select tstr, dt from (
  select event_id, min(message) as tstr0, string_split(min(message), 'FLATTENED_GAME_DATA: ')[-1] as tstr,
    strftime(make_timestamp(min(ts_ms) * 1000) + interval 8 hour, '%Y-%m-%d') as dt
  from @v_log_line where contains(message, 'FLATTENED_GAME_DATA: ') group by event_id) x"""

# the rules of the buffered ingest: late by the shard's clock before the poll, first of each id,
# then runs of at most four lines and two hours per shard and day, of which the last may be open
ACCEPTED = """cut as (select *, cast(cast('0x' || substr(md5(event_id), 1, 8) as ubigint) % 4 as int) as shard,
    string_split(message, 'FLATTENED_GAME_DATA: ')[-1] as tstr,
    strftime(make_timestamp(ts_ms * 1000) + interval 8 hour, '%Y-%m-%d') as dt
  from @v_polled where contains(message, 'FLATTENED_GAME_DATA: ')),
clocks as (select shard, poll, max(ts_ms) as top from cut group by all),
judged as (select c.*, c.ts_ms < (select max(k.top) from clocks k where k.shard = c.shard and k.poll < c.poll) - 600000 as late from cut c),
placed as (select *, row_number() over (partition by event_id, coalesce(late, false) order by poll, copy) as turn from judged)"""
ORACLE["log_late"] = f"""with {ACCEPTED}
select case when late then 'late' else 'repeated' end as kind, event_id, dt, shard, ts_ms from placed where late or turn > 1"""
ORACLE["log_flush"] = f"""with recursive {ACCEPTED},
queued as (select *, row_number() over (partition by shard, dt order by poll, ts_ms, event_id) as rn from placed where not coalesce(late, false) and turn = 1),
runs as (
  select shard, dt, rn, ts_ms as first_ts, 1 as n, 0 as flush from queued where rn = 1
  union all
  select q.shard, q.dt, q.rn,
    case when r.n = 4 or q.ts_ms >= r.first_ts + 7200000 then q.ts_ms else r.first_ts end,
    case when r.n = 4 or q.ts_ms >= r.first_ts + 7200000 then 1 else r.n + 1 end,
    case when r.n = 4 or q.ts_ms >= r.first_ts + 7200000 then r.flush + 1 else r.flush end
  from runs r join queued q on q.shard = r.shard and q.dt = r.dt and q.rn = r.rn + 1),
sizes as (select shard, dt, flush, max(n) as n, min(first_ts) as first_ts from runs group by all),
ends as (select shard, max(top) as clock from clocks group by shard)
select q.event_id, q.tstr, q.dt, q.shard, cast(r.flush as bigint) as flush, case when s.n = 4 then 'rows' else 'age' end as reason
from runs r join queued q on q.shard = r.shard and q.dt = r.dt and q.rn = r.rn
join sizes s on s.shard = r.shard and s.dt = r.dt and s.flush = r.flush join ends e on e.shard = r.shard
where s.n = 4 or e.clock >= s.first_ts + 7200000"""

# ---- windows -------------------------------------------------------------------------

GAPS = "g as (select event_id, user_id, case when event_id % 3 = 0 then value end as x, event_type from @events)"
ORACLE["fill_forward_back"] = f"""with {GAPS},
w as (select *, last_value(x ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and current row) as prev,
  first_value(x ignore nulls) over (partition by user_id order by event_id rows between current row and unbounded following) as nf,
  last_value(x ignore nulls) over (partition by user_id order by event_id rows between current row and unbounded following) as lf from g)
select user_id, event_id, prev, coalesce(prev, nf) as near, coalesce(prev, lf) as far from w"""
ORACLE["renumber"] = """select user_id, event_id,
  row_number() over (partition by user_id order by cast(floor(event_id / 100) as bigint), event_type, event_id) as rn from @events"""
ORACLE["running_distinct"] = f"""with {GAPS} select user_id, event_id,
  count(distinct event_type) over (partition by user_id order by event_id) as n_distinct from g"""

# ---- results -------------------------------------------------------------------------

SCORED = """robots as (select sztoken, nround, playerid, max(dt) as rdt from @v_robot group by all),
rob as (select r.* from @v_robot r join robots x on r.sztoken = x.sztoken and r.nround = x.nround and r.playerid = x.playerid and r.dt = x.rdt),
scored as (
  select s.*, rob.brobot, rob.robotversion, substr(s.createtime, 1, 10) as create_dt from (
    select ngametype, sztoken, nplayerid, nround, gameresult, createtime, starttime, endtime, dt from @v_score
    union all
    select ngametype, sztoken, nplayerid, nround, gameresult, createtime, starttime, endtime, dt from @v_gold) s
  left join rob on s.sztoken = rob.sztoken and s.nround = rob.nround and s.nplayerid = rob.playerid
  where substr(s.createtime, 1, 10) = s.dt)"""

ORACLE["game_result"] = f"""with {SCORED}
select ngametype, sztoken, nplayerid, nround, gameresult, coalesce(brobot, 0) as brobot,
  coalesce(robotversion, '0') as robotversion, createtime, starttime, endtime, create_dt, dt from scored"""

def by_hand(keys: str) -> str:
    """One row per key and hand: its best and worst outcome, what it gained and what it lost."""
    return f"""hands as (select {keys}, max(gameresult) as best, min(gameresult) as worst, bool_or(gameresult = 0) as level,
    sum(greatest(gameresult, 0)) as gained, sum(least(gameresult, 0)) as lost
  from (select * replace (coalesce(brobot, 0) as brobot) from scored) group by {keys}, sztoken, nround)"""


OUTCOMES = """count(*) as total_cnt, count(*) filter (best > 0) as win_cnt, count(*) filter (worst < 0) as lose_cnt,
  count(*) filter (level) as tie_cnt"""

ORACLE["win_lose_round"] = f"""with {SCORED}, {by_hand("dt, nplayerid, ngametype, brobot")}
select dt, nplayerid, ngametype, brobot, {OUTCOMES}, {", ".join(f"0 as {x}" for x in (
    "total_robot_round", "total_human_round", "win_robot_round", "win_human_round", "lose_to_robot_round", "lose_to_human_round"))}
from hands group by all"""

ORACLE["robot_win_lose"] = f"""with {SCORED}, {by_hand("dt, create_dt, ngametype, brobot, robotversion")},
totals as (select dt, create_dt, ngametype, brobot, robotversion, {OUTCOMES},
  cast(sum(gained) as bigint) as win_score, cast(sum(lost) as bigint) as lose_score from hands group by all)
select *, cast(0 as bigint) as tie_score, win_score + lose_score as total_score from totals"""

ORACLE["win_lose_u"] = """with desk as (select dt, sztoken, ngametype = 400 as tournament, max(ucoinratio) as unit,
    max(cast(szrulejson ->> '$.joinFeeUcoin' as bigint)) filter (where substr(createtime, 1, 10) = dt) / 1000000 as fee
  from @v_info where ngametype in (400, 79, 74) group by all),
outcome as (
  select m.dt, m.sztoken, m.nplayerid, 400 as ngametype, cast(null as int) as robot, greatest(m.reward, 0) / 1000000 - fee as gain
  from @v_match m join desk d on d.dt = m.dt and d.sztoken = m.sztoken and tournament where fee is not null
  union all
  select s.dt, s.sztoken, s.nplayerid, s.ngametype, null, round(sum(s.nscore / 1000 / coalesce(unit, 1)), 4)
  from @v_score s left join desk d on d.dt = s.dt and d.sztoken = s.sztoken and not tournament
  where s.ngametype in (79, 74) and starts_with(s.createtime, s.dt) group by 1, 2, 3, 4
  union all
  select dt, sztoken, nplayerid, ngametype, cast(brobot as int), gameresult / 1000 from @v_gold where starts_with(createtime, dt)),
owned as (select o.* exclude (robot), coalesce(robot, cast(u.brobot as int)) as brobot
  from outcome o left join @v_user u on u.dt = o.dt and u.nplayerid = o.nplayerid)
select nplayerid, ngametype, brobot, round(sum(gain), 2) as total_score, round(sum(gain) filter (where gain >= 0), 2) as win_score,
  round(sum(gain) filter (where gain < 0), 2) as lose_score, count(distinct sztoken) as total_sztoken,
  0 as win_robot_score, 0 as win_human_score, 0 as lose_to_human_score,
  0 as lose_to_robot_score, 0 as total_robot_sztoken, 0 as total_human_sztoken, dt
from owned where brobot is not null group by nplayerid, ngametype, brobot, dt"""

# ---- risk and tags -------------------------------------------------------------------

ZEROS = ", ".join(f"0 as player{i}_{c}" for i in (1, 2)
                  for c in ("aggressive", "agr_pct", "call", "call_pct", "fold", "fold_pct"))
PAIRS = f"""table_of as (select dt, sztoken, nround, list({{'id': nplayerid, 'won': gameresult}}) as seated from @v_result group by all),
first_of as (select *, unnest(seated) as a from table_of),
meeting as (select dt, sztoken, a, unnest(list_filter(seated, lambda x: x.id > a.id)) as b from first_of),
duo as (select dt, a.id as player1_id, b.id as player2_id, count(*) as total_games, count(distinct sztoken) as total_desk,
    count(*) filter (where greatest(a.won, b.won) > 0) as win_games, cast(sum(a.won + b.won) as bigint) as total_gameresult
  from meeting group by all),
address as (select dt, nplayerid, list(distinct preloginip) as ips from @v_user
  where preloginip <> '' and datediff('day', try_cast(substr(prelogintime, 1, 10) as date), cast(dt as date)) between 0 and 30 group by all),
visitor as (select t.dt, t.who.id as id, count(*) as hands, any_value(ips) as ips
  from (select dt, unnest(seated) as who from table_of) t left join address h on h.dt = t.dt and h.nplayerid = t.who.id group by all),
both_of as (select d.*, x.hands as hands1, y.hands as hands2, list_sort(list_intersect(x.ips, y.ips)) as common
  from duo d join visitor x on x.dt = d.dt and x.id = player1_id join visitor y on y.dt = d.dt and y.id = player2_id),
pairs as (select player1_id, player2_id, total_games, total_desk, win_games, round(win_games / total_games, 4) as win_rate, total_gameresult,
    total_games as same_cnt, round(total_games / hands1, 9) as player1_same_rate, round(total_games / hands2, 9) as player2_same_rate,
    {ZEROS}, nullif(len(common), 0) as shared_ip_cnts, nullif(array_to_string(common, ','), '') as shared_ip, dt from both_of)"""


def suspects(same: int, win: float, share: float, desks: int) -> str:
    rule = (f"same_cnt >= {same} and win_rate >= {win} and (player1_same_rate >= {share} "
            f"or player2_same_rate >= {share}) and total_desk >= {desks}")
    return (f"(select dt, player1_id as playerid from pairs where {rule} union "
            f"select dt, player2_id from pairs where {rule})")


ORACLE["collusion_pairs"] = f"with {PAIRS} select * from pairs"
ORACLE["suspect_players"] = f"with {PAIRS} select dt, playerid from {suspects(2, 0.5, 0.1, 1)} s"

ORACLE["score_extremes"] = """with sc as (
  select nplayerid, ngametype, floor(sum(gameresult) / 200000) as score from @v_result group by all),
x as (select distinct r.sztoken, r.nround, r.dt, r.nplayerid, coalesce(sc.score, 0.0) as s
  from @v_result r left join sc on r.nplayerid = sc.nplayerid and r.ngametype = sc.ngametype),
k as (select *, row_number() over (partition by sztoken, nround, dt order by s desc, nplayerid) as hi,
  row_number() over (partition by sztoken, nround, dt order by s, nplayerid) as lo from x)
select sztoken, nround, dt, count(*) as players, max(case when hi = 1 then nplayerid end) as high_id, max(s) as high_score,
  max(case when lo = 1 then nplayerid end) as low_id, min(s) as low_score, max(s) = min(s) as all_equal
from k group by sztoken, nround, dt having count(*) >= 2"""

STYLE = f"""{RUN},
style_bound(ord, style_label, v_over, v_to, p_from, p_under, t_from, a_over, a_under, f_over) as (values
  (1, 'Maniac (超激进)', 0.35, null, null, null, null, 3.0, null, null),
  (2, 'Strong TAG (高3-bet紧凶)', null, 0.20, 0.60, null, 0.25, null, null, null),
  (3, 'Calling Station (跟注站)', 0.25, null, null, 0.30, null, null, 1.0, null),
  (4, 'Nit (过度弃牌)', null, null, null, null, null, null, null, 0.60),
  (5, 'Tight-Aggressive (TAG)', null, 0.20, 0.60, null, null, null, null, null),
  (6, 'Loose-Aggressive (LAG)', 0.20, null, 0.50, null, null, null, null, null),
  (7, 'Tight-Passive (TP)', null, 0.20, null, 0.60, null, null, null, null),
  (8, 'Loose-Passive (LP)', 0.20, null, null, 0.50, null, null, null, null)),
quality_bound(rank, quality_label, hands_from, deeds_from) as (values (1, 'high', 100, 200), (2, 'medium', 50, 100), (3, 'low', 10, 20)),
deed as (select distinct dt, sztoken, nround, playerid, json_index, action, stage, betaction, betaction in ('raise', 'allin') as pushes
  from @v_action where betaction <> 'init'),
opened as (select dt, sztoken, nround, min(json_index) as first_push from deed where pushes and stage = 'preflop' group by all),
hand_fact as (select dt, sztoken, nround, playerid, bool_or(stage = 'preflop' and (pushes or betaction = 'call')) as entered,
    bool_or(stage = 'preflop' and pushes) as raised, bool_or(stage = 'preflop' and pushes and json_index > first_push) as raised_again,
    bool_or(stage = 'flop' and pushes) as pushed_flop,
    count(*) filter (where stage in ('flop', 'turn', 'river') and pushes) as late_pushes,
    count(*) filter (where stage in ('flop', 'turn', 'river') and betaction in ('call', 'check')) as late_calls,
    count(*) filter (where betaction = 'Fold') as gave_up, count(*) filter (where betaction = 'allin') as all_in, count(*) as deeds
  from deed left join opened using (dt, sztoken, nround) group by all),
habit as (select run_dt, playerid, count(*) as hands, count(*) filter (where entered) as n_in, count(*) filter (where raised) as n_up,
    count(*) filter (where raised_again) as n_again, count(*) filter (where raised and pushed_flop) as n_on, sum(late_pushes) as n_push,
    sum(late_calls) as n_call, sum(gave_up) as n_fold, sum(all_in) as n_all, sum(deeds) as deeds
  from hand_fact t join run on {window(7)} group by all),
share as (select *, n_in / hands as v, n_up / hands as up, n_up / nullif(n_in, 0) as p, n_again / nullif(n_in, 0) as t, n_on / nullif(n_up, 0) as c,
    n_push / nullif(n_call, 0) as a, n_fold / nullif(deeds, 1) as f, n_all / nullif(deeds, 1) as al from habit),
named as (select run_dt, playerid, arg_min(style_label, ord) as label from share join style_bound
    on coalesce(v > v_over, v_over is null) and coalesce(v <= v_to, v_to is null) and coalesce(p >= p_from, p_from is null)
    and coalesce(p < p_under, p_under is null) and coalesce(t >= t_from, t_from is null) and coalesce(a > a_over, a_over is null)
    and coalesce(a < a_under, a_under is null) and coalesce(f > f_over, f_over is null) group by all),
graded as (select run_dt, playerid, arg_min(quality_label, rank) as grade from habit join quality_bound
    on hands >= hands_from and deeds >= deeds_from group by all),
style as (select playerid, hands as total_hands, round(v, 4) as vpip, round(up, 4) as pfr, round(t, 4) as three_bet_pct,
    round(coalesce(c, 0), 4) as cbet_pct, round(a, 4) as af, round(al, 4) as allin_frequency, round(f, 4) as fold_rate,
    if(hands < 10, 'Insufficient Data', coalesce(label, 'Unclassified')) as playing_style,
    coalesce(grade, 'insufficient') as data_quality, run_dt as dt
  from share left join named using (run_dt, playerid) left join graded using (run_dt, playerid))"""

ORACLE["player_style"] = f"with {STYLE} select * from style"


def _versus(by_hand: bool, days: int = 30) -> str:
    hand = ", sztoken, nround" if by_hand else ""
    return f"""robot_hand as (select dt, sztoken, nround from @v_result group by all having max(brobot) = 1),
own_hand as (select * from @v_result where brobot = 0 and nplayerid is not null),
duel as (select distinct dt, nplayerid, gameresult, ngametype{hand} from own_hand semi join robot_hand using (dt, sztoken, nround)),
played as (select run_dt, nplayerid, count(*) as hands from own_hand t join run on {window(days)} group by all),
fought as (select run_dt, nplayerid, count(*) as duels, avg(cast(gameresult > 0 as int)) as won, avg(gameresult) as profit,
    avg(cast(ngametype = 450 as int)) as gold from duel t join run on {window(days)} group by all having count(*) >= 10),
bot_bound(ord, bot_label, won_over, won_under, won_from, won_to, sign, share_over) as (values
  (1, 'Exploiter (剥削者)', 0.60, null, null, null, 1, null), (2, 'Struggling (挣扎者)', null, 0.40, null, null, -1, null),
  (3, 'Balanced (平衡型)', null, null, 0.40, 0.60, null, null), (4, 'Bot Hunter (猎人)', null, null, null, null, null, 0.8)),
bot_named as (select run_dt, nplayerid, arg_min(bot_label, ord) as label from fought join played using (run_dt, nplayerid) join bot_bound
    on coalesce(won > won_over, won_over is null) and coalesce(won < won_under, won_under is null)
    and coalesce(won >= won_from, won_from is null) and coalesce(won <= won_to, won_to is null)
    and (sign is null or sign(profit) = sign) and coalesce(duels / hands > share_over, share_over is null) group by all),
bot as (select run_dt as dt, nplayerid, duels as total_hands_vs_bot, round(won, 4) as win_rate_vs_bot, round(profit, 2) as avg_profit_vs_bot,
    round(gold, 4) as high_stakes_ratio, round(duels / hands, 4) as bot_hands_ratio, coalesce(label, 'Unclassified') as player_profile_label
  from fought join played using (run_dt, nplayerid) left join bot_named using (run_dt, nplayerid))"""


ORACLE["versus_robot"] = f"with {RUN}, {_versus(False)} select * from bot"
ORACLE["versus_robot_by_hand"] = f"with {RUN}, {_versus(True)} select * from bot"

def _profile(days: int) -> str:
    return f"""{STYLE}, {_versus(False, days)}, {PAIRS},
stay as (select run_dt, t.nplayerid as id, t.ngametype, t.dt, sztoken, nround, substr(createtime, 1, 10) as day,
    cast(substr(starttime, 12, 2) as int) as hour, epoch(cast(endtime as timestamp)) - epoch(cast(starttime as timestamp)) as lasted
  from @v_result t join run on {window(days)}),
life as (select run_dt, id, count(distinct day) as days, round(avg(lasted) filter (where lasted > 0) / 60.0, 2) as mins from stay group by all),
taste as (select run_dt, id, min({{'n': -hands, 'game': ngametype}}) as best from
    (select run_dt, id, ngametype, count(distinct (dt, sztoken, nround)) as hands from stay group by all) x group by all),
clock as (select run_dt, id, min({{'n': -rows, 'hour': hour}}) as best from
    (select run_dt, id, hour, count(*) as rows from stay group by all) x group by all),
club as (select dt, nplayerid as id, min({{'club': nclubid, 'nick': sznickname}}) as best from @v_member group by all),
flagged as (select dt, playerid as id, true as suspected from {suspects(20, 0.7, 0.75, 3)} s),
activity_bound(level, days_from, days_to) as (values ('low', 1, 2), ('medium', 3, 4), ('high', 5, 99)),
person as (select dt, nplayerid as id, szcreatetime as regtime, cast(brobot as int) as brobot, preloginip, prelogintime from @v_user),
profile as (select u.id as nplayerid, regtime, u.brobot, preloginip, prelogintime,
    coalesce(club.best.nick, 'unknown') as sznickname, coalesce(club.best.club, -1) as nclubid, vpip, pfr, three_bet_pct, cbet_pct, af,
    coalesce(allin_frequency, 0.0) as allin_frequency, coalesce(fold_rate, 0.0) as fold_rate,
    coalesce(playing_style, 'Insufficient Data') as playing_style, coalesce(data_quality, 'insufficient') as data_quality,
    coalesce(taste.best.game, -1) as preferred_gametype, coalesce(-taste.best.n, 0) as preferred_game_rounds,
    coalesce(days, 0) as active_days, coalesce(mins, 0.0) as avg_round_duration_mins, coalesce(clock.best.hour, -1) as peak_active_hour,
    coalesce(level, 'silent') as activity_level, if(suspected, 'collusion_suspected', 'normal') as collusion_status,
    coalesce(total_hands_vs_bot, 0) as total_hands_vs_bot, coalesce(win_rate_vs_bot, 0.0) as win_rate_vs_bot,
    coalesce(avg_profit_vs_bot, 0.0) as avg_profit_vs_bot, coalesce(high_stakes_ratio, 0.0) as high_stakes_ratio,
    coalesce(bot_hands_ratio, 0.0) as bot_hands_ratio, coalesce(player_profile_label, 'No Bot Games') as player_profile_label, u.dt
  from person u left join club using (dt, id) left join flagged using (dt, id)
  left join life on life.run_dt = u.dt and life.id = u.id left join taste on taste.run_dt = u.dt and taste.id = u.id
  left join clock on clock.run_dt = u.dt and clock.id = u.id left join activity_bound on days between days_from and days_to
  left join style on style.dt = u.dt and style.playerid = u.id left join bot on bot.dt = u.dt and bot.nplayerid = u.id)"""


ORACLE["player_profile"] = f"with {_profile(30)} select * from profile"
ORACLE["player_profile_7d"] = f"with {_profile(7)} select * from profile"
ORACLE["profile_mart"] = f"with {_profile(30)} select * from profile where active_days > 0"

# ---- marts ---------------------------------------------------------------------------

NEW = """(select t.dt, t.nplayerid from (select distinct dt, nplayerid from @v_user where brobot = '0') t
  left join (select distinct dt, nplayerid from @v_user where brobot = '0') y
  on t.nplayerid = y.nplayerid and y.dt = cast(cast(t.dt as date) - 1 as string) where y.nplayerid is null)"""
ORACLE["new_users"] = f"select dt, nplayerid from {NEW} n"


def _overview(days: int) -> str:
    return f"""with {RUN}, {PAIRS},
hand as (select dt, sztoken, nround, bool_or(brobot = 0) and bool_or(brobot = 1) as mixed,
    sum(gameresult) filter (where brobot = 1) as robot_gain from @v_result group by all),
gambler as (select dt, nplayerid, bool_or(brobot = 0) as human, count(*) as hands, count(*) filter (where gameresult > 0) as wins
  from @v_result group by all),
planted as (select p.dt, p.sztoken, p.nround, p.nplayerid, presettype = '2' as rewarded, gameresult > 0 as gained from @v_preset p
  left join @v_result r using (dt, sztoken, nround, nplayerid) where bpreset = 'true'),
figure(dt, name, n) as (
  select dt, 'rounds', count(*) from hand group by dt
  union all select dt, 'mixed', count(*) from hand where mixed group by dt
  union all select dt, 'mixed_won', count(*) from hand where mixed and robot_gain > 0 group by dt
  union all select dt, 'today', count(*) from gambler where human group by dt
  union all select run_dt, 'month', count(distinct nplayerid) from gambler t join run on {window(days)} where human group by run_dt
  union all select dt, 'fresh', count(*) from {NEW} x group by dt
  union all select dt, 'planted_rounds', count(distinct (sztoken, nround)) from planted group by dt
  union all select dt, 'planted_players', count(distinct nplayerid) from planted group by dt
  union all select dt, 'rewarded', count(distinct nplayerid) from planted where rewarded group by dt
  union all select dt, 'rewarded_won', count(distinct nplayerid) from planted where rewarded and gained group by dt
  union all select dt, 'suspects', count(*) from {suspects(20, 0.7, 0.75, 3)} x group by dt
  union all select dt, 'neighbours', count(distinct id) from (select dt, unnest([player1_id, player2_id]) as id from pairs
    where shared_ip_cnts > 0) x group by dt
  union all select dt, 'lucky', count(*) from gambler where hands >= 10 and wins / hands >= 0.8 group by dt),
day as (pivot figure on name in ('rounds', 'mixed', 'mixed_won', 'today', 'month', 'fresh', 'planted_rounds', 'planted_players',
  'rewarded', 'rewarded_won', 'suspects', 'neighbours', 'lucky') using coalesce(sum(n), 0)::bigint group by dt)
select dt, rounds as round_cnt, mixed as robot_round_cnt, round(mixed / rounds, 6) as robot_round_pct, mixed_won as robot_win_round_cnt,
  round(mixed_won / nullif(mixed, 0), 6) as robot_win_round_pct, today as day_real_player_cnt, month as month_real_player_cnt,
  fresh as new_player_cnt, planted_rounds as preset_round_cnt, planted_players as preset_player_cnt, rewarded as reward_player_cnt,
  rewarded_won as reward_win_round_cnt, suspects as collusion_player_cnt, neighbours as same_ip_player_cnt, lucky as abnormal_high_win_player_cnt
from day where rounds > 0"""


ORACLE["daily_overview"] = _overview(30)
ORACLE["daily_overview_7d"] = _overview(7)

ROBOTS = """met as (select *, bool_or(brobot = 0) over (partition by dt, sztoken, nround) as with_human from @v_result),
rp as (select dt, sztoken, nround, ngametype, robotversion, sum(gameresult) as profit from met where with_human and brobot = 1 group by all)"""
ROBOT_COLS = """1 as brobot, robotversion, ngametype, count(*) as total_round_cnt,
  count(case when profit > 0 then 1 end) as win_round_cnt, 0 as total_player_cnt, 0 as win_player_cnt, cast(sum(profit) as bigint) as gameresult"""
ORACLE["robot_stats"] = f"with {ROBOTS} select dt, {ROBOT_COLS} from rp group by dt, robotversion, ngametype"
for _days in (7, 90):
    ORACLE[f"robot_stats_{_days}d"] = f"""with {RUN}, {ROBOTS} select run_dt as dt, {ROBOT_COLS} from rp t join run
  on t.dt > cast(cast(run_dt as date) - {_days} as string) and t.dt <= run_dt group by run_dt, robotversion, ngametype"""

ORACLE["active_hours"] = f"""with {SCORED}
select ngametype, substr(createtime, 1, 10) as start_dt, substr(createtime, 12, 2) as start_dt_hr,
  count(distinct nplayerid) as player_cnt, count(distinct concat(sztoken, '-', nround)) as round_cnt
from scored where brobot is null group by all"""

for _name, _days in (("activity_tags", 30), ("activity_tags_7d", 7)):
    ORACLE[_name] = f"""with {RUN},
d as (select run_dt, nplayerid, count(distinct dt) as n from @v_result t join run on {window(_days)} where brobot = 0 group by all)
select run_dt as dt, case when n >= 5 then 'high' when n >= 3 then 'mid' when n >= 1 then 'low' else 'silenct' end as active_tag,
  count(distinct nplayerid) as player_cnt from d group by all"""

ORACLE["preset_overview"] = """select dt, ngametype, coalesce(inventiontype, 'no_preset') as inventiontype,
  count(distinct concat(sztoken, '-', nround)) as round_cnt, count(distinct nplayerid) as player_cnt from @v_preset
  group by dt, ngametype, coalesce(inventiontype, 'no_preset')"""
ORACLE["sync_roundtrip"] = ORACLE["preset_overview"]

ORACLE["preset_result"] = """with settled as (select dt, sztoken, nround, nplayerid, ngametype, gameresult from @v_gold where ngametype = 450
  union all select dt, sztoken, nround, nplayerid, ngametype, gameresult from @v_score where ngametype = 420),
dealt as (select p.*, case brobot when 1 then 'robot' when 0 then 'human' end as side,
    case when gameresult >= 0 then 'win' when gameresult < 0 then 'lose' end as ending
  from @v_preset p left join settled using (dt, sztoken, nround, nplayerid, ngametype)
  where bpreset = 'true' and presettype = '2' and ngametype in (420, 450))
select dt, inventiontype, ngametype, side || '_good_' || ending as play_result,
  count(distinct (sztoken, nround)) as round_cnt, count(distinct nplayerid) as player_cnt from dealt group by all"""

ORACLE["flag_export"] = f"""with {PAIRS}
select concat('new_user:', cast(nplayerid as string)) as key, 1 as value, -1 as ttl, cast(null as varchar) as expires_at, dt from {NEW} n
union all
select concat('suspect_user:', cast(playerid as string)), 3, 172800, cast(cast(dt as date) + 2 as string), dt
from {suspects(20, 0.7, 0.75, 3)} s"""

# ---- readers and writers ---------------------------------------------------------------

ORACLE["partition_scan"] = "select sztoken, nround, nplayerid, ngametype, gameresult, dt from @v_result where dt = '2024-01-10'"
ORACLE["range_scan"] = """select dt, count(distinct (sztoken, nround)) as hands from @v_result
where dt > '2024-01-10' and dt <= '2024-01-20' group by dt"""
ORACLE["snapshot_pair"] = """with seen as (select nplayerid, bool_or(dt = '2024-01-10') as today, bool_or(dt = '2024-01-09') as before
  from @v_user where dt in ('2024-01-09', '2024-01-10') group by nplayerid)
select nplayerid, if(today, 'new', 'gone') as change from seen where today <> before"""
ORACLE["path_read"] = "select sztoken, nround, nplayerid, gameresult from @v_result where dt = '2024-01-10' and ngametype = 420"
ORACLE["csv_subset"] = "select cast(nplayerid as varchar) as nplayerid, cast(gameresult as varchar) as gameresult, dt from @v_result"
ORACLE["replace_mart_day"] = """select sztoken, nround, nplayerid,
  if(dt = '2024-01-10', coalesce(inventiontype, 'no_preset'), inventiontype) as inventiontype, dt from @v_preset where dt <> '2024-01-20'"""
ORACLE["upsert_mart"] = """with half as (select nplayerid, ngametype, dt >= '2024-01-20' as late, max(gameresult) as best, max(dt) as seen
  from @v_result where dt <= '2024-01-10' or dt >= '2024-01-20' group by all)
select nplayerid, ngametype, arg_max(best, late) as best, arg_max(seen, late) as seen from half group by nplayerid, ngametype"""
ORACLE["append_latest"] = f"""with o as ({ORACLE["preset_overview"]})
select dt, ngametype, inventiontype, round_cnt, if(dt = max(dt) over (), -1, player_cnt) as player_cnt from o
union all select dt, ngametype, inventiontype, round_cnt, player_cnt from o where dt = '2024-01-10'"""
ORACLE["append_lines"] = """select sztoken, cast(nround as varchar) as nround, cast(nplayerid as varchar) as nplayerid,
  cast(gameresult as varchar) as startscore, if(seat = 6, '[]', concat('[', cast(seat as varchar), ',', cast(seat + 20 as varchar), ']')) as handcards,
  dt from @v_result"""
ORACLE["table_lifecycle"] = f"select * from ({ORACLE['preset_overview']}) o where dt <> '2024-01-10'"
ORACLE["catalog_profile"] = f"""select 'users' as table_name, '' as table_comment, min(dt) as min_dt, max(dt) as max_dt, '{LAST_DT}' as dt from @v_user
union all select 'presets', '', min(dt), max(dt), '{LAST_DT}' from @v_preset"""
ORACLE["catalog_partitions"] = "select 'dt=' || dt as partition, dt = (select max(dt) from @v_preset) as is_latest from (select distinct dt from @v_preset) d"
ORACLE["partition_check"] = """select 'result' as table_name, 'dt=' || dt as partition_spec, true as has_files, true as has_bytes, true as mb_fits
from (select distinct dt from @v_result order by dt limit 5) d"""
ORACLE["login_log"] = """select user_id as nplayerid, 'c' || (user_id % 7) as nclubid, 1 as nactive, strftime(ts, '%Y-%m-%d %H:%M:%S') as sztime,
  '10.0.1.' || (user_id % 20) as loginip from @events where event_type = 'signup'"""
ORACLE["set_tests"] = """select hand_id, player, list_has_all(cards, hole) as hole_in_cards, list_has_all(board, hole) as hole_in_board,
  len(list_distinct(cards)) = len(cards) as distinct_cards,
  array_to_string(list_sort(list_filter(cards, lambda x: not list_contains(board, x))), ',') as own from @v_cards"""
ORACLE["explode_rejects"] = """with e as (select id, dt, unnest(range(cast(json_array_length(szcarddata) as bigint))) as i, szcarddata
  from @v_hand_log where json_valid(szcarddata))
select id, dt, cast(i as int) as json_index, cast(json_extract(szcarddata, '$['||i||']') as varchar) as rejected from e
where json_type(szcarddata, '$['||i||']') <> 'OBJECT'
union all select id, dt, null, szcarddata from @v_hand_log where not json_valid(szcarddata)"""
ORACLE["log_rejects"] = """select rtrim(replace(message, 'INFO FLATTENED_GAME_DATA: ', ''), '}') as tstr,
  strftime(make_timestamp(ts_ms * 1000) + interval 8 hour, '%Y-%m-%d') as dt
from @v_log_line where copy = 0 and starts_with(message, 'INFO FLATTENED') and event_id like '%4'"""

# ---- metadata ------------------------------------------------------------------------

ORACLE["table_profile"] = " union all ".join(
    f"select '{n}' as table_name, min(dt) as min_dt, max(dt) as max_dt, count(*) as row_count from @v_{n}"
    for n in ("result", "user", "action", "preset"))

ORACLE["conform"] = f"""select id, try_cast(nplayerid as int) as playerid, try_cast(score as double) as score,
  cast(try_cast(rectime as date) as string) as rectime, cast(null as string) as remark from ({DIRTY}) d"""


def _count(col: str, kind: str) -> str:
    return (f"count(*) filter (where {col} is null) as nulls, "
            f"count(*) filter (where {col} is not null and try_cast({col} as {kind}) is null) as uncastable, count(*) as rows")


ORACLE["conform_report"] = f"""with d as ({DIRTY})
select 'id' as "column", 'ok' as state, {_count('id', 'bigint')} from d
union all select 'playerid', 'renamed', {_count('nplayerid', 'int')} from d
union all select 'score', 'ok', {_count('score', 'double')} from d
union all select 'rectime', 'ok', {_count('rectime', 'date')} from d
union all select 'remark', 'missing', count(*), 0, count(*) from d
union all select 'kind', 'extra', count(*) filter (where kind is null), 0, count(*) from d"""

# ---- cards ---------------------------------------------------------------------------


def _showdown(view: str, full_house: int, flush: int, ace: int) -> str:
    def straight(name: str, source: str) -> str:
        return f"""{name}d as (select distinct hand_id, player, rk from {source} union select hand_id, player, {ace} from {source} where rk = 14),
{name} as (select hand_id, player, max(h) as h from (select hand_id, player, h, count(*) as n from {name}d
  join (select unnest(range(5, 15)) as h) hs on rk between h - 4 and h group by all) x where n = 5 group by all)"""

    def value(cat, made=(), kick=()) -> str:
        bits = lambda ranks: " + ".join(f"cast(power(2, {r}) as bigint)" for r in ranks) or "0"
        return f"cast({cat} as bigint) * 1073741824 + ({bits(made)}) * 32768 + {bits(kick)}"

    k = lambda i: f"(g[{i}] % 100)"
    n = lambda i: f"floor(g[{i}] / 100)"
    other = "list_max(list_filter(ranks, lambda x: ({})))"
    return f"""r as (select hand_id, player, cast(floor(card / 4) as int) + 2 as rk, card % 4 as st
  from (select hand_id, player, unnest(cards) as card from @{view}) x),
g as (select hand_id, player, list(k order by k desc) as g from (select hand_id, player, rk, count(*) * 100 + rk as k from r group by hand_id, player, rk) x group by all),
a as (select hand_id, player, list(rk) as ranks from r group by all),
fr as (select r.* from r join (select hand_id, player, st from r group by all having count(*) >= 5) s using (hand_id, player, st)),
f as (select hand_id, player, list(rk order by rk desc) as f from fr group by all),
{straight('s', 'r')}, {straight('sf', 'fr')},
power as (select hand_id, player, case
    when sf.h is not null then {value(9, ['sf.h'])}
    when {n(1)} = 4 then {value(8, [k(1)], [other.format(f'x <> {k(1)}')])}
    when {n(1)} = 3 and {n(2)} >= 2 then {value(full_house, [k(1)], [k(2)])}
    when f is not null then {value(flush, kick=[f'f[{i}]' for i in range(1, 6)])}
    when s.h is not null then {value(5, ['s.h'])}
    when {n(1)} = 3 then {value(4, [k(1)], [k(2), k(3)])}
    when {n(1)} = 2 and {n(2)} = 2 then {value(3, [k(1), k(2)], [other.format(f'x <> {k(1)} and x <> {k(2)}')])}
    when {n(1)} = 2 then {value(2, [k(1)], [k(2), k(3), k(4)])}
    else {value(1, kick=[k(i) for i in range(1, 6)])} end as strength
  from g join a using (hand_id, player) left join f using (hand_id, player)
  left join s using (hand_id, player) left join sf using (hand_id, player))"""


SHOW = """select hand_id, player, cast(floor(strength / 1073741824) as int) as category, strength,
  case when strength = max(strength) over (partition by hand_id) then 1 else 0 end as winner from power"""
HOLDEM = _showdown("v_cards", 7, 6, 1)
ORACLE["showdown_winners"] = f"with {HOLDEM} {SHOW}"
ORACLE["showdown_short"] = f"with {_showdown('v_cards_short', 6, 7, 5)} {SHOW}"
ORACLE["showdown_audit"] = f"""with {HOLDEM}
select 'mismatch' as finding, hand_id, player, cast(cast(floor(strength / 1073741824) as int) as string) as computed,
  cast(cast(floor(strength / 1073741824) as int) + 1 as string) as expected, cast(null as bigint) as copies from power
cross join (select unnest([0, 1]) as copy) c
where hand_id % 50 = 7 and (copy = 0 or (hand_id % 400 = 5 and player = 1))
union all
select 'duplicate', hand_id, player, null, null, 2 from power where hand_id % 400 = 5 and player = 1"""

KEY = """concat(substr('23456789TJQKA', cast(greatest(floor(hole[1] / 4), floor(hole[2] / 4)) as int) + 1, 1),
  substr('23456789TJQKA', cast(least(floor(hole[1] / 4), floor(hole[2] / 4)) as int) + 1, 1),
  case when hole[1] % 4 = hole[2] % 4 then 's' else 'o' end)"""
ORACLE["preflop_equity"] = f"""with rates(k, w) as (values {', '.join(f"('{k}', {w})" for k, w, _ in PREFLOP_RATES)}),
h as (select hand_id, player, {KEY} as hand_class from @v_cards)
select hand_id, player, hand_class, cast(coalesce(w, 0.5) as double) as win_rate from h left join rates on k = hand_class"""

ORACLE["equity_audit"] = """select 'mismatch' as finding, hand_id, player, hand_id % 40 = 11 as missing, cast(null as bigint) as copies
from @v_cards where hand_id % 40 in (9, 11)
union all
select 'duplicate', hand_id, player, true, 2 from @v_cards where hand_id % 400 = 5 and player = 1"""

HAND_KEY = "concat({0}, ' ', {1})".format(*[
    f"substr('23456789TJQKA', cast(floor({f}(hole[1], hole[2]) / 4) as int) + 1, 1), "
    f"substr('shdc', cast({f}(hole[1], hole[2]) % 4 as int) + 1, 1)" for f in ("least", "greatest")])
ORACLE["packed_equity"] = f"""with h as (select hand_id, player, {HAND_KEY} as hand_key, list_sort(board) as b,
    (cards[1]*729 + cards[2]*243 + cards[3]*81 + cards[4]*27 + cards[5]*9 + cards[6]*3 + cards[7]) % 1000003 / 1000003.0 as rate from @v_cards),
t as (select hand_key, b, round(min(rate) * 1000000) / 1000000 as rate from h where player < 2 group by all)
select h.hand_id, h.player, h.hand_key, round(cast(coalesce(t.rate, 0.0) as double), 6) as rate from h left join t on h.hand_key = t.hand_key and h.b = t.b"""

ORACLE["packed_files"] = f"""with h as (select hand_id, player, {HAND_KEY} as hand_key, list_sort(hole) as own, n, list_sort(board[1:n]) as b,
    list_reduce(list_prepend(cast(0 as bigint), list_concat(hole, board[1:n])), lambda a, c: a * 3 + c) % 1000003 / 1000003.0 as rate
  from (select *, [0, 3, 4, 5][hand_id % 4 + 1] as n from @v_cards) x),
t as (select case when n > 0 then hand_key end as k, n, case when n > 0 then b else own end as word, round(min(rate) * 1000000) / 1000000 as rate from h where player < 2 group by all)
select h.hand_id, h.player, h.hand_key, cast(h.n as int) as n_board, round(cast(coalesce(t.rate, 0.0) as double), 6) as rate
from h left join t on h.n = t.n and (h.n = 0 or h.hand_key = t.k) and t.word = (case when h.n > 0 then h.b else h.own end)"""
ORACLE["partition_sizes"] = """select 'result' as table_name, 'dt=' || dt as partition_spec, cast(ceil(count(*) / 20.0) as bigint) as files,
  true as same_bytes, true as mb_fits from @v_result group by dt"""
ORACLE["upsert_in_place"] = """with b as (select nplayerid, ngametype, dt > '2024-01-10' as later, max(gameresult) as best, max(dt) as dt from @v_result group by all)
select nplayerid, ngametype, best, dt from b where later or not exists (select 1 from b c where c.later and c.nplayerid = b.nplayerid and c.ngametype = b.ngametype)"""
for _name, _days in (("month_players", 30), ("month_players_7d", 7)):
    ORACLE[_name] = f"""with {RUN} select run_dt as dt, count(distinct t.nplayerid) as month_real_player_cnt
from run join @v_result t on {window(_days)} where t.brobot = 0 group by run_dt"""
ORACLE["bucketed_hands"] = """with s as (select dt, sztoken, nround, count(*) as seats, sum(gameresult) as net from @v_result group by all),
a as (select dt, sztoken, nround, count(*) as acts from @v_action group by all)
select s.*, a.acts from s left join a using (dt, sztoken, nround) where dt between '2024-01-10' and '2024-01-20'"""
ORACLE["suspects_pruned"] = ORACLE["suspect_players"]

HEX = ("case when instr('dchs', substr(trim(x), 2, 1)) > 0 and instr('A23456789TJQK', substr(trim(x), 1, 1)) > 0 "
       "then cast(16 * instr('dchs', substr(trim(x), 2, 1)) + instr('A23456789TJQK', substr(trim(x), 1, 1)) as string) else '?' end")


def _ids(col: str) -> str:
    return f"array_to_string(list_transform(string_split({col}, ','), lambda x: {HEX}), ',')"


ORACLE["validate_presets"] = f"""with c as ({catalogue_sql()}),
i as (select id, winner_card_type, {_ids('winner')} as my_card, {_ids('opponent_1')} as opponent_card,
  {_ids('opponent_2')} as opponent_card_1, {_ids('community_cards')} as board_cards from c)
select id, case when contains(concat(my_card, opponent_card, opponent_card_1, board_cards), '?') then 'illegal'
    when len(list_distinct(string_split(concat_ws(',', my_card, opponent_card, opponent_card_1, board_cards), ','))) <> 11 then 'duplicate'
    else 'ok' end as status, winner_card_type, my_card, opponent_card, opponent_card_1, board_cards from i"""

# ---- evaluation ----------------------------------------------------------------------


def _bet_stats() -> str:
    streets = ["preflop", "flop", "turn", "river"]
    per = ", ".join(
        f"coalesce(sum(case when a.stage = '{s}' and a.act > 0 then a.num end), 0) / 10.0 as {s}_bet, "
        f"coalesce(sum(case when a.stage = '{s}' and a.act = 0 then 1 end), 0) as {s}_fold" for s in streets)
    cols = []
    for c in [*[f"{s}_bet" for s in streets], "payoff"]:
        cols += [f"round(case when count(*) >= 2 then avg({c}) else -1.0 end, 8) as {c}_mean",
                 f"round(case when count(*) >= 2 then stddev_samp({c}) else -1.0 end, 8) as {c}_std"]
    cols += [f"round(case when count(*) >= 2 then cast(sum({s}_fold) as double) / count(*) else -1.0 end, 8) as {s}_fold_rate"
             for s in streets]
    return f"""with bh as ({BET_HANDS}),
l as (select * from (select *, row_number() over (partition by playerid order by ord desc, dt, sztoken, nround) as rn from bh) x where rn <= 128),
h as (select l.playerid, l.ord, l.payoff / 10.0 as payoff, {per} from l left join @v_action a
  on l.playerid = a.playerid and l.dt = a.dt and l.sztoken = a.sztoken and l.nround = a.nround group by all)
select playerid, count(*) as hands, {', '.join(cols)} from h group by playerid"""


ORACLE["player_bet_stats"] = _bet_stats()

BUCKET = """case when act = 0 then 0 when act = 1 then 1 when act = 3 then 7 when num < floor(pot * 0.75) then 2 when num < pot then 3
  when num < floor(pot * 1.5) then 4 when num < pot * 2 then 5 else 6 end"""
ORACLE["raise_bucket"] = f"""select event_id, act, num, pot, {BUCKET} as bucket,
  [{names(RAISE_CLASSES)}][{BUCKET} + 1] as bucket_name, case when act < 0 then -1 when act = 0 then 0 else 1 end as simple from @v_action"""

MATCH = f"""bh as ({BET_HANDS}),
res as (select concat('m', cast(playerid as string)) as agent0, concat('b', cast(nround as string)) as agent1, payoff from bh),
acts as (select concat('m', cast(playerid as string)) as agent0, concat('b', cast(nround as string)) as agent1, stage, {BUCKET} as bucket
  from @v_action where act >= 0),
sc as (select agent0, agent1, count(*) as hands, cast(sum(case when payoff > 0 then 1 else 0 end) as double) / count(*) * 100 as winrate,
  cast(sum(payoff) as double) / 2 as total_payoffs, cast(sum(payoff) as double) / 2 / count(*) * 1000 as mbb_h from res group by all),
ac as (select agent0, agent1, count(*) as n, {', '.join(f"count(*) filter (where bucket = {i}) as n_{c}" for i, c in enumerate(RAISE_CLASSES))}
  from acts group by all),
rep as (select sc.agent0, sc.agent1, hands, round(winrate, 4) as winrate, total_payoffs, round(mbb_h, 4) as mbb_h,
  {', '.join(f"format('{{:.2f}}%', coalesce(cast(n_{c} as double) / n, 0.0) * 100) as {c}" for c in RAISE_CLASSES)},
  {', '.join(f"round(coalesce(cast(n_{c} as double) / n, 0.0), 6) as {c}_ratio" for c in RAISE_CLASSES)},
  {', '.join(f"round(coalesce(cast(n_{c} as double) / hands, 0.0), 6) as {c}_per_game" for c in RAISE_CLASSES)}
  from sc left join ac on sc.agent0 = ac.agent0 and sc.agent1 = ac.agent1)"""
ORACLE["match_report"] = f"with {MATCH} select * from rep order by mbb_h desc, agent0, agent1"
ORACLE["street_mix"] = f"""with {MATCH},
st as (select agent0, agent1, stage, {', '.join(f"count(*) filter (where bucket = {i}) as n_{c}" for i, c in enumerate(RAISE_CLASSES))}
  from acts group by all)
select st.agent0, st.agent1, stage, {', '.join(f"format('{{:.2f}}%', cast(st.n_{c} as double) / ac.n * 100) as {c}" for c in RAISE_CLASSES)}
from st join ac on st.agent0 = ac.agent0 and st.agent1 = ac.agent1"""
ORACLE["baseline_gate"] = f"""with {MATCH}
select agent0, agent1, winrate, mbb_h, {', '.join(f'{c}_per_game' for c in RAISE_CLASSES)} from rep
where agent0 in (select agent0 from rep group by agent0 having min(mbb_h) >= {GATE} and count(distinct agent1) = 3)"""

ORACLE["latency_report"] = """with t as (select count(*) as n, count(*) filter (where ok) as k,
  (max(ts_ms + latency_s * 1000) - min(ts_ms)) / 1000.0 as s, quantile_cont(latency_s, 0.5) as a, quantile_cont(latency_s, 0.9) as b,
  quantile_cont(latency_s, 0.99) as c from @v_request)
select 'total' as metric, cast(n as double) as value from t union all select 'ok', k from t union all select 'fail', n - k from t
union all select 'elapsed_s', round(s, 3) from t union all select 'rps', round(n / s, 6) from t
union all select 'p50', round(a, 6) from t union all select 'p90', round(b, 6) from t union all select 'p99', round(c, 6) from t"""
ORACLE["latency_errors"] = "select err, count(*) as n from @v_request where not ok and err is not null group by err order by n desc, err limit 10"
ORACLE["latency_status"] = "select status, count(*) as n from @v_request where status is not null group by status"
ORACLE["login_preview"] = """select user_id as nplayerid, concat('c', cast(user_id % 7 as string)) as nclubid, 1 as nactive,
  substr(cast(ts as string), 1, 19) as sztime, concat('10.0.1.', cast(user_id % 20 as string)) as loginip
from @events where event_type = 'signup' order by sztime, event_id limit 100"""


def oracle_texts() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in ORACLE.items()}
