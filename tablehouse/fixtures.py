"""Table-shaped inputs derived from the generic test tables.

Each view is one SQL text that reads the same in Spark and DuckDB; `@name` marks a
table or another view.  Where the engines need different functions the text holds
`#name#` parts from `DIALECT`.  The oracle queries use the same texts as CTEs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablehouse.session import scratch

FIRST_DT, LAST_DT = "2024-01-01", "2024-01-30"

TABLES = {"events", "orders", "customer", "lineitem"}

# views that stand for a table several jobs read: written once per session
SHARED = {"v_result", "v_user", "v_action", "v_hand_log", "v_cards", "v_cards_short", "v_info", "v_match", "v_member", "v_preset"}

DIALECT = {
    "spark": {
        "days_from_reg": "lateral view explode(sequence(cast(reg as date), date'2024-01-30', interval 1 day)) x as d",
        "clubs": "lateral view explode(array(7, 11)) x as k",
        "owners": "lateral view explode(array(0, 1)) x as owner",
        "slots3": "lateral view explode(array(0, 1, 2)) x as player",
        "two": "lateral view explode(array(0, 1)) x as copy",
        "join_msgs": "array_join(transform(array_sort(collect_list(struct(event_id, msg))), x -> x.msg), ',')",
        "join_seats": "array_join(transform(array_sort(collect_list(struct(event_id, seatmsg))), x -> x.seatmsg), ',')",
        "arr": "array",
        "arr_end": "",
        "epoch_ms": "cast(floor(unix_micros(cast(ts as timestamp)) / 1000) as bigint)",
    },
    "duck": {
        "days_from_reg": ", unnest(generate_series(cast(reg as date), date '2024-01-30', interval 1 day)) x(d)",
        "clubs": ", unnest([7, 11]) x(k)",
        "owners": ", unnest([0, 1]) x(owner)",
        "slots3": ", unnest([0, 1, 2]) x(player)",
        "two": ", unnest([0, 1]) x(copy)",
        "join_msgs": "string_agg(msg, ',' order by event_id)",
        "join_seats": "string_agg(seatmsg, ',' order by event_id)",
        "arr": "list_value",
        "arr_end": "",
        "epoch_ms": "cast(floor(epoch_us(ts) / 1000) as bigint)",
    },
}

VIEWS = {
    # one row per hand and player, up to six seats; a hand lies in one day.  In every second hand
    # two players keep meeting at many tables, and one of them wins; some hands end in a tie,
    # some tables seat two only, some rows lack the end time
    "v_result": """
select concat('t', cast(tok as string)) as sztoken, hand % 10 as nround, nplayerid, seat,
  case tok % 3 when 0 then 79 when 1 then 420 else 450 end as ngametype,
  gameresult, brobot,
  case when brobot = 1 then concat('v', cast(nplayerid % 3 as string)) else '0' end as robotversion,
  concat(dt, clock) as createtime, concat(dt, clock) as starttime, endtime, dt as create_dt, dt, hand
from (select tok, hand, nplayerid, seat, endtime, clock,
    case when hand % 11 = 3 then 0 when met then abs(won) else won end as gameresult,
    case when nplayerid % 5 = 0 then 1 else 0 end as brobot,
    cast(min(day) over (partition by hand) as string) as dt,
    row_number() over (partition by hand, nplayerid order by seat) as rn
  from (select cast(floor(event_id/60) as bigint) as tok, cast(floor(event_id/6) as bigint) as hand,
    event_id % 12 in (6, 7) as met, case when event_id % 12 in (6, 7) then event_id % 12 - 5 else user_id end as nplayerid,
    event_id % 6 + 1 as seat, cast(ts as date) as day,
    (cast(round(value*100) as bigint) - 5000) * 20 as won,
    substr(cast(ts as string), 11, 9) as clock,
    case when event_id % 41 = 0 then null when event_id % 2 = 0 then substr(cast(ts + interval '3' minute as string), 1, 19)
      else substr(cast(ts + interval '7' minute as string), 1, 19) end as endtime
  from @events where event_id % 6 < 2 or floor(event_id/6) % 13 <> 5) e) f
where rn = 1""",
    "v_score": """
select ngametype, sztoken, nplayerid, nround, gameresult, gameresult as nscore, createtime, starttime, endtime, dt
from @v_result where ngametype <> 450""",
    "v_gold": """
select ngametype, sztoken, nplayerid, nround, brobot, gameresult, createtime, starttime, endtime, dt
from @v_result where ngametype = 450""",
    "v_robot": """
select nplayerid as playerid, sztoken, nround, robotversion, brobot, dt from @v_result where brobot = 1""",
    # a snapshot per day of all users registered by then
    "v_user": """
select nplayerid, concat(reg, ' 00:00:00') as szcreatetime,
  case when nplayerid % 23 = 6 then '' when nplayerid % 29 = 4 then null
    else concat(case when nplayerid % 4 = 0 then reg else cast(cast(d as date) as string) end, ' 08:00:00') end as prelogintime,
  case when nplayerid % 17 = 3 then '' when nplayerid % 19 = 4 then null else concat('10.0.0.', cast(nplayerid % 20 as string)) end as preloginip,
  case when nplayerid % 5 = 0 then '1' else '0' end as brobot, cast(cast(d as date) as string) as dt
from (select nplayerid, concat('2024-01-', lpad(cast(nplayerid % 30 + 1 as string), 2, '0')) as reg
  from (select distinct user_id as nplayerid from @events union all
    select distinct user_id + 1000000 from @events where user_id % 15 = 7) a) u
#days_from_reg#""",
    "v_member": """
select nplayerid, concat('nick', cast(nplayerid as string), '_', cast(k as string)) as sznickname,
  nplayerid % k as nclubid, dt
from @v_user #clubs#""",
    "v_info": """
select concat('o', cast(o_orderkey as string)) as sztoken, 400 as ngametype, o_orderpriority as szroomname,
  concat('2024-01-', lpad(cast(o_orderkey % 30 + 1 as string), 2, '0'), ' 12:00:00') as createtime,
  concat('{"joinFeeUcoin":', cast(cast(floor(o_totalprice) as bigint)*10000 as string),
    ',"awards":[{"award":', cast(cast(floor(o_totalprice) as bigint)*30000 as string), '}]}') as szrulejson,
  cast(null as int) as ucoinratio,
  concat('2024-01-', lpad(cast((case when o_orderkey % 11 = 0 then o_orderkey + 1 else o_orderkey end) % 30 + 1 as string), 2, '0')) as dt
from @orders
union all
select distinct sztoken, ngametype, 'cash', concat(dt, ' 00:00:00'), '{}', 2, dt
from @v_result where ngametype = 79""",
    "v_match": """
select concat('o', cast(o_orderkey as string)) as sztoken, 400 as ngametype, o_custkey % 150 as nplayerid,
  case when o_orderkey % 4 = 0 then cast(floor(o_totalprice) as bigint)*30000 else 0 end as reward,
  concat('2024-01-', lpad(cast((case when o_orderkey % 11 = 0 then o_orderkey + 1 else o_orderkey end) % 30 + 1 as string), 2, '0')) as dt
from @orders""",
    "v_preset": """
select sztoken, nround, ngametype, nplayerid, brobot, dt, seat, gameresult as score,
  case when hand % 4 = 0 then 'true' else 'false' end as bpreset,
  case when hand % 4 <> 0 then null when hand % 3 = 0 then 'score_rank' when hand % 3 = 1 then 'new_user' else 'suspect_user' end as inventiontype,
  case when hand % 4 = 0 and seat = 1 then '1' when hand % 4 = 0 and seat = 2 then '2' when hand % 4 = 0 then '0' end as presettype
from @v_result where ngametype in (420, 450)""",
    "v_deal_log": """
select concat('{"szToken":"', sztoken, '","nround":', cast(nround as string), ',"gametype":', cast(ngametype as string),
  ',"smallblind":10,"nplayerid":', cast(nplayerid as string), ',"seat":', cast(seat as string), ',"score":', cast(score as string),
  ',"brobot":', cast(brobot as string), ',"cards":[17,18],"commoncards":[33,34,35,36,37],"bPreset":', bpreset,
  case when inventiontype is null then '' else concat(',"inventionType":"', inventiontype, '"') end,
  case when presettype is null then '' else concat(',"presetType":', presettype) end, ',"redisScore":0.5}') as tstr, dt
from @v_preset""",
    # one row per player action; twenty actions make a hand, a hand lies in one day.  A player's
    # kind (id modulo 9) says how often which action comes; every second action is of five players
    "v_action": """
select concat('t', cast(cast(floor(event_id/60) as bigint) as string)) as sztoken,
  cast(floor(event_id/20) as bigint) % 3 as nround, playerid, event_id % 20 as json_index, 'S2CStatePlayerOp' as action, stage,
  case when stage = 'preflop' then case playerid % 9
      when 0 then case when k % 2 = 0 then 'raise' else 'allin' end
      when 1 then case when k < 40 then 'raise' else 'none' end
      when 2 then case when k < 90 then 'call' when k < 95 then 'raise' else 'none' end
      when 3 then case when k < 85 then 'Fold' else 'check' end
      when 4 then case when event_id % 20 = 0 then 'raise' else 'none' end
      when 5 then case when k < 60 then 'raise' when k < 80 then 'call' else 'fold' end
      when 6 then case when k < 30 then 'call' when k < 35 then 'raise' else 'none' end
      when 7 then case when k < 45 then 'call' when k < 75 then 'raise' else 'fold' end
      else case when k < 50 then 'check' when k < 60 then 'init' when k < 70 then null else 'none' end end
    else case when playerid % 9 = 3 and k < 85 then 'Fold' when playerid % 9 = 0 and k < 85 then 'raise'
      when playerid % 9 = 2 and k < 80 then 'call' when k < 40 then 'raise' when k < 50 then 'allin' when k < 75 then 'call'
      else 'check' end end as betaction,
  num, 3000 + event_id % 5000 as pot, cast(min(day) over (partition by cast(floor(event_id/20) as bigint)) as string) as dt,
  (event_id * 7 + user_id) % 5 - 1 as act, event_id
from (select event_id, user_id, case when event_id % 2 = 0 then user_id % 5 else user_id % 45 end as playerid,
    (event_id * 37 + cast(round(value*100) as bigint)) % 100 as k, cast(round(value*100) as bigint) as num, cast(ts as date) as day,
    case when event_id % 20 < 8 then 'preflop' when event_id % 20 < 13 then 'flop' when event_id % 20 < 17 then 'turn' else 'river' end as stage
  from @events) e""",
    # messages of a hand, in the text form of the log
    "v_msg": """
select event_id, hand, case
    when i = 2 then concat('{"name":"S2CStateDealCard","data":{"commonCards":', case when hand % 2 = 0 then '"' else '' end,
        '[', cast(hand % 40 as string), ',41,42]', case when hand % 2 = 0 then '"' else '' end, '}}')
    when i = 5 and hand % 3 <> 0 then concat('{"name":"S2CStateDealCard","data":{"commonCards":[', cast(hand % 40 as string), ',41,42,',
        cast(user_id % 40 as string), case when hand % 3 = 2 then ',43' else '' end, ']}}')
    when i = 4 and hand % 3 = 0 then concat('{"name":"S2CBuyInsure","data":{"seat":5,"score":', cast(hand % 2 * 50 as string),
        ',"state":', cast(cast(floor(hand / 3) as bigint) % 6 + 1 as string), '}}')
    when i = 4 and hand % 3 = 1 then '{"name":"S2CGiveUp","data":{"seat":5}}'
    when i = 5 then '{"name":"S2CStateBuyInsure","data":{"seatInfos":[{"seat":6}]}}'
    else concat('{"name":"S2CStatePlayerOp","data":{"curSeat":', cast(i + 1 as string),
        case when event_id % 4 = 0 then '' else concat(',"minBetScore":', cast(event_id % 100 as string), ',"maxBetScore":',
          cast(event_id % 100 + 500 as string), ',"minAddScore":', cast(event_id % 10 as string)) end,
        ',"seatBetState":', cast(event_id % 7 as string), ',"betScore":', cast(cast(round(value*100) as bigint) as string),
        ',"seatCurBet":', cast(user_id as string),
        case when event_id % 5 = 0 then '' else concat(',"poolScore":', cast(30 + i * 10 as string)) end, '}}')
    end as msg
from (select *, cast(floor(event_id/6) as bigint) as hand, event_id % 6 as i from @events) e""",
    # the raw hand log: one JSON array per hand and recording player
    "v_hand_log": """
select l.hand * 2 + owner as id, s.ngametype, case when owner = 0 then s.p0 else s.p1 end as nplayerid, s.sztoken, s.nround,
  s.w0 as nwinscore, s.w0 as nscore, 'hand' as sztitle, '[]' as szhandcard,
  case when l.hand % 97 = 13 then 'notjson' else concat('[{"name":"SeatInfos","data":',
    case when l.hand % 2 = 1 then '{"data":[' else '[' end, s.seats, case when l.hand % 2 = 1 then ']}' else ']' end,
    '},{"name":"S2CStateGameStart","data":{"seatCurBets":',
    case when l.hand % 2 = 1 then '"[10,20,0,0,0,0]"' else '[10,20,0,0,0,0]' end,
    ',"smallBlindSeat":1,"bigBlindSeat":2,"poolScore":30}},', case when l.hand % 7 = 0 then '5,' else '' end, l.msgs,
    ',{"name":"S2CStateConclude","data":{"insureWinLos":', case when l.hand % 2 = 0 then '"' else '' end,
    '[0,0,0,0,', cast(l.hand % 4 * 25 as string), ',0]', case when l.hand % 2 = 0 then '"' else '' end, '}}',
    case when (case when owner = 0 then s.p0 else s.p1 end) % 5 = 0
      then concat(',{"name":"ModelVer","data":{"modelVersion":"v', cast((case when owner = 0 then s.p0 else s.p1 end) % 3 as string), '"}}')
      else '' end, ']') end as szcarddata,
  s.createtime, s.dt
from (select hand, #join_msgs# as msgs from @v_msg group by hand) l
join (select hand, sztoken, nround, ngametype, dt, min(createtime) as createtime, min(nplayerid) as p0, max(nplayerid) as p1,
    max(gameresult) as w0, #join_seats# as seats
  from (select *, seat as event_id, concat('{"nPlayerId":', cast(nplayerid as string), ',"seat":', cast(seat as string), '}') as seatmsg from @v_result) r
  group by hand, sztoken, nround, ngametype, dt) s on l.hand = s.hand
#owners#""",
    # requests and responses of the dealing service, one row per hand
    "v_deals": """
select s.sztoken, s.nround, s.ngametype as gametype, 10 as smallblind, s.users, s.handcards,
  #arr#(s.hand % 40, 41, 42, 43, 44) as commoncards, case when s.hand % 4 = 0 then true else false end as bpreset,
  case when s.hand % 4 = 0 then 'score_rank' end as inventiontype, s.dt
from @v_deal_parts s""",
    # requests against the dealing service
    "v_request": """
select event_id as request_id, value / 100 as latency_s, event_type <> 'error' as ok,
  case when event_type = 'error' then concat('HTTP', cast(500 + user_id % 4 as string)) end as err,
  case when event_type = 'error' then 500 + user_id % 4 else 200 end as status, #epoch_ms# as ts_ms
from @events""",
    # lines of the service log: every seventh is delivered twice, every ninth lacks the keyword
    "v_log_line": """
select concat('e', cast(event_id as string)) as event_id, #epoch_ms# as ts_ms,
  case when event_id % 9 = 0 then 'INFO other' else concat('INFO FLATTENED_GAME_DATA: {"nplayerid":', cast(user_id as string),
    ',"score":', cast(cast(round(value*100) as bigint) as string), '}') end as message, copy
from @events #two#
where copy = 0 or event_id % 7 = 0""",
    # the same lines as six polls deliver them: every fiftieth line comes one poll late
    "v_polled": """
select event_id, ts_ms, message, copy,
  least(5, cast(floor(num * 6 / total) as int) + case when num % 50 = 7 then 1 else 0 end) as poll
from (select l.*, cast(substr(event_id, 2, 20) as bigint) as num, (select count(*) from @events) as total from @v_log_line l) x""",
}

def _deal(size: int, low: int) -> str:
    """Three hands of two cards and a board of five per event, from a deck of `size` cards.

    Slots go to cards by a permutation: size + 1 is a prime (53, 37), so multiplication of
    1..size by a factor modulo that prime only changes their order.  Two such factors and two
    rotations, taken from the event's columns, mix it; the eleven cards of an event differ.
    """
    prime = size + 1

    def card(slot: str) -> str:
        once = f"((({slot} + s) % {size} + 1) * a % {prime} - 1 + v) % {size}"
        return f"(({once}) + 1) * b % {prime} - 1 + {low}"

    board = ", ".join(f"{card(str(i))} as c{i}" for i in range(6, 11))
    return f"""
select event_id as hand_id, player,
  #arr#(c0, c1, c6, c7, c8, c9, c10) as cards, #arr#(c6, c7, c8, c9, c10) as board, #arr#(c0, c1) as hole
from (select event_id, player, {card("2 * player")} as c0, {card("(2 * player + 1)")} as c1, {board}
  from (select event_id, (event_id + user_id) % {size} + 1 as a, (cast(floor(event_id / {size}) as bigint) + cents) % {size} as s,
      (event_id * 5 + cents) % {size} as v, (cents + user_id * 3) % {size} + 1 as b
    from (select event_id, user_id, cast(round(value*100) as bigint) as cents from @events) x) e #slots3#) c"""


VIEWS["v_cards"] = _deal(52, 0)
VIEWS["v_cards_short"] = _deal(36, 16)

# the two list-of-struct columns need engine-specific aggregation
DIALECT["spark"]["users_agg"] = "array_sort(collect_list(struct(nplayerid, seat, gameresult as score, brobot)))"
DIALECT["duck"]["users_agg"] = "list({'nplayerid': nplayerid, 'seat': seat, 'score': gameresult, 'brobot': brobot} order by nplayerid)"
DIALECT["spark"]["cards_agg"] = (
    "filter(array_sort(collect_list(case when seat <> 6 then struct(nplayerid, array(seat, seat + 20) as cards, "
    "case when seat = 1 then 1 when seat = 2 then 2 end as presettype) end)), x -> x is not null)"
)
DIALECT["duck"]["cards_agg"] = (
    "list({'nplayerid': nplayerid, 'cards': [seat, seat + 20], 'presettype': case when seat = 1 then 1 when seat = 2 then 2 end} "
    "order by nplayerid) filter (where seat <> 6)"
)
VIEWS["v_deal_parts"] = """
select hand, sztoken, nround, ngametype, dt, #users_agg# as users, #cards_agg# as handcards
from @v_result group by hand, sztoken, nround, ngametype, dt"""

_STORED: dict[tuple[str, str], str] = {}
_REF = re.compile(r"@(\w+)")


def _text(name: str, engine: str) -> str:
    return re.sub(r"#(\w+)#", lambda m: DIALECT[engine][m.group(1)], VIEWS[name])


def with_views(sql: str) -> str:
    """Oracle text: the query with every view it mentions in front as a CTE."""
    done: dict[str, str] = {}

    def add(text: str) -> None:
        for ref in _REF.findall(text):
            if ref in VIEWS and ref not in done:
                body = _text(ref, "duck")
                add(body)
                done[ref] = f"{ref} as ({_REF.sub(lambda m: m.group(1), body)})"

    add(sql)
    body = _REF.sub(lambda m: m.group(1), sql).strip()
    if not done:
        return body
    head = ",\n".join(done.values())
    for start in ("with recursive ", "with "):
        if body.lower().startswith(start):
            return f"{start}{head},\n{body[len(start):]}"
    return f"with {head}\n{body}"


class Fixtures:
    """The views over one folder of test tables, as Spark frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self.prefix = "th_" + hashlib.md5(self.sf_dir.encode()).hexdigest()[:8] + "_"
        self._have: set[str] = set()

    def _register(self, name: str) -> str:
        alias = self.prefix + name
        if name not in self._have:
            if name in TABLES:
                df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                df = self.spark.sql(self.resolve(_text(name, "spark")))
                if name in SHARED:
                    df = self.stored(name, lambda df=df: df)
            df.createOrReplaceTempView(alias)
            self._have.add(name)
        return alias

    def resolve(self, sql: str) -> str:
        return _REF.sub(lambda m: self._register(m.group(1)), sql)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        key = name if name in TABLES else f"v_{name}"
        return self.spark.table(self._register(key))

    def stored(self, name: str, make: Callable[[], DataFrame], spread: bool = True) -> DataFrame:
        """The frame `make` gives as a table, written once per session.

        The nightly jobs hand tables to each other, and several of them read the same one.
        spread: False for a frame read row by row from a stored table, which is spread already.
        """
        key = (self.spark.sparkContext.applicationId, self.prefix + name)
        if key not in _STORED:
            path, df = scratch(self.spark, name), make()
            cores = self.spark.sparkContext.defaultParallelism
            if spread and len(self.events.inputFiles()) < cores:
                # a test table is one file, hence one task: spread what is read often, by a hash of the
                # row, as dealing rows out in turn would sort all rows of a task first
                df = df.repartition(cores, *df.columns)
            df.write.parquet(path)
            _STORED[key] = path
        return self.spark.read.parquet(_STORED[key])

    def folder(self, name: str, make: Callable[[], str]) -> str:
        """The folder `make` wrote, which happens once per session."""
        key = (self.spark.sparkContext.applicationId, self.prefix + name)
        if key not in _STORED:
            _STORED[key] = make()
        return _STORED[key]

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(self.resolve(text))
