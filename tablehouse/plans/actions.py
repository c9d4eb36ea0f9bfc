"""Player action detail: every message of a hand as seen from each seat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablehouse.functions import rules
from tablehouse.functions.exprs import HAND, num, number_list, pick_col
from tablehouse.operators import scans
from tablehouse.plans.jsonlog import messages

# fixed values: fields of a message payload
PAYLOAD = """minBetScore string, maxBetScore string, minAddScore string, seatBetState string,
 betScore string, seatCurBet string, poolScore string, score string, state string, curSeat string,
 seat string, seatInfos array<struct<seat: string>>, commonCards string, insureWinLos string,
 seatCurBets string, smallBlindSeat string, bigBlindSeat string"""

ORDER = "json_index"
PIECE = [*HAND, "_c"]


def action_messages(dwd: DataFrame) -> DataFrame:
    name = F.col("name")
    return messages(dwd).where(
        (pick_col(dwd, "playerid", "nplayerid") != 0)
        & name.isNotNull() & ~name.isin(*rules.META_MESSAGES)
    )


def events(rows: DataFrame) -> DataFrame:
    """Typed, de-duplicated messages.  Lists may come as JSON lists or as text.

    The rows are spread by hand and piece of the hand once; the de-duplication, the seat join
    and all windows below reuse that distribution.
    """
    p = F.col("p")
    name = F.col("name")
    seat = (
        F.when(name == "S2CStatePlayerOp", p["curSeat"])
        .when(name == "S2CStateBuyInsure", F.try_element_at(p["seatInfos"], F.lit(1))["seat"])
        .otherwise(p["seat"])
    )
    board = F.when(name == "S2CStateDealCard", F.regexp_replace(p["commonCards"], r"[\[\]]", ""))
    typed = (
        rows.select(*PIECE, ORDER, "name", F.from_json("data", PAYLOAD).alias("p"))
        .select(
            *PIECE, ORDER, name.alias("action"),
            seat.alias("event_seat"), board.alias("board"),
            *[num(p[c], "int").alias(c.lower()) for c in
              ("minBetScore", "maxBetScore", "minAddScore", "seatBetState", "betScore",
               "seatCurBet", "poolScore", "state", "smallBlindSeat", "bigBlindSeat")],
            num(p["score"]).alias("score"),
            p["insureWinLos"].alias("insurewinlos"), p["seatCurBets"].alias("seatcurbets"),
        )
    )
    return typed.repartition(*PIECE).dropDuplicates()


def _at_seat(listed: Column) -> Column:
    """The number a per-seat list holds for the row's own seat (seats count from 1)."""
    return num(F.trim(F.try_element_at(number_list(listed), num("seat", "int"))), "int")


def hearers(seats: DataFrame, score: DataFrame, cuts: DataFrame, how: str = "left") -> DataFrame:
    """Who sits in a hand and what they won there, once per piece of the hand."""
    won = score.select(*HAND, F.col("nplayerid").cast("string").alias("playerid"), F.struct("gameresult").alias("won")).repartition(*HAND)
    won = won.groupBy(*HAND, "playerid").agg(F.collect_set("won").alias("results"))
    s = seats.select(*HAND, "createdate", "gametype", "playerid", "seat").dropDuplicates().join(won, [*HAND, "playerid"], "left")
    pieces = F.sequence(F.lit(0), F.coalesce(F.size("_cuts"), F.lit(0)))
    return s.join(F.broadcast(cuts), HAND, how).withColumn("_c", F.explode(pieces)).drop("_cuts")


def fan_out(ev: DataFrame, seats: DataFrame) -> DataFrame:
    """Seat messages to their seat's player, table messages to every seat of the hand.

    One join on the hand's piece serves both; the seat test is a residual condition.
    """
    of_seat = F.col("action").isin(*rules.SEAT_ACTIONS)
    return ev.join(seats, PIECE).where(~of_seat | (F.col("event_seat") == F.col("seat"))).withColumn(
        "board", F.when(~of_seat, F.col("board")))


def _prepare(rows: DataFrame) -> DataFrame:
    """Per row: the seat's own blind, insurance outcome and payment, and the rank among the
    rows of one message (blinds first, then players by id)."""
    start = F.col("action") == "S2CStateGameStart"
    insure = F.col("action") == "S2CBuyInsure"
    seat = num("seat", "int")
    bet = _at_seat(F.col("seatcurbets"))
    small = start & bet.isNotNull() & (F.col("smallblindseat") == seat)
    big = start & bet.isNotNull() & (F.col("bigblindseat") == seat)
    won = F.when(F.col("action") == "S2CStateConclude", _at_seat(F.col("insurewinlos")))

    rank = F.when(F.col("is_small"), 0).when(F.col("is_big"), 1).otherwise(num("playerid", "int"))
    blind = F.when(F.col("is_small") | F.col("is_big"), F.col("startbet")).otherwise(0)
    return rows.select(
        "*",
        F.when(start, bet).alias("startbet"), seat.alias("seat_no"),
        F.coalesce(small, F.lit(False)).alias("is_small"), F.coalesce(big, F.lit(False)).alias("is_big"),
        F.when(won != 0, won).alias("won"),
        F.when(insure & (F.col("score") != 0), F.col("score")).alias("bought"),
    ).select("*", rank.alias("rank"), blind.alias("blind"))


BOTH_WAYS = ("minbetscore", "maxbetscore", "minaddscore", "won")


def _carry(hot: DataFrame, fill: str) -> tuple[DataFrame, DataFrame]:
    """Per piece of a cut hand, player and seat: what the other pieces hand over; and the boards that earlier
    pieces have dealt, a row per piece, player, seat and board.

    `hot` holds the prepared rows of the cut hands, which are reduced to a row per piece, player and
    seat; all else are windows over those.  Values (c_) come from the pieces before, else, where
    gaps are filled backwards, from the whole hand; counts and sums from the pieces before or from all.
    """
    seat, seat_piece = [*HAND, "playerid", "seat"], [*PIECE, "playerid", "seat"]
    columns = (*BOTH_WAYS, "poolscore", "board")
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(ORDER).alias("at"), F.col(c).alias("v"))) for c in columns}
    bought = F.when(F.col("action") == "S2CBuyInsure", F.col(ORDER))

    # a board is new where no earlier piece of the player's hand has dealt it
    first_seen = F.min("_c").over(Window.partitionBy(*seat, "board"))
    dealt = hot.where(F.col("board").isNotNull()).select(*seat_piece, "board").distinct().withColumn("old", F.col("_c") > first_seen)
    fresh = dealt.where(~F.col("old")).groupBy(*seat_piece).agg(F.count(F.lit(1)).alias("n_new"))
    parts = hot.groupBy(*seat_piece).agg(
        *[f(known[c]).alias(f"{n}_{c}") for c in columns for f, n in ((F.max, "last"), (F.min, "first"))],
        F.count(F.lit(1)).alias("n"), F.sum("blind").alias("blind"), F.sum("bought").alias("paid"),
        F.max(bought).alias("bought_at")).join(fresh, seat_piece, "left")

    before = lambda by: Window.partitionBy(*by).orderBy("_c").rangeBetween(Window.unboundedPreceding, -1)
    player, whole = [*HAND, "playerid"], Window.partitionBy(*HAND, "playerid")
    parts = parts.withColumn("boards_before", F.coalesce(F.sum("n_new").over(before(seat)), F.lit(0))).withColumn(
        "all_paid", F.sum("paid").over(Window.partitionBy(*seat)))
    score = F.when(F.col("bought_at").isNotNull() & F.col("all_paid").isNotNull(), F.struct(F.col("bought_at").alias("at"), F.col("all_paid").alias("v")))
    parts = parts.withColumn("last_score", score)
    earlier = {c: F.max(f"last_{c}").over(before(player))["v"] for c in (*columns, "score")}
    later = {c: (F.max if w == "last" else F.min)(f"{w}_{c}").over(whole)["v"] for c, w in (*((c, fill) for c in BOTH_WAYS), ("score", "last"))}
    parts = parts.select(
        *seat_piece, "boards_before", "all_paid", "n", "blind",
        *[(F.coalesce(v, later[c]) if c in later else v).alias(f"c_{c}") for c, v in earlier.items()])
    carry = parts.select(
        "*", F.coalesce(F.sum("n").over(before(HAND)), F.lit(0)).alias("rows_before"),
        F.sum("blind").over(Window.partitionBy(*HAND)).alias("all_blinds"), F.lit(True).alias("is_cut")).drop("n", "blind")
    return carry, dealt.where("old").select(*seat_piece, F.col("board").alias("commoncard"), F.lit(True).alias("is_old"))


def _fill_hands(base: DataFrame, carry: DataFrame, old_boards: DataFrame, fill: str) -> DataFrame:
    """Fills, numbering and totals by windows that all share the distribution by piece."""
    player = Window.partitionBy(*PIECE, "playerid").orderBy(ORDER)
    past, whole = player.rowsBetween(*scans.PAST), player.rowsBetween(*scans.WHOLE)
    base = base.join(carry, [*PIECE, "playerid", "seat"], "left")

    def forward(c) -> Column:
        return F.coalesce(F.last(c, ignorenulls=True).over(past), F.col(f"c_{c}"))

    def both_ways(c, mode: str = fill) -> Column:
        # where nothing comes before, all values come after: the first or last of the whole
        # hand is the one a frame from here on would find, in one pass
        back = F.last if mode == "last" else F.first
        return F.coalesce(forward(c), back(c, ignorenulls=True).over(whole))

    seat = Window.partitionBy(*PIECE, "playerid", "seat")
    # a seat's insurance payments count on each of its insurance messages
    paid = F.when(F.col("action") == "S2CBuyInsure", F.when(F.col("is_cut"), F.col("all_paid")).otherwise(F.sum("bought").over(seat)))
    filled = base.withColumn("score", paid).select(
        "*", *[both_ways(c).alias(f"f_{c}") for c in BOTH_WAYS], both_ways("score", "last").alias("f_score"),
        forward("poolscore").alias("f_pool"), forward("board").alias("commoncard"),
    )
    order = Window.partitionBy(*PIECE).orderBy(ORDER, "rank", "seat_no")
    # the first row of each board in a piece counts, unless an earlier piece has dealt it or hands it over
    known = F.col("is_old").isNotNull() | F.coalesce(F.col("commoncard") == F.col("c_board"), F.lit(False))
    first = F.row_number().over(Window.partitionBy(*PIECE, "playerid", "seat", "commoncard").orderBy(ORDER)) == 1
    filled = filled.join(old_boards, [*PIECE, "playerid", "seat", "commoncard"], "left").withColumn(
        "is_new", (F.col("commoncard").isNotNull() & first & ~known).cast("int"))
    distinct = F.sum("is_new").over(seat.orderBy(ORDER)) + F.coalesce("boards_before", F.lit(0))
    return filled.select(
        "*", (F.row_number().over(order) + F.coalesce("rows_before", F.lit(0))).cast("bigint").alias("rn"),
        F.when(F.col("is_cut"), F.col("all_blinds")).otherwise(F.sum("blind").over(Window.partitionBy(*PIECE))).alias("blinds"),
        distinct.cast("int").alias("predealct"),
    )


def player_action(dwd: DataFrame, seats: DataFrame, score: DataFrame, fill: str = "last",
                  rows: int = scans.ROWS) -> DataFrame:
    """Action detail, one row per hand, seat and message.

    fill: which later value fills leading gaps, 'last' (the hand's last) or 'first' (the
    next one).  Hands are cut into pieces of about `rows` messages, see `scans`; a hand of usual
    size is one piece.
    """
    if fill not in ("last", "first"):
        raise ValueError("fill is 'last' or 'first'")
    source = action_messages(dwd).withColumn(ORDER, F.col(ORDER).cast("int"))
    cuts = scans.find_cuts(source, HAND, ORDER, rows)

    def prepared(how: str) -> DataFrame:
        return _prepare(fan_out(events(scans.cut(source, cuts, HAND, ORDER, how)), hearers(seats, score, cuts, how)))

    numbered = _fill_hands(prepared("left"), *_carry(prepared("inner"), fill), fill)
    start = F.col("action") == "S2CStateGameStart"
    betscore = F.when(start, F.col("startbet")).otherwise(F.col("betscore"))
    pool = (
        F.when(F.col("is_small"), F.col("startbet")).when(F.col("is_big"), F.col("blinds"))
        .when(F.col("rn") == 1, betscore).otherwise(F.col("f_pool"))
    )
    insured = F.col("score") > 0
    return numbered.select("*", F.inline_outer("results")).select(
        "createdate", "sztoken", "nround", "playerid", "seat", F.col("rn").alias("json_index"),
        F.col("f_minbetscore").alias("minbetscore"), F.col("f_maxbetscore").alias("maxbetscore"),
        F.col("f_minaddscore").alias("minaddscore"), "action", "seatbetstate",
        betscore.alias("betscore"),
        F.when(start, F.col("startbet")).otherwise(F.col("seatcurbet")).alias("seatcurbet"),
        pool.cast("bigint").alias("poolscore"), "predealct", "commoncard",
        rules.street(F.col("commoncard")).alias("stage"), "gameresult",
        F.when(insured, 1).otherwise((F.col("action") == "S2CStateBuyInsure").cast("int")).alias("isjumpinsure"),
        F.when(insured, 1).otherwise(0).alias("isinsure"), "score",
        (F.col("f_won") + F.col("f_score")).alias("insurewinscores"),
        rules.bet_action(F.col("action"), F.col("seatbetstate"), F.col("state")).alias("betaction"),
        "gametype", "dt",
    )


def raise_buckets(actions: DataFrame, act: str = "act", size: str = "num", pot: str = "pot") -> DataFrame:
    """Adds the raise class, its label, and the simplified action."""
    a = F.col(act)
    bucket = rules.raise_bucket(a, F.col(size), F.col(pot))
    label = F.try_element_at(F.array(*[F.lit(n) for n in rules.RAISE_CLASSES]), bucket.cast("int") + 1)
    return actions.select(
        "*", bucket.alias("bucket"), label.alias("bucket_name"), rules.simple_action(a).alias("simple"))
