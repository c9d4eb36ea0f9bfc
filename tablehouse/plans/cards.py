"""Showdowns, equity lookups and the preset catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablehouse.functions import cards as C
from tablehouse.functions.exprs import all_different
from tablehouse.functions.preflop import DEFAULT_RATE, PREFLOP_RATES
from tablehouse.sources import io


def showdown(hands: DataFrame, keys: list[str], cards: str = "cards", deck: str = "holdem") -> DataFrame:
    """Category, strength and winner flag per player; folded players are absent rows.

    A deck seats at most 23 players, so a hand's window holds at most 23 rows.
    """
    rated = C.with_strength(hands, cards, deck)
    best = F.max("strength").over(Window.partitionBy(*keys))
    return rated.withColumn("winner", (F.col("strength") == best).cast("int"))


def duel(hands: DataFrame, keys: list[str], deck: str = "holdem") -> DataFrame:
    """Result 1 / 0 / -1 of the first of two hands (`cards1`, `cards2`)."""
    one = C.with_strength(hands, "cards1", deck).withColumnsRenamed({"strength": "s1", "category": "category1"})
    two = C.with_strength(one, "cards2", deck).withColumnsRenamed({"strength": "s2", "category": "category2"})
    return two.select(*keys, "category1", "category2",
                      F.signum(F.col("s1") - F.col("s2")).cast("int").alias("result"))


def audit_mismatches(computed: DataFrame, expected: DataFrame, keys: list[str], value: str,
                     tolerance: float | None = None) -> DataFrame:
    """Rows whose values differ, by more than the tolerance if one is given."""
    joined = computed.select(*keys, F.col(value).alias("computed")).join(
        expected.select(*keys, F.col(value).alias("expected")), keys)
    if tolerance is None:
        return joined.where(~F.col("computed").eqNullSafe(F.col("expected")))
    gap = F.abs(F.col("computed") - F.col("expected")) > tolerance
    return joined.where(F.coalesce(gap, ~F.col("computed").eqNullSafe(F.col("expected"))))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def audit(computed: DataFrame, expected: DataFrame, keys: list[str], value: str,
          tolerance: float | None = None) -> DataFrame:
    """One row per finding: 'mismatch' with both values, 'duplicate' with the copies of a key."""
    bad = audit_mismatches(computed, expected, keys, value, tolerance).select(
        F.lit("mismatch").alias("finding"), *keys, F.col("computed").cast("string").alias("computed"),
        F.col("expected").cast("string").alias("expected"), F.lit(None).cast("bigint").alias("copies"))
    twice = duplicate_keys(expected, keys).select(
        F.lit("duplicate").alias("finding"), *keys, F.lit(None).cast("string").alias("computed"),
        F.lit(None).cast("string").alias("expected"), "copies")
    return bad.unionByName(twice)


def preflop_rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PREFLOP_RATES, "hand_class string, win_rate double, tie_rate double")


def preflop_equity(hands: DataFrame, c1: Column, c2: Column, rates: DataFrame) -> DataFrame:
    """Adds the hand class and its win rate.  The table has 169 rows, one per class."""
    keyed = hands.withColumn("hand_class", C.preflop_key(c1, c2))
    return keyed.join(rates.select("hand_class", "win_rate"), "hand_class", "left").withColumn(
        "win_rate", F.coalesce("win_rate", F.lit(DEFAULT_RATE)))


def hand_key(hole: str) -> Column:
    """Two cards, lower code first, as the packed tables name their files: '2s Ah'."""
    def name(c: Column) -> Column:
        t = C.to_text(c)
        return F.concat(F.substring(t, 2, 1), F.lower(F.substring(t, 1, 1)))

    return F.array_join(F.transform(F.array_sort(hole), name), " ")


def packed_equity(hands: DataFrame, rates: DataFrame, n_cards: int, hole: str = "hole",
                  board: str = "board") -> DataFrame:
    """Adds the packed table's rate for (hole cards, board), 0 where the table has no entry.

    rates: `hand_key` and `word`.  An equi-join on the card bits of the word replaces a
    search per row, so the table may be of any size.
    """
    mask = ~0x3FFFFF
    table = rates.select(
        "hand_key", F.col("word").bitwiseAND(F.lit(mask)).alias("_cards"),
        C.unpack(F.col("word"), n_cards)[1].alias("rate"))
    own = C.pack(F.array_sort(board), F.lit(0.0), n_cards)
    return (
        hands.select("*", hand_key(hole).alias("hand_key"), own.alias("_cards"))
        .join(table, ["hand_key", "_cards"], "left").drop("_cards")
        .withColumn("rate", F.coalesce("rate", F.lit(0.0)))
    )


def packed_lookup(spark: SparkSession, hands: DataFrame, path: str, hole: str = "hole", board: str = "board") -> DataFrame:
    """`packed_equity` from the packed files of a folder, by the size of the board: 0, 3, 4 or 5 cards.

    Boards of n cards are looked up below `board<n>`; without a board the two own cards are the
    word and any file of `board0` may hold it.  Other sizes have no table: rate 0.
    """
    out = []
    for n in (3, 4, 5):
        rates = io.read_packed(spark, f"{path}/board{n}", n).select("hand_key", "word")
        out.append(packed_equity(hands.where(F.size(board) == n), rates, n, hole, board))
    bare = io.read_packed(spark, f"{path}/board0", 2).select("word").withColumn("hand_key", F.lit("any"))
    rows = hands.where(F.size(board) == 0).withColumn("_own", F.array_sort(hole))
    own = C.pack(F.col("_own"), F.lit(0.0), 2)
    table = bare.select(F.col("word").bitwiseAND(F.lit(~0x3FFFFF)).alias("_cards"), C.unpack(F.col("word"), 2)[1].alias("rate"))
    found = rows.select(*hands.columns, hand_key(hole).alias("hand_key"), own.alias("_cards")).join(table, "_cards", "left").drop("_cards")
    out.append(found.withColumn("rate", F.coalesce("rate", F.lit(0.0))))
    other = hands.where(~F.size(board).isin(0, 3, 4, 5) | F.col(board).isNull())
    out.append(other.select("*", hand_key(hole).alias("hand_key"), F.lit(0.0).alias("rate")))
    return reduce(DataFrame.unionByName, out)


# fixed values: card columns of the catalogue and the name each has after validation
CATALOGUE = {"winner": "my_card", "opponent_1": "opponent_card", "opponent_2": "opponent_card_1",
             "community_cards": "board_cards"}


def validate_presets(catalogue: DataFrame) -> DataFrame:
    """Card texts to hex ids with a status: 'ok', 'illegal' (not a card) or 'duplicate'
    (the three hands and the board are not eleven different cards)."""
    parts = {c: F.split(c, ",") for c in CATALOGUE}
    ids = {n: F.transform(parts[c], lambda x: C.hex_id(F.trim(x))) for c, n in CATALOGUE.items()}
    rows = catalogue.select("*", *[e.alias(n) for n, e in ids.items()])
    every = F.concat(*[F.col(n) for n in CATALOGUE.values()])
    rows = rows.withColumn("_all", every)
    illegal = F.exists("_all", lambda x: x.isNull()) | F.col("_all").isNull()
    eleven = all_different(F.col("_all")) & (F.size("_all") == 11)
    status = F.when(illegal, "illegal").when(~eleven, "duplicate").otherwise("ok")
    return rows.withColumn("status", status).drop("_all")
