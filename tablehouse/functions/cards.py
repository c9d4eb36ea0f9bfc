"""Card codes and hand strength as column expressions.

Rank-major code: 0..51 = (rank - 2) * 4 + suit, ranks 2..14 (ace 14), suits S H D C.
Suit-major code: 0..51 = suit * 13 + (ace 0, two 1, ... king 12), suits S H D C.
Hex code: suit nibble 1..4 (d c h s), rank nibble 1..13 (ace 1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: characters of a card
RANKS = "23456789TJQKA"
SUITS = "SHDC"
HEX_RANKS = "A23456789TJQK"
HEX_SUITS = "dchs"

# fixed values: (full house, flush, what an ace is below the lowest card)
DECKS = {"holdem": (7, 6, 1), "short": (6, 7, 5)}

HEX_IDS = {f"{r}{s}": 16 * (i + 1) + j + 1 for i, s in enumerate(HEX_SUITS) for j, r in enumerate(HEX_RANKS)}


def rank_of(card: Column) -> Column:
    return F.shiftright(card.cast("int"), 2) + 2


def suit_of(card: Column) -> Column:
    return card.cast("int").bitwiseAND(F.lit(3))


def from_text(card: Column) -> Column:
    """Rank-major code of 'SA' style text, null if it is no card."""
    r, s = F.instr(F.lit(RANKS), F.substring(card, 2, 1)), F.instr(F.lit(SUITS), F.substring(card, 1, 1))
    legal = (F.length(card) == 2) & (r > 0) & (s > 0)
    return F.when(legal, (r - 1) * 4 + s - 1)


def to_text(card: Column) -> Column:
    return F.concat(F.substring(F.lit(SUITS), suit_of(card) + 1, F.lit(1)),
                    F.substring(F.lit(RANKS), rank_of(card) - 1, F.lit(1)))


def suit_major(card: Column) -> Column:
    """Rank-major to suit-major code."""
    return suit_of(card) * 13 + (rank_of(card) - 1) % 13


def from_suit_major(code: Column) -> Column:
    rank = F.when(code % 13 == 0, 14).otherwise(code % 13 + 1)
    return ((rank - 2) * 4 + F.floor(code / 13)).cast("int")


def hex_parts(code: Column) -> tuple[Column, Column]:
    """(suit nibble, rank nibble)"""
    return F.shiftright(code, 4).bitwiseAND(15), code.bitwiseAND(15)


def hex_id(text: Column) -> Column:
    """Hex code of 'Ad' style text, null if it is no card."""
    table = F.create_map(*[F.lit(x) for kv in HEX_IDS.items() for x in kv])
    return F.try_element_at(table, text)


def pack(cards: Column, rate: Column, n: int) -> Column:
    """64-bit word: six bits per card from the top, rate in millionths in the low 22 bits."""
    word = F.round(rate * 1_000_000).cast("bigint")
    for i in range(n):
        word = word.bitwiseOR(F.shiftleft(F.element_at(cards, i + 1).cast("bigint"), 58 - 6 * i))
    return word


def unpack(word: Column, n: int) -> tuple[Column, Column]:
    """(cards, rate) of a packed word."""
    cards = F.array(*[
        F.shiftrightunsigned(word, 58 - 6 * i).bitwiseAND(F.lit(0x3F)).cast("int") for i in range(n)])
    return cards, word.bitwiseAND(F.lit(0x3FFFFF)) / F.lit(1_000_000.0)


def preflop_key(c1: Column, c2: Column) -> Column:
    """Class of two rank-major cards: high rank, low rank, s or o."""
    r1, r2 = rank_of(c1), rank_of(c2)

    def ch(r: Column) -> Column:
        return F.substring(F.lit(RANKS), r - 1, F.lit(1))

    return F.concat(ch(F.greatest(r1, r2)), ch(F.least(r1, r2)),
                    F.when(suit_of(c1) == suit_of(c2), "s").otherwise("o"))


# A set of ranks is a number with bit r for rank r (2..14, an ace also below the lowest card).


def _clear(ranks: Column, n: int) -> Column:
    """The set without its lowest rank if it has more than n."""
    return F.when(F.bit_count(ranks) > n, ranks.bitwiseAND(ranks - 1)).otherwise(ranks)


def _best(df: DataFrame, want: dict[str, int]) -> DataFrame:
    """Cut each set column down to its n highest ranks; sets have at most n + 2."""
    for _ in range(2):
        df = df.withColumns({c: _clear(F.col(c), n) for c, n in want.items()})
    return df


def _straights(ranks: str, low_ace: int) -> Column:
    """The top ranks of all straights in a set."""
    every = F.col(ranks).bitwiseOR(F.shiftleft(F.shiftright(ranks, 14), low_ace))
    run = every
    for i in range(1, 5):
        run = run.bitwiseAND(F.shiftleft(every, i))
    return run


def with_strength(df: DataFrame, cards: str = "cards", deck: str = "holdem") -> DataFrame:
    """Adds `category` (1 high card .. 9 straight flush) and `strength`, a number that
    orders hands of seven cards.

    strength = category, the ranks that make the category, and the kickers, as three fields
    of 15 bits; two rank sets of one size compare like their ranks from the highest down.
    Everything is integer arithmetic within the row, in steps small enough to be compiled.
    Both are null unless the row has exactly seven distinct cards of codes 0 to 51.
    """
    full_house, flush, low_ace = DECKS[deck]
    base = df.columns
    col = F.col

    def bit(card: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1), F.shiftright(card, 2) + 2)

    def both(a: str, b: str) -> Column:
        return col(a).bitwiseAND(col(b))

    steps = df.select(*base, *[F.coalesce(F.get(F.col(cards), F.lit(i)).cast("int"), F.lit(0)).alias(f"_c{i}") for i in range(7)])
    steps = steps.select(
        "*", *[bit(col(f"_c{i}")).alias(f"_b{i}") for i in range(7)],
        # cards per suit, a byte each
        sum((F.call_function("shiftleft", F.lit(1), suit_of(col(f"_c{i}")) * 8) for i in range(1, 7)),
            F.call_function("shiftleft", F.lit(1), suit_of(col("_c0")) * 8)).alias("_suits"))
    by_suit = [(F.shiftright(col("_suits"), 8 * s).bitwiseAND(F.lit(7)) >= 5, s) for s in range(4)]
    steps = steps.withColumn("_of", F.coalesce(*[F.when(p, s) for p, s in by_suit], F.lit(-1)))
    own = [F.when(suit_of(col(f"_c{i}")) == col("_of"), col(f"_b{i}")).otherwise(F.lit(0)) for i in range(7)]
    steps = steps.withColumn("_f", sum(own[1:], own[0]))
    # ranks seen at least once (_1), twice (_2), three times (_3), four times (_4)
    steps = steps.select("*", col("_b0").alias("_1"), *[F.lit(0).alias(f"_{k}") for k in (2, 3, 4)])
    for i in range(1, 7):
        b = f"_b{i}"
        steps = steps.withColumns({
            "_1": col("_1").bitwiseOR(col(b)),
            **{f"_{k}": col(f"_{k}").bitwiseOR(both(f"_{k - 1}", b)) for k in (2, 3, 4)}})
    steps = steps.select(*base, "_1", "_2", "_3", "_4", "_f")
    steps = steps.select(
        "*", _straights("_1", low_ace).alias("_run"), _straights("_f", low_ace).alias("_srun"),
        col("_3").alias("_trips"), col("_2").alias("_pairs"), col("_f").alias("_kf"))
    steps = _best(steps, {"_run": 1, "_srun": 1, "_trips": 1, "_kf": 5})
    steps = steps.select("*", col("_2").bitwiseAND(F.bitwise_not(col("_trips"))).alias("_below"))
    steps = _best(steps, {"_pairs": 2, "_below": 1})
    present = lambda c: col(c) != 0
    kinds = [  # condition, category, ranks that make it, how many kickers
        (present("_srun"), 9, "_srun", 0),
        (present("_4"), 8, "_4", 1),
        (present("_trips") & present("_below"), full_house, "_trips", 1),
        (present("_f"), flush, None, 5),
        (present("_run"), 5, "_run", 0),
        (present("_trips"), 4, "_trips", 2),
        (F.bit_count("_pairs") == 2, 3, "_pairs", 1),
        (present("_pairs"), 2, "_pairs", 3),
    ]
    category = F.coalesce(*[F.when(k[0], k[1]) for k in kinds], F.lit(1))
    steps = steps.withColumn("category", category)

    def per_category(value, default) -> Column:
        return F.coalesce(*[F.when(col("category") == k[1], value(k)) for k in kinds], default)

    steps = steps.withColumns({
        "_made": per_category(lambda k: col(k[2]) if k[2] else F.lit(0), F.lit(0)),
        "_few": per_category(lambda k: F.lit(k[3]), F.lit(5))})
    left = col("_1").bitwiseAND(F.bitwise_not(col("_made")))
    steps = steps.withColumn("_kick", F.when(col("category") == full_house, col("_below")).when(
        col("category") == flush, col("_kf")).when(col("_few") == 0, 0).otherwise(left))
    for _ in range(2):
        steps = steps.withColumn("_kick", F.when(
            F.bit_count("_kick") > col("_few"), col("_kick").bitwiseAND(col("_kick") - 1)).otherwise(col("_kick")))
    strength = (
        F.shiftleft(col("category").cast("bigint"), 30)
        + F.shiftleft(col("_made").cast("bigint"), 15) + col("_kick"))
    own = [F.get(F.col(cards), F.lit(i)) for i in range(7)]
    legal = (F.size(cards) == 7) & (F.size(F.array_distinct(cards)) == 7)
    for card in own:
        legal = legal & F.coalesce(card.between(0, 51), F.lit(False))
    return steps.withColumn("_legal", F.coalesce(legal, F.lit(False))).select(
        *base, F.when(F.col("_legal"), strength).alias("strength"), F.when(F.col("_legal"), F.col("category")).alias("category"))
