"""Showdowns and card codes."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablehouse.functions import cards as C
from tablehouse.plans import cards
from tablehouse.sources import io

# fixed values: hand 1, hand 2, board, result under short-deck order
SPECIAL = [
    ("HA CJ", "CQ HQ", "C6 H7 D8 S9 DQ", 1),
    ("CQ HQ", "HA CJ", "C6 H7 D8 S9 DQ", -1),
    ("HA CJ", "D9 C9", "C6 H7 D8 S9 H9", -1),
    ("D9 C9", "HA CJ", "C6 H7 D8 S9 H9", 1),
    ("HA CJ", "D9 C9", "H6 H7 H8 H9 S9", 1),
    ("D9 C9", "HA CJ", "H6 H7 H8 H9 S9", -1),
    ("HJ HQ", "HA DT", "H6 H7 H8 H9 HT", 1),
    ("SA HQ", "HA CJ", "H6 S7 D8 H9 S9", 0),
    ("HJ HQ", "C6 D7", "H6 H7 H8 S6 DJ", 1),
    ("C6 D7", "HJ HQ", "H6 H7 H8 S6 DJ", -1),
]


def code(card):
    return C.RANKS.index(card[1]) * 4 + C.SUITS.index(card[0])


def codes(text):
    return [code(c) for c in text.split()]


def test_special_cases(spark):
    rows = [(i, codes(f"{a} {b}"), codes(f"{x} {b}")) for i, (a, x, b, _) in enumerate(SPECIAL)]
    df = spark.createDataFrame(rows, "i int, cards1 array<int>, cards2 array<int>")
    got = {r.i: r.result for r in cards.duel(df, ["i"], "short").collect()}
    assert got == {i: c[3] for i, c in enumerate(SPECIAL)}


def best_of_five(seven, deck):
    """Brute force: the best key of all 21 five-card hands."""
    house, flush, ace = C.DECKS[deck]

    def key(five):
        ranks = sorted((c // 4 + 2 for c in five), reverse=True)
        groups = sorted(((ranks.count(r), r) for r in set(ranks)), reverse=True)
        shape, order = [g[0] for g in groups], [g[1] for g in groups]
        suited = len({c % 4 for c in five}) == 1
        low = sorted(ace if r == 14 else r for r in ranks)
        high = 0
        if len(set(ranks)) == 5 and ranks[0] - ranks[4] == 4:
            high = ranks[0]
        elif len(set(low)) == 5 and low[4] - low[0] == 4:
            high = low[4]
        if high and suited:
            return [9, high]
        if shape[0] == 4:
            return [8, *order]
        if shape == [3, 2]:
            return [house, *order]
        if suited:
            return [flush, *ranks]
        if high:
            return [5, high]
        return [{3: 4, 2: 3 if shape[:2] == [2, 2] else 2, 1: 1}[shape[0]], *order]

    return max(key(f) for f in combinations(seven, 5))


@pytest.mark.parametrize("deck,low", [("holdem", 0), ("short", 16)])
def test_strength_against_brute_force(spark, deck, low):
    rng = np.random.default_rng(7)
    hands = [(i, [int(x) for x in rng.choice(np.arange(low, 52), 7, replace=False)]) for i in range(1500)]
    df = spark.createDataFrame(hands, "i int, cards array<int>")
    got = {r.i: r.strength for r in C.with_strength(df, "cards", deck).collect()}

    house, flush, _ = C.DECKS[deck]
    makes = {9: 1, 8: 1, house: 1, flush: 0, 5: 1, 4: 1, 3: 2, 2: 1, 1: 0}

    def number(key):
        bits = lambda ranks: sum(1 << r for r in ranks)
        cat, ranks = key[0], key[1:]
        return (cat << 30) + (bits(ranks[:makes[cat]]) << 15) + bits(ranks[makes[cat]:])

    assert got == {i: number(best_of_five(h, deck)) for i, h in hands}


def test_wheels(spark):
    df = spark.createDataFrame([(codes("SA H2 D3 C4 S5 H9 DK"),), (codes("SA S2 S3 S4 S5 H6 D9"),)], "cards array<int>")
    assert [(r.category, r.strength >> 15 & 32767) for r in C.with_strength(df).collect()] == [(5, 1 << 5), (9, 1 << 5)]


def test_codes(spark):
    df = spark.range(52).select(F.col("id").cast("int").alias("c"))
    back = df.select("c", C.from_text(C.to_text(F.col("c"))).alias("t"),
                     C.from_suit_major(C.suit_major(F.col("c"))).alias("s"), C.to_text(F.col("c")).alias("n"),
                     C.suit_major(F.col("c")).alias("m")).collect()
    assert all(r.c == r.t == r.s for r in back)
    assert {r.n: r.m for r in back}["SA"] == 0 and {r.n: r.m for r in back}["CK"] == 51
    bad = spark.createDataFrame([("XX",), ("SAA",), ("",)], "c string").select(C.from_text(F.col("c")).alias("v"))
    assert [r.v for r in bad.collect()] == [None] * 3
    hexed = spark.createDataFrame([("Ad",), ("Ks",), ("1d",)], "c string").select(C.hex_id(F.col("c")).alias("v"))
    assert [r.v for r in hexed.collect()] == [0x11, 0x4D, None]
    parts = spark.createDataFrame([(0x4D,)], "c int").select(*C.hex_parts(F.col("c")))
    assert tuple(parts.first()) == (4, 13)


def test_pack_round_trip(spark):
    df = spark.createDataFrame([([51, 2, 40], 0.123456), ([0, 1, 2], 1.0)], "b array<int>, r double")
    cards_, rate = C.unpack(C.pack(F.col("b"), F.col("r"), 3), 3)
    assert [(r.c, round(r.x, 6)) for r in df.select(cards_.alias("c"), rate.alias("x")).collect()] == [
        ([51, 2, 40], 0.123456), ([0, 1, 2], 1.0)]


def test_packed_files(spark, tmp_path):
    words = [(40 << 58 | 44 << 52 | 51 << 46 | 250000), (1 << 58 | 2 << 52 | 3 << 46 | 999999)]
    np.array(words, dtype=">u8").tofile(tmp_path / "2s Ah.bytes")
    rates = io.read_packed(spark, str(tmp_path), 3)
    rows = {tuple(r.cards): (r.hand_key, r.rate) for r in rates.collect()}
    assert rows == {(40, 44, 51): ("2s Ah", 0.25), (1, 2, 3): ("2s Ah", 0.999999)}
    hands = spark.createDataFrame([([49, 0], [51, 40, 44]), ([49, 0], [5, 6, 7])], "hole array<int>, board array<int>")
    assert [r.rate for r in cards.packed_equity(hands, rates, 3).orderBy("rate").collect()] == [0.0, 0.25]


def test_preflop_classes(spark):
    rates = cards.preflop_rates(spark)
    assert rates.count() == 169
    hands = spark.createDataFrame([(code("HA"), code("HK")), (code("S2"), code("DA")), (code("S9"), code("H9"))], "a int, b int")
    out = cards.preflop_equity(hands, F.col("a"), F.col("b"), rates).collect()
    assert {r.hand_class: r.win_rate for r in out} == {"AKs": 0.6621, "A2o": 0.5294, "99o": 0.7166}


def test_audit(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.25), (3, None)], "k int, v double")
    b = spark.createDataFrame([(1, 0.5000001), (2, 0.3), (3, 0.1), (3, 0.1)], "k int, v double")
    rows = cards.audit(a, b, ["k"], "v", 1e-6).collect()
    assert sorted((r.finding, r.k) for r in rows) == [("duplicate", 3), ("mismatch", 2), ("mismatch", 3), ("mismatch", 3)]


def test_catalogue(spark):
    df = spark.createDataFrame(
        [("Ad,Kd", "2c,3c", "4c,5c", "6h,7h,8h,9h,Th"), ("Ad,Ad", "2c,3c", "4c,5c", "6h,7h,8h,9h,Th"),
         ("Xd,Kd", "2c,3c", "4c,5c", "6h,7h,8h,9h,Th"), ("Ad,Kd", "2c,3c", "4c,5c", "6h,7h,8h,9h")],
        "winner string, opponent_1 string, opponent_2 string, community_cards string")
    rows = cards.validate_presets(df).collect()
    assert [r.status for r in rows] == ["ok", "duplicate", "illegal", "duplicate"]
    assert rows[0].my_card == [0x11, 0x1D]


def test_only_seven_distinct_cards_have_a_strength(spark):
    rows = [(list(range(7)),), (list(range(8)),), ([0, 1, 2, 3, 4, 5, None],), ([0, 0, 2, 3, 4, 5, 6],), ([0, 1, 2],), ([0, 1, 2, 3, 4, 5, 52],), (None,), ([],)]
    df = spark.createDataFrame(rows, "cards array<int>")
    got = [(r.strength is not None, r.category is not None) for r in C.with_strength(df).collect()]
    assert got == [(True, True)] + [(False, False)] * 7
