"""Player statistics, match reports and latency reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehouse.functions.exprs import percent_text, ratio
from tablehouse.functions.rules import RAISE_CLASSES
from tablehouse.operators.joins import semi
from tablehouse.operators.keyed import first_n, top_counts
from tablehouse.operators.percentile import exact_percentiles

STREETS = ["preflop", "flop", "turn", "river"]


def player_bet_stats(hands: DataFrame, actions: DataFrame, hand_keys: list[str], n: int = 128,
                     min_hands: int = 2, padding: float = -1.0) -> DataFrame:
    """Fourteen features over a player's last n hands.

    hands: player, hand keys, `ord` (greater is later), `small_blind`, `payoff`.
    actions: player, hand keys, `stage`, `act` (below 0 forced, 0 fold), `num`.
    Bets and payoffs count in small blinds.  Players with fewer than min_hands hands get
    the padding value.  Each map task keeps n hands per player before the shuffle.
    """
    keys = ["playerid", *hand_keys]
    recent = first_n(hands.select(*keys, "ord", "small_blind", "payoff"), ["playerid"],
                     [F.desc("ord"), *hand_keys], n)
    act, stage = F.col("act"), F.col("stage")
    # actions of other hands go before they are summed up
    per_hand = semi(actions.where(act >= 0), recent, keys).groupBy(*keys).agg(
        *[F.sum(F.when((stage == s) & (act > 0), F.col("num"))).alias(f"{s}_bet") for s in STREETS],
        *[F.sum(F.when((stage == s) & (act == 0), 1)).alias(f"{s}_fold") for s in STREETS])
    blind = F.col("small_blind")
    rows = recent.join(per_hand, keys, "left").select(
        "playerid", (F.col("payoff") / blind).alias("payoff"),
        *[(F.coalesce(f"{s}_bet", F.lit(0)) / blind).alias(f"{s}_bet") for s in STREETS],
        *[F.coalesce(f"{s}_fold", F.lit(0)).alias(f"{s}_fold") for s in STREETS])
    stats = []
    for c in [*[f"{s}_bet" for s in STREETS], "payoff"]:
        stats += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std")]
    stats += [ratio(F.sum(f"{s}_fold"), F.count(F.lit(1))).alias(f"{s}_fold_rate") for s in STREETS]
    out = rows.groupBy("playerid").agg(F.count(F.lit(1)).alias("hands"), *stats)
    names = [c for c in out.columns if c not in ("playerid", "hands")]
    enough = F.col("hands") >= min_hands
    return out.select("playerid", "hands", *[
        F.round(F.when(enough, F.col(c)).otherwise(F.lit(padding)), 8).alias(c) for c in names])


def match_report(results: DataFrame, actions: DataFrame) -> DataFrame:
    """Per pairing: win %, total and mbb per hand, and the share of each action class.

    results: `agent0`, `agent1`, `payoff` per hand.  actions: `agent0`, `agent1`, `bucket`.
    """
    pair = ["agent0", "agent1"]
    total = F.sum("payoff").cast("double") / 2
    hands = F.count(F.lit(1))
    scores = results.groupBy(*pair).agg(
        hands.alias("hands"),
        (ratio(F.count_if(F.col("payoff") > 0), hands) * 100).alias("winrate"),
        total.alias("total_payoffs"), (ratio(total, hands) * 1000).alias("mbb_h"))
    counts = actions.where("bucket >= 0").groupBy(*pair).agg(
        *[F.count_if(F.col("bucket") == i).alias(f"n_{c}") for i, c in enumerate(RAISE_CLASSES)],
        F.count(F.lit(1)).alias("n_actions"))
    rows = scores.join(counts, pair, "left")
    mix = [F.coalesce(ratio(f"n_{c}", "n_actions"), F.lit(0.0)) for c in RAISE_CLASSES]
    return rows.select(
        *pair, "hands", F.round("winrate", 4).alias("winrate"), "total_payoffs",
        F.round("mbb_h", 4).alias("mbb_h"),
        *[percent_text(m).alias(c) for m, c in zip(mix, RAISE_CLASSES)],
        *[F.round(m, 6).alias(f"{c}_ratio") for m, c in zip(mix, RAISE_CLASSES)],
        *[F.round(F.coalesce(ratio(f"n_{c}", "hands"), F.lit(0.0)), 6).alias(f"{c}_per_game") for c in RAISE_CLASSES],
    )


def ranked(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc("mbb_h"), "agent0", "agent1")


def street_mix(actions: DataFrame) -> DataFrame:
    """Share of each action class by street, of all actions of the pairing."""
    pair = ["agent0", "agent1"]
    counts = actions.where("bucket >= 0").groupBy(*pair, "stage").pivot("bucket", list(range(8))).count()
    counts = counts.na.fill(0).withColumnsRenamed({str(i): c for i, c in enumerate(RAISE_CLASSES)})
    total = counts.groupBy(*pair).agg(F.sum(sum((F.col(c) for c in RAISE_CLASSES), F.lit(0))).alias("total"))
    return counts.join(total, pair).select(
        *pair, "stage", *[percent_text(ratio(c, "total")).alias(c) for c in RAISE_CLASSES])


def baseline_gate(report: DataFrame, baselines: list[str], threshold: float) -> DataFrame:
    """Report rows of the models that reach the threshold, unrounded, against every baseline."""
    against = report.where(F.col("agent1").isin(*baselines))
    passed = against.groupBy("agent0").agg(
        F.bool_and(ratio("total_payoffs", "hands") * 1000 >= threshold).alias("ok"),
        F.count_distinct("agent1").alias("seen"),
    ).where(F.col("ok") & (F.col("seen") == len(baselines)))
    return semi(against, passed, ["agent0"])


def latency_report(requests: DataFrame) -> DataFrame:
    """Totals, rate and latency percentiles as (metric, value) rows."""
    span = (F.max(F.col("ts_ms") + F.col("latency_s") * 1000) - F.min("ts_ms")) / 1000.0
    totals = requests.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("ok"), span.alias("elapsed_s"))
    metrics = totals.select(F.explode(F.create_map(
        F.lit("total"), F.col("total").cast("double"), F.lit("ok"), F.col("ok").cast("double"),
        F.lit("fail"), (F.col("total") - F.col("ok")).cast("double"),
        F.lit("elapsed_s"), F.round("elapsed_s", 3),
        F.lit("rps"), F.round(ratio("total", "elapsed_s"), 6),
    )).alias("metric", "value"))
    marks = exact_percentiles(requests, "latency_s", [0.5, 0.9, 0.99]).select(
        F.concat(F.lit("p"), F.round(F.col("p") * 100).cast("int").cast("string")).alias("metric"),
        F.round("value", 6).alias("value"))
    return metrics.unionByName(marks)


def top_errors(requests: DataFrame, k: int = 10) -> DataFrame:
    return top_counts(requests.where("not ok and err is not null"), "err", k)


def status_counts(requests: DataFrame) -> DataFrame:
    return requests.where("status is not null").groupBy("status").agg(F.count(F.lit(1)).alias("n"))
