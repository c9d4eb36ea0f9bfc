"""Hot keys: same results as brute force when a key is cut up."""

from itertools import combinations

from pyspark.sql import functions as F

from tablehouse.operators import scans
from tablehouse.operators.joins import pairs
from tablehouse.operators.percentile import exact_percentiles


def hot(spark, n=300):
    """A third of all rows on key 0."""
    rows = [(0 if i % 3 == 0 else 1 + i % 7, i * 3 % 911, None if i % 4 else float(i), f"v{i * i % 11}") for i in range(n)]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    return rows, spark.createDataFrame(rows, "k int, o int, x double, v string")


def brute(rows, back):
    out = {}
    for k in {r[0] for r in rows}:
        seq = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        for i, r in enumerate(seq):
            before = [s[2] for s in seq[:i + 1] if s[2] is not None]
            after = [s[2] for s in seq[i:] if s[2] is not None]
            later = (after[0] if back == "first" else after[-1]) if after and back else None
            out[k, r[1]] = before[-1] if before else later
    return out


def test_fill(spark):
    rows, df = hot(spark)
    df = df.withColumns({"near": F.col("x"), "far": F.col("x")})
    want = {c: brute(rows, back) for c, back in (("x", None), ("near", "first"), ("far", "last"))}
    for size in (10, 1_000):
        got = scans.fill(df, ["k"], "o", {"x": None, "near": "first", "far": "last"}, size).collect()
        for c in want:
            assert {(r.k, r.o): r[c] for r in got} == want[c], (c, size)


def test_fill_leading_gap(spark):
    df = spark.createDataFrame([(1, 0, None), (1, 1, "x"), (1, 2, None), (1, 3, "y")], "k int, o int, c string")
    for size in (1, 100):  # 1: every row is a cut
        get = lambda back: [r.c for r in scans.fill(df, ["k"], "o", {"c": back}, size).orderBy("o").collect()]  # noqa: B023, E731
        assert get("last") == ["y", "x", "x", "y"]
        assert get("first") == ["x", "x", "x", "y"]


def test_renumber(spark):
    rows, df = hot(spark)
    want = {}
    for k in {r[0] for r in rows}:
        for i, r in enumerate(sorted((r for r in rows if r[0] == k), key=lambda r: r[1])):
            want[k, r[1]] = i + 1
    for size in (10, 1_000):
        got = {(r.k, r.o): r.rn for r in scans.renumber(df, ["k"], "o", [F.col("v")], rows=size).collect()}
        assert got == want


def test_running_distinct(spark):
    rows, df = hot(spark)
    want = {(r[0], r[1]): len({s[3] for s in rows if s[0] == r[0] and s[1] <= r[1]}) for r in rows}
    for size in (10, 1_000):
        got = {(r.k, r.o): r.n_distinct for r in scans.running_distinct(df, ["k"], "o", "v", rows=size).collect()}
        assert got == want


def test_null_keys_and_positions(spark):
    df = spark.createDataFrame([(None, 1, None), (None, 2, 3.0), (1, None, 4.0), (1, 5, None)], "k int, o int, x double")
    got = sorted(scans.fill(df, ["k"], "o", {"x": "first"}, 1).collect(), key=str)
    assert got == sorted([(None, 1, 3.0), (None, 2, 3.0), (1, None, 4.0), (1, 5, 4.0)], key=str)
    assert scans.renumber(df.filter("false"), ["k"], "o", []).count() == 0


def test_pieces_are_even_despite_an_outlier(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.when(F.col("id") == 0, F.lit(10**12)).otherwise(F.col("id")).alias("o"))
    pieces = scans.cut(df, scans.find_cuts(df, ["k"], "o", 500), ["k"], "o")
    sizes = [r["count"] for r in pieces.groupBy("_c").count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 5_000 and sum(sizes) == 20_000
    order = pieces.groupBy("_c").agg(F.min("o").alias("a"), F.max("o").alias("b")).orderBy("_c").collect()
    assert all(x.b < y.a for x, y in zip(order, order[1:]))


def test_cuts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(scans, "MOST_CUTS", 16)
    rows, df = hot(spark)
    cuts = scans.find_cuts(df, ["k"], "o", 1)
    assert sum(len(r._cuts) for r in cuts.collect()) == 16
    assert {(r.k, r.o): r.x for r in scans.fill(df, ["k"], "o", {"x": None}, 1).collect()} == brute(rows, None)


def test_no_job_while_building(spark):
    """A scan is a plan of one shape: nothing runs before its rows are asked for."""
    _, df = hot(spark)
    spark.sparkContext.setJobGroup("building", "building")
    scans.fill(df, ["k"], "o", {"x": "last"}, 10)
    scans.running_distinct(df, ["k"], "o", "v", rows=10)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_pairs_of_a_hot_key(spark):
    rows = [(0, i) for i in range(100)] + [(1, 5), (1, 7), (1, 9), (2, 1)]
    df = spark.createDataFrame(rows, "k int, id int").withColumn("w", F.col("id") * 2)
    want = {(k, a, b) for k in (0, 1, 2) for a, b in combinations(sorted(i for j, i in rows if j == k), 2)}
    for block in (8, 1000):
        frame = pairs(df, ["k"], "id", ["w"], block=block)
        got = frame.collect()
        assert len(got) == len(want) and {(r.k, r.id_1, r.id_2) for r in got} == want
        assert all(r.w_1 == 2 * r.id_1 and r.w_2 == 2 * r.id_2 for r in got)
        parts = [r["count"] for r in frame.groupBy("k", "_i", "_j").count().collect()]
        assert block == 1000 or (max(parts) < 400 and len(parts) > 50)


def test_collusion_pairs_of_a_hot_hand(spark):
    """One hand holds most rows; every pair is found."""
    from tablehouse.plans import risk

    seats = [("d", "t", 0, i, i - 100) for i in range(200)] + [("d", "t", n, i, 5) for n in range(1, 20) for i in range(3)]
    result = spark.createDataFrame(seats, "dt string, sztoken string, nround int, nplayerid int, gameresult int")
    got = {(r.player1_id, r.player2_id): r.total_games for r in risk.pair_stats(result).select(
        "player1_id", "player2_id", "total_games").collect()}
    assert len(got) == 200 * 199 // 2
    assert {p: n for p, n in got.items() if n > 1} == {(0, 1): 20, (0, 2): 20, (1, 2): 20}


def test_percentiles(spark, monkeypatch):
    """Ties, all values inside one thousandth, huge and negative ones; rounds until an interval is small."""
    import numpy as np

    from tablehouse.operators import percentile

    rng = np.random.default_rng(7)
    cases = [
        [0.25 * (i * i % 37) for i in range(501)] + [9.5] * 250,
        list(5 + rng.random(3000) / 1000),
        [1e300, -1e300, 0.0, -0.0, 1e-300] + list(rng.standard_normal(500)),
        [7.0] * 900 + [8.0],
        [3.5],
    ]
    ps = [0.0, 0.5, 0.9, 0.99, 1.0]
    for values in cases:
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double").repartition(5)
        for small in (8, 4096):
            monkeypatch.setattr(percentile, "SMALL", small)
            got = {r.p: r.value for r in exact_percentiles(df, "x", ps).collect()}
            for p in ps:
                assert abs(got[p] - np.percentile(values, p * 100)) <= 1e-9 * max(1, abs(got[p])), (p, small)
    assert exact_percentiles(spark.createDataFrame([(None,)], "x double"), "x", ps).count() == 0


def test_percentiles_never_gather_all_values(spark):
    """Every exchange of the selection is by a group, none puts the values into one partition."""
    from tablehouse.operators import percentile

    values = spark.range(5000).select(F.rand(3).alias("v"))
    whole = [percentile.Interval(-1.0, 1.0, 0, 5000)]
    plan = percentile._salted(percentile._within(values, whole), ["i"], F.kll_sketch_agg_double("v").alias("s"))
    assert "SinglePartition" not in plan._jdf.queryExecution().executedPlan().toString()
    assert max(x.n for x in percentile._split(values, whole)) < 500
