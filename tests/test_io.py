"""Readers, writers, metadata and the ingest."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tablehouse.functions.exprs import in_list, local_day, pick_col, ratio
from tablehouse.operators import joins
from tablehouse.operators.keyed import first_n, latest, top1, top_counts, union_distinct
from tablehouse.plans import catalog
from tablehouse.session import scratch
from tablehouse.sources import io
from tablehouse.streaming import ingest


def days(spark, *rows):
    return spark.createDataFrame(rows, "dt string, k int, v int")


def test_overwrite_only_its_days(spark):
    path = scratch(spark, "t")
    io.overwrite_days(days(spark, ("2024-01-01", 1, 1), ("2024-01-02", 1, 1)), path)
    io.overwrite_days(days(spark, ("2024-01-02", 1, 9)), path)
    io.replace_day(days(spark, ("2024-01-03", 1, None)), path, "2024-01-03", {"v": 0})
    rows = {r.dt: r.v for r in io.read_table(spark, path).collect()}
    assert rows == {"2024-01-01": 1, "2024-01-02": 9, "2024-01-03": 0}
    assert io.read_path(spark, path, "dt=2024-01-02").count() == 1
    plan = io.read_path(spark, path, "dt=2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert [r.dt for r in io.day_range(io.read_table(spark, path), "2024-01-01", "2024-01-02", True).collect()] == ["2024-01-02"]
    today, before = io.snapshots(io.read_table(spark, path), "2024-01-02")
    assert (today.count(), before.count()) == (1, 1)


def test_sync_modes(spark):
    a, b = scratch(spark, "a"), scratch(spark, "b")
    df = days(spark, ("2024-01-01", 1, 1), ("2024-01-02", 1, 2))
    io.sync_table(df, a)
    io.sync_table(df.withColumn("v", F.lit(7)), a, use_latest=True)
    assert {r.dt: r.v for r in io.read_table(spark, a).collect()} == {"2024-01-01": 1, "2024-01-02": 7}
    io.sync_table(df, a, spec="dt=2024-01-01", mode="append")
    assert io.read_table(spark, a).count() == 3
    io.sync_table(df.limit(1), a)
    assert io.read_table(spark, a).count() == 1
    io.sync_table(df.drop("dt"), b)
    assert spark.read.parquet(b).count() == 2


def test_merge(spark):
    cur, new = days(spark, ("d", 1, 1), ("d", 2, 2)), days(spark, ("d", 2, 9), ("d", 3, 3))
    assert {r.k: r.v for r in io.merge(cur, new, ["dt", "k"]).collect()} == {1: 1, 2: 9, 3: 3}


@pytest.mark.parametrize("bad", ["dt", "dt=", "d t=1", "dt=a b", "dt=1;drop"])
def test_bad_specs(bad):
    with pytest.raises(ValueError):
        io.partition_spec(bad)


def test_names_are_checked(spark):
    assert io.partition_spec("dt=2024-01-30, region=sg") == {"dt": "2024-01-30", "region": "sg"}
    with pytest.raises(ValueError):
        io.ddl("t", {"a b": "int"})
    with pytest.raises(ValueError):
        io.increment(days(spark), "yesterday")


def test_catalog_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS th_test")
    where = scratch(spark, "tbl")
    try:
        io.create_table(spark, "th_test.t", {"k": "int", "v": "int"}, location=where)
        for row in (("2024-01-03", 1, 1), ("2024-01-05", 2, 2)):
            io.insert_by_name(days(spark, row).select("v", "k", "dt"), "th_test.t")
        assert [(r.dt, r.k) for r in spark.table("th_test.t").orderBy("dt").collect()] == [("2024-01-03", 1), ("2024-01-05", 2)]
        assert catalog.latest_dt(spark, "th_test.t") == "2024-01-05"
        row = catalog.table_profile(spark, "th_test", "2024-01-06").first()
        assert (row.table_name, row.min_dt, row.max_dt, row.dt) == ("t", "2024-01-03", "2024-01-05", "2024-01-06")
        assert where in row.table_location
        io.drop_partition(spark, "th_test.t", "dt=2024-01-05")
        assert catalog.latest_dt(spark, "th_test.t") == "2024-01-03"
        io.overwrite_days(days(spark, ("2024-01-09", 3, 3)), where)
        assert catalog.repair(spark, "th_test") == ["t"]
        assert catalog.latest_dt(spark, "th_test.t") == "2024-01-09"
    finally:
        spark.sql("DROP DATABASE th_test CASCADE")


def test_sizes(spark):
    path = scratch(spark, "sz")
    io.overwrite_days(days(spark, ("2024-01-01", 1, 1), ("2024-01-02", 1, 1)), path)
    rows = catalog.partition_sizes(spark, {"t": path}).orderBy("partition_spec").collect()
    assert [r.partition_spec for r in rows] == ["dt=2024-01-01", "dt=2024-01-02"]
    on_disk = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))
    assert sum(r.bytes for r in rows) == on_disk
    assert catalog.partition_sizes(spark, {"t": path}, 1).count() == 1
    assert catalog.table_sizes(catalog.partition_sizes(spark, {"t": path})).first().partition_count == 2


def test_conform(spark):
    df = spark.createDataFrame([("1", "x", 5), ("zz", "y", None)], "NPLAYERID string, name string, extra int")
    schema = {"playerid": ("int", ["nplayerid"]), "name": ("string", []), "dt": ("date", [])}
    assert [tuple(r) for r in catalog.conform(df, schema).collect()] == [(1, "x", None), (None, "y", None)]
    report = {r["column"]: (r.state, r.nulls, r.uncastable) for r in catalog.conform_report(df, schema).collect()}
    assert report == {"playerid": ("renamed", 0, 1), "name": ("ok", 0, 0), "dt": ("missing", 2, 0), "extra": ("extra", 1, 0)}
    with pytest.raises(ValueError):
        pick_col(df, "nope")


def test_csv_and_jsonl(spark, tmp_path):
    for n in ("a", "b"):
        (tmp_path / f"{n}.csv").write_text("x,y,z\n1,2,3\n")
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    assert [tuple(r) for r in io.read_csv(spark, paths, ["x", "z"], ["x", "y", "z"]).collect()] == [("1", "3")] * 2
    assert io.read_csv(spark, paths, ["y"]).count() == 2
    out = scratch(spark, "jl")
    for _ in range(2):
        io.append_jsonl(days(spark, ("d", 1, 1)), out)
    assert spark.read.json(out).count() == 2


def test_small_operators(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (2, "a", 1), (2, None, 9)], "k int, s string, n int")
    assert {r.k: r.s for r in top1(df, ["k"], [-F.col("n"), F.col("s")], ["s"]).collect()} == {1: "a", 2: None}
    assert {r.k: r.s for r in latest(df, ["k"], "n", ["s"]).collect()} == {1: "b", 2: None}
    assert [tuple(r) for r in top_counts(df.where("s is not null"), "s", 1).collect()] == [("a", 2)]
    assert first_n(df, ["k"], [F.desc("n"), F.col("s")], 1).count() == 2
    assert union_distinct(df.select("k"), df.select("k")).count() == 2
    a, b = df.where("k = 1"), df.where("n = 5 or n = 9")
    assert joins.both(a, b, ["k"]).count() == 1
    assert joins.anti(df, a, ["k"]).count() == 2 and joins.semi(df, a, ["k"]).count() == 2
    assert joins.full([a.select("k"), df.select("k", "n").where("k = 2")], ["k"]).count() == 4
    assert df.where(in_list("s", ["a"])).count() == 2 and df.where(in_list("s", ["a"], True)).count() == 1
    assert df.select(ratio("n", F.lit(0)).alias("r")).first().r is None


def lines(path, *rows):
    path.mkdir(exist_ok=True)
    n = len(list(path.iterdir()))
    (path / f"{n}.json").write_text("\n".join(
        json.dumps({"event_id": i, "ts_ms": ts, "message": m}) for i, ts, m in rows))


def test_ingest(spark, tmp_path):
    key, hour = ingest.KEYWORD, 3_600_000
    start = 1_704_060_000_000  # 2023-12-31 22:00 UTC: the next day in UTC+8
    src, out, bad, state = (tmp_path / n for n in ("src", "out", "bad", "state"))
    run = lambda: ingest.ingest(spark, str(src), str(out), str(bad), str(state), files_per_batch=1).awaitTermination()
    lines(src, ("a", start, f"x {key}{{\"n\":1}} "), ("a", start, f"x {key}{{\"n\":1}}"), ("b", start, "no keyword"),
          ("c", start + 1, f"{key}broken"))
    run()
    lines(src, ("d", start + 30 * hour, f"{key}{{\"n\":2}}"))
    run()
    lines(src, ("e", start, f"{key}{{\"n\":3}}"), ("d", start + 30 * hour, f"{key}{{\"n\":2}}"))  # late; repeated
    run()
    rows = spark.read.parquet(str(out)).select("tstr", F.col("dt").cast("string")).collect()
    assert sorted(map(tuple, rows)) == [('{"n":1}', "2024-01-01"), ('{"n":2}', "2024-01-02")]
    assert [r.tstr for r in spark.read.parquet(str(bad)).collect()] == ["broken"]


def test_local_day(spark):
    df = spark.createDataFrame([(1_704_067_200_000,), (1_704_038_399_000,), (None,)], "ms bigint")
    got = [r.d for r in df.select(local_day(F.col("ms")).alias("d")).collect()]
    assert got[:2] == ["2024-01-01", "2023-12-31"] and got[2] > "2024"


def test_ingested_files_are_in_time_order(spark, tmp_path):
    import json

    lines = [{"event_id": str(i), "ts_ms": 3_600_000 * (1000 + i * 7919 % 40), "message": ingest.KEYWORD + json.dumps({"t": i * 7919 % 40})} for i in range(40)]
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.json").write_text("\n".join(map(json.dumps, lines)))
    ingest.ingest(spark, str(src), str(tmp_path / "t"), str(tmp_path / "bad"), str(tmp_path / "c"), delay="3 days").awaitTermination()
    import pyarrow.parquet as pq

    files = list((tmp_path / "t").rglob("*.parquet"))
    for f in files:
        hours = [json.loads(x)["t"] for x in pq.ParquetFile(f).read(columns=["tstr"]).column("tstr").to_pylist()]
        assert hours == sorted(hours)
    assert sum(pq.ParquetFile(f).metadata.num_rows for f in files) == 40
