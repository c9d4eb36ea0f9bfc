"""What a job holds or writes at once must not grow with its input."""

from bisect import bisect_left
from pathlib import Path

import pandas as pd

from tablehouse import queries
from tablehouse.fixtures import Fixtures
from tablehouse.operators import scans
from tablehouse.plans import actions, catalog
from tablehouse.session import scratch, tune
from tablehouse.sources import files
from tablehouse.streaming import buffer


def test_stored_tables_are_dealt_without_a_sort(spark, sf_dir, monkeypatch):
    dealt = []
    frames = type(spark.range(1))
    plain = frames.repartition
    monkeypatch.setattr(frames, "repartition", lambda df, *by: dealt.append(by) or plain(df, *by))
    fx = Fixtures(spark, sf_dir)
    monkeypatch.setattr(fx, "prefix", "th_sizes_")
    assert fx.stored("plain", lambda: spark.range(10)).count() == 10
    assert [by[1:] for by in dealt] == [("id",)]  # a hash of the row, not in turn
    n = queries._exploded(fx).count()  # writes the log
    dealt.clear()
    assert queries._dwd(fx).count() == n > 0
    assert not dealt  # the exploded log is written where it is made


def test_pieces_by_groups_of_cuts(spark, monkeypatch):
    monkeypatch.setattr(scans, "GROUP", 3)
    cut_at = {1: [5], 2: [10, 20, 30], 3: list(range(0, 100, 10)), 4: []}
    cuts = spark.createDataFrame([(k, c) for k, c in cut_at.items() if c], "k int, _cuts array<int>")
    rows = spark.createDataFrame([(k, o) for k in cut_at for o in range(-1, 102)], "k int, o int")
    got = {(r.k, r.o): r["_c"] for r in scans.cut(rows, cuts, ["k"], "o").collect()}
    assert got == {(k, o): bisect_left(c, o) for k, c in cut_at.items() for o in range(-1, 102)}
    assert {r.k for r in scans.cut(rows, cuts, ["k"], "o", "inner").collect()} == {1, 2, 3}


def test_no_lists_of_boards_on_action_rows(spark):
    types = "dt string, sztoken string, nround int, _c int, playerid string, seat string, json_index int, action string, board string, blind int, bought double"
    both = "minbetscore int, maxbetscore int, minaddscore int, won int, poolscore int"
    hand = ("d", "t", 1)
    rows = [(*hand, c, "1", "1", 10 * c + i, "x", b, 0, None, None, None, None, None, None)
            for c, boards in enumerate((["a", "b"], ["b", "c"], ["a", "c", "d"])) for i, b in enumerate(boards)]
    carry, old = actions._carry(spark.createDataFrame(rows, f"{types}, {both}"), "last")
    assert not [f.name for f in carry.schema if f.dataType.typeName() in ("array", "map")]
    assert {r["_c"]: (r.boards_before, r.c_board) for r in carry.collect()} == {0: (0, None), 1: (2, "b"), 2: (3, "c")}
    assert sorted((r["_c"], r.commoncard) for r in old.collect()) == [(1, "b"), (2, "a"), (2, "c")]


class State:
    """A state variable that counts its calls."""

    def __init__(self):
        self.kept, self.calls = {}, 0

    def _of(self, key=()):
        self.calls += 1
        return self.kept.get(key)

    def exists(self): return self._of() is not None
    def get(self): return self._of()
    def update(self, value): self.updateValue((), value)
    def containsKey(self, key): return self._of(key) is not None
    def getValue(self, key): return self._of(key)
    def removeKey(self, key): self.kept.pop(key)
    def keys(self): return list(self.kept)

    def updateValue(self, key, value):
        self.calls += 1
        self.kept[key] = value


class Handle(dict):
    def getValueState(self, name, schema): return self.setdefault(name, State())
    def getMapState(self, name, *schemas): return self.setdefault(name, State())
    def listTimers(self): return [1]


class Now:
    def getCurrentProcessingTimeInMs(self): return 0


def test_state_calls_do_not_grow_with_lines(monkeypatch):
    monkeypatch.setattr(buffer, "OUT_ROWS", 30)

    def calls(n):
        rules, handle = buffer.Buffers(4, 7200, 600), Handle()
        rules.init(handle)
        lines = pd.DataFrame({"dt": "d", "event_id": [f"e{i}" for i in range(n)], "ts_ms": range(n), "tstr": "x"})
        out = pd.concat(list(rules.handleInputRows((0,), iter([lines]), Now())))
        assert sorted(out["flush"]) == sorted(i // 4 for i in range(n))
        assert handle["flushes"].kept == {("d",): (n // 4,)}
        more = pd.DataFrame({"dt": "d", "event_id": [f"f{i}" for i in range(4)], "ts_ms": range(n, n + 4), "tstr": "x"})
        assert set(pd.concat(list(rules.handleInputRows((0,), iter([more]), Now())))["flush"]) == {n // 4}
        return sum(s.calls for s in handle.values())

    assert calls(400) == calls(40)


def test_exchanges_of_table_jobs_follow_the_input(spark, sf_dir):
    plan = queries.all_queries()["player_action"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert ", 1024)" in plan
    tune(spark)  # other operators keep the session's sizes
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) != "1024"


def test_a_day_is_written_by_many_tasks(spark, sf_dir, monkeypatch):
    folders = {}
    plain = queries.scratch
    monkeypatch.setattr(queries, "scratch", lambda s, name: folders.setdefault(name, plain(s, name)))
    monkeypatch.setattr(queries, "FILE_ROWS", 2)
    monkeypatch.setattr(queries, "BLOCK_FILES", 1)
    found = {r.partition_spec: r for r in queries.all_queries()["partition_sizes"](spark, sf_dir).collect()}
    rows = {f"dt={r.dt}": r["count"] for r in Fixtures(spark, sf_dir).result.groupBy("dt").count().collect()}
    assert {k: r.files for k, r in found.items()} == {k: -(-n // 2) for k, n in rows.items()}
    assert all(r.same_bytes and r.mb_fits for r in found.values())
    most = max(rows, key=rows.get)
    assert len({name.name.split("-")[1] for name in Path(folders["sized"], most).glob("*.parquet")}) > 1


def test_a_scan_holds_a_bounded_number_of_files(spark, sf_dir, monkeypatch):
    scans_of, most = [], 16
    plain = queries.io.read_table

    def seen(*args, **kw):
        scans_of.append(plain(*args, **kw))
        return scans_of[-1]

    monkeypatch.setattr(queries.io, "read_table", seen)
    monkeypatch.setattr(queries, "FILE_ROWS", 2)
    monkeypatch.setattr(queries, "FILES_AT_ONCE", most, raising=False)
    kept = {key: spark.conf.get(key) for key in getattr(queries, "SCAN", {})}
    found = {r.partition_spec: r for r in queries.all_queries()["partition_sizes"](spark, sf_dir).collect()}
    assert {key: spark.conf.get(key) for key in kept} == kept
    assert all(r.same_bytes and r.mb_fits for r in found.values())
    held = [df.inputFiles() for df in scans_of]
    assert max(map(len, held)) <= 3 * most < sum(map(len, held))  # dealt by a hash: some more than `most` at times
    assert len({f for fs in held for f in fs}) == sum(map(len, held)) == sum(r.files for r in found.values())


def test_slices_hold_every_file_once(spark):
    root = scratch(spark, "sliced")
    n = {"a": 1, "b": 2, "c": 40, "d": 3}
    for dt, k in n.items():
        for i in range(k):
            path = Path(root.removeprefix("file:"), f"dt={dt}", f"part-{i}.parquet")
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(b"x")
    sizes = catalog.partition_sizes(spark, {"t": root})
    lists = list(files.slices(spark, root, sizes, 5))
    assert lists[:2] == [[f"{root}/dt=a", f"{root}/dt=b"], [f"{root}/dt=d"]]
    assert sorted(p for paths in lists[2:] for p in paths) == sorted(f"{root}/dt=c/part-{i}.parquet" for i in range(40))
    assert len(lists) == 2 + 8 and max(map(len, lists)) < 20
    assert list(files.slices(spark, root, sizes.where("false"), 5)) == []


def test_files_and_folders_read_alike(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    spark.range(60).selectExpr("id", "nullif(concat('d', cast(id % 3 as string)), 'd2') as dt").repartition(4).write.partitionBy("dt").parquet(root)
    read, columns = queries.io.read_table, "id bigint, dt string"
    whole = read(spark, root, columns)
    folders = [f"{root}/dt=__HIVE_DEFAULT_PARTITION__"]
    for paths in (folders, [f for f in whole.inputFiles() if "DEFAULT" in f]):
        part = read(spark, root, columns, paths)
        assert part.schema == whole.schema
        assert sorted(map(tuple, part.collect())) == [(i, None) for i in range(2, 60, 3)]
    assert read(spark, root, columns, whole.inputFiles()).exceptAll(whole).count() == 0 < whole.count() == 60
