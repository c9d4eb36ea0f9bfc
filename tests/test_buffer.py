"""Buffered log ingest: restart, timers, failing writes and the rules for late and repeated lines."""

import json
import time

import pytest

from tablehouse.streaming import buffer

RULES = {"max_rows": 3, "max_age_s": 100, "delay_s": 10, "shards": 1}
DAY = 1_704_100_000_000  # 2024-01-01 17:06:40 in Shanghai


@pytest.fixture
def home(tmp_path):
    (tmp_path / "lines").mkdir()
    return tmp_path


@pytest.fixture(autouse=True)
def few_partitions(spark):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", kept)


def poll(home, name, lines):
    """One file of (id, seconds after the day's start, payload) lines."""
    rows = [{"event_id": i, "ts_ms": None if s is None else DAY + s * 1000, "message": f"INFO {buffer.KEYWORD}{p}"} for i, s, p in lines]
    (home / "lines" / f"{name}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    time.sleep(0.02)


def ingest(spark, home, **more):
    paths = {n: str(home / n) for n in ("table", "side", "failed", "state")}
    return buffer.ingest_buffered(spark, str(home / "lines"), paths["table"], paths["side"], paths["failed"], paths["state"],
                                  files_per_batch=1, **{**RULES, **more})


def rows(spark, home, name):
    path = home / name
    if not path.exists():
        return []
    return sorted((r.kind, r.event_id, r.flush, r.reason) for r in spark.read.parquet(str(path)).collect())


def test_flush_late_repeated_and_restart(spark, home):
    poll(home, "a", [("a", 0, "{1}"), ("b", 5, "{2}"), ("c", 6, "{3}"), ("d", 7, "{4}"), ("d", 7, "{4}"), (None, 8, "{}"), ("x", None, "{}")])
    ingest(spark, home).awaitTermination()
    # three lines fill a buffer; d is open, its copy is set aside
    assert rows(spark, home, "table") == [("line", i, 0, "rows") for i in "abc"]
    assert rows(spark, home, "side") == [("repeated", "d", None, None)]
    # after a restart the open buffer, the ids and the clock are still there
    poll(home, "b", [("d", 7, "{4}"), ("e", 200, "{5}"), ("f", 1, "{6}"), ("g", -4, "{7}")])
    poll(home, "c", [("h", 150, "{8}"), ("i", 195, "{9}"), ("e", 200, "{5}")])
    ingest(spark, home).awaitTermination()
    # d and f left when the clock came to 200; g was 11 s behind 7; h is late after 200, i is not
    assert rows(spark, home, "table") == [*[("line", i, 0, "rows") for i in "abc"], ("line", "d", 1, "age"), ("line", "f", 1, "age")]
    assert rows(spark, home, "side") == [("late", "g", None, None), ("late", "h", None, None), *[("repeated", i, None, None) for i in "dde"]]
    poll(home, "d", [("z", 1000, "{}")])
    ingest(spark, home).awaitTermination()
    assert [r[1:] for r in rows(spark, home, "table") if r[2] == 2] == [("e", 2, "age"), ("i", 2, "age")]


def test_failing_writes(spark, home):
    """A write that fails once is repeated; one that fails twice leaves its lines as JSON and the stream goes on."""
    calls = []

    def shaky(batch, batch_id, table, side):
        calls.append(batch_id)
        if batch_id == 0 and calls.count(0) == 1 or batch_id == 1:
            raise OSError("disk full")
        buffer.write_parts(batch, batch_id, table, side)

    for name, ids in (("a", "abc"), ("b", "def"), ("c", "ghi")):
        poll(home, name, [(i, 1, "{}") for i in ids])
    query = ingest(spark, home, write=shaky)
    query.awaitTermination()
    assert query.exception() is None and calls == [0, 0, 1, 1, 2]
    assert [r[1] for r in rows(spark, home, "table")] == list("abcghi")
    dead = spark.read.json(str(home / "failed")).collect()
    assert sorted(r.event_id for r in dead) == list("def") and {r.error for r in dead} == {"OSError: disk full"}


def test_timer(spark, home):
    """A buffer that gets no more lines leaves the state by the wall clock."""
    poll(home, "a", [("a", 0, "{}")])
    query = ingest(spark, home, every="200 milliseconds", max_age_s=2)
    try:
        end = time.time() + 40
        while time.time() < end and not rows_or_none(spark, home):
            time.sleep(0.5)
        assert rows(spark, home, "table") == [("line", "a", 0, "timer")]
    finally:
        query.stop()


def rows_or_none(spark, home):
    try:
        return rows(spark, home, "table")
    except Exception:  # noqa: BLE001 - files of a batch that is being written
        return None
