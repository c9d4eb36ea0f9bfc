"""Buffered log ingest: lines wait in keyed state and leave it in flushes.

Lines are dealt over `shards` by a hash of their id, so a repeated line meets the first one and a
busy day is spread.  A shard keeps

    clock   the latest time of its lines; a line more than `delay` older than the
            clock was before the batch is late
    seen    ids of the last `delay`, in buckets of time: a line with one of them is repeated
    open    per local day the lines not yet written, with the time of the first

Within a batch a shard's lines are taken in order of time.  The state is asked once per day or bucket
and batch, as a call to it takes longer than a line does.  A buffer leaves the state when it has
`max_rows` lines (reason 'rows'), when a line or the clock is `max_age_s` beyond its first line
('age'), or when no line comes for so long by the wall clock ('timer').  Late and repeated
lines come out as side rows.  What is still open at a stop is in the checkpoint and goes on from there.

The sink writes each batch to its own folder; a write that fails is tried once more,
and lines that fail twice go to a dead-letter folder, so the stream goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tablehouse.functions.exprs import cut_after, local_day
from tablehouse.streaming.ingest import KEYWORD, read_log

OUT = "kind string, shard int, dt string, flush long, reason string, event_id string, ts_ms long, tstr string"
COLUMNS = [c.split()[0] for c in OUT.split(", ")]
TRIES = 2
OUT_ROWS = 50_000
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def shard_of(event_id: Column, shards: int) -> Column:
    return (F.conv(F.substring(F.md5(event_id.cast("binary")), 1, 8), 16, 10).cast("bigint") % shards).cast("int")


def with_keyword(lines: DataFrame, keyword: str, zone: str, shards: int) -> DataFrame:
    """shard, dt, event_id, ts_ms and what follows the keyword; lines without an id or a time can't be placed and are left out."""
    message = F.trim("message")
    return lines.where(message.contains(keyword) & F.col("event_id").isNotNull() & F.col("ts_ms").isNotNull()).select(
        shard_of(F.col("event_id"), shards).alias("shard"), local_day(F.col("ts_ms"), zone).alias("dt"), "event_id", "ts_ms",
        cut_after(message, keyword).alias("tstr"))


def framed(out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(out, columns=COLUMNS).astype({"flush": "Int64"})


class Buffers(StatefulProcessor):
    """State and rules of a shard."""

    def __init__(self, max_rows: int, max_age_s: int, delay_s: int):
        self.max_rows, self.max_age, self.delay = max_rows, max_age_s * 1000, delay_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", "ts long")
        self.seen = handle.getMapState("seen", "bucket long", "ids array<string>")
        self.open = handle.getMapState("open", "dt string", "arrived long, ids array<string>, ts array<long>, tstr array<string>")
        self.flushes = handle.getMapState("flushes", "dt string", "n long")

    def _is_new(self, event_id: str, ts: int, touched: dict[int, set]) -> bool:
        bucket = ts // max(self.delay, 1)
        if bucket not in touched:
            touched[bucket] = set(self.seen.getValue((bucket,))[0]) if self.seen.containsKey((bucket,)) else set()
        if event_id in touched[bucket]:
            return False
        touched[bucket].add(event_id)
        return True

    def _flush(self, shard: int, dt: str, buffer: list, reason: str, out: list) -> None:
        if dt not in self.numbers:
            self.numbers[dt] = self.flushes.getValue((dt,))[0] if self.flushes.containsKey((dt,)) else 0
        number = self.numbers[dt]
        self.numbers[dt] = number + 1
        _, ids, ts, tstr = buffer
        out += [("line", shard, dt, number, reason, *line) for line in zip(ids, ts, tstr)]

    def _keep_numbers(self) -> None:
        for dt, number in self.numbers.items():
            self.flushes.updateValue((dt,), (number,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        shard, now = int(key[0]), timerValues.getCurrentProcessingTimeInMs()
        batch = pd.concat(list(rows)).sort_values(["ts_ms", "event_id"], kind="stable")
        before = self.clock.get()[0] if self.clock.exists() else None
        clock = max(int(batch["ts_ms"].max()), before if before is not None else -(1 << 62))
        out: list[tuple] = []
        seen: dict[int, set] = {}
        open_: dict[str, list] = {}
        first: dict[str, int] = {}  # the earliest time in a buffer
        self.numbers: dict[str, int] = {}
        for dt, event_id, ts, tstr in zip(batch["dt"], batch["event_id"], batch["ts_ms"].astype(int).tolist(), batch["tstr"]):
            if len(out) >= OUT_ROWS:
                yield framed(out)
                out = []
            if before is not None and ts < before - self.delay:
                out.append(("late", shard, dt, None, None, event_id, ts, tstr))
                continue
            if not self._is_new(event_id, ts, seen):
                out.append(("repeated", shard, dt, None, None, event_id, ts, tstr))
                continue
            if dt not in open_:
                kept = self.open.getValue((dt,)) if self.open.containsKey((dt,)) else None
                open_[dt] = [kept[0], *map(list, kept[1:])] if kept else [now, [], [], []]
                first[dt] = min(open_[dt][2], default=ts)
            buffer = open_[dt]
            if buffer[2] and ts >= first[dt] + self.max_age:
                self._flush(shard, dt, buffer, "age", out)
                buffer = open_[dt] = [now, [], [], []]
            first[dt] = min(first[dt], ts) if buffer[2] else ts
            for place, value in zip(buffer[1:], (event_id, ts, tstr)):
                place.append(value)
            if len(buffer[1]) >= self.max_rows:
                self._flush(shard, dt, buffer, "rows", out)
                open_[dt] = [now, [], [], []]
        for dt, buffer in open_.items():
            if buffer[1]:
                self.open.updateValue((dt,), tuple(buffer))
            elif self.open.containsKey((dt,)):
                self.open.removeKey((dt,))
        for bucket, ids in seen.items():
            self.seen.updateValue((bucket,), (sorted(ids),))
        # ids that only late lines could repeat are forgotten
        for old in [k[0] for k in list(self.seen.keys()) if (k[0] + 1) * max(self.delay, 1) <= clock - self.delay]:
            self.seen.removeKey((old,))
        self.clock.update((clock,))
        self._expire(shard, lambda arrived, first: clock >= first + self.max_age, "age", out)
        self._keep_numbers()
        # one timer a shard: a state iterator is read to its end before the next call
        if list(self.open.keys()) and not list(self.handle.listTimers()):
            self.handle.registerTimer(now + self.max_age)
        yield framed(out)

    def _expire(self, shard: int, due: Callable[[int, int], bool], reason: str, out: list) -> None:
        for dt in sorted(k[0] for k in list(self.open.keys())):
            buffer = self.open.getValue((dt,))
            if due(buffer[0], min(buffer[2])):
                self._flush(shard, dt, buffer, reason, out)
                self.open.removeKey((dt,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        shard, now = int(key[0]), timerValues.getCurrentProcessingTimeInMs()
        out: list[tuple] = []
        self.numbers = {}
        self._expire(shard, lambda arrived, first: now >= arrived + self.max_age, "timer", out)
        self._keep_numbers()
        left = [self.open.getValue(k)[0] for k in list(self.open.keys())]
        if left:
            self.handle.registerTimer(min(left) + self.max_age)
        yield framed(out)

    def close(self) -> None:
        pass


def buffered(lines: DataFrame, max_rows: int = 10_000, max_age_s: int = 600, delay_s: int = 600, shards: int = 64,
             keyword: str = KEYWORD, zone: str = "Asia/Shanghai") -> DataFrame:
    """Streaming rows of `OUT`: kind 'line' for flushed lines, 'late' and 'repeated' for those left aside."""
    return with_keyword(lines, keyword, zone, shards).groupBy("shard").transformWithStateInPandas(
        Buffers(max_rows, max_age_s, delay_s), OUT, "append", "processingTime")


def write_parts(batch: DataFrame, batch_id: int, table: str, side: str) -> None:
    """Flushed lines by day below `table`, late and repeated ones below `side`; a repeated batch replaces itself."""
    rows = batch.withColumn("batch", F.lit(f"{batch_id:08d}"))
    for keep, path, parts in (("kind = 'line'", table, ("dt", "batch")), ("kind <> 'line'", side, ("kind", "batch"))):
        rows.where(keep).sortWithinPartitions(*parts, "shard", "flush", "ts_ms").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def sink(table: str, side: str, failed: str, write: Callable = write_parts, tries: int = TRIES) -> Callable[[DataFrame, int], None]:
    """A batch writer that tries `tries` times and then puts the batch's lines into `failed` as JSON."""
    def run(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for attempt in range(tries):
                try:
                    return write(held, batch_id, table, side)
                except Exception as error:  # noqa: BLE001 - whatever the storage raises, the lines must not be lost
                    reason = f"{type(error).__name__}: {str(error).splitlines()[0][:200]}"
            held.withColumn("error", F.lit(reason)).write.mode("overwrite").json(f"{failed}/batch={batch_id:08d}")
        finally:
            held.unpersist()

    return run


def ingest_buffered(spark: SparkSession, source: str, table: str, side: str, failed: str, checkpoint: str, every: str | None = None,
                    files_per_batch: int = 1000, write: Callable = write_parts, **rules) -> StreamingQuery:
    """Start the ingest of a growing folder; `rules` are those of `buffered`.

    every: trigger interval; None reads what is there and stops, leaving open buffers in the checkpoint.
    """
    stream = buffered(read_log(spark, source, files_per_batch), **rules)
    writer = stream.writeStream.foreachBatch(sink(table, side, failed, write)).option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    # timers by the wall clock ask for batches without data for ever: a run that is to stop does without them
    kept = spark.conf.get(NO_DATA)
    spark.conf.set(NO_DATA, "false")
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(NO_DATA, kept)
