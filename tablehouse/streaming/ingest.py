"""Log ingest: service log lines to a table partitioned by local day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablehouse.functions.exprs import cut_after, local_day

KEYWORD = "FLATTENED_GAME_DATA: "
LINE = "event_id string, ts_ms bigint, message string"


def read_log(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """A folder of JSON-lines files that grows; files_per_batch bounds a micro-batch."""
    return spark.readStream.schema(LINE).option("maxFilesPerTrigger", files_per_batch).json(path)


def select_lines(lines: DataFrame, keyword: str = KEYWORD, delay: str = "10 minutes",
                 zone: str = "Asia/Shanghai") -> DataFrame:
    """Lines with the keyword, cut after it, once per event id.

    An id is remembered for `delay` of event time; a line later than that is dropped.
    """
    message = F.trim("message")
    return (
        lines.where(message.contains(keyword))
        .select("event_id", F.timestamp_millis("ts_ms").alias("event_ts"),
                cut_after(message, keyword).alias("tstr"), local_day(F.col("ts_ms"), zone).alias("dt"))
        .withWatermark("event_ts", delay)
        .dropDuplicatesWithinWatermark(["event_id"])
    )


def _sink(table: str, rejects: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        """Each batch goes to its own folder below the day, so a repeated batch replaces itself."""
        rows = batch.withColumn("batch", F.lit(f"{batch_id:08d}"))
        ok = F.from_json("tstr", "map<string, string>").isNotNull() & F.col("tstr").startswith("{")
        parted = rows.persist()
        try:
            for keep, path in ((ok, table), (~ok, rejects)):
                parted.where(keep).sortWithinPartitions("dt", "batch", "event_ts").select("tstr", "dt", "batch").write.mode(
                    "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "batch").parquet(path)
        finally:
            parted.unpersist()

    return write


def ingest(spark: SparkSession, source: str, table: str, rejects: str, checkpoint: str,
           keyword: str = KEYWORD, delay: str = "10 minutes", every: str | None = None,
           files_per_batch: int = 1000) -> StreamingQuery:
    """Start the ingest.

    every: trigger interval, e.g. '600 seconds'; None reads what is there and stops.  Lines
    whose payload is not a JSON object go to `rejects`.
    """
    stream = select_lines(read_log(spark, source, files_per_batch), keyword, delay)
    writer = stream.writeStream.foreachBatch(_sink(table, rejects)).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
