"""The registered queries: every job bound to the generic test tables."""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehouse.fixtures import FIRST_DT, LAST_DT, Fixtures
from tablehouse.functions import rules
from tablehouse.functions.exprs import HAND, all_different, is_subset
from tablehouse.operators import joins, scans
from tablehouse.plans import actions, bitmaps, cards, catalog, evaluate, jsonlog, marts, results, risk, tags
from tablehouse.session import scratch, tune
from tablehouse.sources import files, io
from tablehouse.streaming import buffer
from tablehouse.streaming import ingest as stream

SPAN = (FIRST_DT, LAST_DT)
DAY, DAY_BEFORE, LATER = "2024-01-10", "2024-01-09", "2024-01-20"
REGISTRY: dict[str, Callable[[Fixtures], DataFrame]] = {}


def query(fn: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


def bind(fn: Callable[[Fixtures], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Fixtures(tune(spark, tables=True), sf_dir))

    run.__name__ = fn.__name__
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: bind(fn) for name, fn in REGISTRY.items()}


def _exploded(fx: Fixtures) -> DataFrame:
    return jsonlog.explode_log(fx.hand_log)


def _dwd(fx: Fixtures) -> DataFrame:
    """The exploded log as the table the later jobs read."""
    return fx.stored("dwd", lambda: _exploded(fx).drop("szcarddata"), spread=False)


# ---- hand logs -----------------------------------------------------------------------


@query
def explode_log(fx):
    return _exploded(fx).select("id", "gametype", "playerid", "sztoken", "nround", "winscore", "score",
                           "json_index", "name", "data", "carddata", "createtime", "dt")


@query
def seat_info(fx):
    return jsonlog.seat_info(_dwd(fx))


@query
def robot_info(fx):
    return jsonlog.robot_info(_dwd(fx), fx.user)


@query
def player_action(fx):
    dwd = _dwd(fx)
    return actions.player_action(dwd, jsonlog.seat_info(dwd), fx.score)


@query
def player_action_first(fx):
    """The variant that fills gaps with the nearest later value."""
    dwd = _dwd(fx)
    return actions.player_action(dwd, jsonlog.seat_info(dwd), fx.score, fill="first")


def _hot_dwd(fx: Fixtures) -> DataFrame:
    """The exploded log with every second hand's messages in one hand, whose seats are those of hand 0."""
    hand = F.floor(F.col("id") / 2)
    hot = hand % 2 == 0
    rows = _dwd(fx).where(~hot | (hand == 0) | (F.col("name") != "SeatInfos"))
    return rows.withColumns({
        "json_index": F.when(hot, hand * 100 + F.col("json_index")).otherwise(F.col("json_index")),
        **{c: F.when(hot, F.lit(v)).otherwise(F.col(c)) for c, v in (("sztoken", "hot"), ("nround", 0), ("dt", DAY))}})


@query
def player_action_hot(fx):
    """The action detail where one hand holds most messages, cut into pieces of some 500."""
    dwd = _hot_dwd(fx)
    return actions.player_action(dwd, jsonlog.seat_info(dwd), fx.score, rows=500)


@query
def card_preset(fx):
    return jsonlog.card_preset(fx.deal_log)


@query
def flatten_deals(fx):
    rows = jsonlog.flatten_deals(fx.deals)
    text = lambda c: F.array_join(c, ",").alias(c)
    return rows.select("sztoken", "nround", "gametype", "smallblind", "nplayerid", "seat", "score", "brobot",
                       text("cards"), text("commoncards"), "bpreset", "inventiontype", "presettype",
                       "redisscore", "dt")


@query
def log_ingest(fx):
    """Streams the log lines of a scratch folder into a table and reads it back."""
    spark = fx.spark
    source, table, rejects, state = (scratch(spark, n) for n in ("lines", "temp_tab", "rejects", "state"))
    fx.log_line.select("event_id", "ts_ms", "message").write.json(source)
    stream.ingest(spark, source, table, rejects, state).awaitTermination()
    return io.read_table(spark, table, "tstr string, dt string, batch string").select("tstr", "dt")


FLUSH = {"max_rows": 4, "max_age_s": 7200, "delay_s": 600, "shards": 4}


def _polled(fx: Fixtures) -> str:
    """The lines of six polls through the buffered ingest, a batch per poll; the folder with its tables."""
    def run() -> str:
        spark, home = fx.spark, scratch(fx.spark, "buffered")
        # made by all tasks once; a poll is one file, so one task writes it and should only copy it
        fx.polled.write.partitionBy("poll").parquet(f"{home}/polls")
        polls = spark.read.schema(fx.polled.schema).parquet(f"{home}/polls")
        for poll in range(6):
            polls.where(F.col("poll") == poll).select("event_id", "ts_ms", "message").coalesce(1).write.mode("append").json(f"{home}/lines")
        buffer.ingest_buffered(spark, f"{home}/lines", f"{home}/table", f"{home}/side", f"{home}/failed", f"{home}/state",
                               files_per_batch=1, **FLUSH).awaitTermination()
        return home

    return fx.folder("buffered", run)


@query
def log_flush(fx):
    """Lines as the buffered ingest wrote them, with the flush that took them; what is still open waits in the state."""
    rows = io.read_table(fx.spark, f"{_polled(fx)}/table", buffer.OUT + ", batch string")
    return rows.select("event_id", "tstr", "dt", "shard", "flush", "reason")


@query
def log_late(fx):
    """Lines that came too late or twice, which the ingest sets aside."""
    rows = io.read_table(fx.spark, f"{_polled(fx)}/side", buffer.OUT + ", batch string")
    return rows.select("kind", "event_id", "dt", "shard", "ts_ms")


# ---- windows -------------------------------------------------------------------------


def _gaps(fx: Fixtures) -> DataFrame:
    return fx.sql("select event_id, user_id, case when event_id % 3 = 0 then value end as x, "
                  "event_type from @events")


@query
def fill_forward_back(fx):
    df = _gaps(fx).withColumns({"prev": F.col("x"), "near": F.col("x"), "far": F.col("x")})
    return scans.fill(df, ["user_id"], "event_id", {"prev": None, "near": "first", "far": "last"}).select(
        "user_id", "event_id", "prev", "near", "far")


@query
def renumber(fx):
    df = fx.sql("select user_id, cast(floor(event_id / 100) as bigint) as slot, event_id, event_type from @events")
    return scans.renumber(df, ["user_id"], "slot", [F.col("event_type"), F.col("event_id")]).select(
        "user_id", "event_id", "rn")


@query
def running_distinct(fx):
    return scans.running_distinct(_gaps(fx), ["user_id"], "event_id", "event_type").select(
        "user_id", "event_id", "n_distinct")


# ---- results -------------------------------------------------------------------------


def _result(fx: Fixtures) -> DataFrame:
    return results.game_result(fx.score, fx.gold, fx.robot)


@query
def game_result(fx):
    return _result(fx)


@query
def win_lose_round(fx):
    return results.win_lose_round(results.scored(fx.score, fx.gold, fx.robot))


@query
def robot_win_lose(fx):
    return results.robot_win_lose(results.scored(fx.score, fx.gold, fx.robot))


@query
def win_lose_u(fx):
    return results.win_lose_u(fx.info, fx.match, fx.score, fx.gold, fx.user)


# ---- risk and tags -------------------------------------------------------------------


def _pairs(fx: Fixtures) -> DataFrame:
    return risk.collusion_pairs(fx.result, fx.user)


@query
def collusion_pairs(fx):
    return _pairs(fx).withColumn("shared_ip", F.array_join("shared_ip", ","))


def _pair_table(fx: Fixtures) -> DataFrame:
    """The pair table as the later jobs read it."""
    return fx.stored("pairs", lambda: _pairs(fx).select(
        "dt", "player1_id", "player2_id", "same_cnt", "win_rate", "total_desk", "player1_same_rate",
        "player2_same_rate", "shared_ip_cnts"))


@query
def suspect_players(fx):
    """Looser limits than the default."""
    return risk.suspects(_pair_table(fx), (2, 0.5, 0.1, 1))


@query
def suspects_pruned(fx):
    """The same players straight from the results, without those who can't be suspects."""
    return risk.suspects_from_results(fx.result, (2, 0.5, 0.1, 1))


@query
def score_extremes(fx):
    scores = fx.sql("select nplayerid, ngametype, cast(floor(sum(gameresult) / 200000) as double) as score from @v_result "
                    "group by nplayerid, ngametype")
    return risk.score_extremes(fx.result, scores, ["sztoken", "nround", "dt"])


@query
def player_style(fx):
    return tags.player_style(fx.action, *SPAN)


@query
def versus_robot(fx):
    return tags.versus_robot(fx.result, *SPAN)


@query
def versus_robot_by_hand(fx):
    return tags.versus_robot(fx.result, *SPAN, by_hand=True)


def _profile(fx: Fixtures, **kw) -> DataFrame:
    return tags.player_profile(fx.user, fx.member, tags.player_style(fx.action, *SPAN), fx.result,
                               _pair_table(fx), *SPAN, **kw)


@query
def player_profile(fx):
    return _profile(fx)


@query
def player_profile_7d(fx):
    """A look-back shorter than the data: rows leave the window."""
    return _profile(fx, days=7)


@query
def profile_mart(fx):
    return marts.profile_mart(_profile(fx))


# ---- marts ---------------------------------------------------------------------------


@query
def daily_overview(fx):
    return marts.daily_overview(fx.result, fx.user, fx.preset, _pair_table(fx), *SPAN)


@query
def daily_overview_7d(fx):
    return marts.daily_overview(fx.result, fx.user, fx.preset, _pair_table(fx), *SPAN, days=7)


@query
def month_players(fx):
    """Monthly players from stored bitmaps per day; one day is written without half its rows first and run again later."""
    table = scratch(fx.spark, "player-bitmaps")
    late = (F.col("dt") == DAY) & (F.col("nround") % 2 == 0)
    io.overwrite_days(bitmaps.day_players(fx.result.where(~late)), table)
    io.overwrite_days(bitmaps.day_players(fx.result.where(F.col("dt") == DAY)), table)
    stored = io.read_table(fx.spark, table, "bucket bigint, bits binary, dt string")
    return bitmaps.players_over(stored, *SPAN)


@query
def month_players_7d(fx):
    return bitmaps.players_over(bitmaps.day_players(fx.result), *SPAN, days=7)


def _bucketed(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    """Results and actions by day, bucketed by the hand."""
    def table(name: str, rows: DataFrame) -> DataFrame:
        where = scratch(fx.spark, "bucketed")
        return io.write_bucketed(rows, f"th_{name}_{where[-32:]}", where, ("sztoken", "nround"), 8)

    return table("result", fx.result.drop("hand")), table("action", fx.action.withColumn("nround", F.col("nround").cast("bigint")))


def hands_of_both(result: DataFrame, action: DataFrame) -> DataFrame:
    span = F.col("dt").between(DAY, LATER)
    seats = result.where(span).groupBy(*HAND).agg(F.count(F.lit(1)).alias("seats"), F.sum("gameresult").alias("net"))
    acts = action.where(span).groupBy(*HAND).agg(F.count(F.lit(1)).alias("acts"))
    return seats.join(acts, HAND, "left")


@query
def bucketed_hands(fx):
    """Hands with their seats, result and actions from tables bucketed by the hand."""
    return hands_of_both(*_bucketed(fx))


@query
def robot_stats(fx):
    return marts.robot_stats(fx.result)


@query
def robot_stats_90d(fx):
    return marts.robot_stats(fx.result, *SPAN, days=90)


@query
def robot_stats_7d(fx):
    return marts.robot_stats(fx.result, *SPAN, days=7)


@query
def active_hours(fx):
    return marts.active_hours(results.scored(fx.score, fx.gold, fx.robot))


@query
def activity_tags(fx):
    return marts.activity_tags(fx.result, *SPAN)


@query
def activity_tags_7d(fx):
    return marts.activity_tags(fx.result, *SPAN, days=7)


@query
def preset_overview(fx):
    return marts.preset_overview(fx.preset)


@query
def preset_result(fx):
    return marts.preset_result(fx.preset, fx.gold, fx.score)


@query
def new_users(fx):
    return marts.new_users(fx.user)


@query
def flag_export(fx):
    return marts.all_flags(fx.user, _pair_table(fx))


# ---- metadata and sync ---------------------------------------------------------------


@query
def sync_roundtrip(fx):
    """Write a mart day by day, replace it, upsert into it, and read it back."""
    target = scratch(fx.spark, "mart")
    rows = marts.preset_overview(fx.preset)
    io.sync_table(rows.withColumn("player_cnt", F.lit(0).cast("bigint")), target)
    io.overwrite_days(rows, target)
    return io.read_table(fx.spark, target)


@query
def table_profile(fx):
    return catalog.frame_profile({"result": fx.result, "user": fx.user, "action": fx.action, "preset": fx.preset})


@query
def partition_sizes(fx):
    """Files and bytes per partition; the bytes are held against those the scan of the table reports."""
    target = scratch(fx.spark, "sized")
    cores = fx.spark.sparkContext.defaultParallelism
    # a day is written by many tasks, in blocks of whole files
    numbered = scans.renumber(fx.result, ["dt"], "hand", [F.col("nplayerid")])
    block = F.floor((F.col("rn") - 1) / (FILE_ROWS * BLOCK_FILES))
    numbered.repartition(4 * cores, "dt", block).drop("hand", "rn").write.option("maxRecordsPerFile", FILE_ROWS).options(
        **MANY_FILES).partitionBy("dt").parquet(target)
    catalog.partition_sizes(fx.spark, {"result": target}).write.parquet(listed := scratch(fx.spark, "listed"))
    sizes = fx.spark.read.parquet(listed)
    scanned = _scanned_sizes(fx, target, sizes)
    return sizes.join(scanned, "partition_spec", "left").select(
        "table_name", "partition_spec", "files", (F.col("bytes") == F.col("read_bytes")).alias("same_bytes"),
        (F.col("size_mb") == F.round(F.col("read_bytes") / 1048576, 2)).alias("mb_fits"))


def _scanned_sizes(fx: Fixtures, target: str, sizes: DataFrame) -> DataFrame:
    """Bytes per partition as scans of the table report them, each of some FILES_AT_ONCE files, as the driver holds a
    status and a place in a task for every file of a scan.  A scan gives a row per partition, and the settings are
    those of these scans only."""
    found, columns = [], ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fx.result.drop("hand").schema.fields)
    kept = {key: fx.spark.conf.get(key) for key in SCAN}
    for key, value in SCAN.items():
        fx.spark.conf.set(key, value)
    try:
        for paths in files.slices(fx.spark, target, sizes, FILES_AT_ONCE):
            found += _scan(fx, target, columns, paths).collect()
            gc.collect()  # frames lie in cycles of Python's, and a frame keeps the list of its files in the JVM
    finally:
        for key, value in kept.items():
            fx.spark.conf.set(key, value)
    scanned = fx.spark.createDataFrame(found, "partition_spec string, read_bytes bigint")
    return scanned.groupBy("partition_spec").agg(F.sum("read_bytes").alias("read_bytes"))


def _scan(fx: Fixtures, target: str, columns: str, paths: list[str]) -> DataFrame:
    rows = io.read_table(fx.spark, target, columns, paths)
    files_of = rows.select("dt", "_metadata.file_path", "_metadata.file_size").distinct()
    return files_of.groupBy(F.concat(F.lit("dt="), "dt").alias("partition_spec")).agg(F.sum("file_size").alias("read_bytes"))


FILE_ROWS, BLOCK_FILES, FILES_AT_ONCE = 20, 50, 1 << 16
# a scan of many small files: more of them in a task (Spark packs them by the cost of opening one), no block
# locations and no listings kept, a list of files is looked up by few tasks
SCAN = {
    "spark.sql.files.openCostInBytes": str(128 << 10),
    "spark.sql.sources.ignoreDataLocality": "true",
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}
# each task moves its own files at its end, not the driver all of them
MANY_FILES = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


# ---- readers and writers: each writes to a fresh folder and reads it back ---------------

RESULT_COLS = ["sztoken", "nround", "nplayerid", "ngametype", "gameresult", "dt"]


def _result_table(fx: Fixtures) -> DataFrame:
    """The result table by day, as the jobs of one day read it."""
    def written() -> str:
        path = scratch(fx.spark, "result-by-day")
        io.overwrite_days(fx.result.select(*RESULT_COLS), path)
        return path

    return io.read_table(fx.spark, fx.folder("result-by-day", written))


@query
def partition_scan(fx):
    """One day's partition of the result table."""
    return io.increment(_result_table(fx), DAY)


@query
def range_scan(fx):
    """A range of days, open below, reduced to hands per day."""
    rows = io.day_range(_result_table(fx), DAY, LATER, open_below=True)
    return rows.select("dt", "sztoken", "nround").distinct().groupBy("dt").agg(F.count(F.lit(1)).alias("hands"))


@query
def snapshot_pair(fx):
    """Players of a day's snapshot who are missing in that of the day before, and the reverse."""
    target = scratch(fx.spark, "users")
    io.overwrite_days(fx.user.select("nplayerid", "brobot", "dt"), target)
    today, before = (s.select("nplayerid") for s in io.snapshots(io.read_table(fx.spark, target), DAY))
    return joins.anti(today, before, ["nplayerid"]).withColumn("change", F.lit("new")).unionByName(
        joins.anti(before, today, ["nplayerid"]).withColumn("change", F.lit("gone")))


@query
def path_read(fx):
    """A path read with a partition spec of two columns."""
    target = scratch(fx.spark, "by-type")
    io.overwrite_days(fx.result.select(*RESULT_COLS), target, ("dt", "ngametype"))
    return io.read_path(fx.spark, target, f"dt={DAY}, ngametype=420").select("sztoken", "nround", "nplayerid", "gameresult")


@query
def csv_subset(fx):
    """Some columns of CSV files, as text."""
    target = scratch(fx.spark, "csv")
    fx.result.select(*RESULT_COLS).write.option("header", "true").csv(target)
    return io.read_csv(fx.spark, [target], ["nplayerid", "gameresult", "dt"], header=RESULT_COLS)


@query
def replace_mart_day(fx):
    """Delete-then-insert of one day with default values; another day is emptied."""
    target = scratch(fx.spark, "mart")
    rows = fx.preset.select("sztoken", "nround", "nplayerid", "inventiontype", "dt")
    io.overwrite_days(rows, target)
    io.replace_day(rows.where(F.col("dt") == DAY), target, DAY, {"inventiontype": "no_preset"})
    io.replace_day(rows.where("false"), target, LATER)
    return io.read_table(fx.spark, target)


@query
def upsert_mart(fx):
    """Rows of the second half of the month replace or join those of the first by key."""
    best = lambda rows: rows.groupBy("nplayerid", "ngametype").agg(
        F.max("gameresult").alias("best"), F.max("dt").alias("seen"))
    return io.merge(best(fx.result.where(F.col("dt") <= DAY)), best(fx.result.where(F.col("dt") >= LATER)),
                    ["nplayerid", "ngametype"])


@query
def upsert_in_place(fx):
    """A stored mart of best results by the day they were seen; the second half of the month is merged into it."""
    mart = scratch(fx.spark, "upserted")
    best = lambda rows: rows.groupBy("nplayerid", "ngametype").agg(
        F.max("gameresult").alias("best"), F.max("dt").alias("dt"))
    for half in (F.col("dt") <= DAY, F.col("dt") > DAY):
        files.upsert(best(fx.result.where(half)), mart, ["nplayerid", "ngametype"])
    return files.read_mart(fx.spark, mart, "nplayerid bigint, ngametype int, best bigint, dt string")


@query
def append_latest(fx):
    """A mart written whole, its latest day replaced, one day appended once more."""
    target = scratch(fx.spark, "mart")
    rows = marts.preset_overview(fx.preset)
    io.sync_table(rows, target)
    io.sync_table(rows.withColumn("player_cnt", F.lit(-1).cast("bigint")), target, use_latest=True)
    io.sync_table(rows, target, spec=f"dt={DAY}", mode="append")
    return io.read_table(fx.spark, target)


@query
def append_lines(fx):
    """Deal rows as JSON lines, appended in two writes, read back as the preset table."""
    target = scratch(fx.spark, "lines")
    lines = jsonlog.deal_lines(jsonlog.flatten_deals(fx.deals))
    for odd in (0, 1):
        io.append_jsonl(lines.where(F.get_json_object("tstr", "$.nround").cast("int") % 2 == odd), target)
    back = fx.spark.read.schema("tstr string, dt string").json(target)
    return jsonlog.card_preset(back).select("sztoken", "nround", "nplayerid", "startscore", "handcards", "dt")


@query
def table_lifecycle(fx):
    """Create a catalog table, insert by column name, drop one partition, read what is left."""
    where = scratch(fx.spark, "lifecycle")
    name = "th_" + where[-32:]
    columns = {"inventiontype": "string", "ngametype": "int", "round_cnt": "bigint", "player_cnt": "bigint", "dt": "string"}
    io.create_table(fx.spark, name, columns, location=where)
    io.insert_by_name(marts.preset_overview(fx.preset), name)
    io.drop_partition(fx.spark, name, f"dt={DAY}")
    return fx.spark.table(name)


def _catalog(fx: Fixtures) -> str:
    """A database of two tables whose partitions were written by path and then registered."""
    where = scratch(fx.spark, "catalog")
    name = "th_" + where[-32:]
    fx.spark.sql(f"CREATE DATABASE {name} LOCATION '{where}'")
    for table, rows in (("users", fx.user.select("nplayerid", "dt")), ("presets", fx.preset.select("nplayerid", "dt"))):
        io.create_table(fx.spark, f"{name}.{table}", {"nplayerid": "bigint"}, location=f"{where}/{table}")
        io.overwrite_days(rows, f"{where}/{table}")
    catalog.repair(fx.spark, name)
    return name


@query
def catalog_profile(fx):
    """First and last day of every table of a database, from the catalog alone."""
    return catalog.table_profile(fx.spark, _catalog(fx), LAST_DT).select("table_name", "table_comment", "min_dt", "max_dt", "dt")


@query
def catalog_partitions(fx):
    """The registered partitions of a table, each marked if it is the latest."""
    table = f"{_catalog(fx)}.presets"
    newest = catalog.latest_dt(fx.spark, table)
    return catalog.partitions(fx.spark, table).select(
        "partition", (F.col("partition") == f"dt={newest}").alias("is_latest"))


@query
def partition_check(fx):
    """The first five partitions on storage: files found, bytes above zero, megabytes from the bytes."""
    target = scratch(fx.spark, "sized")
    io.overwrite_days(fx.result.select(*RESULT_COLS), target)
    sizes = catalog.partition_sizes(fx.spark, {"result": target}, max_partitions=5)
    return sizes.select("table_name", "partition_spec", (F.col("files") > 0).alias("has_files"),
                        (F.col("bytes") > 0).alias("has_bytes"),
                        (F.col("size_mb") == F.round(F.col("bytes") / 1048576, 2)).alias("mb_fits"))


@query
def login_log(fx):
    """The whole login log."""
    return _logins(fx).drop("event_id")


@query
def set_tests(fx):
    """Per hand: own cards within the seven, cards that are not on the board, all different."""
    return fx.cards.select("hand_id", "player", is_subset("hole", "cards").alias("hole_in_cards"),
                           is_subset("hole", "board").alias("hole_in_board"), all_different("cards").alias("distinct_cards"),
                           F.array_join(F.array_sort(F.array_except("cards", "board")), ",").alias("own"))


@query
def explode_rejects(fx):
    """Hand logs and elements that the explode job can't use."""
    return jsonlog.rejected(fx.hand_log)


@query
def log_rejects(fx):
    """Lines whose payload is no JSON object, by the day they were logged."""
    spark = fx.spark
    source, table, rejects, state = (scratch(spark, n) for n in ("lines", "temp_tab", "rejects", "state"))
    cut = F.when(F.col("event_id").endswith("4"), F.rtrim("message", F.lit("}"))).otherwise(F.col("message"))
    fx.log_line.select("event_id", "ts_ms", cut.alias("message")).write.json(source)
    stream.ingest(spark, source, table, rejects, state).awaitTermination()
    return io.read_table(spark, rejects, "tstr string, dt string, batch string").select("tstr", "dt")


DIRTY = """select event_id as id, case when event_id % 10 = 3 then 'n/a' when event_id % 10 = 4 then null
  else cast(user_id as string) end as nplayerid, cast(value as string) as score,
  case when event_id % 7 = 0 then 'soon' else cast(cast(ts as date) as string) end as rectime,
  event_type as kind from @events"""
DECLARED = {
    "id": ("bigint", []), "playerid": ("int", ["nplayerid"]), "score": ("double", ["nscore"]),
    "rectime": ("date", []), "remark": ("string", ["szremark"]),
}


@query
def conform(fx):
    return catalog.conform(fx.sql(DIRTY), DECLARED).withColumn("rectime", F.col("rectime").cast("string"))


@query
def conform_report(fx):
    return catalog.conform_report(fx.sql(DIRTY), DECLARED)


# ---- cards ---------------------------------------------------------------------------


@query
def showdown_winners(fx):
    return cards.showdown(fx.cards, ["hand_id"]).select("hand_id", "player", "category", "strength", "winner")


@query
def showdown_short(fx):
    return cards.showdown(fx.cards_short, ["hand_id"], deck="short").select(
        "hand_id", "player", "category", "strength", "winner")


@query
def showdown_audit(fx):
    computed = cards.showdown(fx.cards, ["hand_id"]).select("hand_id", "player", "category")
    wrong = F.when(F.col("hand_id") % 50 == 7, F.col("category") + 1).otherwise(F.col("category"))
    expected = computed.withColumn("category", wrong)
    twice = expected.where("hand_id % 400 = 5 and player = 1")
    return cards.audit(computed, expected.unionByName(twice), ["hand_id", "player"], "category")


@query
def preflop_equity(fx):
    hands = fx.cards.select("hand_id", "player", "hole")
    return cards.preflop_equity(hands, F.col("hole")[0], F.col("hole")[1], cards.preflop_rates(fx.spark)).select(
        "hand_id", "player", "hand_class", "win_rate")


@query
def equity_audit(fx):
    """Win rates held against a copy with small and large deviations: within 1e-6 they agree."""
    hands = fx.cards.select("hand_id", "player", "hole")
    computed = cards.preflop_equity(hands, F.col("hole")[0], F.col("hole")[1], cards.preflop_rates(fx.spark)).select(
        "hand_id", "player", "win_rate")
    gap = F.when(F.col("hand_id") % 40 == 3, 1e-7).when(F.col("hand_id") % 40 == 9, 1e-3).otherwise(0.0)
    rate = F.when(F.col("hand_id") % 40 != 11, F.col("win_rate") + gap)
    expected = computed.withColumn("win_rate", rate)
    twice = expected.where("hand_id % 400 = 5 and player = 1")
    return cards.audit(computed, expected.unionByName(twice), ["hand_id", "player"], "win_rate", 1e-6).select(
        "finding", "hand_id", "player", F.col("expected").isNull().alias("missing"), "copies")


def _packed(fx: Fixtures) -> DataFrame:
    """A packed table of the boards of two of the three players, with a rate from the cards."""
    known = fx.cards.where("player < 2").select(
        cards.hand_key("hole").alias("hand_key"), "board",
        (F.aggregate("cards", F.lit(0).cast("bigint"), lambda a, c: a * 3 + c) % 1000003 / 1000003.0).alias("rate"))
    return io.write_packed_rows(known.groupBy("hand_key", F.array_sort("board").alias("board")).agg(
        F.min("rate").alias("rate")), 5)


@query
def packed_equity(fx):
    return cards.packed_equity(fx.cards.select("hand_id", "player", "hole", "board"), _packed(fx), 5).select(
        "hand_id", "player", "hand_key", F.round("rate", 6).alias("rate"))


@query
def packed_files(fx):
    """Packed files per board size, written from the cards of two of three players, read back and looked up."""
    home = scratch(fx.spark, "packed")
    hands = fx.cards.select("hand_id", "player", "hole", F.slice("board", 1, F.element_at(F.array(F.lit(0), F.lit(3), F.lit(4), F.lit(5)), (F.col("hand_id") % 4 + 1).cast("int"))).alias("board"))
    rate = F.aggregate(F.concat("hole", "board"), F.lit(0).cast("bigint"), lambda a, c: a * 3 + c) % 1000003 / 1000003.0
    known = hands.where("player < 2").select(cards.hand_key("hole").alias("hand_key"), F.array_sort("hole").alias("hole"), F.array_sort("board").alias("board"), rate.alias("rate"))
    for n in (0, 3, 4, 5):
        own = known.where(F.size("board") == n)
        if n == 0:
            own = own.select(F.lit("all").alias("hand_key"), F.col("hole").alias("board"), "rate")
        rows = own.groupBy("hand_key", "board").agg(F.min("rate").alias("rate"))
        io.write_packed(io.write_packed_rows(rows, n or 2), f"{home}/board{n}").write.format("noop").mode("overwrite").save()
    return cards.packed_lookup(fx.spark, hands, home).select("hand_id", "player", "hand_key", F.size("board").alias("n_board"), F.round("rate", 6).alias("rate"))


CATALOGUE = """select event_id as id, #card#(c0) || ',' || #card#(c1) as winner, #card#(c2) || ',' || #card#(c3) as opponent_1,
  case when event_id % 10 = 3 then #card#(c2) when event_id % 10 = 7 then 'Xx' else #card#(c4) end || ',' || #card#(c5) as opponent_2,
  #card#(c6) || ',' || #card#(c7) || ',' || #card#(c8) || ',' || #card#(c9) || ',' || #card#(c10) as community_cards,
  event_type as winner_card_type
from (select event_id, event_type, """ + ", ".join(
    f"(event_id * 7 + {i} * st) % 52 as c{i}" for i in range(11)) + """
  from (select *, case event_id % 6 when 0 then 1 when 1 then 5 when 2 then 7 when 3 then 11 when 4 then 17 else 23 end as st
    from @events) a) b"""


def catalogue_sql() -> str:
    import re

    card = r"concat(substr('23456789TJQKA', cast(floor(\1 / 4) as int) + 1, 1), substr('shcd', cast(\1 % 4 as int) + 1, 1))"
    return re.sub(r"#card#\((c\d+)\)", card, CATALOGUE)


@query
def validate_presets(fx):
    rows = cards.validate_presets(fx.sql(catalogue_sql()))
    return rows.select("id", "status", "winner_card_type", *[
        F.array_join(c, ",", "?").alias(c) for c in cards.CATALOGUE.values()])


# ---- evaluation ----------------------------------------------------------------------

BET_HANDS = """select playerid, dt, sztoken, nround, max(event_id) as ord, 10 as small_blind,
  cast(sum(num) as bigint) % 2001 - 1000 as payoff from @v_action group by playerid, dt, sztoken, nround"""


@query
def player_bet_stats(fx):
    return evaluate.player_bet_stats(fx.sql(BET_HANDS), fx.action, ["dt", "sztoken", "nround"])


def _matches(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    sides = [F.concat(F.lit("m"), F.col("playerid").cast("string")).alias("agent0"),
             F.concat(F.lit("b"), F.col("nround").cast("string")).alias("agent1")]
    acts = actions.raise_buckets(fx.action.where("act >= 0")).select(*sides, "stage", "bucket")
    return fx.sql(BET_HANDS).select(*sides, "payoff"), acts


@query
def match_report(fx):
    return evaluate.ranked(evaluate.match_report(*_matches(fx)))


@query
def street_mix(fx):
    return evaluate.street_mix(_matches(fx)[1])


@query
def baseline_gate(fx):
    report = evaluate.match_report(*_matches(fx))
    return evaluate.baseline_gate(report, ["b0", "b1", "b2"], GATE).select(
        "agent0", "agent1", "winrate", "mbb_h", *[f"{c}_per_game" for c in rules.RAISE_CLASSES])


GATE = -25_000.0


@query
def raise_bucket(fx):
    return actions.raise_buckets(fx.action).select("event_id", "act", "num", "pot", "bucket", "bucket_name", "simple")


@query
def latency_report(fx):
    return evaluate.latency_report(fx.request)


@query
def latency_errors(fx):
    return evaluate.top_errors(fx.request)


@query
def latency_status(fx):
    return evaluate.status_counts(fx.request)


def _logins(fx: Fixtures) -> DataFrame:
    return fx.sql("select user_id as nplayerid, concat('c', cast(user_id % 7 as string)) as nclubid, 1 as nactive, "
                  "substr(cast(ts as string), 1, 19) as sztime, concat('10.0.1.', cast(user_id % 20 as string)) as loginip, "
                  "event_id from @events where event_type = 'signup'")


@query
def login_preview(fx):
    return io.preview(_logins(fx).orderBy("sztime", "event_id"), 100).drop("event_id")


__all__ = ["all_queries", "REGISTRY"]
