"""Readers and writers: partitioned tables, path reads, marts."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehouse.sources import files


def check_day(dt: str) -> str:
    """The text itself if it names a calendar day as the partitions do."""
    if date.fromisoformat(dt).isoformat() != dt:
        raise ValueError(f"not a day: {dt!r}")
    return dt


def check_name(name: str) -> str:
    if not (name.isascii() and name.isidentifier()):
        raise ValueError(f"not a name: {name!r}")
    return name


def partition_spec(text: str, columns: Collection[str] | None = None) -> dict[str, str]:
    """'dt=2024-01-30,region=sg' to a mapping.  A `dt` has to be a day, other values letters,
    digits and - _ : . only; with `columns` the names have to be among them."""
    spec = {}
    for item in text.split(",") if text.strip() else []:
        name, _, value = (x.strip() for x in item.partition("="))
        if columns is not None and name not in columns:
            raise ValueError(f"no partition column {name!r} among {sorted(columns)}")
        if not value or set(value) - {c for c in value if c.isalnum() or c in "-_:."}:
            raise ValueError(f"not a partition value: {item!r}")
        spec[check_name(name)] = check_day(value) if name == "dt" else value
    return spec


# ---- readers -------------------------------------------------------------------------


def increment(df: DataFrame, dt: str) -> DataFrame:
    """Rows of one day's partition."""
    return df.where(F.col("dt") == check_day(dt))


def day_range(df: DataFrame, first: str, last: str, open_below: bool = False) -> DataFrame:
    low = F.col("dt") > check_day(first) if open_below else F.col("dt") >= check_day(first)
    return df.where(low & (F.col("dt") <= check_day(last)))


def snapshots(df: DataFrame, dt: str) -> tuple[DataFrame, DataFrame]:
    """The snapshot of a day and that of the day before."""
    before = F.date_sub(F.to_date(F.lit(check_day(dt))), 1).cast("string")
    return increment(df, dt), df.where(F.col("dt") == before)


def read_table(spark: SparkSession, path: str, columns: str | None = None, only: list[str] | None = None) -> DataFrame:
    """A partitioned parquet folder; `dt` stays text.  A declared schema saves reading footers.

    only: paths of folders or files below it, to read these; they need not show the type of `dt`, a schema does."""
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    reader = spark.read.schema(columns) if columns else spark.read
    return reader.option("basePath", path).parquet(*only) if only else reader.parquet(path)


def read_path(spark: SparkSession, path: str, spec: str = "", limit: int | None = None) -> DataFrame:
    df = read_table(spark, path)
    for key, value in partition_spec(spec, df.columns).items():
        df = df.where(F.col(key) == value)
    return df if not limit else df.limit(limit)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def read_csv(spark: SparkSession, paths: list[str], columns: list[str], header: list[str] | None = None) -> DataFrame:
    """Some columns of CSV files as text.  header: all columns of the files, if they are known;
    otherwise the header line of the first file names them."""
    reader = spark.read.option("header", "true")
    if header:
        reader = reader.schema(", ".join(f"`{c}` string" for c in header)).option("enforceSchema", "false")
    return reader.csv(paths).select(*columns)


def read_sql(spark: SparkSession, options: dict[str, str], query: str, partition: dict | None = None) -> DataFrame:
    """A query pushed to a JDBC source.  partition: column, lower, upper, count for parallel reads."""
    reader = spark.read.format("jdbc").options(**options)
    if partition:
        return reader.options(
            dbtable=f"({query}) q", partitionColumn=partition["column"], lowerBound=partition["lower"],
            upperBound=partition["upper"], numPartitions=partition["count"]).load()
    return reader.option("query", query).load()


def read_packed(spark: SparkSession, path: str, n_cards: int, split: int = files.SPLIT) -> DataFrame:
    """Files of big-endian 64-bit words, one file per hand, to (hand_key, word, cards, rate).

    The file name is the hand key.  Files are read by byte ranges, see `files.read_words`.
    """
    from tablehouse.functions.cards import unpack

    cards, rate = unpack(F.col("word"), n_cards)
    return files.read_words(spark, path, split).select(
        F.col("name").alias("hand_key"), "word", cards.alias("cards"), rate.alias("rate"))


def write_packed(rows: DataFrame, path: str) -> DataFrame:
    """(hand_key, word) rows to a file per hand key, as `read_packed` reads them."""
    return files.write_words(rows.select(F.col("hand_key").alias("name"), "word"), path)


def write_packed_rows(rates: DataFrame, n_cards: int, board: str = "board", rate: str = "rate") -> DataFrame:
    """(hand_key, board, rate) to (hand_key, word), the inverse of `read_packed`'s decoding."""
    from tablehouse.functions.cards import pack

    return rates.select("hand_key", pack(F.array_sort(board), F.col(rate), n_cards).alias("word"))


# ---- writers -------------------------------------------------------------------------


def overwrite_days(df: DataFrame, path: str, partitions: tuple[str, ...] = ("dt",)) -> None:
    """Replace exactly the partitions the rows belong to; others stay.

    Rows are gathered by partition before writing so that a day is not scattered over as
    many files as there are tasks; adaptive execution splits a large day again.
    """
    df.hint("rebalance", *partitions).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def replace_day(df: DataFrame, path: str, dt: str, defaults: dict | None = None) -> None:
    """Delete-then-insert of one day in a mart, as one partition overwrite.

    A day without rows must be emptied too, which a dynamic overwrite would not do.
    """
    rows = publish_defaults(df.drop("dt"), defaults or {})
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/dt={check_day(dt)}")


def merge(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert: rows of `changes` replace rows of `current` with the same key."""
    return current.join(changes.select(*keys), keys, "left_anti").select(*current.columns).unionByName(
        changes.select(*current.columns))


def publish_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.na.fill(defaults) if defaults else df


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def insert_by_name(df: DataFrame, table: str) -> None:
    """Insert into a catalog table by column name, replacing the partitions concerned."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)


def ddl(table: str, columns: dict[str, str], partitions: tuple[str, ...] = ("dt",), location: str | None = None) -> str:
    """CREATE TABLE text of a partitioned parquet table."""
    for name in [*table.split("."), *columns, *partitions]:
        check_name(name)
    cols = ", ".join(f"`{c}` {t}" for c, t in {**columns, **{p: columns.get(p, "string") for p in partitions}}.items())
    where = f" LOCATION '{location}'" if location else ""
    by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    return f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet{by}{where}"


def create_table(spark: SparkSession, table: str, columns: dict[str, str], **kw) -> None:
    spark.sql(ddl(table, columns, **kw))


def write_bucketed(df: DataFrame, table: str, path: str, by: tuple[str, ...], buckets: int, partitions: tuple[str, ...] = ("dt",)) -> DataFrame:
    """A catalog table by day whose rows lie in `buckets` by a hash of `by`, sorted: joins and groups on those columns need no exchange."""
    for name in [*table.split("."), *by, *partitions]:
        check_name(name)
    df.repartition(buckets, *by).write.mode("overwrite").option("path", path).option("partitionOverwriteMode", "static").partitionBy(
        *partitions).bucketBy(buckets, *by).sortBy(*by).saveAsTable(table)
    return df.sparkSession.table(table)


def drop_partition(spark: SparkSession, table: str, spec: str) -> None:
    where = ", ".join(f"`{k}` = '{v}'" for k, v in partition_spec(spec).items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({where})")


def write_jdbc(df: DataFrame, options: dict[str, str], table: str, batch: int = 1000, mode: str = "append") -> None:
    """Parallel batched insert; overwriting keeps the target's definition."""
    df.write.format("jdbc").options(**options).option("dbtable", table).option("batchsize", batch).option(
        "truncate", "true").mode(mode).save()


def sync_table(df: DataFrame, target: str, spec: str = "", mode: str = "overwrite",
               use_latest: bool = False) -> None:
    """Copy a table, one of its partitions or its latest partition to a parquet mart.

    With a partition the rest of the target stays; without, overwriting replaces it all.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("mode is 'overwrite' or 'append'")
    rows = df
    if use_latest:
        newest = df.agg(F.max("dt")).first()[0]  # as a literal it prunes the partitions read below
        rows = df.where(F.col("dt") == F.lit(newest))
    for key, value in partition_spec(spec, df.columns).items():
        rows = rows.where(F.col(key) == value)
    if "dt" not in df.columns:
        rows.write.mode(mode).parquet(target)
    elif mode == "append":
        rows.hint("rebalance", "dt").write.mode("append").partitionBy("dt").parquet(target)
    elif spec or use_latest:
        overwrite_days(rows, target)
    else:
        rows.hint("rebalance", "dt").write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("dt").parquet(target)
