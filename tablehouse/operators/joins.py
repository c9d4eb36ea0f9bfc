"""Join shapes used by the jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehouse.operators import scans


def semi(df: DataFrame, keys_of: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of df whose key occurs in the other frame."""
    return df.join(keys_of.select(*keys), keys, "left_semi")


def anti(df: DataFrame, keys_of: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of df whose key does not occur in the other frame."""
    return df.join(keys_of.select(*keys), keys, "left_anti")


def both(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys that occur in both frames."""
    return a.select(*keys).intersect(b.select(*keys))


def star(base: DataFrame, dims: list[DataFrame], keys: list[str]) -> DataFrame:
    """Base rows with the columns of each dimension, null where it has no row."""
    return reduce(lambda left, dim: left.join(dim, keys, "left"), dims, base)


def full(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """All keys of all frames; the key columns hold whichever side has them."""
    return reduce(lambda left, right: left.join(right, keys, "full"), frames)


def pairs(df: DataFrame, keys: list[str], id_col: str, cols: list[str], block: int = 1024) -> DataFrame:
    """Pairs of rows of one key with a smaller and a greater id, as `<col>_1`, `<col>_2`.

    Every key is cut into blocks of about `block` rows at hashes of its own ids (see `scans`),
    one block for nearly all usual keys, and each pair of blocks is a join key of its own (`_i`, `_j`, which
    follow from the ids), so no task holds a whole hot key.  A row of a key of n rows is copied n / block
    times per side, against the n / 2 pairs it gives.  The result is distributed by `keys`, `_i`, `_j`.
    """
    rows = df.select(*keys, id_col, *cols).withColumn("_h", F.xxhash64(id_col))
    cuts = scans.find_cuts(rows, keys, "_h", block)
    tagged = rows.join(F.broadcast(cuts), keys, "left").select(
        *keys, id_col, *cols, scans.piece("_h").alias("_b"), F.sequence(F.lit(0), F.coalesce(F.size("_cuts"), F.lit(0))).alias("_all"))

    def blocks(own: str, other: str, suffix: str) -> DataFrame:
        side = tagged.select(*keys, id_col, *cols, F.col("_b").alias(own), F.explode("_all").alias(other))
        side = side.withColumnsRenamed({c: f"{c}_{suffix}" for c in [id_col, *cols]})
        return side.repartition(*keys, "_i", "_j")

    return blocks("_i", "_j", "1").join(blocks("_j", "_i", "2"), [*keys, "_i", "_j"]).where(
        F.col(f"{id_col}_1") < F.col(f"{id_col}_2"))
