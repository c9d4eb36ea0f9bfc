"""Running computations per key, spread however much of the data one key holds.

Every key is cut at some of its own positions in the order column: a row whose (key, position)
hashes to 0 modulo `rows` is a cut, so a piece has about `rows` positions whatever their values
are, and usual keys have no cut at all.  Windows run per (key, piece) after one exchange; for
keys with cuts a small table of what each piece holds says what a piece inherits from those before
or after it.  The plan is the same for all keys and sizes and no job runs while it is built.

The cuts are broadcast: of more than `MOST_CUTS` only those of least hash count, so the table is
bounded by construction and pieces grow beyond `rows` only then (4 million rows for 10^12).

The order column is a number; rows of a key that share its value stay in one piece.  Null keys
are a group that is not cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS = 1 << 20
MOST_CUTS = 1 << 18
GROUP = 1 << 9

BEFORE = (Window.unboundedPreceding, -1)
PAST = (Window.unboundedPreceding, Window.currentRow)
WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)


def find_cuts(df: DataFrame, keys: list[str], order: str, rows: int = ROWS) -> DataFrame:
    """The keys with cuts and these, ascending, as `_cuts`."""
    mark = F.xxhash64(*keys, order)
    found = df.where(F.col(order).isNotNull() & (F.pmod(mark, F.lit(rows)) == 0)).select(*keys, order).distinct()
    kept = found.orderBy(F.pmod(F.floor(mark / rows), F.lit(1 << 40)), mark).limit(MOST_CUTS)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list(order)).alias("_cuts"))


def piece(order: str) -> Column:
    """How many of `_cuts` lie below a row's position, by halving steps; 0 without cuts."""
    def step(at: Column, width: Column) -> Column:
        return F.when(F.get("_cuts", at + width - 1) < F.col(order), at + width).otherwise(at)

    steps = F.array(*[F.lit(1 << i) for i in range(MOST_CUTS.bit_length() - 1, -1, -1)])
    return F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), step))


def cut(df: DataFrame, cuts: DataFrame, keys: list[str], order: str, how: str = "left") -> DataFrame:
    """df with `_c`, the piece a row lies in; how='inner' keeps the keys with cuts only.

    A row meets the last cut of every group of `GROUP` cuts, and then the cuts of its own group:
    a joined row carries its list, so it must not carry all cuts of its key.
    """
    groups = cuts.select(*keys, F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_cuts") - 1) / GROUP).cast("int")),
        lambda g: F.slice("_cuts", g * GROUP + 1, GROUP)).alias("_groups"))
    lasts = groups.select(*keys, F.transform(F.slice("_groups", F.lit(1), F.size("_groups") - 1), F.array_max).alias("_cuts"))
    within = groups.select(*keys, F.posexplode("_groups").alias("_g", "_cuts"))
    placed = df.join(F.broadcast(lasts), keys, how).withColumn("_g", piece(order)).drop("_cuts")
    return placed.join(F.broadcast(within), [*keys, "_g"], "left").withColumn("_c", F.col("_g") * GROUP + piece(order)).drop("_cuts", "_g")


def _inherit(df: DataFrame, cuts: DataFrame, keys: list[str], order: str, marked: DataFrame, aggs: list[Column], carried: dict[str, Column]) -> DataFrame:
    """df, dealt by (key, piece), with what pieces of cut keys inherit; nulls for the others.

    `marked` is what the pieces are summed up from.  There are two pieces per cut at most.
    """
    summary = cut(marked, cuts, keys, order, "inner").groupBy(*keys, "_c").agg(*aggs)
    carry = summary.select(*keys, "_c", *[c.alias(n) for n, c in carried.items()])
    return cut(df, cuts, keys, order).repartition(*keys, "_c").join(F.broadcast(carry), [*keys, "_c"], "left")


def fill(df: DataFrame, keys: list[str], order: str, cols: dict[str, str | None], rows: int = ROWS) -> DataFrame:
    """Fill nulls with the last earlier value; what is left with a later one.

    cols: per column None (forward only), 'first' (the nearest later value) or 'last' (the key's last).

    A row without an earlier value has all of the key's values after it, so the nearest
    later value is the key's first and the last later value is the key's last: one pass
    over the whole partition, where a frame from the current row on would take n passes.
    """
    if not set(cols.values()) <= {None, "first", "last"}:
        raise ValueError("the way back is None, 'first' or 'last'")
    by_piece = Window.partitionBy(*keys).orderBy("_c")
    local = Window.partitionBy(*keys, "_c").orderBy(order)
    aggs, carried, value = [], {}, {}
    for c, back in cols.items():
        known = F.when(F.col(c).isNotNull(), F.col(order))
        aggs.append(F.max_by(c, known).alias(f"_last_{c}"))
        carried[f"_p_{c}"] = F.last(f"_last_{c}", True).over(by_piece.rowsBetween(*BEFORE))
        picks = [F.last(c, True).over(local.rowsBetween(*PAST)), F.col(f"_p_{c}")]
        if back:
            pick = F.first if back == "first" else F.last
            if back == "first":
                aggs.append(F.min_by(c, known).alias(f"_first_{c}"))
            carried[f"_a_{c}"] = pick(f"_{back}_{c}", True).over(by_piece.rowsBetween(*WHOLE))
            picks += [F.col(f"_a_{c}"), pick(c, True).over(local.rowsBetween(*WHOLE))]
        value[c] = F.coalesce(*picks).alias(c)
    joined = _inherit(df, find_cuts(df, keys, order, rows), keys, order, df, aggs, carried)
    return joined.select(*[value.get(c, F.col(c)) for c in df.columns])


def renumber(df: DataFrame, keys: list[str], order: str, ties: list[Column], name: str = "rn", rows: int = ROWS) -> DataFrame:
    """Row number per key by the order column, then by `ties`."""
    before = F.sum("_rows").over(Window.partitionBy(*keys).orderBy("_c").rowsBetween(*BEFORE))
    joined = _inherit(df, find_cuts(df, keys, order, rows), keys, order, df, [F.count(F.lit(1)).alias("_rows")], {"_p": before})
    local = Window.partitionBy(*keys, "_c").orderBy(order, *ties)
    return joined.select(*df.columns, (F.row_number().over(local) + F.coalesce("_p", F.lit(0))).cast("bigint").alias(name))


def running_distinct(df: DataFrame, keys: list[str], order: str, col: str, name: str = "n_distinct", rows: int = ROWS) -> DataFrame:
    """How many different values of a column the key has shown up to and with this row.

    Nulls do not count; rows of equal position agree (range frame).  The first row of each value in a
    piece is marked, those that an earlier piece had are unmarked, and the marks are summed.
    """
    cuts = find_cuts(df, keys, order, rows)
    values = cut(df.where(F.col(col).isNotNull()), cuts, keys, order, "inner").select(*keys, "_c", col).distinct()
    earlier = F.row_number().over(Window.partitionBy(*keys, col).orderBy("_c"))
    turns = values.withColumn("_turn", earlier)
    fresh = turns.groupBy(*keys, "_c").agg(F.count_if(F.col("_turn") == 1).alias("_fresh"))
    before = F.sum("_fresh").over(Window.partitionBy(*keys).orderBy("_c").rowsBetween(*BEFORE))
    carry = fresh.select(*keys, "_c", before.alias("_p"))
    again = turns.where("_turn > 1").select(*keys, "_c", col, F.lit(True).alias("_again"))
    dealt = cut(df, cuts, keys, order).repartition(*keys, "_c")
    joined = dealt.join(F.broadcast(carry), [*keys, "_c"], "left").join(again, [*keys, "_c", col], "left")
    first = F.row_number().over(Window.partitionBy(*keys, "_c", col).orderBy(order)) == 1
    new = F.col(col).isNotNull() & F.col("_again").isNull() & first
    local = Window.partitionBy(*keys, "_c").orderBy(order)
    return joined.withColumn("_new", new.cast("int")).select(
        *df.columns, (F.sum("_new").over(local) + F.coalesce("_p", F.lit(0))).cast("bigint").alias(name))


def total_over(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """The key's total on each of its rows: summed map-side, then joined back."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias(name))
    return df.join(totals, keys)
