"""Hand logs and deal logs: JSON text to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehouse.functions.exprs import HAND, day_of, pick_col

SEATS = "array<struct<nPlayerId: string, seat: string>>"

# fixed values: JSON fields of a deal-log line and the column each becomes
DEAL_FIELDS = {
    "szToken": "sztoken", "nround": "nround", "gametype": "ngametype", "smallblind": "smallblind",
    "nplayerid": "nplayerid", "seat": "seat", "score": "startscore", "brobot": "brobot",
    "cards": "handcards", "commoncards": "commoncards", "bPreset": "bpreset",
    "inventionType": "inventiontype", "presetType": "presettype", "redisScore": "redisscore",
}


def explode_log(ods: DataFrame) -> DataFrame:
    """One row per message of each hand log.

    `carddata` is the message with its position injected as `json_index`; `name`,
    `data` (JSON text) and `json_index` are also given as columns so that later jobs
    need not parse it again.  Elements that are not objects are dropped but keep their
    position; logs that are not JSON give no rows (`rejected` has them).  Of a key that a
    message repeats, the last value counts; a `json_index` of its own gives way to the position.
    """
    elements = ods.select(
        "id",
        pick_col(ods, "ngametype", "gametype").alias("gametype"),
        pick_col(ods, "nplayerid", "playerid").alias("playerid"),
        "sztoken", "nround",
        pick_col(ods, "nwinscore", "winscore").alias("winscore"),
        pick_col(ods, "nscore", "score").alias("score"),
        "sztitle", "szhandcard", "szcarddata", "createtime", "dt",
        F.posexplode(F.from_json("szcarddata", "array<string>")).alias("json_index", "element"),
    ).where(F.substring(F.trim("element"), 1, 1) == "{")
    index = F.struct(F.lit("json_index").alias("key"), F.col("json_index").cast("string").alias("value"))
    parsed = elements.withColumn("entries", F.map_entries(F.from_json("element", "map<string, string>")))
    later = lambda x, i: F.exists(F.slice("entries", i + 2, F.size("entries")), lambda y: y["key"] == x["key"])
    parsed = parsed.withColumn("fields", F.filter("entries", lambda x, i: (x["key"] != "json_index") & ~later(x, i)))
    last = lambda key: F.try_element_at(F.filter("fields", lambda x: x["key"] == key), F.lit(1))["value"]
    return parsed.select(
        "id", "gametype", "playerid", "sztoken", "nround", "winscore", "score", "sztitle",
        "szhandcard", "szcarddata",
        F.to_json(F.map_from_entries(F.concat("fields", F.array(index)))).alias("carddata"), "json_index",
        last("name").alias("name"), last("data").alias("data"), "createtime", "dt",
    )


def rejected(ods: DataFrame) -> DataFrame:
    """Logs that `explode_log` can't use (null position), and their elements that are no objects."""
    elements = F.from_json("szcarddata", "array<string>")
    rows = ods.select("id", "dt", F.posexplode_outer(F.when(F.size(elements) > 0, elements)).alias("json_index", "element"), "szcarddata")
    good = F.coalesce(F.substring(F.trim("element"), 1, 1) == "{", F.lit(False))
    empty = F.col("json_index").isNull() & F.coalesce(F.size(F.from_json("szcarddata", "array<string>")) == 0, F.lit(False))
    return rows.where(~good & ~empty).select("id", "dt", "json_index", F.coalesce("element", "szcarddata").alias("rejected"))


def messages(dwd: DataFrame) -> DataFrame:
    """Message rows with `json_index`, `name` and `data`, parsed from `carddata` if need be."""
    if {"json_index", "name", "data"} <= set(dwd.columns):
        return dwd
    parsed = F.from_json("carddata", "name string, data string, json_index int")
    return dwd.withColumn("_m", parsed).select(
        "*", F.col("_m.json_index"), F.col("_m.name"), F.col("_m.data")
    ).drop("_m")


def seat_info(dwd: DataFrame) -> DataFrame:
    """Players seated per hand, from `SeatInfos` messages (a list, or a list under `data`)."""
    rows = messages(dwd).where(
        (F.col("name") == "SeatInfos") & (pick_col(dwd, "playerid", "nplayerid") != 0)
    )
    bare = F.substring("data", 1, 1) == "["
    listed = F.when(bare, F.col("data")).otherwise(F.get_json_object("data", "$.data"))
    return (
        rows.select(
            day_of(pick_col(dwd, "createtime")).alias("createdate"), "sztoken", "nround",
            pick_col(dwd, "gametype", "ngametype").alias("gametype"), "dt",
            F.explode(F.from_json(listed, SEATS)).alias("s"),
        )
        .select("createdate", "sztoken", "nround", "gametype",
                F.col("s.nPlayerId").alias("playerid"), F.col("s.seat").alias("seat"), "dt")
        .where("playerid is not null and seat is not null")
        # spread by hand, as the later join needs it; the de-duplication keeps that
        .repartition(*HAND)
        .dropDuplicates()
    )


def robot_info(dwd: DataFrame, user: DataFrame) -> DataFrame:
    """Model version per recorded robot hand with the user's robot flag of that day."""
    versions = messages(dwd).where(F.col("name") == "ModelVer").select(
        pick_col(dwd, "playerid", "nplayerid").alias("playerid"), "sztoken", "nround",
        F.get_json_object("data", "$.modelVersion").alias("robotversion"), "dt",
    )
    flags = user.select(F.col("nplayerid").alias("playerid"), "dt", "brobot")
    return versions.join(flags, ["playerid", "dt"]).select(
        "playerid", "sztoken", "nround", "robotversion", "brobot", "dt"
    )


def card_preset(lines: DataFrame) -> DataFrame:
    """Deal-log JSON lines to text columns; one parse per line."""
    schema = ", ".join(f"`{f}` string" for f in DEAL_FIELDS)
    parsed = lines.select(F.from_json("tstr", schema).alias("j"), "dt")
    return parsed.select(*[F.col(f"j.`{f}`").alias(c) for f, c in DEAL_FIELDS.items()], "dt")


def flatten_deals(deals: DataFrame, default_score: float = 0.0) -> DataFrame:
    """One row per seated player of a deal.

    `users` and `handcards` are lists of structs on the same row, so each player's cards
    are picked in place and nothing is shuffled.  No cards give an empty list.
    """
    rows = deals.select("*", F.explode("users").alias("u"))
    own = F.filter("handcards", lambda h: h["nplayerid"] == F.col("u.nplayerid"))
    own = F.try_element_at(own, F.lit(-1))
    cards_type = deals.schema["handcards"].dataType.elementType["cards"].dataType.simpleString()
    score = F.lit(default_score)
    if "scores" in deals.columns:
        score = F.coalesce(F.try_element_at("scores", F.col("u.nplayerid")), score)
    return rows.select(
        "sztoken", "nround", "gametype", "smallblind",
        F.col("u.nplayerid").alias("nplayerid"), F.col("u.seat").alias("seat"),
        F.col("u.score").alias("score"), F.col("u.brobot").alias("brobot"),
        F.coalesce(own["cards"], F.array().cast(cards_type)).alias("cards"),
        "commoncards", F.coalesce("bpreset", F.lit(False)).alias("bpreset"), "inventiontype",
        own["presettype"].alias("presettype"), score.alias("redisscore"), "dt",
    )


def deal_lines(rows: DataFrame) -> DataFrame:
    """The rows of `flatten_deals` as log lines, inverse of `card_preset`."""
    names = {c: f for f, c in DEAL_FIELDS.items()} | {"score": "score", "cards": "cards", "gametype": "gametype"}
    fields = [F.col(c).alias(names.get(c, c)) for c in rows.columns if c != "dt"]
    return rows.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("tstr"), "dt")


__all__ = ["HAND", "explode_log", "rejected", "messages", "seat_info", "robot_info", "card_preset",
           "flatten_deals", "deal_lines"]
