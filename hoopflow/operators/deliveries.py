"""Exactly one copy of each message in a batch: the earliest delivery wins, then the smallest delivery number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoopflow.functions.ids import BLANKS, key_part, message_key


def never() -> Column:
    """The time of a delivery without a loading time: after all that have one."""
    return F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")


def arrival(loaded_at: str = "loaded_at", delivery_id: str = "delivery_id") -> Column:
    """What decides which copy stays; the smallest is the first."""
    return F.struct(F.coalesce(F.col(loaded_at).cast("timestamp_ntz"), never()).alias("at"), F.col(delivery_id).alias("id"))


def is_total(code: Column, dorsal: Column, game: Column) -> Column:
    """Club rows: marked TOTAL, or, where the mark is missing, carrying one of the game's two club codes instead of a player."""
    clubs = F.concat(F.lit("-"), F.upper(F.translate(game, BLANKS, "")), F.lit("-"))
    return F.coalesce((F.upper(F.trim(dorsal)) == "TOTAL") | F.contains(clubs, F.concat(F.lit("-"), code, F.lit("-"))), F.lit(False))


def first_deliveries(box: DataFrame, *keep: str) -> DataFrame:
    """One row per message with the columns ``keep`` of its first delivery.

    Rows whose identifier is null belong to no message and are left out; an empty table gives an empty result. The
    aggregate combines on the map side, so copies of one message meet as one partial row per task.
    """
    key = message_key(F.col("game_player_id"))
    return (
        box.where(F.col("game_player_id").isNotNull())
        .groupBy(key.alias("message"))
        .agg(F.min_by(F.struct(*keep), arrival()).alias("first"))
        .select("message", *[F.col("first")[k].alias(k) for k in keep])
    )


def player_messages(box: DataFrame, *keep: str) -> DataFrame:
    """First deliveries of player rows, with the player's code taken from the message (so a null ``player_id`` loses nothing)."""
    want = list(dict.fromkeys([*keep, "dorsal", "game"]))
    got = first_deliveries(box, *want).withColumn("player_code", key_part(F.col("message"), 3))
    return got.where(~is_total(F.col("player_code"), F.col("dorsal"), F.col("game")))
