"""Canonical forms of dirty identifiers, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks that untidy identifiers contain.
BLANKS = " \t\n\x0b\f\r\u00a0\u200b\ufeff"
#: season, game number and, for messages, the player or club, with anything that is no letter or digit between them
GAME = r"^([A-Z]+[0-9]+)[^A-Z0-9]+0*([0-9]+)$"
MESSAGE = r"^([A-Z]+[0-9]+)[^A-Z0-9]+0*([0-9]+)[^A-Z0-9]+(.+)$"


def _bare(c: Column) -> Column:
    return F.upper(F.translate(c, BLANKS, ""))


def game_key(c: Column) -> Column:
    """``E2020-018``, ``e2020_0018`` and `` E2020_18 `` are one game; text of another form stands for itself, null stays null."""
    return F.regexp_replace(_bare(c), GAME, "$1_$2")


def message_key(c: Column) -> Column:
    """The message an identifier names: season, game number and player or club, however written."""
    return F.regexp_replace(_bare(c), MESSAGE, "$1_$2_$3")


def key_part(key: Column, n: int) -> Column:
    """Part 1 (season), 2 (game number) or 3 (player or club) of a message key; null where the key has no such part."""
    return F.get(F.split(key, "_", 3), F.lit(n - 1))


def season_of(key: Column) -> Column:
    return key_part(key, 1)


def reference(c: Column) -> Column:
    """A reference as it is compared: case and outer blanks ignored; null, blank and ``-`` are no references."""
    b = F.lower(F.regexp_replace(c, r"^[\s\u00a0]+|[\s\u00a0]+$", ""))
    return F.when((b != "") & (b != "-"), b)
