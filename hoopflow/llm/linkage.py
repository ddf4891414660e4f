"""Matching entities across sources without keys: decisions about names and players of the box score.

Heuristic matching functions vote on each candidate pair (spelling, shirt number, club, former club, season, the confirmed or
refused name, remarks); the label model explains the votes by an unseen match and gives each pair a confidence, which is shared out
among a decision's candidates because a decision means one person at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoopflow.llm import names


def matches(box: DataFrame, table: DataFrame, clubs: DataFrame, players: DataFrame | None = None) -> DataFrame:
    """decision_id, player_id, confidence: every registration of the person a decision most likely means.

    Pairs of less than an even chance are no matches, so of several equally likely persons none is one. Empty tables and decisions
    without a usable name give no rows; equal rows give one.
    """
    label, _, attached, _ = names.linked(box, table, clubs, players)
    return attached.join(label, "person").select("decision_id", F.col("pid").alias("player_id"), "confidence").distinct()
