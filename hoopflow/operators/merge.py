"""Merging history and increments: the increments rule the seasons they cover."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def only_season(base: DataFrame, season: str | None) -> DataFrame:
    """The history of one season, or all of it; asking for a season that isn't there is an error."""
    if season is None:
        return base
    rows = base.where(F.col("season_code") == season)
    if rows.isEmpty():
        raise ValueError(f"the history has no rows of season {season!r}")
    return rows


def uncovered(base: DataFrame, deltas: DataFrame) -> DataFrame:
    """History of the seasons that no increment touches (one increment row hides the whole season)."""
    seasons = deltas.select("season_code").distinct()
    return base.join(seasons, "season_code", "left_anti").select(base.columns)


def merge(base: DataFrame | None, deltas: DataFrame, season: str | None = None) -> DataFrame:
    """History first, then increments. Both need the same columns in the same order, or the schema has drifted."""
    if base is None:
        return deltas
    if base.columns != deltas.columns:
        raise ValueError(f"columns differ: {base.columns} and {deltas.columns}")
    return uncovered(only_season(base, season), deltas).unionByName(deltas)


def lowest_rank(df: DataFrame, key: list[str], rank: str = "rank", order: tuple[str, ...] = ()) -> DataFrame:
    """One row per key: the lowest rank, then the first by ``order``. Null ranks come last."""
    at = Window.partitionBy(*key).orderBy(F.col(rank).cast("long").asc_nulls_last(), *order)
    return df.withColumn("_n", F.row_number().over(at)).where("_n = 1").drop("_n")
