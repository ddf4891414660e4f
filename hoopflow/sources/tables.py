"""File sources: text CSV for merging, increments with a strict header check, schedules, the player map and recorded decisions."""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoopflow.operators.features import STATS

#: The columns of the project's files, in order.
BOX = [
    "game_player_id", "game_id", "game", "round", "phase", "season_code", "player_id", "is_starter", "is_playing", "team_id", "dorsal", "player", "minutes",
    *STATS, "valuation", "plus_minus",
]
HEADER = [
    "game_id", "game", "date", "time", "round", "phase", "season_code", "score_a", "score_b", "team_a", "team_b", "team_id_a", "team_id_b", "coach_a", "coach_b",
    "game_time", "remaining_partial_time", "referee_1", "referee_2", "referee_3", "stadium", "capacity", "w_id", "fouls_a", "fouls_b", "timeouts_a", "timeouts_b",
    *[f"score_quarter_{q}_{s}" for q in range(1, 5) for s in "ab"], *[f"score_extra_time_{q}_{s}" for q in range(1, 5) for s in "ab"],
]
MAP = ["stats_team", "stats_name", "team", "name", "variants", "match_status", "matched_by", "notes"]
TEXT = {"game_player_id", "game_id", "game", "phase", "season_code", "player_id", "team_id", "dorsal", "player", "minutes"}
BOX_TYPED = T.StructType([T.StructField(c, T.StringType() if c in TEXT else T.IntegerType()) for c in BOX])


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_text(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """A CSV with every value as written, in file order by ``_file`` and ``_at``. A header with other names or another order is an error."""
    reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").schema(text_schema(columns))
    return reader.csv(path).select("*", F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_at"))


def read_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)


def file_header(path: Path) -> list[str]:
    with path.open(newline="", encoding="utf-8") as f:
        return next(csv.reader(f))


def delta_files(folder: str) -> list[Path]:
    """Increments in the order of their names, which carry the time they were written."""
    found = sorted(Path(folder).glob("*_delta_*.csv"))
    if not found:
        raise FileNotFoundError(f"no increments in {folder}")
    return found


def read_deltas(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    """All increments; each must have exactly the columns of the history, or of the first increment if there is none."""
    files = delta_files(folder)
    columns = columns or file_header(files[0])
    for f in files:
        if (own := file_header(f)) != columns:
            raise ValueError(f"{f.name}: columns {own} differ from {columns}")
    return read_text(spark, [str(f) for f in files], columns)


def read_schedules(spark: SparkSession, folder: str) -> DataFrame:
    files = sorted(Path(folder).glob("schedule_*.csv"))
    if not files:
        raise FileNotFoundError(f"no schedules in {folder}")
    frames = [read_text(spark, str(f), file_header(f)).drop("_file", "_at") for f in files]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.withColumn("gameday", F.col("gameday").cast("int"))


def read_map(spark: SparkSession, path: str) -> DataFrame:
    return read_typed(spark, path, text_schema(MAP)).withColumn("variants", F.split("variants", r" \| "))


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """Recorded decisions; of several about one player the last counts. A file that isn't there gives none."""
    one = "struct<match_status: string, name: string, notes: string, stats_name: string, stats_team: string>"
    if not Path(path).exists():
        return spark.createDataFrame([], "stats_team string, stats_name string, match_status string, name string, notes string")
    rows = spark.read.option("multiLine", True).schema(f"decisions array<{one}>").json(path).select(F.posexplode("decisions").alias("at", "d"))
    last = rows.groupBy("d.stats_team", "d.stats_name").agg(F.max_by("d", "at").alias("d"))
    return last.select("d.stats_team", "d.stats_name", "d.match_status", "d.name", "d.notes")
