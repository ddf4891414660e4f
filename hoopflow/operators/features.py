"""Form indicators of players, grades of teams by position, the next round and the sheets made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoopflow.functions.text import minutes_number, pad3
from hoopflow.operators.entity import resolve_players, with_club

SLOW, FAST = 5, 3
POSITIONS = ("C", "F", "G")
PLAYER = ["player_normalized", "team_id", "position"]

#: The columns of the box score's figures, of the sheets, and the indicators' names.
STATS = [
    "points", "two_points_made", "two_points_attempted", "three_points_made", "three_points_attempted", "free_throws_made", "free_throws_attempted",
    "offensive_rebounds", "defensive_rebounds", "total_rebounds", "assists", "steals", "turnovers", "blocks_favour", "blocks_against", "fouls_committed", "fouls_received",
]
BOXSCORE = [
    "season_code", "year", "game_player_id", "game_id", "player_id", "phase", "round", "game", "team_id", "opponent", "homeaway", "position", "dorsal", "player",
    "player_normalized", "quotation", "valuation", "is_starter", "is_playing", "minutes", "minutes_num", *STATS, "plus_minus",
]
RECORD = [
    "player", "team", "position", "turn", "venue", "opponent", "crd_last", "normd_pstn_pir", "exp_pir", "pir_mean", "pir_per_crd", "pir_breakeven", "pir_per_min",
    "pir_last", "pir_lag1", "pir_lag2", "pir_std", "pir_p10", "pir_p50", "pir_p75", "pir_p90", "pir_slow", "pir_fast", "pir_trend",
    "mins_mean", "mins_std", "mins_slow", "mins_fast", "mins_trend",
]


def position_letter(c: Column) -> Column:
    return F.when(c == "Guard", "G").when(c == "Forward", "F").when(c == "Center", "C")


def prepare_boxscore(box: DataFrame, year: int) -> DataFrame:
    """Player rows from a season year on, with year, minutes as a number, opponent and venue. Blank minutes are 0."""
    home, away = F.split_part("game", F.lit("-"), F.lit(1)), F.split_part("game", F.lit("-"), F.lit(2))
    at_home = F.col("team_id") == home
    return (
        box.withColumn("year", F.regexp_replace("season_code", "^[A-Za-z]+", "").try_cast("int"))
        .where((F.col("year") >= year) & (F.coalesce(F.col("dorsal"), F.lit("")) != "TOTAL"))
        .withColumn("minutes_num", minutes_number(F.col("minutes")))
        .withColumn("minutes", F.when(F.col("minutes") == "DNP", "0:00").otherwise(F.col("minutes")))
        .withColumn("homeaway", F.when(at_home, "home").otherwise("away"))
        .withColumn("opponent", F.when(at_home, away).otherwise(home))
    )


def name_players(df: DataFrame, entries: DataFrame, lookup: DataFrame) -> DataFrame:
    """Rows whose player the map knows, with the full name."""
    named = resolve_players(with_club(df, "team_id", lookup, "_club"), "player", "_club", entries).drop("_club")
    return named.where("player_normalized is not null")


def drop_counts(prepared: DataFrame, named: DataFrame, joined: DataFrame) -> DataFrame:
    """step, rows, players: what the map and the price list leave out. prepared, named, joined: the rows before, after the map, and after the price list."""
    key = ["game_player_id"]
    lost = prepared.join(named.select(*key), key, "left_anti").select(F.lit("unknown player").alias("step"), F.col("player").alias("p"))
    free = named.join(joined.select(*key).distinct(), key, "left_anti").select(F.lit("no price or position").alias("step"), F.col("player_normalized").alias("p"))
    return lost.unionByName(free).groupBy("step").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("p").alias("players"))


def season_stats(stats: DataFrame, by: list[str]) -> DataFrame:
    """One row per player (and ``by``): the first in price-list order of those with one full name."""
    first = Window.partitionBy(*by, "player_normalized").orderBy("rank", "player_id", "position", "quotation")
    return stats.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def join_stats(df: DataFrame, stats: DataFrame, season_wide: bool, by: tuple[str, ...] = ()) -> DataFrame:
    """Adds position and quotation from the price list, per season or per round; rows without either are dropped.

    stats: by..., player_normalized, position (letter), quotation, round, rank, player_id. Per round, repeated list rows multiply rows.
    """
    keys = [*by, "player_normalized"]
    s = season_stats(stats, list(by)).select(*keys, "position", "quotation") if season_wide else stats.select(*keys, F.col("round").try_cast("int").alias("round"), "position", "quotation")
    return df.join(s, keys if season_wide else [*keys, "round"], "left").where("quotation is not null and position is not null")


def player_kpis(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per player, team and position. One window numbers the games from the last one back; one aggregate does the rest.

    Games are ordered by round, game and message. Nulls are skipped by means and quantiles; one game has no deviation.
    """
    by = by or PLAYER
    back = Window.partitionBy(*by).orderBy(F.desc("round"), F.desc("game_id"), F.desc("game_player_id"))
    d = df.withColumn("_n", F.row_number().over(back))
    v, m = F.col("valuation"), F.col("minutes_num")

    def tail(c: Column, k: int) -> Column:
        return F.when(F.col("_n") <= k, c)

    def last(c: Column) -> Column:
        return F.min_by(c, F.when(c.isNotNull(), F.col("_n")))

    k = d.groupBy(*by).agg(
        last(F.col("quotation")).alias("crd_last"), F.avg(v).alias("pir_mean"), last(v).cast("double").alias("pir_last"),
        F.max(F.when(F.col("_n") == 2, v)).cast("double").alias("pir_lag1"), F.max(F.when(F.col("_n") == 3, v)).cast("double").alias("pir_lag2"), F.stddev_samp(v).alias("pir_std"),
        F.percentile(tail(v, SLOW), F.array(F.lit(0.1), F.lit(0.5), F.lit(0.75), F.lit(0.9))).alias("_q"),
        F.avg(tail(v, SLOW)).alias("pir_slow"), F.avg(tail(v, FAST)).alias("pir_fast"),
        F.avg(m).alias("mins_mean"), F.stddev_samp(m).alias("mins_std"), F.avg(tail(m, SLOW)).alias("mins_slow"), F.avg(tail(m, FAST)).alias("mins_fast"),
    )
    for i, q in enumerate(("pir_p10", "pir_p50", "pir_p75", "pir_p90")):
        k = k.withColumn(q, F.get("_q", F.lit(i)))
    return (
        k.drop("_q")
        .withColumn("pir_per_crd", F.try_divide("pir_mean", "crd_last"))
        .withColumn("pir_breakeven", (F.col("pir_mean") - F.col("crd_last") * 1.1) / 25)
        .withColumn("pir_per_min", F.try_divide("pir_mean", "mins_mean"))
        .withColumn("pir_trend", F.try_divide("pir_fast", "pir_slow"))
        .withColumn("mins_trend", F.try_divide("mins_fast", "mins_slow"))
    )


def fill_empty(record: DataFrame) -> DataFrame:
    """Spreads and the rate per minute become 0, trends 1, lags the player's mean; other empty cells stay."""
    out = record.fillna({"pir_std": 0.0, "mins_std": 0.0, "pir_per_min": 0.0, "pir_trend": 1.0, "mins_trend": 1.0})
    for lag in ("pir_lag1", "pir_lag2"):
        out = out.withColumn(lag, F.coalesce(lag, "pir_mean"))
    return out


def game_means(df: DataFrame) -> DataFrame:
    """Mean valuation per game, team, opponent and position."""
    return df.groupBy("game_id", "team_id", "opponent", "position").agg(F.avg("valuation").alias("valuation"))


def graded(means: DataFrame, of: str, ascending: bool) -> DataFrame:
    """The mean of game means per team and position, against the league's mean of the position, and its rank within it."""
    g = means.groupBy(of, "position").agg(F.avg("valuation").alias("valuation"))
    g = g.withColumn("league_average", F.avg("valuation").over(Window.partitionBy("position"))).withColumn("normd_pstn_pir", F.try_divide("valuation", "league_average"))
    order = F.asc_nulls_last("normd_pstn_pir") if ascending else F.desc_nulls_last("normd_pstn_pir")
    rank = F.rank().over(Window.partitionBy("position").orderBy(order)).cast("double")
    return g.withColumn("grade", F.when(F.col("normd_pstn_pir").isNotNull(), rank))


def conceded(means: DataFrame) -> DataFrame:
    return graded(means, "opponent", False)


def collected(means: DataFrame) -> DataFrame:
    return graded(means, "team_id", True)


def grade_pivot(grades: DataFrame, of: str, suffix: str) -> DataFrame:
    """team and one column per position; a position without games is 0."""
    p = grades.groupBy(F.col(of).alias("team")).pivot("position", list(POSITIONS)).agg(F.first("grade"))
    return p.select("team", *[F.bround(F.coalesce(F.col(x), F.lit(0.0)), 2).alias(f"{x}_{suffix}_pir") for x in POSITIONS])


def history_long(means: DataFrame) -> DataFrame:
    """Game means with the game's number, its rank (by the number's text) among the team's games of the position, and a label."""
    order = Window.partitionBy("team_id", "position").orderBy("game_id_num")
    return (
        means.withColumn("game_id_num", F.element_at(F.split("game_id", "_"), -1))
        .withColumn("game_no", pad3(F.rank().over(order)))
        .withColumn("game_no_opponent", F.concat_ws("_", "game_no", "opponent"))
    )


def history_wide(means: DataFrame) -> DataFrame:
    """Conceded grades with the collected ones of the same team and position beside them."""

    def side(g: DataFrame, of: str, word: str) -> DataFrame:
        return g.select(
            F.col(of).alias("team"), "position", F.col("valuation").alias(f"pir_{word}_per_position"), F.col("league_average").alias(f"pir_{word}_per_position_league_average"),
            F.col("normd_pstn_pir").alias(f"normalized_pir_{word}_per_position_league_average"), F.col("grade").alias(f"grade_pir_{word}_per_position"),
        )

    return side(conceded(means), "opponent", "conceded").join(side(collected(means), "team_id", "collected"), ["team", "position"], "left")


def schedule_of(header: DataFrame) -> DataFrame:
    """The games in the form of a season's schedule: one row per game, dates written like ``Sep 24, 2026``."""
    one = Window.partitionBy("game_id").orderBy("date", "round")
    h = header.withColumn("_n", F.row_number().over(one)).where("_n = 1")
    return h.select(
        "season_code", F.col("game_id").alias("gamecode"), F.col("round").alias("gameday"), F.date_format("date", "MMM d, yyyy").alias("date"),
        F.col("team_a").alias("hometeam"), F.col("team_id_a").alias("homecode"), F.col("team_id_a").alias("hometv"),
        F.col("team_b").alias("awayteam"), F.col("team_id_b").alias("awaycode"), F.col("team_id_b").alias("awaytv"),
    )


def next_round(box: DataFrame) -> int:
    """One more than the last round of the whole table."""
    return int(box.agg(F.max("round")).first()[0] or 0) + 1


def round_games(schedule: DataFrame, gameday: int | Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Games of a round with their turn: 2 on its latest date if it has several, else 1."""
    games = schedule.where(F.col("gameday") == gameday).withColumn("_d", F.to_date("date", "MMM d, yyyy"))
    ends = games.groupBy(*by).agg(F.max("_d").alias("_late"), F.min("_d").alias("_early"))
    both = games.join(ends, list(by)) if by else games.join(F.broadcast(ends))  # one row where there is no ``by``
    turn = F.when((F.col("_d") == F.col("_late")) & (F.col("_late") != F.col("_early")), 2).otherwise(1)
    return both.withColumn("turn", turn).drop("_d", "_late", "_early")


def by_team(games: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Two rows per game, one for each team, from one scan."""
    sides = F.array(
        F.struct(F.col("homecode").alias("team"), F.col("awaycode").alias("opponent"), F.lit("home").alias("venue")),
        F.struct(F.col("awaycode").alias("team"), F.col("homecode").alias("opponent"), F.lit("away").alias("venue")),
    )
    return games.select(*by, "turn", F.explode(sides).alias("s")).select(*by, "s.team", "s.opponent", "turn", "s.venue")


def schedule_grades(games: DataFrame, conceded_pivot: DataFrame, collected_pivot: DataFrame) -> DataFrame:
    """The round's games with both teams' grades and the differences of what one collects and the other concedes."""
    out = games.select("hometeam", "homecode", "awayteam", "awaycode", "turn", "date", "gameday")
    for pivot in (conceded_pivot, collected_pivot):
        for side in ("home", "away"):
            renamed = pivot.select(F.col("team").alias("_t"), *[F.col(c).alias(f"{side}_{c}") for c in pivot.columns if c != "team"])
            out = out.join(renamed, F.col(f"{side}code") == F.col("_t"), "left").drop("_t")
    for a, b in (("collected", "conceded"), ("conceded", "collected")):
        for p in POSITIONS:
            out = out.withColumn(f"{p}_home_{a}_away_{b}", F.col(f"home_{p}_{a}_pir") - F.col(f"away_{p}_{b}_pir"))
    return out


def analytical_record(kpis: DataFrame, teams: DataFrame, grades: DataFrame) -> DataFrame:
    """Indicators with the next opponent and the projection against it; a team without a game keeps an empty projection."""
    r = kpis.join(teams.withColumnRenamed("team", "team_id"), "team_id", "left")
    r = r.join(grades.select("opponent", "position", "normd_pstn_pir"), ["opponent", "position"], "left").withColumn("exp_pir", F.col("pir_mean") * F.col("normd_pstn_pir"))
    return fill_empty(r.withColumnsRenamed({"player_normalized": "player", "team_id": "team"}).select(*RECORD))


def optimizer_input(record: DataFrame) -> DataFrame:
    return record.withColumn("in_prev_roster", F.lit(0))


def teams_sheet(schedule: DataFrame) -> DataFrame:
    return schedule.select(F.col("hometeam").alias("team"), F.col("homecode").alias("code"), F.col("hometv").alias("tv")).distinct()


def build_sheets(box: DataFrame, stats: DataFrame, schedule: DataFrame, year: int, entries: DataFrame, lookup: DataFrame, season_wide: bool = True) -> dict[str, DataFrame]:
    """All sheets by name; the caller writes them (one folder each, or a workbook)."""
    df = join_stats(name_players(prepare_boxscore(box, year), entries, lookup), stats, season_wide)
    means = game_means(df)
    games = round_games(schedule, next_round(box))
    record = analytical_record(player_kpis(df), by_team(games), conceded(means))
    return {
        "schedule": schedule,
        "teams": teams_sheet(schedule),
        "boxscore": df.select(*BOXSCORE),
        "hist_long_pir_per_pos": history_long(means),
        "hist_wide_pir_per_pos": history_wide(means),
        "next_round_team_pir_per_pos": schedule_grades(games, grade_pivot(conceded(means), "opponent", "conceded"), grade_pivot(collected(means), "team_id", "collected")),
        "player_analytical_record": record,
        "optimizer_input": optimizer_input(record),
    }
