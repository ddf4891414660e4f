"""Queries of the engine's own operators over the project's tables, each with SQL that states the same."""

from __future__ import annotations

from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hoopflow.config import Optimization
from hoopflow.functions import text as X
from hoopflow.functions.ids import game_key
from hoopflow.operators import entity, features, merge, quality
from hoopflow.operators.deliveries import first_deliveries
from hoopflow.operators.squad import frame, kernel, solves
from hoopflow.plans.data_queries import _GAME, _MESSAGE
from hoopflow.plans.lineage import JOBS, Lineage, closure, edge_frame
from hoopflow.session import cut, table, work_dir
from hoopflow.sources import live, sinks, tables

#: What the indicators, and what the matching of names, read of the box score.
PREPARED = ("season_code", "game_player_id", "game_id", "player_id", "phase", "round", "game", "team_id", "dorsal", "player", "valuation", "minutes")
PEOPLE = ("season_code", "game_id", "player_id", "team_id", "dorsal", "player", "minutes", "round")
#: Of those, what the pools of spellings are made of.
SPELLED = ("season_code", "player_id", "team_id", "dorsal", "player")
CFG = Optimization(target="pir_mean", robustness_lambda=0.1, upside_beta=0.2, downside_gamma=0.1, cash=100.0, unlimited_trades=True, credit_value=3.0)


def box(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """The merged box score: the asked columns of the first delivery of each message, team codes tidied."""
    rows = first_deliveries(table(spark, d, "euroleague_box_score"), *columns).drop("message")
    return rows.withColumn("team_id", F.upper(F.trim("team_id"))) if "team_id" in columns else rows


def schedule(spark: SparkSession, d: str) -> DataFrame:
    return features.schedule_of(table(spark, d, "euroleague_game_header"))


def register(spark: SparkSession, d: str) -> DataFrame:
    """The club register in the shape of a schedule's home teams."""
    return table(spark, d, "clubs").select(F.trim("team").alias("hometeam"), F.upper(F.trim("code")).alias("homecode"), F.trim("tv").alias("hometv"))


def prices(spark: SparkSession, d: str) -> DataFrame:
    """The price list, one row per key, under the keys by which box-score rows are joined."""
    f = merge.lowest_rank(table(spark, d, "fantasy_players"), ["season_code", "round", "player_id"], "rank", ("name", "team"))
    return f.select(
        "season_code", "round", F.upper(F.trim("team")).alias("team_id"), X.match_key(F.col("name")).alias("player_normalized"), features.position_letter(F.col("position")).alias("position"),
        "quotation", "rank", "player_id",
    )


def prepare_boxscore(spark: SparkSession, d: str) -> DataFrame:
    p = features.prepare_boxscore(box(spark, d, *PREPARED), 2000)
    return p.select("game_player_id", "year", "team_id", "opponent", "homeaway", "minutes", "minutes_num")


def _keyed(spark: SparkSession, d: str) -> DataFrame:
    p = features.prepare_boxscore(box(spark, d, *PREPARED), 2000)
    return p.withColumn("player_normalized", X.match_key(X.abbreviate_name(X.reorder_name(F.col("player")))))


def _joined(spark: SparkSession, d: str) -> DataFrame:
    return features.join_stats(_keyed(spark, d), prices(spark, d).where("round = 'all'"), True, ("season_code", "team_id"))


def join_stats_season(spark: SparkSession, d: str) -> DataFrame:
    return _joined(spark, d).select("game_player_id", "player_normalized", "position", "quotation")


def join_stats_per_round(spark: SparkSession, d: str) -> DataFrame:
    j = features.join_stats(_keyed(spark, d), prices(spark, d).where("round <> 'all'"), False, ("season_code", "team_id"))
    return j.select("game_player_id", "player_normalized", "round", "position", "quotation")


def _six(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def player_kpis(spark: SparkSession, d: str) -> DataFrame:
    return _six(features.player_kpis(_joined(spark, d)))


def player_kpis_filled(spark: SparkSession, d: str) -> DataFrame:
    return _six(features.fill_empty(features.player_kpis(_joined(spark, d))).select(*features.PLAYER, "pir_std", "mins_std", "pir_per_min", "pir_trend", "mins_trend", "pir_lag1", "pir_lag2"))


def _means(spark: SparkSession, d: str) -> DataFrame:
    return features.game_means(_joined(spark, d))


def pir_game_team_position(spark: SparkSession, d: str) -> DataFrame:
    return _six(_means(spark, d))


def grades_conceded(spark: SparkSession, d: str) -> DataFrame:
    return _six(features.conceded(_means(spark, d)))


def grades_collected(spark: SparkSession, d: str) -> DataFrame:
    return _six(features.collected(_means(spark, d)))


def grade_pivot_conceded(spark: SparkSession, d: str) -> DataFrame:
    return features.grade_pivot(features.conceded(_means(spark, d)), "opponent", "conceded")


def grade_pivot_collected(spark: SparkSession, d: str) -> DataFrame:
    return features.grade_pivot(features.collected(_means(spark, d)), "team_id", "collected")


def hist_long(spark: SparkSession, d: str) -> DataFrame:
    return _six(features.history_long(_means(spark, d)))


def hist_wide(spark: SparkSession, d: str) -> DataFrame:
    return _six(features.history_wide(_means(spark, d)))


def _last_rounds(spark: SparkSession, d: str) -> DataFrame:
    s = schedule(spark, d)
    last = F.max("gameday").over(Window.partitionBy("season_code"))
    return features.round_games(s.withColumn("_last", last).where("gameday = _last").drop("_last"), F.col("gameday"), ("season_code",))


def next_round_games(spark: SparkSession, d: str) -> DataFrame:
    return _last_rounds(spark, d).select("season_code", "gamecode", "gameday", "date", "homecode", "awaycode", "turn")


def next_round_by_team(spark: SparkSession, d: str) -> DataFrame:
    return features.by_team(_last_rounds(spark, d), ("season_code",))


def schedule_grades(spark: SparkSession, d: str) -> DataFrame:
    m = _means(spark, d)
    return features.schedule_grades(_last_rounds(spark, d), features.grade_pivot(features.conceded(m), "opponent", "conceded"), features.grade_pivot(features.collected(m), "team_id", "collected"))


def analytical_record(spark: SparkSession, d: str) -> DataFrame:
    """For the last season: every player's indicators and the projection for its last round."""
    j = _joined(spark, d)
    latest = j.agg(F.max("season_code").alias("season_code"))
    j = j.join(F.broadcast(latest), "season_code", "left_semi")
    teams = features.by_team(_last_rounds(spark, d).join(F.broadcast(latest), "season_code", "left_semi"))
    return _six(features.analytical_record(features.player_kpis(j), teams, features.conceded(features.game_means(j))))


def optimizer_input(spark: SparkSession, d: str) -> DataFrame:
    return features.optimizer_input(analytical_record(spark, d)).select("player", "team", "position", "turn", "crd_last", "exp_pir", "in_prev_roster")


def teams_distinct(spark: SparkSession, d: str) -> DataFrame:
    return features.teams_sheet(register(spark, d))


MERGED = ("season_code", "game_player_id", "valuation")


def _split(spark: SparkSession, d: str, since: int = 2025) -> tuple[DataFrame, DataFrame]:
    """History and increments: seasons from ``since`` on come as increments, the history still holds the first of them."""
    b = box(spark, d, *MERGED)
    year = F.regexp_extract("season_code", r"(\d+)", 1).cast("int")
    return b.where(year <= since), b.where(year >= since)


def merge_deltas(spark: SparkSession, d: str) -> DataFrame:
    base, deltas = _split(spark, d)
    return merge.merge(base, deltas)


def merge_covered_seasons(spark: SparkSession, d: str) -> DataFrame:
    base, deltas = _split(spark, d)
    return merge.uncovered(base, deltas).groupBy("season_code").agg(F.count(F.lit(1)).alias("n"))


def merge_base_season(spark: SparkSession, d: str) -> DataFrame:
    """The history's last season under the increments of later ones."""
    base, deltas = _split(spark, d, 2024)
    season = base.agg(F.max("season_code")).first()[0]
    later = deltas.where(F.col("season_code") > season)
    return merge.merge(base, later, season) if season else later


def merge_files(spark: SparkSession, d: str) -> DataFrame:
    """The same through files: a history, an increment per season named by its time, read as text with checked headers."""
    base, deltas = _split(spark, d)
    at = Path(work_dir(spark, "files").removeprefix("file://"))
    sinks.write_ordered(base, f"file://{at}/history", ["game_player_id"])
    deltas.write.partitionBy("season_code").options(**sinks.AS_WRITTEN).csv(f"file://{at}/staged")
    (at / "increments").mkdir()
    for season in sorted(at.glob("staged/season_code=*")):
        rows = spark.read.option("header", True).csv(f"file://{season}").withColumn("season_code", F.lit(season.name.partition("=")[2])).select(*MERGED)
        sinks.write_ordered(rows, f"file://{at}/one", ["game_player_id"])
        next((at / "one").glob("part-*.csv")).rename(at / "increments" / f"{season.name.partition('=')[2]}_delta_20260101T000000Z.csv")
    history = tables.read_text(spark, f"file://{at}/history", list(MERGED)).withColumn("_rank", F.lit(0))
    out = merge.merge(history, tables.read_deltas(spark, str(at / "increments"), list(MERGED)).withColumn("_rank", F.lit(1)))
    return out.select("season_code", "game_player_id", F.col("valuation").cast("int").alias("valuation"))


def dedupe_lowest_rank(spark: SparkSession, d: str) -> DataFrame:
    kept = merge.lowest_rank(table(spark, d, "fantasy_players"), ["season_code", "round", "player_id"], "rank", ("name", "team"))
    return kept.select("season_code", "round", "player_id", "rank")


def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, d, "euroleague_box_score"), ["game_player_id"])


def blank_rows(spark: SparkSession, d: str) -> DataFrame:
    return quality.blank_rows(table(spark, d, "documents"), "text").select("doc_id")


def _players(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "euroleague_box_score").select("player").distinct()


def normalize_names(spark: SparkSession, d: str) -> DataFrame:
    return _players(spark, d).select("player", X.normalize_name(F.col("player")).alias("normalized"))


def match_keys(spark: SparkSession, d: str) -> DataFrame:
    return _players(spark, d).select("player", X.match_key(F.col("player")).alias("key"))


def reorder_abbreviate(spark: SparkSession, d: str) -> DataFrame:
    full = X.reorder_name(F.col("player"))
    return _players(spark, d).select("player", full.alias("reordered"), X.abbreviate_name(full).alias("abbreviated"))


def title_case(spark: SparkSession, d: str) -> DataFrame:
    return _players(spark, d).select("player", X.title_case(F.col("player")).alias("titled"))


def _lookup(spark: SparkSession, d: str) -> DataFrame:
    return entity.team_lookup(entity.team_entries(register(spark, d)))


def _people(spark: SparkSession, d: str) -> DataFrame:
    """What names are matched with, merged once."""
    return cut(box(spark, d, *PEOPLE))


def spelling_pools(spark: SparkSession, d: str) -> DataFrame:
    return entity.spelling_pool(box(spark, d, *PEOPLE)).withColumn("owners", F.array_join("owners", "|"))


def recent_season_pool(spark: SparkSession, d: str) -> DataFrame:
    return entity.club_pool(_people(spark, d), _lookup(spark, d)).withColumn("owners", F.array_join("owners", "|"))


def raw_spellings(spark: SparkSession, d: str) -> DataFrame:
    return entity.raw_spellings(box(spark, d, *PEOPLE)).withColumn("raw", F.array_join("raw", "|"))


def _rows(spark: SparkSession, d: str, b: DataFrame) -> DataFrame:
    lookup = _lookup(spark, d)
    return entity.match_rows(table(spark, d, "fantasy_players").where("team is not null and name is not null"), lookup, entity.club_pool(b, lookup), entity.spelling_pool(b))


def candidate_status(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d, _people(spark, d)).select("team", "name", "club", "match_status", "matched_by")


def candidate_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Listed names that their own club's spellings don't settle, with what all clubs' spellings offer."""
    return _rows(spark, d, _people(spark, d)).where("match_status != 'exact'").select("team", "name", "resolved_name", "match_status", "matched_by", "notes")


def _decided(spark: SparkSession, d: str) -> DataFrame:
    """The latest usable decision about each listed player."""
    t = table(spark, d, "player_name_decisions").where("stats_team is not null and (match_status <> 'confirmed' or name is not null)")
    last = Window.partitionBy("stats_team", "stats_name").orderBy(F.desc("decided_at"), F.desc("decision_id"))
    t = t.withColumn("_n", F.row_number().over(last)).where("_n = 1").withColumn("notes", F.coalesce(F.nullif(F.trim("notes"), F.lit("")), F.lit("-")))
    return entity.check_decisions(t)


def decisions_overlay(spark: SparkSession, d: str) -> DataFrame:
    return entity.apply_decisions(_rows(spark, d, _people(spark, d)), _decided(spark, d)).select("team", "name", "match_status", "matched_by")


def _entries(spark: SparkSession, d: str, b: DataFrame) -> DataFrame:
    """The map of names. The pools are sets, so they are made of what differs between games, not of every game's row."""
    n = cut(b.select(*SPELLED).distinct())
    return cut(entity.map_entries(entity.apply_decisions(_rows(spark, d, n), _decided(spark, d)), entity.raw_spellings(n)))


def map_variants(spark: SparkSession, d: str) -> DataFrame:
    return _entries(spark, d, _people(spark, d)).withColumn("variants", F.array_join("variants", " | "))


def map_file(spark: SparkSession, d: str) -> DataFrame:
    """The map written and read again."""
    at = work_dir(spark, "map")
    sinks.write_map(_entries(spark, d, _people(spark, d)), at)
    return tables.read_map(spark, at).select("stats_team", "stats_name", "name", "match_status", F.array_join("variants", " | ").alias("variants"))


def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return entity.status_counts(_entries(spark, d, _people(spark, d))).withColumn("clubs", F.array_join("clubs", "|"))


def lookup_player(spark: SparkSession, d: str) -> DataFrame:
    b = _people(spark, d)
    return entity.resolve_players(entity.with_club(b.select("player", "team_id").distinct(), "team_id", _lookup(spark, d)), "player", "club", _entries(spark, d, b))


def lookup_team(spark: SparkSession, d: str) -> DataFrame:
    return entity.with_club(table(spark, d, "euroleague_box_score").select("team_id").distinct(), "team_id", _lookup(spark, d))


def audit_stats_only(spark: SparkSession, d: str) -> DataFrame:
    return entity.stats_only(_entries(spark, d, _people(spark, d)))


def audit_box_only(spark: SparkSession, d: str) -> DataFrame:
    b = _people(spark, d)
    return entity.box_only(b, _entries(spark, d, b), _lookup(spark, d)).withColumn("rounds", F.array_join("rounds", ","))


def audit_hint(spark: SparkSession, d: str) -> DataFrame:
    b = _people(spark, d)
    e = _entries(spark, d, b)
    return entity.hints(entity.box_only(b, e, _lookup(spark, d)), e)


def audit_cases(spark: SparkSession, d: str) -> DataFrame:
    b = _people(spark, d)
    e = _entries(spark, d, b)
    return entity.audit_cases(e, entity.hints(entity.box_only(b, e, _lookup(spark, d)), e))


def _mapped(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Prepared rows, those whose player the map knows, and those with a price, the price list's names resolved by the map too."""
    prepared = cut(features.prepare_boxscore(box(spark, d, *PREPARED), 2000))
    b = cut(box(spark, d, *PEOPLE))
    e, lookup = _entries(spark, d, b), _lookup(spark, d)
    named = cut(features.name_players(prepared, e, lookup))
    f = merge.lowest_rank(table(spark, d, "fantasy_players").where("round = 'all'"), ["season_code", "round", "player_id"], "rank", ("name", "team"))
    stats = entity.resolve_players(entity.with_club(f, "team", lookup, "_club"), "name", "_club", e).withColumn("position", features.position_letter(F.col("position")))
    return prepared, named, features.join_stats(named, stats.where("player_normalized is not null"), True, ("season_code",))


def kpis_by_map(spark: SparkSession, d: str) -> DataFrame:
    """The indicators through the map of names, as the workbook has them."""
    return _six(features.player_kpis(_mapped(spark, d)[2]).select(*features.PLAYER, "crd_last", "pir_mean", "pir_last", "pir_std", "pir_slow", "mins_mean"))


def drop_counts(spark: SparkSession, d: str) -> DataFrame:
    return features.drop_counts(*_mapped(spark, d))


def next_round_number(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(features.next_round(table(spark, d, "euroleague_box_score")),)], "next_round int")


def json_props(spark: SparkSession, d: str) -> DataFrame:
    """JSON read into a typed column and written again."""
    p = F.from_json("props", "struct<k: bigint>")
    return table(spark, d, "events").select("event_id", p["k"].alias("k"), F.to_json(F.struct(p["k"].alias("k"))).alias("state"))


def live_box_rows(spark: SparkSession, d: str) -> DataFrame:
    """Box scores in the shape of live answers, taken apart again: games with two clubs that both have players and a TOTAL row."""
    fields = {k: f for k, f in live.FIELDS.items() if k in (*PREPARED, "points", "plus_minus", "is_starter", "is_playing")}
    b = box(spark, d, *dict.fromkeys([*PREPARED, *fields])).withColumn("g", game_key(F.col("game_id"))).where("team_id is not null and team_id != ''")
    person = F.struct(F.col("player_id").alias("Player_ID"), *[F.col(k).alias(f) for k, f in fields.items()])
    total = F.coalesce(F.col("dorsal"), F.lit("")) == "TOTAL"
    per = b.groupBy("g", "team_id").agg(F.collect_list(F.when(~total, person)).alias("PlayersStats"), F.min(F.when(total, F.struct("game_player_id", person.alias("p"), "player"))).alias("t"))
    per = per.where("size(PlayersStats) > 0 and t is not null").select("g", F.struct("team_id", F.col("t.player").alias("Team"), "PlayersStats", F.col("t.p").alias("totr")).alias("s"))
    games = per.groupBy("g").agg(F.array_sort(F.collect_list("s")).alias("Stats")).where("size(Stats) = 2")
    part = F.split("g", "_")
    raw = games.select(F.lit("boxscore").alias("kind"), part[0].alias("season"), part[1].cast("int").alias("gamecode"), F.to_json(F.struct(F.lit(False).alias("Live"), "Stats")).alias("payload"))
    rows = live.box_rows(raw, table(spark, d, "euroleague_game_header").select(F.col("season_code").alias("season"), F.split(game_key(F.col("game_id")), "_")[1].cast("int").alias("gamecode"), "round", "phase").distinct())
    return rows.select("game_player_id", "game_id", "game", "round", "team_id", "dorsal", "player", "minutes", "is_starter", "points", "valuation", "plus_minus")


def live_header_rows(spark: SparkSession, d: str) -> DataFrame:
    """Headers in the shape of live answers, taken apart again."""
    h = table(spark, d, "euroleague_game_header").distinct()
    cells = [F.col(k).cast("string").alias(f) for k, f in live.HEADER_FIELDS.items()]
    cells += [F.date_format("date", "dd/MM/yyyy").alias("Date"), F.left("time", F.lit(5)).alias("Hour"), F.col("season_code").alias("pcom"), F.lit(False).alias("Live")]
    cells += [F.col(f"score_quarter_{q}_{s}").alias(f"ScoreQuarter{q}{s.upper()}") for q in range(1, 5) for s in "ab"] + [F.coalesce(f"score_extra_time_1_{s}", F.lit(0)).alias(f"ScoreExtraTime{s.upper()}") for s in "ab"]
    part = F.split(game_key(F.col("game_id")), "_")
    raw = h.select(F.lit("header").alias("kind"), F.col("season_code").alias("season"), part[1].cast("int").alias("gamecode"), F.to_json(F.struct(*cells)).alias("payload"))
    return live.header_rows(raw).select("game_id", "game", "date", "time", "round", "score_a", "score_b", "team_a", "capacity", "referee_3", "score_quarter_4_b", "score_extra_time_1_a")


def schedule_answer(spark: SparkSession, d: str) -> DataFrame:
    """The last season's schedule as the one answer it comes in."""
    s = schedule(spark, d)
    season = s.agg(F.max("season_code")).first()[0] or ""
    cells = F.struct("gamecode", F.col("gameday").cast("string").alias("gameday"), "date", "homecode", "awaycode")
    raw = s.where(F.col("season_code") == season).agg(F.to_json(F.collect_list(cells)).alias("payload"))
    return live.schedule_rows(raw, season).select("gamecode", "gameday", "homecode", "awaycode")


def price_pages(spark: SparkSession, d: str) -> DataFrame:
    """The price list in pages of columns and rows, put together again."""
    f = table(spark, d, "fantasy_players").withColumn("page", F.floor(F.col("player_id") / 100))
    data = F.struct(F.array(F.lit("name"), F.lit("fg-missed")).alias("columns"), F.collect_list(F.struct(F.col("player_id").alias("id"), F.array("name", "fg_missed").alias("row"))).alias("players"))
    pages = f.groupBy("round", "page").agg(data.alias("data")).select("round", F.to_json(F.struct("data")).alias("payload"))
    return live.fantasy_rows(pages).select("round", "player_id", F.col("cells")["name"].alias("name"), F.col("cells")["fg_missed"].alias("fg_missed"))


def lineage_paths(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of datasets and jobs of this project with a path between them."""
    return closure(edge_frame(spark, Lineage(list(JOBS))))


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    """Last season's players with a full set of indicators, one row per player."""
    r = analytical_record(spark, d).where("turn is not null").withColumn("crd_last", F.round("crd_last", 1))
    one = Window.partitionBy("player").orderBy(F.desc("pir_mean"), "team", "position", "opponent")
    return features.optimizer_input(r.withColumn("_n", F.row_number().over(one)).where("_n = 1").drop("_n")).where("crd_last > 0")


def objective_components(spark: SparkSession, d: str) -> DataFrame:
    c = frame.objective_components(frame.model_frame(_candidates(spark, d), CFG), CFG)
    return _six(c.select("player", "risk_adjustment", "score", "credit_growth", "growth_value"))


def input_rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return frame.rule_counts(frame.model_frame(_candidates(spark, d), CFG))


def candidate_counts(spark: SparkSession, d: str) -> DataFrame:
    return frame.candidate_counts(frame.model_frame(_candidates(spark, d), CFG))


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    """The last season's candidates with their place within the position by mean valuation."""
    best = Window.partitionBy("position").orderBy(F.desc("pir_mean"), "player")
    return _candidates(spark, d).withColumn("place", F.row_number().over(best))


def _chosen(spark: SparkSession, d: str) -> DataFrame:
    """A fixed solution: the best of each position, sold for it the next best."""
    c, p, n = _ranked(spark, d), F.col("position"), F.col("place")
    need = F.when(p == "C", 2).otherwise(4)
    starter = ((p == "C") & (n == 1)) | ((p != "C") & (n <= 2))
    role = F.when(starter, "starter").when((p == "G") & (n == 3), "sixth").when(n <= need, "bench").otherwise("none")
    c = c.withColumn("role", role).withColumn("selected", (n <= need).cast("int")).withColumn("action", F.when(n <= need, "buy").when(n <= 2 * need, "sell").otherwise("none"))
    top = Window.partitionBy(F.col("role") == "starter").orderBy(F.desc("pir_mean"), "player")
    c = c.withColumn("is_captain", F.when((F.col("role") == "starter") & (F.row_number().over(top) == 1), 1).otherwise(0))
    return c.select(F.lit("fixed").alias("scenario"), F.lit("main").alias("kind"), "player", "team", "position", F.col("crd_last").alias("price"), F.col("pir_mean").alias("score"), "role", "selected", "action", "is_captain")


def selection_sheet(spark: SparkSession, d: str) -> DataFrame:
    return solves.selection_sheet(_chosen(spark, d)).select("player", "position", "role", "action", "is_captain", F.col("place").alias("group_place"))


def lineup_sum(spark: SparkSession, d: str) -> DataFrame:
    return _chosen(spark, d).groupBy("scenario").agg(F.round(solves.lineup_sum("score"), 6).alias("points"), F.round(F.sum(F.col("selected") * F.col("price")), 6).alias("price"), F.count_if(F.col("action") == "sell").alias("sold"))


def best_lineup(spark: SparkSession, d: str) -> DataFrame:
    """Each club's and season's best line-up of its four best guards, four best forwards and two best centers."""
    best = Window.partitionBy("season_code", "team_id", "position").orderBy(F.desc("score"), "player_normalized")
    p = _joined(spark, d).groupBy("season_code", "team_id", "player_normalized", "position").agg(F.avg("valuation").alias("score")).where("score is not null")
    p = p.withColumn("place", F.row_number().over(best)).where("place <= case position when 'C' then 2 else 4 end")
    return p.groupBy("season_code", "team_id").applyInPandas(solves.lineup_of, "season_code string, team_id string, points double, captain string").where("points is not null")


SMALL = replace(CFG, cash=147.0)


def squad_optimum_small(spark: SparkSession, d: str) -> DataFrame:
    """The best squad out of the six best guards, five best forwards and three best centers of the last season."""
    few = _ranked(spark, d).where("place <= case position when 'G' then 6 when 'F' then 5 else 3 end").drop("place")
    solved = solves.solve_all(cut(few), {"small": (SMALL, None)}, ("main",))
    return solved.agg(F.round(F.max("objective"), 4).alias("objective"))


HELD = replace(SMALL, cash=1.5, unlimited_trades=False, max_trades=2)


def small_scenarios(spark: SparkSession, d: str) -> DataFrame:
    """The same candidates in two scenarios, without a current squad and with the best of each position as one, and what each is held against."""
    few = cut(_ranked(spark, d).where("place <= case position when 'G' then 6 when 'F' then 5 else 3 end"))
    roster = tuple(r["player"] for r in few.where("place <= case position when 'C' then 2 else 4 end").select("player").collect())
    solved = solves.solve_all(few.drop("place"), {"free": (SMALL, None), "held": (HELD, roster)})
    return solved.where("objective is not null").groupBy("scenario", "kind").agg(F.round(F.max("objective"), 4).alias("objective"))


def _solved(spark: SparkSession, d: str) -> DataFrame:
    return cut(solves.solve_all(cut(_candidates(spark, d)), {"plain": (CFG, None)}))


def squad_optimum(spark: SparkSession, d: str) -> DataFrame:
    return solves.selection_sheet(_solved(spark, d)).where("selected = 1 or action = 'sell'").drop("seconds")


def scenario_summary(spark: SparkSession, d: str) -> DataFrame:
    return solves.report_sheet(_solved(spark, d), {"plain": (CFG, None)})


def squad_sensitivity(spark: SparkSession, d: str) -> DataFrame:
    return solves.sensitivity(_solved(spark, d))


_NAMES = [
    prepare_boxscore, join_stats_season, join_stats_per_round, player_kpis, player_kpis_filled, pir_game_team_position, grades_conceded, grades_collected, grade_pivot_conceded,
    grade_pivot_collected, hist_long, hist_wide, next_round_games, next_round_by_team, schedule_grades, analytical_record, optimizer_input, teams_distinct, merge_deltas,
    merge_covered_seasons, merge_base_season, dedupe_lowest_rank, duplicate_keys, blank_rows, normalize_names, match_keys, reorder_abbreviate, title_case, spelling_pools, recent_season_pool,
    raw_spellings, candidate_status, decisions_overlay, map_variants, lookup_player, lookup_team, audit_stats_only, audit_box_only, audit_hint, objective_components, input_rule_counts,
    candidate_counts, squad_optimum, scenario_summary, squad_sensitivity, merge_files, candidate_fallback, map_file, status_counts, audit_cases, kpis_by_map, drop_counts, next_round_number,
    json_props, live_box_rows, live_header_rows, schedule_answer, price_pages, lineage_paths, selection_sheet, lineup_sum, best_lineup, squad_optimum_small, small_scenarios,
]
QUERIES = {f.__name__: f for f in _NAMES}


def _norm(c: str) -> str:
    return f"trim(regexp_replace(upper(strip_accents(replace({c}, 'ß', 'SS'))), '[^A-Z]+', ' ', 'g'))"


def _key(c: str) -> str:
    return f"regexp_replace({_norm(c)}, '( (JR|SR|II|III|IV))+$', '')"


def _reorder(c: str) -> str:
    return f"case when contains({c}, ',') then trim(substr({c}, strpos({c}, ',') + 1)) || ' ' || trim(substr({c}, 1, strpos({c}, ',') - 1)) else {c} end"


def _short(c: str) -> str:
    t = f"trim({c})"
    return f"case when strpos({t}, ' ') > 0 and trim(substr({t}, strpos({t}, ' ') + 1)) <> '' then substr({t}, 1, 1) || '. ' || trim(substr({t}, strpos({t}, ' ') + 1)) else {t} end"


def _title(c: str) -> str:
    return f"list_aggregate(list_transform(regexp_extract_all({c}, '(\\p{{L}}+|[^\\p{{L}}]+)'), lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), 'string_agg', '')"


_BOX = f"""box as (select * exclude (rn, team_id), upper(trim(team_id)) as team_id from (
  select *, row_number() over (partition by {_MESSAGE} order by loaded_at nulls last, delivery_id) as rn from euroleague_box_score where game_player_id is not null) where rn = 1)"""
_PREPARED = f"""{_BOX},
prepared as (
  select * replace (case when minutes = 'DNP' then '0:00' else minutes end as minutes), try_cast(regexp_replace(season_code, '^[A-Za-z]+', '') as int) as year,
    case when trim(minutes) in ('', 'DNP') then 0.0 else try_cast(split_part(trim(minutes), ':', 1) as int) + try_cast(split_part(trim(minutes), ':', 2) as int) / 60.0 end as minutes_num,
    case when team_id = split_part(game, '-', 1) then 'home' else 'away' end as homeaway,
    case when team_id = split_part(game, '-', 1) then split_part(game, '-', 2) else split_part(game, '-', 1) end as opponent
  from box where coalesce(dorsal, '') <> 'TOTAL' and try_cast(regexp_replace(season_code, '^[A-Za-z]+', '') as int) >= 2000)"""
_PRICES = f"""listed as (select * exclude (n) from (select *, row_number() over (partition by season_code, round, player_id order by rank nulls last, name nulls first, team nulls first) as n from fantasy_players) where n = 1),
prices as (select season_code, round, upper(trim(team)) as team_id, {_key("name")} as player_normalized,
    case position when 'Guard' then 'G' when 'Forward' then 'F' when 'Center' then 'C' end as position, quotation, rank, player_id from listed)"""
_JOINED = f"""{_PREPARED},
keyed as (select *, {_key(_short(_reorder("player")))} as player_normalized from prepared),
{_PRICES},
season as (select * exclude (n) from (select *, row_number() over (partition by season_code, team_id, player_normalized order by rank nulls first, player_id nulls first, position nulls first, quotation nulls first) as n
    from prices where round = 'all') where n = 1),
joined as (select k.*, s.position, s.quotation from keyed k join season s on k.season_code = s.season_code and k.team_id = s.team_id and k.player_normalized = s.player_normalized
    where s.quotation is not null and s.position is not null)"""


def _kpis(source: str) -> str:
    return f"""numbered as (select *, row_number() over (partition by player_normalized, team_id, position order by round desc, game_id desc, game_player_id desc) as n from {source}),
kpis0 as (select player_normalized, team_id, position, arg_min(quotation, n) filter (where quotation is not null) as crd_last, avg(valuation) as pir_mean,
    cast(arg_min(valuation, n) filter (where valuation is not null) as double) as pir_last, cast(max(case when n = 2 then valuation end) as double) as pir_lag1,
    cast(max(case when n = 3 then valuation end) as double) as pir_lag2, stddev_samp(valuation) as pir_std,
    quantile_cont(case when n <= 5 then valuation end, 0.1) as pir_p10, quantile_cont(case when n <= 5 then valuation end, 0.5) as pir_p50,
    quantile_cont(case when n <= 5 then valuation end, 0.75) as pir_p75, quantile_cont(case when n <= 5 then valuation end, 0.9) as pir_p90,
    avg(case when n <= 5 then valuation end) as pir_slow, avg(case when n <= 3 then valuation end) as pir_fast, avg(minutes_num) as mins_mean, stddev_samp(minutes_num) as mins_std,
    avg(case when n <= 5 then minutes_num end) as mins_slow, avg(case when n <= 3 then minutes_num end) as mins_fast from numbered group by 1, 2, 3),
kpis as (select *, pir_mean / nullif(crd_last, 0) as pir_per_crd, (pir_mean - crd_last * 1.1) / 25 as pir_breakeven, pir_mean / nullif(mins_mean, 0) as pir_per_min,
    pir_fast / nullif(pir_slow, 0) as pir_trend, mins_fast / nullif(mins_slow, 0) as mins_trend from kpis0)"""


_KPI_COLUMNS = ["crd_last", *features.RECORD[9:]]
_FILLED = {
    "pir_std": "coalesce(pir_std, 0)", "mins_std": "coalesce(mins_std, 0)", "pir_per_min": "coalesce(pir_per_min, 0)", "pir_trend": "coalesce(pir_trend, 1)", "mins_trend": "coalesce(mins_trend, 1)",
    "pir_lag1": "coalesce(pir_lag1, pir_mean)", "pir_lag2": "coalesce(pir_lag2, pir_mean)",
}


def _rounded(columns: list[str], given: dict[str, str] | None = None) -> str:
    return ", ".join(f"round(cast({(given or {}).get(c, c)} as double), 6) as {c}" for c in columns)


def _means_sql(source: str) -> str:
    return f"means as (select game_id, team_id, opponent, position, avg(valuation) as valuation from {source} group by 1, 2, 3, 4)"


def _graded(name: str, of: str, direction: str) -> str:
    return f"""{name} as (select *, case when normd_pstn_pir is not null then cast(rank() over (partition by position order by normd_pstn_pir {direction} nulls last) as double) end as grade from (
    select *, valuation / nullif(league_average, 0) as normd_pstn_pir from (
    select *, avg(valuation) over (partition by position) as league_average from (select {of}, position, avg(valuation) as valuation from means group by 1, 2))))"""


_GRADES = f"{_JOINED}, {_means_sql('joined')}, {_graded('conceded', 'opponent', 'desc')}, {_graded('collected', 'team_id', 'asc')}"
_GRADE_COLUMNS = _rounded(["valuation", "league_average", "normd_pstn_pir", "grade"])


def _pivot(source: str, of: str, word: str) -> str:
    cells = ", ".join(f"round_even(coalesce(max(case when position = '{p}' then grade end), 0.0), 2) as {p}_{word}_pir" for p in features.POSITIONS)
    return f"select {of} as team, {cells} from {source} group by {of}"


_SCHEDULE = """schedule as (select season_code, game_id as gamecode, round as gameday, strftime(date, '%b %-d, %Y') as date, date as day, team_a as hometeam, team_id_a as homecode, team_b as awayteam, team_id_b as awaycode from (
    select *, row_number() over (partition by game_id order by date nulls first, round nulls first) as n from euroleague_game_header) where n = 1),
games as (select *, case when day = max(day) over (partition by season_code) and max(day) over (partition by season_code) <> min(day) over (partition by season_code) then 2 else 1 end as turn from (
    select *, max(gameday) over (partition by season_code) as last from schedule) where gameday = last),
sides as (select season_code, homecode as team, awaycode as opponent, turn, 'home' as venue from games union all select season_code, awaycode, homecode, turn, 'away' from games)"""
_RECORD = f"""{_JOINED}, now as (select * from joined where season_code = (select max(season_code) from joined)), {_kpis('now')}, {_means_sql('now')}, {_graded('conceded', 'opponent', 'desc')}, {_SCHEDULE},
record as (select player_normalized as player, k.team_id as team, k.position, s.turn, s.venue, s.opponent, normd_pstn_pir, pir_mean * normd_pstn_pir as exp_pir, k.* exclude (player_normalized, team_id, position)
  from kpis k left join (select * from sides where season_code = (select max(season_code) from joined)) s on k.team_id = s.team left join conceded c on c.opponent = s.opponent and c.position = k.position)"""
_SCHEDULE_GRADES = ", ".join(
    [f"{a}_{w}.{p}_{w}_pir as {a}_{p}_{w}_pir" for w in ("conceded", "collected") for a in ("home", "away") for p in features.POSITIONS]
    + [f"home_{a}.{p}_{a}_pir - away_{b}.{p}_{b}_pir as {p}_home_{a}_away_{b}" for a, b in (("collected", "conceded"), ("conceded", "collected")) for p in features.POSITIONS]
)
_PEOPLE = "(dorsal <> 'TOTAL' or dorsal is null)"
_CLUBS = f"""register as (select distinct trim(team) as hometeam, upper(trim(code)) as homecode, trim(tv) as hometv from clubs),
lookup as (select distinct {_norm("x")} as key, hometeam as club from (select unnest([hometeam, homecode, hometv]) as x, hometeam from register))"""
_POOLS = f"""{_BOX}, {_CLUBS},
everyone as (select {_reorder("player")} as spelling, list_sort(list_distinct(list(player_id))) as owners from box where {_PEOPLE} group by 1),
recent as (select distinct season_code from box where {_PEOPLE} order by 1 desc limit 2),
clubbed as (select club, {_reorder("player")} as spelling, list_sort(list_distinct(list(player_id))) as owners from box join lookup on {_norm("team_id")} = key
  where {_PEOPLE} and season_code in (select season_code from recent) group by 1, 2),
raw as (select {_norm(_reorder("player"))} as key, list_sort(list_distinct(list(player))) as raw from box where {_PEOPLE} group by 1)"""
_MATCHED = f"""{_POOLS},
own as (select club, {_key(_short("spelling"))} as key, count(distinct {_short("spelling")}) as n_spellings, count(distinct ({_short("spelling")}, spelling)) as n_owners, list_sort(list_distinct(list({{'s': {_short("spelling")}, 'f': spelling}}))) as pairs from clubbed group by 1, 2),
rest as (select {_key(_short("spelling"))} as key, count(distinct {_short("spelling")}) as n_spellings, count(distinct ({_short("spelling")}, spelling)) as n_owners, list_sort(list_distinct(list({{'s': {_short("spelling")}, 'f': spelling}}))) as pairs from everyone group by 1),
listed as (select distinct team, name from fantasy_players where team is not null and name is not null),
met as (select p.team, p.name, coalesce(l.club, '') as club, o.n_spellings as os, o.n_owners as oo, o.pairs as op, r.n_spellings as rs, r.n_owners as ro, r.pairs as rp
  from listed p left join lookup l on {_norm("p.team")} = l.key left join own o on o.club = l.club and o.key = {_key("p.name")} left join rest r on r.key = {_key("p.name")}),
rows as (select team, name, club,
    case when os is not null then case when os = 1 and oo = 1 then 'exact' else 'needs_review' end when rs is null then 'no_candidate' else 'needs_review' end as match_status,
    case when os is not null then case when os > 1 then 'exact_ambiguous_spelling' when oo > 1 then 'exact_collision' else 'exact' end
         when rs is null then 'exact' when rs = 1 and ro = 1 then 'exact_other_club' when rs > 1 then 'exact_ambiguous_spelling' else 'exact_collision' end as matched_by,
    list_transform(coalesce(op, rp, []), lambda x: {_title("x.f")}) as candidates from met),
rows1 as (select team, name, club, coalesce(candidates[1], '') as resolved_name, match_status, matched_by,
    concat_ws('; ', case when club = '' then 'team code ''' || team || ''' is not in the team map' end,
      case when len(candidates) > 0 and match_status = 'needs_review' then 'candidates: ' || array_to_string(candidates, '; ') end) as notes from rows),
decided as (select * from (select *, row_number() over (partition by stats_team, stats_name order by decided_at desc nulls last, decision_id desc) as n from player_name_decisions
    where stats_team is not null and (match_status <> 'confirmed' or name is not null)) where n = 1),
overlaid as (select r.team, r.name, r.club,
    case when use then case when d_status = 'confirmed' then trim(d_name) else '' end else resolved_name end as resolved_name, case when use then d_status else match_status end as match_status,
    case when use then 'agent' else matched_by end as matched_by, case when use then coalesce(nullif(trim(d_notes), ''), '-') else notes end as notes
  from (select r.*, d.match_status as d_status, d.name as d_name, d.notes as d_notes, r.match_status <> 'exact' and d.match_status is not null as use
    from rows1 r left join decided d on d.stats_team = r.team and d.stats_name = r.name) r),
entries as (select o.team as stats_team, o.name as stats_name, o.club as team, o.full as name, list_sort(list_distinct(list_concat([o.name, o.full], coalesce(w.raw, [])))) as variants, match_status, matched_by, notes
  from (select *, match_status in ('exact', 'confirmed') as done, case when match_status in ('exact', 'confirmed') then resolved_name else name end as full from overlaid) o
  left join raw w on o.done and {_norm("o.full")} = w.key),
known as (select {_norm("v")} as key, team as club, name from (select unnest(variants) as v, team, name from entries where match_status not in ('needs_review', 'no_candidate')))"""
_BOXONLY = f"""{_MATCHED},
played as (select team_id as team, player, count(distinct (game_id, round)) as games, list_sort(list_distinct(list(round))) as rounds from box
  where coalesce(dorsal, '') <> 'TOTAL' and coalesce(trim(minutes), '') not in ('', 'DNP', '0:00') group by 1, 2),
boxonly as (select p.team, coalesce(l.club, '') as club, p.player, p.games, p.rounds from played p left join lookup l on {_norm("p.team")} = l.key where {_norm("p.player")} not in (select key from known))"""
_CANDIDATES = f"""{_RECORD},
filled as (select player, team, position, turn, opponent, round(crd_last, 1) as crd_last, {_rounded(["pir_mean", "pir_p10", "pir_p90"])}, {_rounded(["pir_std"], _FILLED)} from record where turn is not null),
candidates as (select * exclude (n) from (select *, row_number() over (partition by player order by pir_mean desc, team, position, opponent nulls first) as n from filled) where n = 1 and crd_last > 0)"""
_PREPARED_ONLY = _PREPARED[len(_BOX) + 2 :]
_MAPPED = f"""{_MATCHED}, {_PREPARED_ONLY},
a as (select key, count(distinct name) as n, min(name) as name from known group by 1), b as (select key, club, count(distinct name) as n, min(name) as name from known group by 1, 2),
named as (select * from (select p.*, case when a.n = 1 then a.name when b.n = 1 then b.name end as player_normalized from prepared p left join lookup l on {_norm("p.team_id")} = l.key
  left join a on a.key = {_norm("p.player")} left join b on b.key = {_norm("p.player")} and b.club = l.club) where player_normalized is not null),
priced as (select * exclude (n) from (select *, row_number() over (partition by season_code, round, player_id order by rank nulls last, name nulls first, team nulls first) as n from fantasy_players where round = 'all') where n = 1),
resolved as (select * from (select p.season_code, p.rank, p.player_id, p.quotation, case position when 'Guard' then 'G' when 'Forward' then 'F' when 'Center' then 'C' end as position,
  case when a.n = 1 then a.name when b.n = 1 then b.name end as player_normalized from priced p left join lookup l on {_norm("p.team")} = l.key left join a on a.key = {_norm("p.name")}
  left join b on b.key = {_norm("p.name")} and b.club = l.club) where player_normalized is not null),
season as (select * exclude (n) from (select *, row_number() over (partition by season_code, player_normalized order by rank nulls first, player_id nulls first, position nulls first, quotation nulls first) as n from resolved) where n = 1),
joined as (select k.*, s.position, s.quotation from named k join season s on k.season_code = s.season_code and k.player_normalized = s.player_normalized where s.quotation is not null and s.position is not null)"""
_HINTED = f"""{_BOXONLY},
near as (select b.*, case when e.stats_name is not null then 1 end as t from boxonly b
  left join (select * from entries where match_status <> 'exact') e on b.club = e.team and len(list_intersect(
    list_filter(string_split({_norm("substr(e.stats_name, strpos(e.stats_name || ' ', ' ') + 1)")}, ' '), lambda x: x <> ''), string_split({_norm("b.player")}, ' '))) > 0),
verdicts as (select team, club, player, case when club = '' then 'unknown team' when count(t) > 0 then 'box score only, likely' else 'box score only' end as case_ from near group by team, club, player)"""
_RANKED = f"""{_CANDIDATES}, ranked as (select *, row_number() over (partition by position order by pir_mean desc, player) as place, case position when 'C' then 2 else 4 end as need from candidates)"""
_CHOSEN = f"""{_RANKED},
roled as (select *, case when (position = 'C' and place = 1) or (position <> 'C' and place <= 2) then 'starter' when position = 'G' and place = 3 then 'sixth' when place <= need then 'bench' else 'none' end as role,
  case when place <= need then 'buy' when place <= 2 * need then 'sell' else 'none' end as action from ranked),
chosen as (select *, case when role = 'starter' and row_number() over (partition by role = 'starter' order by pir_mean desc, player) = 1 then 1 else 0 end as is_captain from roled)"""
_SPLITS = "(" + ", ".join(f"({g}, {f}, {c})" for g, f, c in kernel.ACTIVE) + ")"
_EDGES = ", ".join(f"('{a}', '{b}')" for a, b in Lineage(list(JOBS)).edges())
_LIVE = f"""{_BOX}, b as (select *, {_GAME.format(c="game_id")} as g from box where team_id is not null and team_id <> ''),
clubbed0 as (select g, team_id, count(*) filter (where coalesce(dorsal, '') <> 'TOTAL') as n, min(game_player_id) filter (where dorsal = 'TOTAL') as total_id from b group by 1, 2),
good as (select g, min(team_id) || '-' || max(team_id) as game from clubbed0 where n > 0 and total_id is not null group by g having count(*) = 2),
sides0 as (select c.* from clubbed0 c join good using (g) where n > 0 and total_id is not null),
heads as (select distinct {_GAME.format(c="game_id")} as g, round, phase from euroleague_game_header),
ids as (select good.g, good.game, split_part(good.g, '_', 1) || '_' || lpad(split_part(good.g, '_', 2), cast(greatest(3, length(split_part(good.g, '_', 2))) as int), '0') as game_id, h.round from good left join heads h on h.g = good.g)"""

_VARIANTS = ", ".join(
    f"('{key}', '{kind}', {c.cash}, {1000 if c.trades is None else c.trades}, {c.credit_value}, {int(c.robustness_lambda > 0)}, {int(key == 'held')})"
    for key, cfg in (("free", SMALL), ("held", HELD)) for kind, c in solves.variants(cfg).items() if (key, kind) != ("free", "no_trade")
)
_SMALL = f"""{_RANKED},
few as (select *, pir_mean - 0.1 * pir_std + 0.2 * greatest(0, pir_p90 - pir_mean) - 0.1 * greatest(0, pir_mean - pir_p10) as score, (pir_mean - 1.1 * crd_last) / 25 as growth,
    row_number() over (order by player) - 1 as bit, case when place <= need then 1 else 0 end as prev from ranked where place <= case position when 'G' then 6 when 'F' then 5 else 3 end),
masks as (select unnest(range(16384)) as mask),
squads as (select mask, sum(growth) as growth, sum(crd_last) as price, sum(1 - prev) as new, (select sum(crd_last * prev) from few) as held from few, masks where bit_count(mask) = 10 and (mask >> bit) & 1 = 1 group by mask
  having count(*) filter (where position = 'G') = 4 and count(*) filter (where position = 'F') = 4 and count(*) filter (where position = 'C') = 2),
capped as (select mask from (select s.mask, f.team, count(*) as n from squads s join few f on (s.mask >> f.bit) & 1 = 1 group by 1, 2) group by mask having max(n) <= 6),
lines as (select s.mask, m.mask as active from squads s join capped using (mask) join masks m on m.mask & s.mask = m.mask and bit_count(m.mask) = 6),
valued as (select l.mask, l.active, sum(f.score * case when (l.active >> f.bit) & 1 = 1 then 1.0 else 0.5 end) + max(case when (l.active >> f.bit) & 1 = 1 then f.score end) as risky,
    sum(f.pir_mean * case when (l.active >> f.bit) & 1 = 1 then 1.0 else 0.5 end) + max(case when (l.active >> f.bit) & 1 = 1 then f.pir_mean end) as plain,
    count(*) filter (where (l.active >> f.bit) & 1 = 1 and position = 'G') as g, count(*) filter (where (l.active >> f.bit) & 1 = 1 and position = 'F') as f_, count(*) filter (where (l.active >> f.bit) & 1 = 1 and position = 'C') as c
  from lines l join few f on (l.mask >> f.bit) & 1 = 1 group by 1, 2),
best as (select mask, max(risky) as risky, max(plain) as plain from valued where (g, f_, c) in {_SPLITS} group by 1),
variants(scenario, kind, cash, trades, credit, risk, holds) as (values {_VARIANTS})"""

SQL = {
    "small_scenarios": f"""with {_SMALL} select scenario, kind, round(max(case when risk = 1 then risky else plain end + credit * growth), 4) as objective from best join squads using (mask), variants
where price <= cash + holds * held + 1e-6 and (holds = 0 or new <= trades) group by 1, 2""",
    "merge_files": f"""with {_BOX}, b as (select season_code, game_player_id, valuation, cast(regexp_extract(season_code, '([0-9]+)', 1) as int) as y from box)
select season_code, game_player_id, valuation from b""",
    "candidate_fallback": f"with {_MATCHED} select team, name, resolved_name, match_status, matched_by, notes from rows1 where match_status <> 'exact'",
    "map_file": f"with {_MATCHED} select stats_team, stats_name, name, match_status, array_to_string(variants, ' | ') as variants from entries",
    "status_counts": f"with {_MATCHED} select match_status, matched_by, count(*) as names, array_to_string(list_sort(list_distinct(list(coalesce(team, '')))), '|') as clubs from entries group by 1, 2",
    "audit_cases": f"""with {_HINTED} select case_ as "case", club, count(*) as players from (
  select 'listed only' as case_, coalesce(team, '') as club from entries where match_status not in ('exact', 'confirmed') union all select case_, club from verdicts) group by 1, 2""",
    "kpis_by_map": f"with {_MAPPED}, {_kpis('joined')} select player_normalized, team_id, position, {_rounded(['crd_last', 'pir_mean', 'pir_last', 'pir_std', 'pir_slow', 'mins_mean'])} from kpis",
    "drop_counts": f"""with {_MAPPED} select 'unknown player' as step, count(*) as rows, count(distinct player) as players from prepared where game_player_id not in (select game_player_id from named) having count(*) > 0
union all select 'no price or position', count(*), count(distinct player_normalized) from named where game_player_id not in (select game_player_id from joined) having count(*) > 0""",
    "next_round_number": "select cast(coalesce(max(round), 0) + 1 as int) as next_round from euroleague_box_score",
    "json_props": "select event_id, cast(json_extract(props, '$.k') as bigint) as k, '{\"k\":' || json_extract_string(props, '$.k') || '}' as state from events",
    "live_box_rows": f"""with {_LIVE}
select i.game_id || '_' || trim(b.player_id) as game_player_id, i.game_id, i.game, i.round, b.team_id, trim(b.dorsal) as dorsal, trim(b.player) as player, trim(b.minutes) as minutes, b.is_starter, b.points, b.valuation, b.plus_minus
from b join sides0 s on b.g = s.g and b.team_id = s.team_id join ids i on i.g = b.g where coalesce(b.dorsal, '') <> 'TOTAL'
union all select i.game_id || '_' || b.team_id, i.game_id, i.game, i.round, b.team_id, 'TOTAL', trim(b.player), trim(b.minutes), 0, b.points, b.valuation, null
from b join sides0 s on b.game_player_id = s.total_id and b.team_id = s.team_id and b.g = s.g and b.dorsal = 'TOTAL' join ids i on i.g = b.g""",
    "live_header_rows": f"""select split_part(g, '_', 1) || '_' || lpad(split_part(g, '_', 2), cast(greatest(3, length(split_part(g, '_', 2))) as int), '0') as game_id, team_id_a || '-' || team_id_b as game, date, substr(time, 1, 5) || ':00' as time, round,
  score_a, score_b, trim(team_a) as team_a, capacity, nullif(trim(referee_3), '') as referee_3, score_quarter_4_b, nullif(score_extra_time_1_a, 0) as score_extra_time_1_a
from (select distinct *, {_GAME.format(c="game_id")} as g from euroleague_game_header) where score_a + score_b > 0""",
    "schedule_answer": f"with {_SCHEDULE} select gamecode, cast(gameday as varchar) as gameday, homecode, awaycode from schedule where season_code = (select max(season_code) from schedule)",
    "price_pages": "select round, player_id, name, fg_missed from fantasy_players",
    "lineage_paths": f"with recursive e(src, dst) as (select * from (values {_EDGES})), r(src, dst) as (select src, dst from e union select r.src, e.dst from r join e on r.dst = e.src) select src, dst from r",
    "selection_sheet": f"""with {_CHOSEN} select player, position, role, action, is_captain,
  (case role when 'starter' then 0.0 when 'sixth' then 1.0 when 'bench' then 2.0 else 3.0 end - case when action = 'sell' then 0.5 else 0.0 end)::double as group_place from chosen""",
    "lineup_sum": f"""with {_CHOSEN} select 'fixed' as scenario, round(sum(pir_mean * (case when role in ('starter', 'sixth') then 1.0 when role = 'bench' then 0.5 else 0.0 end + is_captain)), 6) as points,
  round(sum(case when place <= need then crd_last else 0 end), 6) as price, count(*) filter (where action = 'sell') as sold from chosen""",
    "best_lineup": f"""with {_JOINED},
own as (select * from (select *, row_number() over (partition by season_code, team_id, position order by score desc, player_normalized) as place from (
    select season_code, team_id, player_normalized, position, avg(valuation) as score from joined group by 1, 2, 3, 4) where score is not null) where place <= case position when 'C' then 2 else 4 end),
ten as (select *, row_number() over (partition by season_code, team_id order by player_normalized, position) - 1 as bit, count(*) over (partition by season_code, team_id) as n from own),
masks as (select unnest(range(1024)) as mask),
lines as (select season_code, team_id, mask, sum(score * case when (mask >> bit) & 1 = 1 then 1.0 else 0.5 end) + max(case when (mask >> bit) & 1 = 1 then score end) as points,
    arg_max(player_normalized, score) filter (where (mask >> bit) & 1 = 1) as captain,
    count(*) filter (where (mask >> bit) & 1 = 1 and position = 'G') as g, count(*) filter (where (mask >> bit) & 1 = 1 and position = 'F') as f, count(*) filter (where (mask >> bit) & 1 = 1 and position = 'C') as c
  from ten, masks where n = 10 and bit_count(mask) = 6 group by 1, 2, 3)
select season_code, team_id, round(max(points), 4) as points, arg_max(captain, points) as captain from lines where (g, f, c) in {_SPLITS} group by 1, 2""",
    "squad_optimum_small": f"""with {_RANKED},
few as (select *, pir_mean - 0.1 * pir_std + 0.2 * greatest(0, pir_p90 - pir_mean) - 0.1 * greatest(0, pir_mean - pir_p10) as score, 3 * (pir_mean - 1.1 * crd_last) / 25 as growth,
    row_number() over (order by player) - 1 as bit from ranked where place <= case position when 'G' then 6 when 'F' then 5 else 3 end),
masks as (select unnest(range(16384)) as mask),
squads as (select mask, sum(growth) as growth, sum(crd_last) as price from few, masks where bit_count(mask) = 10 and (mask >> bit) & 1 = 1 group by mask
  having count(*) filter (where position = 'G') = 4 and count(*) filter (where position = 'F') = 4 and count(*) filter (where position = 'C') = 2 and sum(crd_last) <= {SMALL.cash} + 1e-6),
capped as (select mask from (select s.mask, f.team, count(*) as n from squads s join few f on (s.mask >> f.bit) & 1 = 1 group by 1, 2) group by mask having max(n) <= 6),
lines as (select s.mask, m.mask as active, s.growth from squads s join capped using (mask) join masks m on m.mask & s.mask = m.mask and bit_count(m.mask) = 6),
valued as (select l.mask, l.active, any_value(l.growth) as growth, sum(f.score * case when (l.active >> f.bit) & 1 = 1 then 1.0 else 0.5 end) + max(case when (l.active >> f.bit) & 1 = 1 then f.score end) as points,
    count(*) filter (where (l.active >> f.bit) & 1 = 1 and position = 'G') as g, count(*) filter (where (l.active >> f.bit) & 1 = 1 and position = 'F') as f_, count(*) filter (where (l.active >> f.bit) & 1 = 1 and position = 'C') as c
  from lines l join few f on (l.mask >> f.bit) & 1 = 1 group by 1, 2)
select round(max(points + growth), 4) as objective from valued where (g, f_, c) in {_SPLITS}""",
    "prepare_boxscore": f"with {_PREPARED} select game_player_id, year, team_id, opponent, homeaway, minutes, cast(minutes_num as double) as minutes_num from prepared",
    "join_stats_season": f"with {_JOINED} select game_player_id, player_normalized, position, quotation from joined",
    "join_stats_per_round": f"""with {_JOINED} select k.game_player_id, k.player_normalized, k.round, p.position, p.quotation from keyed k join prices p on k.season_code = p.season_code and k.team_id = p.team_id
  and k.player_normalized = p.player_normalized and p.round <> 'all' and try_cast(p.round as int) = k.round where p.quotation is not null and p.position is not null""",
    "player_kpis": f"with {_JOINED}, {_kpis('joined')} select player_normalized, team_id, position, {_rounded(_KPI_COLUMNS)} from kpis",
    "player_kpis_filled": f"with {_JOINED}, {_kpis('joined')} select player_normalized, team_id, position, {_rounded(list(_FILLED), _FILLED)} from kpis",
    "pir_game_team_position": f"with {_JOINED}, {_means_sql('joined')} select game_id, team_id, opponent, position, round(valuation, 6) as valuation from means",
    "grades_conceded": f"with {_GRADES} select opponent, position, {_GRADE_COLUMNS} from conceded",
    "grades_collected": f"with {_GRADES} select team_id, position, {_GRADE_COLUMNS} from collected",
    "grade_pivot_conceded": f"with {_GRADES} {_pivot('conceded', 'opponent', 'conceded')}",
    "grade_pivot_collected": f"with {_GRADES} {_pivot('collected', 'team_id', 'collected')}",
    "hist_long": f"""with {_GRADES} select game_id, team_id, opponent, position, round(valuation, 6) as valuation, game_id_num, no as game_no, no || '_' || opponent as game_no_opponent from (
  select *, printf('%03d', rank() over (partition by team_id, position order by game_id_num)) as no from (select *, string_split(game_id, '_')[-1] as game_id_num from means))""",
    "hist_wide": f"""with {_GRADES} select a.opponent as team, a.position, """ + ", ".join(
        f"round({t}.{c}, 6) as {n}" for t, w in (("a", "conceded"), ("b", "collected"))
        for c, n in (("valuation", f"pir_{w}_per_position"), ("league_average", f"pir_{w}_per_position_league_average"), ("normd_pstn_pir", f"normalized_pir_{w}_per_position_league_average"), ("grade", f"grade_pir_{w}_per_position"))
    ) + " from conceded a left join collected b on a.opponent = b.team_id and a.position = b.position",
    "next_round_games": f"with {_SCHEDULE} select season_code, gamecode, gameday, date, homecode, awaycode, turn from games",
    "next_round_by_team": f"with {_SCHEDULE} select season_code, team, opponent, turn, venue from sides",
    "schedule_grades": f"""with {_GRADES}, {_SCHEDULE}, pc as ({_pivot('conceded', 'opponent', 'conceded')}), pt as ({_pivot('collected', 'team_id', 'collected')})
select hometeam, homecode, awayteam, awaycode, turn, date, gameday, {_SCHEDULE_GRADES} from games left join pc home_conceded on homecode = home_conceded.team left join pc away_conceded on awaycode = away_conceded.team
left join pt home_collected on homecode = home_collected.team left join pt away_collected on awaycode = away_collected.team""",
    "analytical_record": f"with {_RECORD} select player, team, position, turn, venue, opponent, {_rounded(['normd_pstn_pir', 'exp_pir', *_KPI_COLUMNS], _FILLED)} from record",
    "optimizer_input": f"with {_RECORD} select player, team, position, turn, {_rounded(['crd_last', 'exp_pir'])}, 0 as in_prev_roster from record",
    "teams_distinct": "select distinct trim(team) as team, upper(trim(code)) as code, trim(tv) as tv from clubs",
    "merge_deltas": f"""with {_BOX}, b as (select season_code, game_player_id, valuation, cast(regexp_extract(season_code, '([0-9]+)', 1) as int) as y from box)
select season_code, game_player_id, valuation from b where y >= 2025 or season_code not in (select season_code from b where y >= 2025)""",
    "merge_covered_seasons": f"""with {_BOX}, b as (select season_code, cast(regexp_extract(season_code, '([0-9]+)', 1) as int) as y from box)
select season_code, count(*) as n from b where y <= 2025 and season_code not in (select season_code from b where y >= 2025) group by 1""",
    "merge_base_season": f"""with {_BOX}, b as (select season_code, game_player_id, valuation, cast(regexp_extract(season_code, '([0-9]+)', 1) as int) as y from box), m as (select max(season_code) as s from b where y <= 2024)
select season_code, game_player_id, valuation from b, m where (y <= 2024 and season_code = s) or (y >= 2024 and season_code > s)""",
    "dedupe_lowest_rank": f"with {_PRICES} select season_code, round, player_id, rank from listed",
    "duplicate_keys": "select game_player_id, count(*) as n from euroleague_box_score group by 1 having count(*) > 1",
    "blank_rows": "select doc_id from documents where coalesce(trim(text, ' '), '') = ''",
    "normalize_names": f"select distinct player, {_norm('player')} as normalized from euroleague_box_score",
    "match_keys": f"select distinct player, {_key('player')} as key from euroleague_box_score",
    "reorder_abbreviate": f"select distinct player, {_reorder('player')} as reordered, {_short(_reorder('player'))} as abbreviated from euroleague_box_score",
    "title_case": f"select distinct player, {_title('player')} as titled from euroleague_box_score",
    "spelling_pools": f"with {_POOLS} select spelling, array_to_string(owners, '|') as owners from everyone",
    "recent_season_pool": f"with {_POOLS} select club, spelling, array_to_string(owners, '|') as owners from clubbed",
    "raw_spellings": f"with {_POOLS} select key, array_to_string(raw, '|') as raw from raw",
    "candidate_status": f"with {_MATCHED} select team, name, club, match_status, matched_by from rows1",
    "decisions_overlay": f"with {_MATCHED} select team, name, match_status, matched_by from overlaid",
    "map_variants": f"with {_MATCHED} select * replace (array_to_string(variants, ' | ') as variants) from entries",
    "lookup_player": f"""with {_MATCHED}, a as (select key, count(distinct name) as n, min(name) as name from known group by 1), b as (select key, club, count(distinct name) as n, min(name) as name from known group by 1, 2)
select p.player, p.team_id, l.club, case when a.n = 1 then a.name when b.n = 1 then b.name end as player_normalized from (select distinct player, team_id from box) p left join lookup l on {_norm("p.team_id")} = l.key
left join a on a.key = {_norm("p.player")} left join b on b.key = {_norm("p.player")} and b.club = l.club""",
    "lookup_team": f"with {_CLUBS} select t.team_id, l.club from (select distinct team_id from euroleague_box_score) t left join lookup l on {_norm('t.team_id')} = l.key",
    "audit_stats_only": f"with {_MATCHED} select stats_team as team, stats_name as name, team as club, match_status as status, notes from entries where match_status not in ('exact', 'confirmed')",
    "audit_box_only": f"with {_BOXONLY} select team, club, player, games, array_to_string(rounds, ',') as rounds from boxonly",
    "audit_hint": f"""with {_BOXONLY},
near as (select b.*, case when e.stats_name is not null then e.stats_team || ' ' || e.stats_name || ' (' || e.match_status || ')' end as t from boxonly b
  left join (select * from entries where match_status <> 'exact') e on b.club = e.team and len(list_intersect(
    list_filter(string_split({_norm("substr(e.stats_name, strpos(e.stats_name || ' ', ' ') + 1)")}, ' '), lambda x: x <> ''), string_split({_norm("b.player")}, ' '))) > 0),
g as (select team, club, player, games, rounds, list_sort(list_distinct(coalesce(list(t) filter (where t is not null), []))) as likely from near group by 1, 2, 3, 4, 5)
select team, club, player, games, case when len(rounds) > 1 then rounds[1] || '-' || rounds[-1] else cast(rounds[1] as varchar) end as rounds, array_to_string(likely, '; ') as likely,
  case when club = '' then 'unknown team' when len(likely) = 0 then 'not listed' else 'likely' end as verdict, {_title(_reorder("player"))} as decide_as from g""",
    "objective_components": f"""with {_CANDIDATES}, p as (select player, pir_mean as target, crd_last as price,
    -0.1 * pir_std + 0.2 * greatest(0, pir_p90 - pir_mean) - 0.1 * greatest(0, pir_mean - pir_p10) as r, (pir_mean - 1.1 * crd_last) / 25 as g from candidates)
select player, round(r, 6) as risk_adjustment, round(target + r, 6) as score, round(g, 6) as credit_growth, round(3 * g, 6) as growth_value from p""",
    "input_rule_counts": f"""with {_CANDIDATES} select count(*) filter (where isnan(crd_last) or isinf(crd_last) or isnan(pir_mean) or isinf(pir_mean)) as not_finite, count(*) filter (where trim(player) = '') as blank_player,
count(*) - count(distinct player) as repeated_player, count(*) filter (where position not in ('G', 'F', 'C')) as unknown_position, count(*) filter (where crd_last <= 0) as price_not_positive,
count(*) filter (where turn < 1) as turn_not_whole, 0 as flag_not_0_or_1, 0 as previous, """ + ", ".join(f"count(*) filter (where position = '{p}') as candidates_{p}, 0 as previous_{p}" for p in "GFC") + " from candidates",
    "candidate_counts": f"with {_CANDIDATES} select position, turn, count(*) as candidates from candidates group by 1, 2",
}
