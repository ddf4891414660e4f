"""The queries of the general data problems, and SQL for those that SQL can state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hoopflow.operators import references, rolling
from hoopflow.session import table, work_dir
from hoopflow.streaming.seen import repeats


def _four(spark: SparkSession, d: str) -> list[DataFrame]:
    return [table(spark, d, n) for n in ("euroleague_box_score", "euroleague_game_header", "player_name_decisions", "clubs")]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_rows(*_four(spark, d))


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_counts(*_four(spark, d))


def p4_trailing_days(spark: SparkSession, d: str) -> DataFrame:
    """The newest of two versions: most deliveries in the first, the last ones as arrivals."""
    return rolling.trailing_days(table(spark, d, "euroleague_box_score"), table(spark, d, "euroleague_game_header"), work_dir(spark, "rolling"))


def p4_versions(spark: SparkSession, d: str) -> DataFrame:
    """The same through four versions, the later ones made of arrivals and corrections."""
    return rolling.trailing_days(table(spark, d, "euroleague_box_score"), table(spark, d, "euroleague_game_header"), work_dir(spark, "rolling"), (0.4, 0.7, 0.9))


def p4_trailing_rounds(spark: SparkSession, d: str) -> DataFrame:
    return rolling.trailing_rounds(table(spark, d, "euroleague_box_score"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return repeats(table(spark, d, "euroleague_box_score"), work_dir(spark, "seen"))


QUERIES = {f.__name__: f for f in (p2_found, p2_counts, p4_trailing_days, p4_versions, p4_trailing_rounds, p5_found)}

#: Shared parts of the SQL: canonical games and messages, and the first delivery of each player message.
_GAME = r"regexp_replace(upper(regexp_replace({c}, '[\s\x{{00a0}}]+', '', 'g')), '^([A-Z]+[0-9]+)[^A-Z0-9]+0*([0-9]+)$', '\1_\2')"
_MESSAGE = r"regexp_replace(upper(regexp_replace(game_player_id, '[\s\x{00a0}]+', '', 'g')), '^([A-Z]+[0-9]+)[^A-Z0-9]+0*([0-9]+)[^A-Z0-9]+(.+)$', '\1_\2_\3')"
_REF = r"nullif(nullif(lower(regexp_replace({c}, '^[\s\x{{00a0}}]+|[\s\x{{00a0}}]+$', '', 'g')), ''), '-')"
_ORPHANS = f"""
names as (select {_REF.format(c="x")} as ref, added_on, removed_on from (select unnest([code, team, tv]) as x, added_on, removed_on from clubs)),
days as (select {_GAME.format(c="game_id")} as game_key, min(date) as day from euroleague_game_header group by 1),
refs as (
  select 'euroleague_box_score' as table_name, season_code, cast(delivery_id as varchar) as row_key, {_REF.format(c="team_id")} as ref, day
  from (select *, {_GAME.format(c="game_id")} as game_key from euroleague_box_score) left join days using (game_key)
  union all
  select 'player_name_decisions', season_code, decision_id, {_REF.format(c="stats_team")}, cast(decided_at as date) from player_name_decisions),
lost as (
  select * from refs where ref is not null and not exists (
    select 1 from names n where n.ref = refs.ref and (refs.day is null or (n.added_on <= refs.day and (n.removed_on is null or refs.day < n.removed_on)))))"""
_FIRST = f"""
delivered as (select *, {_MESSAGE} as message from euroleague_box_score where game_player_id is not null),
first as (select *, split_part(message, '_', 3) as code from (
  select *, row_number() over (partition by message order by loaded_at nulls last, delivery_id) as rn from delivered) where rn = 1),
played as (
  select code as player_id, {_GAME.format(c="game_id")} as game_key, upper(trim(season_code)) as season_code, round, cast(valuation as bigint) as val,
    case when upper(trim(minutes)) = 'DNP' then 0
         when regexp_matches(trim(minutes), '^[0-9]{{1,3}}:[0-9]{{1,2}}$')
         then cast(split_part(trim(minutes), ':', 1) as int) * 60 + cast(split_part(trim(minutes), ':', 2) as int) end as secs
  from first where not coalesce(upper(trim(dorsal)) = 'TOTAL' or list_contains(string_split(upper(regexp_replace(game, '\\s', '', 'g')), '-'), code), false)),
days as (select {_GAME.format(c="game_id")} as game_key, min(date) as day from euroleague_game_header group by 1)"""


def _trailing(windows: tuple[int, ...], at: str, by: str = "") -> str:
    cells = []
    for w in windows:
        near = f"filter (where s.{at} - a.{at} < {w})"
        cells.append(
            f"coalesce(sum(a.games) {near}, 0) as games_{w}, coalesce(sum(a.val_sum) {near}, 0) as valuation_total_{w}, "
            f"(sum(a.val_sum) {near}) / nullif(cast(sum(a.val_n) {near} as double), 0) as valuation_avg_{w}, "
            f"coalesce(sum(a.secs_sum) {near}, 0) / 60.0 as minutes_total_{w}, "
            f"(sum(a.secs_sum) {near}) / 60.0 / nullif(cast(sum(a.secs_n) {near} as double), 0) as minutes_avg_{w}"
        )
    keys = f"s.player_id, {'s.' + by + ', ' if by else ''}s.{at}"
    same = f"a.player_id = s.player_id {f'and a.{by} = s.{by}' if by else ''} and a.{at} <= s.{at} and s.{at} - a.{at} < {max(windows)}"
    body = ", ".join(cells)
    for name in [f"{k}_{w}" for w in windows for k in ("games", "valuation_total")]:
        body = body.replace(f" as {name}", f"::bigint as {name}")
    return f"select {keys}, {body} from spine s left join amounts a on {same} group by {keys.replace('s.', 's.')}"


_P4 = f"""with {_FIRST},
amounts as (select player_id, day, coalesce(sum(val), 0) as val_sum, count(val) as val_n, coalesce(sum(secs), 0) as secs_sum, count(secs) as secs_n, count(*) as games
  from played join days using (game_key) where day is not null group by all),
spine as (select player_id, cast(unnest(generate_series(min(day), max(day) + 29, interval 1 day)) as date) as day from amounts group by player_id)
{_trailing((7, 30), "day")}"""
SQL = {
    "p2_found": f"with {_ORPHANS} select table_name, season_code, row_key from lost",
    "p2_counts": f"""with {_ORPHANS}, t as (select table_name, season_code, count(*) as n_references from refs where ref is not null group by all),
l as (select table_name, season_code, count(*) as n_orphans from lost group by all)
select t.table_name, t.season_code, n_references, coalesce(n_orphans, 0) as n_orphans from t left join l on t.table_name = l.table_name and t.season_code is not distinct from l.season_code""",
    "p4_trailing_days": _P4,
    "p4_versions": _P4,
    "p4_trailing_rounds": f"""with {_FIRST},
amounts as (select player_id, season_code, round, coalesce(sum(val), 0) as val_sum, count(val) as val_n, coalesce(sum(secs), 0) as secs_sum, count(secs) as secs_n, count(*) as games
  from played where round is not null group by all),
spine as (select player_id, season_code, cast(unnest(generate_series(min(round), max(round) + 4)) as int) as round from amounts group by player_id, season_code)
{_trailing((3, 5), "round", "season_code")}""",
    "p5_found": f"""select delivery_id from (select delivery_id, row_number() over (partition by {_MESSAGE} order by loaded_at nulls last, delivery_id) as rn
from euroleague_box_score where game_player_id is not null) where rn > 1""",
}
