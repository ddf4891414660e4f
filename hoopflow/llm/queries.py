"""The queries of the operators for text and model-training data, and SQL for those that SQL can state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoopflow.llm import garbled, linkage, mixing, names, percentiles, tokens
from hoopflow.session import cut, table


def _people(spark: SparkSession, d: str) -> list[DataFrame]:
    return [table(spark, d, n) for n in ("euroleague_box_score", "player_name_decisions", "clubs", "fantasy_players")]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return names.found(*_people(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_confidences(spark, d).select("decision_id", "player_id")


def p3_confidences(spark: SparkSession, d: str) -> DataFrame:
    return linkage.matches(*_people(spark, d))


def _valued(spark: SparkSession, d: str) -> DataFrame:
    return percentiles.person_rows(table(spark, d, "euroleague_box_score"))


def p6_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return percentiles.percentiles(_valued(spark, d), percentiles.box_groups(), F.col("valuation"))


def p6_states(spark: SparkSession, d: str) -> DataFrame:
    return percentiles.prefix_state(_valued(spark, d), percentiles.box_groups(), F.col("valuation"), F.col("season_code"))


def p6_merged(spark: SparkSession, d: str) -> DataFrame:
    return percentiles.merge(p6_states(spark, d))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"))


def p7_decoded(spark: SparkSession, d: str) -> DataFrame:
    return tokens.decode(cut(p7_ids(spark, d)), spark)


def p8_copies(spark: SparkSession, d: str) -> DataFrame:
    return mixing.choose(cut(mixing.sized_documents(table(spark, d, "documents"))), table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    sized, targets = cut(mixing.sized_documents(table(spark, d, "documents"))), table(spark, d, "mix_targets")
    return mixing.shares(mixing.choose(sized, targets), sized, targets)


def p9_restored(spark: SparkSession, d: str) -> DataFrame:
    return garbled.garbled(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_restored(spark, d).select("doc_id")


QUERIES = {
    f.__name__: f
    for f in (p1_found, p3_found, p3_confidences, p6_percentiles, p6_states, p6_merged, p7_ids, p7_decoded, p8_copies, p8_shares, p9_found, p9_restored)
}

_RANKED = r"""with v as (
  select 'player' as level, player as grp, valuation as v from euroleague_box_score where coalesce(upper(trim(dorsal)) <> 'TOTAL', true)
  union all
  select 'club_season', coalesce(upper(regexp_replace(team_id, '^[\s\x{00a0}]+|[\s\x{00a0}]+$', '', 'g')), '') || '|' || season_code, valuation
  from euroleague_box_score where coalesce(upper(trim(dorsal)) <> 'TOTAL', true)),
r as (select level, grp, v, row_number() over (partition by level, grp order by v) as rn, count(*) over (partition by level, grp) as n from v where v is not null)
select level, grp, max(n) as n, """ + ", ".join(
    f"cast(max(case when rn = greatest(1, ({q} * n + 999) // 1000) then v end) as double) as p{q}" for q in percentiles.TARGETS
) + " from r group by level, grp"

SQL = {
    "p6_percentiles": _RANKED,
    # Whole numbers below 2**20 are exact in the 32 bits that the states keep.
    "p6_merged": _RANKED,
    "p7_decoded": "select doc_id, coalesce(text, '') as text from documents",
}
