"""Exact, club-scoped matching of listed players to box-score spellings, recorded decisions, lookups and the audit.

Every step is a join on a normalised key. Pools are grouped before they are joined, so a common name is one row with a set of owners.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoopflow.functions.text import abbreviate_name, full_name, match_key, name_tokens, normalize_name, reorder_name, rounds_label, surname_tokens, title_case

OPEN = ("needs_review", "no_candidate")
RESOLVED = ("exact", "confirmed")
DECIDED = ("confirmed", "rejected", "no_match")
NOT_PLAYED = ("", "DNP", "0:00")


def team_entries(schedule: DataFrame) -> DataFrame:
    """team, variants: one row per home team. An empty schedule, a team with two code pairs or a spelling of two teams is an error."""
    pairs = schedule.select(*[F.trim(c).alias(c) for c in ("hometeam", "homecode", "hometv")]).distinct()
    per = pairs.groupBy("hometeam").agg(F.collect_set(F.struct("homecode", "hometv")).alias("codes"))
    bad = per.where(F.size("codes") > 1).limit(3).collect()
    if bad:
        raise ValueError(f"teams with several code pairs: {[r['hometeam'] for r in bad]}")
    entries = per.select(
        F.col("hometeam").alias("team"), F.array_sort(F.array_distinct(F.array("hometeam", F.col("codes")[0]["homecode"], F.col("codes")[0]["hometv"]))).alias("variants")
    )
    if entries.isEmpty():
        raise ValueError("the schedule has no rows")
    clash = team_lookup(entries).groupBy("key").agg(F.collect_set("club").alias("clubs")).where(F.size("clubs") > 1).limit(3).collect()
    if clash:
        raise ValueError(f"spellings of two teams: {[(r['key'], sorted(r['clubs'])) for r in clash]}")
    return entries


def team_lookup(entries: DataFrame) -> DataFrame:
    """key, club: every spelling of a team."""
    spelled = entries.select(F.explode(F.concat("variants", F.array("team"))).alias("v"), F.col("team").alias("club"))
    return spelled.select(normalize_name(F.col("v")).alias("key"), "club").distinct()


def with_club(df: DataFrame, team: str, lookup: DataFrame, name: str = "club") -> DataFrame:
    """Adds the club a team spelling stands for; null where it is unknown."""
    return df.join(lookup.select(F.col("key").alias("_k"), F.col("club").alias(name)), normalize_name(F.col(team)) == F.col("_k"), "left").drop("_k")


def spelling_pool(box: DataFrame) -> DataFrame:
    """spelling, owners: reordered box-score spellings and the player ids behind each; club rows don't count."""
    rows = box.where((F.col("dorsal") != "TOTAL") | F.col("dorsal").isNull())
    return rows.groupBy(reorder_name(F.col("player")).alias("spelling")).agg(F.array_sort(F.collect_set("player_id")).alias("owners"))


def recent_seasons(box: DataFrame, n: int = 2) -> DataFrame:
    """season_code of the last n seasons that have player rows."""
    rows = box.where((F.col("dorsal") != "TOTAL") | F.col("dorsal").isNull())
    return rows.select("season_code").distinct().orderBy(F.desc("season_code")).limit(n)


def club_pool(box: DataFrame, lookup: DataFrame, n: int = 2) -> DataFrame:
    """club, spelling, owners over the recent seasons; rows of unknown clubs are left out."""
    rows = box.where((F.col("dorsal") != "TOTAL") | F.col("dorsal").isNull()).join(recent_seasons(box, n), "season_code", "left_semi")
    rows = with_club(rows, "team_id", lookup).where("club is not null")
    return rows.groupBy("club", reorder_name(F.col("player")).alias("spelling")).agg(F.array_sort(F.collect_set("player_id")).alias("owners"))


def raw_spellings(box: DataFrame) -> DataFrame:
    """key, raw: the spellings as written behind each normalised full name."""
    rows = box.where((F.col("dorsal") != "TOTAL") | F.col("dorsal").isNull())
    return rows.groupBy(normalize_name(reorder_name(F.col("player"))).alias("key")).agg(F.array_sort(F.collect_set("player")).alias("raw"))


def candidate_pool(pool: DataFrame, *by: str) -> DataFrame:
    """by..., key, n_spellings, n_owners, candidates: full names under the match key of their abbreviation.

    Abbreviations with one key are the key's spellings; the full names behind the only abbreviation are its owners.
    """
    named = pool.select(*by, F.col("spelling").alias("full"), abbreviate_name(F.col("spelling")).alias("short"))
    return (
        named.groupBy(*by, match_key(F.col("short")).alias("key"))
        .agg(F.count_distinct("short").alias("n_spellings"), F.array_sort(F.collect_set(F.struct("short", "full"))).alias("pairs"))
        .select(*by, "key", "n_spellings", F.size("pairs").alias("n_owners"), F.transform("pairs", lambda p: p["full"]).alias("candidates"))
    )


def candidate_status(n_spellings: Column, n_owners: Column) -> tuple[Column, Column]:
    """Status and how it was found: one spelling of one owner is exact, more of either needs review."""
    status = F.when(n_spellings.isNull(), "no_candidate").when((n_spellings == 1) & (n_owners == 1), "exact").otherwise("needs_review")
    how = F.when(n_spellings > 1, "exact_ambiguous_spelling").when(n_owners > 1, "exact_collision").otherwise("exact")
    return status, how


def match_rows(stats: DataFrame, lookup: DataFrame, clubs: DataFrame, everyone: DataFrame) -> DataFrame:
    """One row per listed player: the club's recent spellings first, then all history, where a single hit still needs review."""
    players = with_club(stats.select("team", "name").distinct(), "team", lookup)
    own = candidate_pool(clubs, "club").select(F.col("club").alias("_club"), F.col("key").alias("_key"), *[F.col(c).alias(f"own_{c}") for c in ("n_spellings", "n_owners", "candidates")])
    rest = candidate_pool(everyone).select(F.col("key").alias("_all"), *[F.col(c).alias(f"all_{c}") for c in ("n_spellings", "n_owners", "candidates")])
    p = players.withColumn("key", match_key(F.col("name")))
    p = p.join(own, (p.club == F.col("_club")) & (p.key == F.col("_key")), "left").join(rest, p.key == F.col("_all"), "left")
    status, how = candidate_status(F.col("own_n_spellings"), F.col("own_n_owners"))
    status2, how2 = candidate_status(F.col("all_n_spellings"), F.col("all_n_owners"))
    elsewhere = (status == "no_candidate") & (status2 == "exact")
    p = p.select(
        "team", "name", F.coalesce("club", F.lit("")).alias("club"),
        F.when(elsewhere, "needs_review").when(status == "no_candidate", status2).otherwise(status).alias("match_status"),
        F.when(elsewhere, "exact_other_club").when(status == "no_candidate", how2).otherwise(how).alias("matched_by"),
        F.transform(F.coalesce(F.when(status == "no_candidate", F.col("all_candidates")).otherwise(F.col("own_candidates")), F.array().cast("array<string>")), title_case).alias("candidates"),
    )
    unknown = F.when(F.col("club") == "", F.concat(F.lit("team code '"), F.col("team"), F.lit("' is not in the team map")))
    listed = F.when((F.size("candidates") > 0) & (F.col("match_status") == "needs_review"), F.concat(F.lit("candidates: "), F.array_join("candidates", "; ")))
    return p.select(
        "team", "name", "club", F.coalesce(F.get("candidates", F.lit(0)), F.lit("")).alias("resolved_name"), "match_status", "matched_by", F.concat_ws("; ", unknown, listed).alias("notes")
    )


def check_decisions(decisions: DataFrame) -> DataFrame:
    """stats_team, stats_name, match_status, resolved_name, notes; unknown statuses, missing notes and confirmations without a name are errors."""
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    problem = (
        F.when(~F.coalesce(F.col("match_status").isin(*DECIDED), F.lit(False)), "unknown status")
        .when(blank("notes"), "no notes")
        .when((F.col("match_status") == "confirmed") & blank("name"), "confirmed without a name")
    )
    bad = decisions.withColumn("problem", problem).where("problem is not null").limit(3).collect()
    if bad:
        raise ValueError("; ".join(f"{r['stats_team']}|{r['stats_name']}: {r['problem']}" for r in bad))
    name = F.when(F.col("match_status") == "confirmed", F.trim("name")).otherwise("")
    return decisions.select("stats_team", "stats_name", "match_status", name.alias("resolved_name"), F.trim("notes").alias("notes"))


def apply_decisions(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decisions replace everything but exact matches; those about players that are gone have no effect. One decision per key."""
    d = decisions.select(F.col("stats_team").alias("team"), F.col("stats_name").alias("name"), *[F.col(c).alias(f"d_{c}") for c in ("match_status", "resolved_name", "notes")])
    use = (F.col("match_status") != "exact") & F.col("d_match_status").isNotNull()
    pick = lambda c: F.when(use, F.col(f"d_{c}")).otherwise(F.col(c)).alias(c)
    joined = rows.join(d, ["team", "name"], "left")
    return joined.select("team", "name", "club", pick("resolved_name"), pick("match_status"), F.when(use, "agent").otherwise(F.col("matched_by")).alias("matched_by"), pick("notes"))


def map_entries(rows: DataFrame, raw: DataFrame) -> DataFrame:
    """The player map: resolved players carry the full name and all its spellings, others their listed name."""
    done = F.col("match_status").isin(*RESOLVED)
    r = rows.withColumn("full", F.when(done, F.col("resolved_name")).otherwise(F.col("name")))
    r = r.join(raw.withColumnRenamed("key", "_key"), done & (normalize_name(F.col("full")) == F.col("_key")), "left")
    variants = F.array_sort(F.array_union(F.array("name", "full"), F.coalesce("raw", F.array().cast("array<string>"))))
    return r.select(
        F.col("team").alias("stats_team"), F.col("name").alias("stats_name"), F.col("club").alias("team"), F.col("full").alias("name"), variants.alias("variants"), "match_status", "matched_by", "notes"
    )


def player_lookup(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables: (key, n_names, name) over all clubs and (key, club, n_names, name); open entries aren't looked up."""
    known = entries.where(~F.col("match_status").isin(*OPEN)).select(F.explode("variants").alias("v"), F.col("team").alias("club"), "name")
    known = known.select(normalize_name(F.col("v")).alias("key"), "club", "name")
    one = [F.count_distinct("name").alias("n_names"), F.min("name").alias("only")]
    return known.groupBy("key").agg(*one), known.groupBy("key", "club").agg(*one)


def resolve_players(df: DataFrame, name: str, club: str, entries: DataFrame, out: str = "player_normalized") -> DataFrame:
    """Adds the full name behind a spelling: the only one, else the only one within the club, else null."""
    by_key, by_club = player_lookup(entries)
    d = df.withColumn("_k", normalize_name(F.col(name)))
    a = by_key.select(F.col("key").alias("_k"), F.col("n_names").alias("_n"), F.col("only").alias("_only"))
    b = by_club.select(F.col("key").alias("_k"), F.col("club").alias("_c"), F.col("n_names").alias("_cn"), F.col("only").alias("_conly"))
    d = d.join(a, "_k", "left").join(b.withColumnRenamed("_k", "_k2"), (F.col("_k") == F.col("_k2")) & (F.col(club) == F.col("_c")), "left")
    found = F.when(F.col("_n") == 1, F.col("_only")).when(F.col("_cn") == 1, F.col("_conly"))
    return d.withColumn(out, found).drop("_k", "_k2", "_n", "_only", "_c", "_cn", "_conly")


def stats_only(entries: DataFrame) -> DataFrame:
    """Listed players that no box-score spelling resolves to."""
    return entries.where(~F.col("match_status").isin(*RESOLVED)).select(
        F.col("stats_team").alias("team"), F.col("stats_name").alias("name"), F.col("team").alias("club"), F.col("match_status").alias("status"), "notes"
    )


def box_only(box: DataFrame, entries: DataFrame, lookup: DataFrame) -> DataFrame:
    """team, club, player, games, rounds of players with minutes whose spelling the map doesn't know; shared names count as known."""
    played = box.where((F.coalesce(F.col("dorsal"), F.lit("")) != "TOTAL") & ~F.coalesce(F.trim("minutes"), F.lit("")).isin(*NOT_PLAYED))
    per = played.groupBy("team_id", "player").agg(F.count_distinct(F.struct("game_id", "round")).alias("games"), F.array_sort(F.collect_set("round")).alias("rounds"))
    known, _ = player_lookup(entries)
    per = per.withColumn("_k", normalize_name(F.col("player"))).join(known.select(F.col("key").alias("_k")), "_k", "left_anti").drop("_k")
    return with_club(per, "team_id", lookup).select(F.col("team_id").alias("team"), F.coalesce("club", F.lit("")).alias("club"), "player", "games", "rounds")


def status_counts(entries: DataFrame) -> DataFrame:
    """match_status, matched_by, names, clubs: how many listed names ended how, and at which clubs (sorted, '' for unknown ones)."""
    return entries.groupBy("match_status", "matched_by").agg(F.count(F.lit(1)).alias("names"), F.array_sort(F.collect_set(F.coalesce("team", F.lit("")))).alias("clubs"))


def audit_cases(entries: DataFrame, hinted: DataFrame) -> DataFrame:
    """case, club, players: the audit's report: listed only, in the box score only (likely or not listed), and of an unknown team."""
    listed = stats_only(entries).select(F.lit("listed only").alias("case"), "club")
    boxed = hinted.select(F.when(F.col("verdict") == "unknown team", "unknown team").when(F.col("verdict") == "likely", "box score only, likely").otherwise("box score only").alias("case"), "club")
    return listed.unionByName(boxed).groupBy("case", F.coalesce("club", F.lit("")).alias("club")).agg(F.count(F.lit(1)).alias("players"))


def hints(boxed: DataFrame, entries: DataFrame) -> DataFrame:
    """What the audit says of each unresolved box-score player, with same-club listed players of the same surname.

    Names meet on club and token, and what is listed under a token is one row, so rows of a frequent club or of unknown teams aren't compared in pairs.
    """
    text = F.concat_ws(" ", "stats_team", "stats_name", F.concat(F.lit("("), "match_status", F.lit(")")))
    free = entries.where("match_status <> 'exact'").select(F.col("team").alias("_club"), text.alias("text"), F.explode(surname_tokens(F.col("stats_name"))).alias("_token"))
    listed = free.groupBy("_club", "_token").agg(F.collect_set("text").alias("texts"))
    near = boxed.select("*", F.explode_outer(name_tokens(F.col("player"))).alias("token")).join(listed, (F.col("club") == F.col("_club")) & (F.col("token") == F.col("_token")), "left")
    g = near.groupBy("team", "club", "player", "games", "rounds").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("texts")))).alias("likely"))
    return g.select(
        "team", "club", "player", "games", rounds_label(F.col("rounds")).alias("rounds"), F.array_join("likely", "; ").alias("likely"),
        F.when(F.col("club") == "", "unknown team").when(F.size("likely") == 0, "not listed").otherwise("likely").alias("verdict"), full_name(F.col("player")).alias("decide_as"),
    )
