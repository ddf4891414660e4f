"""Variant spellings of names typed by people.

Distinct tokens meet through a symmetric-delete index: two tokens few edits apart share a string that is left after deleting letters
from each. Distinct names that have such a token in common are aligned by the best assignment of their tokens, in which initials,
abbreviations and short forms may stand for a token; short forms are learnt from spellings known to be one person's. What else the
rows say of two aligned names (shirt number, years, clubs, games played together) are votes, and a generative model that is fitted
without labels says which pairs are one person.

Nothing pairs all rows of a name: a token that many names share (a given name) only joins names whose other tokens begin alike, and
rows meet on a pair of names together with a piece of evidence (shirt number, club and year, or league and year), so a name or a
given name that a third of all rows carry spreads over these.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoopflow.llm import people
from hoopflow.llm.labelmodel import posterior
from hoopflow.llm.spelling import LEARNT, LIKE, SAME, align, keys, token_score
from hoopflow.session import cut

#: Spellings of so many different people must show a short form before it counts.
SHOWN = 2
#: The score of different tokens that don't even have two letters in common.
UNLIKE = -2.0


def token_pairs(names: DataFrame) -> DataFrame:
    """a, b: tokens of ``name`` that are one token spelled twice, both ways round, equal ones included. Single letters are left out."""

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(key=[sorted(keys(t)) for t in b["token"]]).explode("key", ignore_index=True).dropna(subset=["key"])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[[token_score(x, y) >= SAME for x, y in zip(b["a"], b["b"])]]

    tokens = cut(names.select(F.explode(F.split("name", " ")).alias("token")).where("length(token) > 1").distinct())
    listed = tokens.mapInPandas(index, "token string, key string")
    met = listed.withColumnRenamed("token", "a").join(listed.withColumnRenamed("token", "b"), "key").where("a < b").select("a", "b").distinct()
    near = met.mapInPandas(score, "a string, b string")
    return cut(near.union(near.select("b", "a")).union(tokens.select("token", F.col("token").alias("x"))))


def partners(names: DataFrame, same: DataFrame) -> DataFrame:
    """token, rare: how few other tokens a token occurs with: 1 up to two, 0 up to nine, -1 beyond (given names, as a rule).

    A token is as common as the most common of those that are the same token spelled otherwise.
    """
    t = F.split("name", " ")
    pairs = names.select("name", F.explode(t).alias("token")).where("length(token) > 1").withColumn("other", F.explode(t)).where("token != other and length(other) > 1")
    n = pairs.groupBy("token").agg(F.count_distinct("other").alias("n"))
    most = same.join(n.withColumnRenamed("token", "b"), "b").groupBy(F.col("a").alias("token")).agg(F.max("n").alias("n"))
    return most.select("token", F.when(F.col("n") <= 2, 1).when(F.col("n") <= 9, 0).otherwise(-1).alias("rare"))


def listed(names: DataFrame) -> DataFrame:
    """league, name, token, begins: each name under its tokens, with the first two letters of its other tokens (any letter, where there are none)."""
    others = F.expr("filter(split(name, ' '), (x, j) -> j <> _i)")
    first = F.array_distinct(F.filter(F.flatten(F.transform(others, lambda x: F.array(F.substring(x, 1, 1), F.substring(x, 2, 1)))), lambda c: c != ""))
    any_letter = F.array(*[F.lit(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"])
    out = names.select("league", "name", F.posexplode(F.split("name", " ")).alias("_i", "token")).where("length(token) > 1")
    return out.select("league", "name", "token", F.when(F.size(first) > 0, first).otherwise(any_letter).alias("begins"))


def meeting(names: DataFrame, same: DataFrame, rare: DataFrame) -> DataFrame:
    """league, name_a, name_b (a <= b): names of one league that have a token in common and, if that is a common one, agree in the beginning of another.

    Of any two names that ``align`` accepts some token pair is met here: where the shared tokens are common, two aligned names agree in
    one of the first two letters of some other token.
    """
    any_begin = F.array(F.lit(""))
    own = listed(names).join(rare, "token", "left").withColumn("common", F.coalesce(F.col("rare") == -1, F.lit(False)))
    b = own.select("league", F.col("name").alias("name_b"), F.col("token").alias("token_b"), F.explode(F.when(F.col("common"), F.col("begins")).otherwise(F.concat(any_begin, "begins"))).alias("begin"))
    to = same.join(rare.withColumnRenamed("token", "b"), "b", "left").select(F.col("a").alias("token"), "b", F.coalesce(F.col("rare") == -1, F.lit(False)).alias("to_common"))
    # A rare misspelling of a common token meets the names with that token no more freely than they meet each other.
    a = own.select("league", F.col("name").alias("name_a"), "token", "begins", F.col("common").alias("from_common")).join(to, "token").withColumn("few", ~F.col("from_common") & ~F.col("to_common"))
    a = a.select("league", "name_a", F.col("token").alias("token_a"), F.col("b").alias("token_b"), "few", F.explode(F.when(F.col("few"), any_begin).otherwise(F.col("begins"))).alias("begin"))
    # What ``token_score`` asks of other tokens, a little wider: the exact alignment follows.
    tail = "substring(if(length(x) > length(y), x, y), 1, least(length(x), length(y)))"
    letters = lambda t: f"array_join(array_sort(split({t}, '')), '')"
    edits = f"levenshtein(x, y, 2) >= 0 or (levenshtein(x, y, 4) >= 0 and levenshtein({letters('x')}, {letters('y')}, 2) >= 0)"
    close = f"startswith(x, y) or startswith(y, x) or (least(length(x), length(y)) > 3 and ({edits})) or levenshtein(if(length(x) > length(y), y, x), {tail}, 2) >= 0"
    other = f"exists(split(name_a, ' '), x -> x <> token_a and exists(split(name_b, ' '), y -> y <> token_b and ({close})))"
    alone = "not contains(name_a, ' ') or not contains(name_b, ' ')"
    met = a.join(b, ["league", "token_b", "begin"]).where(f"name_a <= name_b and (few or name_a = name_b or {alone} or {other})")
    return met.select("league", "name_a", "name_b").distinct()


def aligned(pairs: DataFrame) -> DataFrame:
    """league, name_a, name_b, family, given, extra, odd, top of the pairs whose family names are the same."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            s = [align(tuple(x.split()), tuple(y.split())) for x, y in zip(p["name_a"], p["name_b"])]
            p = p.assign(**{k: [x[i] for x in s] for i, k in enumerate(("family", "given", "extra", "odd", "top"))})
            yield p[p["family"] >= SAME]

    return pairs.mapInPandas(score, "league string, name_a string, name_b string, family double, given double, extra int, odd string, top string")


def names_alike(names: DataFrame, one: DataFrame) -> DataFrame:
    """league, name_a, name_b (both ways round), worth, family_level, given_level, rare_level of names that may be one person's.

    names: distinct (league, folded name). one: name_a, name_b, who: spellings known to be one person's, from which short forms are learnt: token
    pairs that stand for each other with SHOWN different people. A learnt short form is no different token; different tokens
    without two letters in common are further apart than others.
    """
    same = token_pairs(names)
    rare = cut(partners(names, same))
    pairs = cut(aligned(meeting(names, same, rare)))
    ordered = one.select(F.least("name_a", "name_b").alias("name_a"), F.greatest("name_a", "name_b").alias("name_b"), "who")
    shown = ordered.join(pairs.where("odd != ''").select("name_a", "name_b", "odd").distinct(), ["name_a", "name_b"]).groupBy("odd").agg(F.count_distinct("who").alias("n")).where(F.col("n") >= SHOWN)
    both = pairs.join(shown, "odd", "left").join(rare.withColumnRenamed("token", "top"), "top", "left")
    alike = F.expr("exists(sequence(1, length(split_part(odd, '|', 1)) - 1), i -> contains(split_part(odd, '|', 2), substring(split_part(odd, '|', 1), i, 2)))")
    given = F.when(F.col("n").isNotNull(), F.lit(LEARNT)).when((F.col("odd") != "") & ~alike, F.lit(UNLIKE)).otherwise(F.col("given"))
    level = F.when(given >= 0.85, 2).when(given >= 0.6, 1).when(given >= LIKE, 0).when(given > UNLIKE, -1).otherwise(-2)
    both = both.select(
        "league", "name_a", "name_b", (F.col("family") + given - F.col("extra") / 4).alias("worth"), ((F.col("family") >= 0.99).cast("int") - (F.col("extra") > 0).cast("int")).alias("family_level"),
        level.alias("given_level"), F.coalesce("rare", F.lit(1)).alias("rare_level"),
    )
    # Two names that only share a given name are not alike.
    both = both.where("given_level >= 0 or rare_level >= 0")
    turned = both.where("name_a != name_b").select("league", F.col("name_b").alias("name_a"), F.col("name_a").alias("name_b"), "worth", *SPELLING)
    return cut(both.unionByName(turned))


SPELLING = ["family_level", "given_level", "rare_level"]


def meet(left: DataFrame, right: DataFrame, alike: DataFrame, ids: tuple[str, str]) -> DataFrame:
    """ids and the levels of their best spellings. left, right: an id, league, name, ``ev`` (pieces of evidence; the first letter is their kind).

    Rows meet on a pair of names and a piece of evidence. Given names that differ need two kinds of evidence: they may be short forms nobody has
    shown yet.
    """
    a = left.select("league", ids[0], F.col("name").alias("name_a"), F.explode("ev").alias("ev")).join(alike, ["league", "name_a"])
    b = right.select("league", ids[1], F.col("name").alias("name_b"), F.explode("ev").alias("ev"))
    met = a.join(b, ["league", "name_b", "ev"])
    if ids == ("a", "b"):
        met = met.where("a < b")
    best = met.groupBy(*ids).agg(F.max(F.struct("worth", *SPELLING)).alias("s"), F.count_distinct(F.left("ev", F.lit(1))).alias("kinds"))
    return best.where("s.given_level >= 0 or kinds > 1").select(*ids, *[F.col("s")[c].alias(c) for c in SPELLING])


def evidence(kind: str, *parts: Column) -> Column:
    """One piece of evidence as text; null where a part is unknown."""
    return F.concat(F.lit(kind), *[x for p in parts for x in (F.lit("|"), p.cast("string"))])


def evidences(*pieces: Column) -> Column:
    """The pieces that are known."""
    return F.array_distinct(F.array_compact(F.flatten(F.array(*pieces))))


def around(year: Column, make) -> Column:
    """A piece for the year before, the year and the year after."""
    return F.array(*[make(year + k) for k in (-1, 0, 1)])


def components(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, person: the smallest node reachable over the pairs (a, b). Labels move along the pairs until none changes.

    Persons have few registrations, so a handful of rounds suffices; each is materialised in the shared folder.
    """
    both = cut(pairs.select("a", "b").union(pairs.select("b", "a")).distinct())
    linked = cut(both.select(F.col("a").alias("node")).distinct().withColumn("person", F.col("node")))
    while True:
        offer = both.join(linked, F.col("b") == F.col("node")).groupBy("a").agg(F.min("person").alias("best"))
        step = linked.join(offer, F.col("node") == F.col("a"), "left")
        nxt = cut(step.select("node", F.least("person", "best").alias("person"), (F.col("best") < F.col("person")).alias("moved")))
        linked = nxt.select("node", "person")
        if nxt.where("moved").isEmpty():
            return nodes.join(linked, "node", "left").select("node", F.coalesce("person", "node").alias("person"))


def agreement(a: str, b: str, yes: int = 2) -> Column:
    """``yes`` where both are known and equal, its negative where they differ, 0 where one is unknown."""
    return F.when(F.col(a) == F.col(b), yes).when(F.col(a) != F.col(b), -yes).otherwise(0)


#: The functions that vote on two registrations, what they can vote, and what a step of a vote weighs before anything is learnt.
REGISTERED = {
    "rare_level": (-1, 0, 1), "family_level": (-1, 0, 1), "given_level": (-2, -1, 0, 1, 2), "dorsal_votes": (-2, 0, 2), "gap_votes": (-1, 0, 1), "club_votes": (0, 1), "together_votes": (-2, 0),
}
REGISTERED_START = {"rare_level": 0.5, "family_level": 0.5, "given_level": 1.0, "dorsal_votes": 1.5, "gap_votes": 0.7, "club_votes": 1.5, "together_votes": 4.0}
REGISTERED_EVEN = 3.0


def same_registrations(regs: DataFrame, names: DataFrame, facts: DataFrame, alike: DataFrame) -> DataFrame:
    """a, b (a < b): two registrations of one person by the model's posterior.

    Pairs meet on the shirt number, or on a club in the same or the next year, within a league. Years, and whether the two ever played in the same game are votes, none of them a condition.
    """
    own = names.select("pid", "name").join(regs.where("league is not null").select("pid", "league", "dorsal", "stays"), "pid")
    number, here = F.array(evidence("d", F.col("dorsal"))), F.transform("stays", lambda s: evidence("c", s["club"], s["year"]))
    near = F.flatten(F.transform("stays", lambda s: around(s["year"], lambda y: evidence("c", s["club"], y))))
    left, right = own.select("league", F.col("pid").alias("a"), "name", evidences(number, near).alias("ev")), own.select("league", F.col("pid").alias("b"), "name", evidences(number, here).alias("ev"))
    pair = cut(meet(left, right, alike, ("a", "b")))
    for side in ("a", "b"):
        pair = pair.join(regs.select(F.col("pid").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("dorsal", "lo", "hi", "stays")]), side)
    gap = F.greatest(F.col("lo_a") - F.col("hi_b"), F.col("lo_b") - F.col("hi_a"))
    shared = F.expr("exists(stays_a, x -> exists(stays_b, y -> x.club = y.club and abs(x.year - y.year) <= 1))")
    games = facts.groupBy("pid", "league", "year").agg(F.array_distinct(F.flatten(F.collect_list("games"))).alias("games"))
    at = lambda s: games.select(F.col("pid").alias(s), "league", "year", F.col("games").alias(f"games_{s}"))
    together = pair.select("a", "b").join(at("a"), "a").join(at("b"), ["b", "league", "year"]).where(F.arrays_overlap("games_a", "games_b")).select("a", "b", F.lit(True).alias("met")).distinct()
    votes = pair.join(together, ["a", "b"], "left").select(
        "a", "b", "rare_level", "family_level", "given_level", agreement("dorsal_a", "dorsal_b").alias("dorsal_votes"),
        F.coalesce(F.when(gap <= 1, 1).when(gap > 3, -1), F.lit(0)).alias("gap_votes"), F.when(shared, 1).otherwise(0).alias("club_votes"), F.when(F.col("met"), -2).otherwise(0).alias("together_votes"),
    )
    return posterior(cut(votes), REGISTERED, REGISTERED_START, REGISTERED_EVEN)


def persons(facts: DataFrame, decided: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(pid, person); one row per person (person, dorsal, lo, hi, stays); (person, league, name); and the names that are alike."""
    players = facts.where("not total")
    regs, names = people.registrations(players)
    regs, names = cut(regs), cut(names)
    main = names.groupBy("pid").agg(F.max_by("name", F.struct("n", "name")).alias("name_b"))
    own = names.select("pid", F.col("name").alias("name_a")).join(main, "pid").where("name_a != name_b").select("name_a", "name_b", F.col("pid").alias("who"))
    told = decided.where("status = 'confirmed' and full is not null and name != full").select(F.col("name").alias("name_a"), F.col("full").alias("name_b"), F.col("full").alias("who"))
    every = names.join(regs.select("pid", "league"), "pid").select("league", "name").union(decided.select("league", "name")).union(decided.where("full is not null").select("league", "full"))
    every = every.where("league is not null").distinct()
    alike = names_alike(cut(every), own.union(told))
    links = same_registrations(regs, names, players, alike).where("confidence >= 0.5 and together_votes = 0")
    label = cut(components(links, regs.select(F.col("pid").alias("node"))).withColumnRenamed("node", "pid"))
    spellings = cut(names.join(regs.select("pid", "league"), "pid").join(label, "pid").select("person", "league", "name").distinct())
    whole = regs.join(label, "pid").groupBy("person").agg(F.max_by("dorsal", "n").alias("dorsal"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.array_distinct(F.flatten(F.collect_list("stays"))).alias("stays"))
    return label, cut(whole), spellings, alike


#: The functions that vote on a decision and a person.
MEANT = {
    "rare_level": (-1, 0, 1), "family_level": (-1, 0, 1), "given_level": (-2, -1, 0, 1, 2), "dorsal_votes": (-2, 0, 2), "club_votes": (-1, 0, 1, 2), "before_votes": (-1, 0, 1),
    "season_votes": (-2, -1, 0, 1), "alone_votes": (0, 1), "full_votes": (-2, 0, 1, 2), "turned_votes": (-1, 0, 1), "absent_votes": (-2, 0),
}
MEANT_START = {"rare_level": 0.5, "family_level": 0.5, "given_level": 0.8, "dorsal_votes": 2.5, "club_votes": 1.5, "before_votes": 1.0, "season_votes": 0.8, "alone_votes": 0.7, "full_votes": 1.0, "turned_votes": 0.2, "absent_votes": 2.5}
MEANT_EVEN = 2.5


def decision_candidates(decided: DataFrame, whole: DataFrame, spellings: DataFrame, alike: DataFrame) -> DataFrame:
    """Decisions and persons whose names align, with what each field says of the pair: for (above 0), against (below 0), or nothing (0).

    They meet on the shirt number, on a club in the same or the next year, on the club the notes name, or on league and season (a year
    more or less).
    """
    ids = ("decision_id", "person")
    own = spellings.join(whole.select("person", "dorsal", "stays"), "person")
    stay = lambda make: F.transform("stays", make)
    held = [stay(lambda s: evidence("d", s["league"], F.col("dorsal"))), stay(lambda s: evidence("c", s["club"], s["year"])), stay(lambda s: evidence("b", s["club"])), stay(lambda s: evidence("y", s["league"], s["year"]))]
    league, year = F.col("league"), F.col("year")
    told = [F.array(evidence("d", league, F.col("dorsal"))), around(year, lambda y: evidence("c", F.col("club"), y)), F.array(evidence("b", F.col("before"))), around(year, lambda y: evidence("y", league, y))]
    pair = cut(meet(decided.select("league", "decision_id", "name", evidences(*told).alias("ev")), own.select("league", "person", "name", evidences(*held).alias("ev")), alike, ids))
    rivals = pair.where("given_level >= 0").groupBy("decision_id").agg(F.count(F.lit(1)).alias("rivals"))
    # How the confirmed or turned down name agrees with the person's spellings: 2 and 1 well, -2 not, 0 where none is given.
    given = pair.select(*ids).join(decided.where("full is not null").select("decision_id", "league", F.col("full").alias("name_a")), "decision_id").join(alike.select("league", "name_a", "name_b", "given_level"), ["league", "name_a"])
    level = F.when(F.col("given_level") >= 1, 2).when(F.col("given_level") == 0, 1).otherwise(-2)
    like = given.join(spellings.withColumnRenamed("name", "name_b"), ["league", "person", "name_b"]).groupBy(*ids).agg(F.max(level).alias("like"))
    w = whole.select("person", F.col("dorsal").alias("w_dorsal"), "lo", "hi", "stays")
    pair = pair.join(decided.drop("name"), "decision_id").join(w, "person").join(like, list(ids), "left").join(rivals, "decision_id", "left")
    pair = pair.withColumn("like", F.when(F.col("full").isNull(), 0).otherwise(F.coalesce("like", F.lit(-2))))
    there = F.col("year").between(F.col("lo"), F.col("hi"))
    at = lambda shift: F.expr(f"exists(stays, x -> x.club = club and x.year = year + {shift})")
    any_time = lambda c: F.expr(f"exists(stays, x -> x.club = {c})")
    turned = F.col("status") == "rejected"
    return cut(pair.select(
        *ids, "rare_level", "family_level", "given_level", agreement("dorsal", "w_dorsal").alias("dorsal_votes"),
        F.when(F.col("club").isNull(), 0).when(F.coalesce(at(0), F.lit(False)), 2).when(any_time("club"), 1).otherwise(-1).alias("club_votes"),
        F.when(F.col("before").isNull(), 0).when(any_time("before"), 1).otherwise(-1).alias("before_votes"),
        F.when(F.col("year").isNull() | F.col("lo").isNull(), 0).when(there, 1).when(F.col("year").between(F.col("lo") - 1, F.col("hi") + 1), -1).otherwise(-2).alias("season_votes"),
        F.when((F.col("rivals") == 1) & (F.col("given_level") >= 0), 1).otherwise(0).alias("alone_votes"),
        F.when(F.col("status") == "confirmed", F.col("like")).otherwise(0).alias("full_votes"),
        F.when(turned & (F.col("like") > 0), -1).when(turned & (F.col("like") < 0), 1).otherwise(0).alias("turned_votes"), F.when(F.col("absent"), -2).otherwise(0).alias("absent_votes"),
    ))


def meant(candidates: DataFrame) -> DataFrame:
    """The candidates with their confidence: the model's posterior, shared out among a decision's persons, since it means one at most."""
    p = posterior(candidates, MEANT, MEANT_START, MEANT_EVEN)
    odds = F.least(F.col("confidence"), F.lit(1 - 1e-9)) / (1 - F.least(F.col("confidence"), F.lit(1 - 1e-9)))
    total = p.groupBy("decision_id").agg(F.sum(odds).alias("_all"))
    return p.join(total, "decision_id").withColumn("confidence", odds / (1 + F.col("_all"))).drop("_all")


def attach(candidates: DataFrame, least: float = 0.5) -> DataFrame:
    """decision_id, person, confidence: the person a decision most likely means, if at least that likely; equal ones can't both be."""
    best = meant(candidates).where(F.col("confidence") >= least).groupBy("decision_id").agg(F.min_by(F.struct("person", "confidence"), F.struct(-F.col("confidence"), F.col("person"))).alias("b"))
    return best.select("decision_id", "b.person", "b.confidence")


#: The functions that vote on two decisions about people whom the box score doesn't have.
DECIDED = {"rare_level": (-1, 0, 1), "family_level": (-1, 0, 1), "given_level": (-2, -1, 0, 1, 2), "dorsal_votes": (-2, 0, 2), "club_votes": (-1, 0, 1), "season_votes": (-1, 0, 1), "position_votes": (-1, 0, 1)}
DECIDED_START = {"rare_level": 0.5, "family_level": 0.5, "given_level": 1.0, "dorsal_votes": 1.5, "club_votes": 1.0, "season_votes": 1.0, "position_votes": 1.5}
DECIDED_EVEN = 1.5


def same_decisions(decided: DataFrame, attached: DataFrame, alike: DataFrame) -> DataFrame:
    """decision_id, person of all decisions: those attached to a person of the box score, and the others grouped among themselves.

    Two decisions that fit no one meet on a shirt number, a club in the same or the next year, or league and season, and belong
    together by the model's posterior over what their fields say.
    """
    rest = cut(decided.join(attached.select("decision_id"), "decision_id", "left_anti"))
    league, year = F.col("league"), F.col("year")
    exact = [F.array(evidence("d", league, F.col("dorsal"))), F.array(evidence("y", league, year))]
    left = rest.select("league", F.col("decision_id").alias("a"), "name", evidences(*exact, around(year, lambda y: evidence("c", F.col("club"), y))).alias("ev"))
    right = rest.select("league", F.col("decision_id").alias("b"), "name", evidences(*exact, F.array(evidence("c", F.col("club"), year))).alias("ev"))
    pair = cut(meet(left, right, alike, ("a", "b")))
    for s in ("a", "b"):
        pair = pair.join(rest.select(F.col("decision_id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("league", "year", "club", "dorsal", "position")]), s)
    season = F.when((F.col("year_a") == F.col("year_b")) & (F.col("league_a") == F.col("league_b")), 1).when(F.abs(F.col("year_a") - F.col("year_b")) > 1, -1).otherwise(0)
    votes = cut(pair.select("a", "b", "rare_level", "family_level", "given_level", agreement("dorsal_a", "dorsal_b").alias("dorsal_votes"), agreement("club_a", "club_b", 1).alias("club_votes"), season.alias("season_votes"), agreement("position_a", "position_b", 1).alias("position_votes")))
    links = posterior(votes, DECIDED, DECIDED_START, DECIDED_EVEN).where("confidence >= 0.5")
    alone = components(links, rest.select(F.col("decision_id").alias("node")).distinct())
    return attached.select("decision_id", "person").unionByName(alone.select(F.col("node").alias("decision_id"), F.concat(F.lit("D|"), "person").alias("person")))


def pairs_within(member: DataFrame, key: str) -> DataFrame:
    """ref_a, ref_b: all pairs of one person's references, the smaller first."""
    a = member.select(F.col(key).alias("ref_a"), "person")
    b = member.select(F.col(key).alias("ref_b"), "person")
    return a.join(b, "person").where("ref_a < ref_b").select("ref_a", "ref_b").distinct()


def linked(box: DataFrame, table: DataFrame, clubs: DataFrame, players: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(pid, person), the decisions, (decision_id, person, confidence), and the names that are alike."""
    facts = cut(people.facts(box))
    decided = people.decisions(table, clubs, facts, players)
    label, whole, spellings, alike = persons(facts, decided)
    return label, decided, cut(attach(decision_candidates(decided, whole, spellings, alike))), alike


def found(box: DataFrame, table: DataFrame, clubs: DataFrame, players: DataFrame | None = None) -> DataFrame:
    """ref_a, ref_b: player_ids, and decision_ids, that stand for one person. Empty tables give no pairs; equal rows make one reference."""
    label, decided, attached, alike = linked(box, table, clubs, players)
    return pairs_within(label, "pid").unionByName(pairs_within(same_decisions(decided, attached, alike), "decision_id"))
