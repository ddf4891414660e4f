"""What the tables say about people: registrations of the box score and decisions about names of the price list."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoopflow.llm.spelling import distance, fold, tokens
from hoopflow.session import cut

CLUB_LIMIT = 20_000


def league_of(season: Column) -> Column:
    return F.regexp_extract(F.upper(F.trim(season)), r"^([A-Z]*)", 1)


def year_of(season: Column) -> Column:
    return F.regexp_extract(season, r"(\d+)", 1).try_cast("int")


#: Blanks that untidy codes contain.
BLANKS = " \t\n\r\u00a0"


def _code(c: Column) -> Column:
    b = F.upper(F.translate(c, BLANKS, ""))
    return F.when(b != "", b)


def facts(box: DataFrame) -> DataFrame:
    """pid, league, year, club, dorsal, player, total, n, games: the box score summed up in one scan, club rows (``total``) included.

    ``games`` are the numbers of the season's games, so their set is bounded by a season. Rows without player_id can't be referred to and
    are left out; a club counts only if it is one of the game's two.
    """
    sides = F.concat(F.lit("-"), F.upper(F.translate("game", BLANKS, "")), F.lit("-"))
    of_game = lambda code: F.contains(sides, F.concat(F.lit("-"), code, F.lit("-")))
    club, code, dorsal = _code(F.col("team_id")), _code(F.col("player_id")), _code(F.col("dorsal"))
    number = F.coalesce(F.split_part(F.translate("game_id", "-./:" + BLANKS, "____"), F.lit("_"), F.lit(-1)).try_cast("int"), F.hash("game_id"))
    rows = box.where(F.col("player_id").isNotNull()).select(
        F.col("player_id").alias("pid"), "season_code", F.when(of_game(club), club).alias("club"), dorsal.alias("dorsal"), "player",
        F.coalesce((dorsal == "TOTAL") | of_game(code), F.lit(False)).alias("total"), number.alias("game"),
    )
    summed = rows.groupBy("pid", "season_code", "club", "dorsal", "player", "total").agg(F.count(F.lit(1)).alias("n"), F.collect_set("game").alias("games"))
    return summed.withColumn("league", league_of(F.col("season_code"))).withColumn("year", year_of(F.col("season_code"))).drop("season_code")


def fold_names(df: DataFrame, column: str, out: str = "name") -> DataFrame:
    """Adds the folded tokens of a name; done once per distinct spelling."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"_spelling": b["_spelling"], out: [" ".join(tokens(x)) for x in b["_spelling"]]})

    spellings = df.select(F.col(column).alias("_spelling")).where(F.col(column).isNotNull()).distinct()
    folded = spellings.mapInPandas(run, f"_spelling string, {out} string")
    return df.join(folded, F.col(column) == F.col("_spelling"), "left").drop("_spelling")


def registrations(facts_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables: one row per registration (pid, dorsal, lo, hi, n, stays), and its spellings (pid, name, n).

    The dorsal is the one worn most often (the smaller one where two tie), stays are the (league, year, club) with at least two rows, or
    all of them where none has two.
    """
    names = fold_names(facts_.groupBy("pid", "player").agg(F.sum("n").alias("n")), "player").where("name != ''").groupBy("pid", "name").agg(F.sum("n").alias("n"))
    worn = facts_.where("dorsal is not null").groupBy("pid", "dorsal").agg(F.sum("n").alias("n")).groupBy("pid").agg(F.max_by("dorsal", F.struct("n", F.col("dorsal"))).alias("dorsal"))
    stay = facts_.where("club is not null and year is not null").groupBy("pid", "league", "year", "club").agg(F.sum("n").alias("n"))
    at = F.struct("league", "year", "club")
    stays = stay.groupBy("pid").agg(F.collect_set(F.when(F.col("n") >= 2, at)).alias("s"), F.collect_set(at).alias("all"))
    stays = stays.select("pid", F.when(F.size("s") > 0, F.col("s")).otherwise(F.col("all")).alias("stays"))
    base = facts_.groupBy("pid").agg(F.mode("league").alias("league"), F.min("year").alias("lo"), F.max("year").alias("hi"), F.sum("n").alias("n"))
    none = F.expr("cast(array() as array<struct<league: string, year: int, club: string>>)")
    return base.join(worn, "pid", "left").join(stays, "pid", "left").withColumn("stays", F.coalesce("stays", none)), names


class ClubNames:
    """Club names to codes: exact, as a reserve side, and one edit away where only one club is that near."""

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        self.code = {n: c for n, c in rows}
        self.short: dict[str, set[str]] = {}
        for n, c in rows:
            whole = fold(n)
            for t in {whole, *(x for x in whole.split() if len(x) >= 4)}:
                self.short.setdefault(t, set()).add(c)
        self.longest = max((t.count(" ") + 1 for t in self.short), default=1)
        self.known: dict[str, str | None] = {}

    def find(self, text: str | None) -> str | None:
        t = (text or "").strip().lower()
        if t in ("", "-"):
            return None
        if t not in self.known:
            self.known[t] = self._find(t)
        return self.known[t]

    def _find(self, t: str) -> str | None:
        t = re.sub(r"\s+(ii|b)$", "", t)
        if t in self.code:
            return self.code[t]
        exact = self.short.get(fold(t), set())
        if len(exact) == 1:
            return next(iter(exact))
        near = {c for n, c in self.code.items() if distance(t, n, 1) <= 1}
        return near.pop() if len(near) == 1 else None

    def mentioned(self, text: str) -> tuple[str | None, set[str]]:
        """The one club that a text names by its longest names in it, and the words that name it; None where there are several or none."""
        words, found, used = fold(text).split(), set(), set()
        at = 0
        while at < len(words):
            for n in range(min(self.longest, len(words) - at), 0, -1):
                part = " ".join(words[at : at + n])
                if len(part) >= 4 and len(own := self.short.get(part, ())) == 1:
                    found |= own
                    used |= set(words[at : at + n])
                    at += n - 1
                    break
            at += 1
        return (next(iter(found)) if len(found) == 1 else None), used


def club_names(clubs: DataFrame, facts_: DataFrame) -> list[tuple[str, str]]:
    """(lower-case name, code) of the register and, for clubs that it lacks, of the box score's club rows.

    Clubs are few; more than CLUB_LIMIT names are refused rather than broadcast. Where two clubs share a name, the register's wins.
    """
    listed = clubs.where("code is not null").select(
        F.explode(F.array(*[F.lower(F.trim(F.col(c))) for c in ("code", "team", "tv")])).alias("n"), F.upper(F.trim("code")).alias("c"), F.lit(0).alias("o")
    )
    seen = facts_.where("total and player is not null").groupBy(_code(F.col("pid")).alias("c"), "player").agg(F.sum("n").alias("n")).where("n > 1")
    seen = seen.select(F.explode(F.array(F.lower("c"), F.lower(F.trim("player")))).alias("n"), "c", F.lit(1).alias("o"))
    best = listed.unionByName(seen).where("n is not null and n not in ('', '-')").groupBy("n").agg(F.min(F.struct("o", "c")).alias("b"))
    rows = best.select("n", "b.c").orderBy("n").limit(CLUB_LIMIT + 1).collect()
    if len(rows) > CLUB_LIMIT:
        raise ValueError(f"there are more than {CLUB_LIMIT} names of clubs")
    return [(r["n"], r["c"]) for r in rows]


#: A word says something of decisions if at least one in so many has it, so a table of such words is bounded whatever the data.
TELLING = 4096
#: Odds of no_match at which remarks speak against a match.
AGAINST = 20.0


def remark_words(table: DataFrame) -> dict[str, float]:
    """What each word of the notes says for ``no_match``: log odds against the other decisions, learnt from all decisions.

    Words of fewer than one decision in TELLING say nothing; so at most TELLING times the mean number of words are kept.
    """
    d = table.select((F.col("match_status") == "no_match").alias("no"), F.array_distinct(F.regexp_extract_all(F.lower("notes"), F.lit(r"(\p{L}{2,})"), F.lit(1))).alias("w"))
    total = d.agg(F.count_if("no").alias("no"), F.count_if(~F.coalesce("no", F.lit(False))).alias("yes")).first()
    every = total["no"] + total["yes"]
    words = d.select("no", F.explode("w").alias("word")).groupBy("word").agg(F.count_if("no").alias("no"), F.count(F.lit(1)).alias("n")).where(F.col("n") * TELLING >= every)
    size = (total["no"] + 2) / (total["yes"] + 2)
    return {r["word"]: math.log((r["no"] + size) / (r["n"] - r["no"] + 1) / size) for r in words.collect()} | {"": math.log(size)}


DECISION = "decision_id string, league string, year int, name string, full string, status string, club string, before string, dorsal string, position string, absent boolean"


def decisions(table: DataFrame, clubs: DataFrame, facts_: DataFrame, players: DataFrame | None = None) -> DataFrame:
    """Decisions with what their text says: folded names, club and another club the notes name as codes, the shirt number (the one
    number of up to three digits in the notes), the position (a value of the price list's ``position``), and whether the notes' words are those of decisions
    that found nobody. Nulls stay null; a decision without a usable name is left out, as nothing can be compared."""
    names, said = club_names(clubs, facts_), remark_words(table)
    listed = players.select(F.lower(F.trim("position")).alias("p")).where("p != ''").distinct().limit(101).collect() if players is not None else []
    if len(listed) > 100:
        raise ValueError("there are more than 100 positions")
    places = re.compile(rf"\b({'|'.join(sorted(re.escape(r['p']) for r in listed)) or '(?!)'})\b", re.I)
    sure = math.log(AGAINST)

    def parsed(notes: str, lookup: ClubNames) -> tuple:
        numbers, place = set(re.findall(r"(?<!\w)\d{1,3}(?!\w)", notes)), places.search(notes)
        club, used = lookup.mentioned(notes)
        words = {w for w in re.findall(r"[^\W\d_]{2,}", notes.lower()) if fold(w) not in used}
        odds = said.get("", 0.0) + sum(said.get(w, 0.0) for w in words)
        return numbers.pop() if len(numbers) == 1 else None, club, place.group(1).lower() if place else None, bool(words) and odds >= sure

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lookup = ClubNames(names)
        for b in batches:
            notes = b["notes"].fillna("")
            facts = {n: parsed(n, lookup) for n in notes.unique()}
            folded = {n: " ".join(tokens(n)) for n in pd.concat([b["stats_name"], b["name"]]).dropna().unique()}
            season = b["season_code"].fillna("").str.strip().str.upper()
            out = pd.DataFrame({
                "decision_id": b["decision_id"], "league": season.str.extract(r"^([A-Z]*)")[0], "year": season.str.extract(r"(\d+)")[0].astype("Int32"),
                "name": b["stats_name"].map(folded).replace("", None), "full": b["name"].map(folded).replace("", None), "status": b["match_status"], "club": [lookup.find(x) for x in b["stats_team"]],
            })
            for k, c in enumerate(("dorsal", "before", "position", "absent")):
                out[c] = notes.map(lambda n, k=k: facts[n][k])
            yield out[out["decision_id"].notna() & out["name"].notna()][[c.split()[0] for c in DECISION.split(", ")]]

    wanted = table.select("decision_id", "season_code", "stats_name", "stats_team", "name", "match_status", "notes")
    return cut(wanted.mapInPandas(run, DECISION))
