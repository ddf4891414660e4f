import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hoopflow.functions import text as X
from hoopflow.operators import entity

BOX = "season_code string, team_id string, player_id string, player string, dorsal string, game_id string, minutes string, round int"


def one(spark, f, values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(f(F.col("v"))).collect()]


def plain(s):
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).upper()
    return " ".join("".join(c if "A" <= c <= "Z" else " " for c in s).split())


def test_names(spark):
    assert one(spark, X.normalize_name, ["Đoković, Ñ.", "Straße", "İbrahim ﬁn", "  a  b ", "", None]) == ["OKOVIC N", "STRASSE", "IBRAHIM FIN", "A B", "", None]
    assert one(spark, X.match_key, ["Jones Jr.", "JONES III JR", "Jr"]) == ["JONES", "JONES", "JR"]
    assert one(spark, X.reorder_name, ["JONES, CARLIK", "Carlik Jones", "A, B, C", "X,"]) == ["CARLIK JONES", "Carlik Jones", "B, C A", " X"]
    assert one(spark, X.abbreviate_name, ["Marc-Owen Fodzo Dada", "Nene", " A  B "]) == ["M. Fodzo Dada", "Nene", "A. B"]
    assert one(spark, X.title_case, ["o'neal-smith JR", ""]) == ["O'Neal-Smith Jr", ""]
    assert one(spark, X.minutes_number, ["10:30", "DNP", "", None, "x"]) == [10.5, 0.0, 0.0, None, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(min_codepoint=32, max_codepoint=0x24F), max_size=12), min_size=20, max_size=40))
def test_normalised_as_by_the_unicode_tables(spark, names):
    assert one(spark, X.normalize_name, names) == [plain(n) for n in names]


@pytest.fixture(scope="module")
def world(spark):
    schedule = spark.createDataFrame([("Red Club", "RED", "REDTV"), ("Blue Club", "BLU", "BLUTV")], "hometeam string, homecode string, hometv string")
    box = spark.createDataFrame(
        [
            ("E2025", "RED", "P1", "JONES, CARLIK", "1", "g1", "10:00", 1), ("E2025", "RED", "P1", "JONES, CARLIK", "1", "g2", "12:00", 2), ("E2025", "BLU", "P2", "SMITH, ADAM", "2", "g1", "DNP", 1),
            ("E2025", "BLU", "P3", "SMITH, ANN", "3", "g1", "01:00", 1), ("E2010", "RED", "P4", "OLD, Émile", "4", "g0", "05:00", 1), ("E2025", "BLU", "BLU", "Blue Club", "TOTAL", "g1", "200:00", 1),
            ("E2024", "ZZZ", "P5", "LOST, PETE", "5", "g9", "05:00", 3),
        ],
        BOX,
    )
    lookup = entity.team_lookup(entity.team_entries(schedule))
    stats = spark.createDataFrame([("RED", "C. Jones"), ("BLU", "A. Smith"), ("BLU", "E. Old"), ("XXX", "C. Jones"), ("RED", "N. Body")], "team string, name string")
    rows = entity.match_rows(stats, lookup, entity.club_pool(box, lookup), entity.spelling_pool(box))
    return box, lookup, rows


def test_candidates(world):
    got = {(r["team"], r["name"]): (r["match_status"], r["matched_by"], r["resolved_name"]) for r in world[2].collect()}
    assert got == {
        ("RED", "C. Jones"): ("exact", "exact", "Carlik Jones"), ("BLU", "A. Smith"): ("needs_review", "exact_collision", "Adam Smith"),
        ("BLU", "E. Old"): ("needs_review", "exact_other_club", "Émile Old"), ("XXX", "C. Jones"): ("needs_review", "exact_other_club", "Carlik Jones"), ("RED", "N. Body"): ("no_candidate", "exact", ""),
    }


def test_decisions_map_and_lookup(spark, world):
    box, lookup, rows = world
    table = spark.createDataFrame(
        [("BLU", "A. Smith", "confirmed", " Ann Smith ", "seen"), ("RED", "C. Jones", "rejected", None, "no effect"), ("RED", "Gone", "no_match", None, "x")],
        "stats_team string, stats_name string, match_status string, name string, notes string",
    )
    entries = entity.map_entries(entity.apply_decisions(rows, entity.check_decisions(table)), entity.raw_spellings(box))
    e = {(r["stats_team"], r["stats_name"]): r for r in entries.collect()}
    assert e["BLU", "A. Smith"]["name"] == "Ann Smith" and "SMITH, ANN" in e["BLU", "A. Smith"]["variants"] and e["BLU", "A. Smith"]["matched_by"] == "agent"
    assert e["RED", "C. Jones"]["match_status"] == "exact"
    found = entity.resolve_players(entity.with_club(box, "team_id", lookup), "player", "club", entries)
    assert {r["player"]: r["player_normalized"] for r in found.collect()}["JONES, CARLIK"] == "Carlik Jones"
    left = {r["player"]: r for r in entity.hints(entity.box_only(box, entries, lookup), entries).collect()}
    assert "JONES, CARLIK" not in left and left["LOST, PETE"]["verdict"] == "unknown team"


def test_hints_meet_on_club_and_token(spark):
    boxed = spark.createDataFrame(
        [
            ("RED", "Red Club", "DE LA CRUZ, ANA", 2, [1, 2]), ("RED", "Red Club", "CRUZ, ANA", 1, [3]), ("BLU", "Blue Club", "CRUZ, ANA", 1, [3]), ("XXX", "", "Ana CRUZ", 1, [4]), (None, "", "CRUZ CRUZ", 1, [4]),
            ("RED", "Red Club", "", 1, [None]), ("RED", "Red Club", None, 1, [5]), ("RED", "Red Club", "B, A", 1, [6]),
        ],
        "team string, club string, player string, games bigint, rounds array<int>",
    )
    entries = spark.createDataFrame(
        [
            ("RED", "A. De la Cruz", "Red Club", "rejected"), ("RED", "A. Cruz", "Red Club", "no_match"), ("RED", "A. Cruz", "Red Club", "no_match"), ("RED", "B. Cruz", "Red Club", "exact"), ("RED", "Cruz", "Red Club", "rejected"),
            ("YYY", "Z. Crúz", "", "needs_review"), (None, "Y. Cruz", "", "no_candidate"), ("ZZZ", "X.  ", "", "rejected"), ("ZZZ", None, "", "rejected"), ("BLU", "W. Cruz", None, "rejected"),
        ],
        "stats_team string, stats_name string, team string, match_status string",
    )
    both, unknown = "RED A. Cruz (no_match); RED A. De la Cruz (rejected)", "Y. Cruz (no_candidate); YYY Z. Crúz (needs_review)"
    hints = entity.hints(boxed, entries)
    assert {(r["team"], r["player"]): (r["likely"], r["verdict"]) for r in hints.collect()} == {
        ("RED", "DE LA CRUZ, ANA"): (both, "likely"), ("RED", "CRUZ, ANA"): (both, "likely"), ("BLU", "CRUZ, ANA"): ("", "not listed"), ("XXX", "Ana CRUZ"): (unknown, "unknown team"), (None, "CRUZ CRUZ"): (unknown, "unknown team"),
        ("RED", ""): ("", "not listed"), ("RED", None): ("", "not listed"), ("RED", "B, A"): ("", "not listed"),
    }
    assert hints.count() == 8
    plan = hints._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x]
    assert len(joins) == 1 and "token" in joins[0] and "overlap" not in plan  # club alone would pair all players of unknown teams


@pytest.mark.parametrize(("status", "name", "notes"), [("maybe", None, "x"), ("rejected", None, " "), ("confirmed", "", "x")])
def test_bad_decisions(spark, status, name, notes):
    t = spark.createDataFrame([("T", "N", status, name, notes)], "stats_team string, stats_name string, match_status string, name string, notes string")
    with pytest.raises(ValueError, match="T|N"):
        entity.check_decisions(t)


def test_bad_schedules(spark):
    s = "hometeam string, homecode string, hometv string"
    for data, word in (([("A", "X", "1"), ("A", "Y", "1")], "several"), ([("A", "X", "1"), ("B", "X", "2")], "two teams"), ([], "no rows")):
        with pytest.raises(ValueError, match=word):
            entity.team_entries(spark.createDataFrame(data, s))
