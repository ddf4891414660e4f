from datetime import datetime
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hoopflow.llm import labelmodel, linkage, names, people
from hoopflow.llm import spelling as S


def test_folding_and_alignment():
    assert S.tokens("FANAMIRAK, GÖKTUĞ Jr.") == ("FANAMIRAK", "GOKTUG") and S.tokens("Goektugh Fanamirak") == ("GOKTUG", "FANAMIRAK")
    assert S.tokens("Jr") == ("JR",) and S.tokens(None) == () and S.tokens(" - ") == ()
    assert S.align(("J", "TESONEZ"), ("TESONEZ", "JOAQUIN"))[:2] == (1.0, 0.55)
    assert S.align(("PACO", "BABUTERO"), ("BABUTERO", "FRANCISCO"))[1:4] == (-1.0, 0, "FRANCISCO|PACO")
    assert S.align(("FLALILLEUX", "FRANCOIS"), ("FLALILLEUX", "FREDERIC"))[1] < 0.4
    assert S.align((), ("A",))[0] < 0
    assert S.align(tuple("ABCDEF"), tuple("FEDCBA"))[2] == 0


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 5).flatmap(lambda m: st.tuples(st.integers(1, m), st.just(m))).flatmap(lambda s: st.lists(st.lists(st.integers(0, 9), min_size=s[1], max_size=s[1]), min_size=s[0], max_size=s[0])))
def test_assignment_is_the_cheapest(cost):
    got = S.assign(cost)
    assert len(set(got)) == len(cost)
    assert sum(c[j] for c, j in zip(cost, got)) == min(sum(c[j] for c, j in zip(cost, p)) for p in permutations(range(len(cost[0])), len(cost)))


def changed(t, edits):
    for i, c, how in edits:
        i %= max(1, len(t))
        t = {"insert": t[:i] + c + t[i:], "delete": t[:i] + t[i + 1 :], "change": t[:i] + c + t[i + 1 :], "swap": t[:i] + t[i + 1 : i + 2] + t[i : i + 1] + t[i + 2 :]}[how]
    return t


EDITS = st.lists(st.tuples(st.integers(0, 11), st.sampled_from("ABCD"), st.sampled_from(["insert", "delete", "change", "swap"])), max_size=2)
TOKEN = st.text("ABCD", min_size=1, max_size=11)


@settings(max_examples=400, deadline=None)
@given(TOKEN, EDITS)
def test_tokens_that_are_the_same_share_a_key(t, edits):
    u = changed(t, edits)
    if S.token_score(t, u) >= S.SAME:
        assert S.keys(t) & S.keys(u)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(TOKEN, EDITS, st.integers(1, 11)), min_size=1, max_size=3), st.booleans())
def test_accepted_names_meet_in_the_index(parts, turned):
    a = tuple(t for t, _, _ in parts)
    b = tuple(changed(t, e)[:n] for t, e, n in parts)
    b = tuple(x for x in (b[::-1] if turned else b) if x)
    family, given_, *_ = S.align(a, b)
    if family >= S.SAME and given_ >= S.LIKE:
        met = [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if min(len(x), len(y)) > 1 and S.token_score(x, y) >= S.SAME and S.keys(x) & S.keys(y)]
        assert any(S.classes(a, i) & S.classes(b, j) for i, j in met), (a, b)


@pytest.mark.parametrize("common", [False, True])
def test_meeting_names_in_spark(spark, common):
    spelled = ["LI WU", "WU LI", "KIM ALEXANDER", "KIM ALEX", "J KOSTOVIC", "J KASTOVAC", "KOSTOVIC", "IVAN KOSTOVIC MARIC", "NOBODY AT ALL", "A B", "KOSTOVIC JURE", "NIKOLAS V", "NIKOLAS VARDO", "NIKOLAAS VRADO"]
    rows = spark.createDataFrame([("E", n) for n in spelled], "league string, name string")
    same = names.token_pairs(rows)
    rare = names.partners(rows, same)
    rare = rare.withColumn("rare", rare["rare"] * 0 - 1) if common else rare
    got = {frozenset((r["name_a"], r["name_b"])) for r in names.meeting(rows, same, rare).collect()}
    for x in spelled:
        for y in spelled:
            s = S.align(tuple(x.split()), tuple(y.split()))
            if s[0] >= S.SAME and s[1] >= S.LIKE:
                assert frozenset((x, y)) in got, (x, y)


BOX = "season_code string, game_player_id string, game_id string, game string, player_id string, team_id string, dorsal string, player string"
DEC = "decision_id string, season_code string, stats_name string, stats_team string, name string, match_status string, notes string, decided_at timestamp_ntz, pid string, player string"
CLUBS = "code string, team string, tv string, added_on string, removed_on string"


def season(pid, name, dorsal, club, year, lo, hi):
    return [(f"E{year}", f"E{year}_{k:03d}_{pid}", f"E{year}_{k:03d}", f"{club}-ZZZ", pid, club, dorsal, name) for k in range(lo, hi)]


ROWS = [
    *season("P1", "JAKEVILLÉ, THÉO", "10", "AAA", 2010, 1, 12), *season("P2", "JAKEVILE, T.", "10", "AAA", 2010, 12, 20), *season("P3", "JAKEVILLE, THEO", "10", "BBB", 2011, 1, 9),
    *season("P4", "JAKEVILLÉ, THÉO", "77", "CCC", 2010, 1, 9),  # a namesake
    *season("P5", "JAKEVILLÉ, FRANÇOIS", "10", "DDD", 2010, 20, 29),  # a relative with his number elsewhere
    *season("P6", "PILMA, PACO", "4", "AAA", 2010, 1, 9), *season("P7", "PILMA, FRANCISCO", "4", "AAA", 2011, 1, 9),
    *season("P8", "TWIN, ADAM", "5", "AAA", 2010, 1, 9), *season("P9", "TWIN, ADAM", "5", "BBB", 2010, 1, 9),  # in the same games: two people
    ("E2010", "E2010_001_AAA", "E2010_001", "AAA-ZZZ", "AAA", "AAA", None, "Club A"), ("E2010", "E2010_001_PX", "E2010_001", "AAA-ZZZ", None, "AAA", "3", "NO ID"), (None, "odd", None, None, "PY", None, None, ""),
    *season("P1", "JAKEVILLÉ, THÉO", "10", "AAA", 2010, 1, 12),
]
at = datetime(2011, 1, 1)
DECISIONS = [
    ("D1", "E2010", "T. Jakeville", "Club A", None, "no_match", "wears 10", at), ("D2", "E2011", "Theo Jakevillé", "bbb", "Théo Jakevillé", "confirmed", "", at), ("D3", "E2010", "T. Jakevillé", "CCC", None, "rejected", "dorsal 77 in the team sheets", at),
    ("D4", "E2010", "F. Pilma", "AAA", None, "confirmed", None, at), ("D5", "E2012", "N. Newman", "AAA", None, "no_match", "new signing, not played", at), ("D6", "E2012", "N. Newmann", "Club A II", None, "no_match", "youth contract, no minutes so far", at),
    ("D7", "E2012", None, "AAA", None, "no_match", "", at), ("D8", None, "Q. Nobody", None, None, None, None, None),
]


def frames(spark, rows=ROWS, decisions=DECISIONS):
    return (
        spark.createDataFrame(rows, BOX), spark.createDataFrame([(*d, None, None) for d in decisions], DEC),
        spark.createDataFrame([("aaa ", "Club A", "TVA", None, None), ("BBB", "Club B", None, None, None), ("CCC", "Club C", "C", None, None), (None, None, None, None, None)], CLUBS),
    )


def test_pairs_of_references(spark):
    got = {(r["ref_a"], r["ref_b"]) for r in names.found(*frames(spark)).collect()}
    assert got == {("P1", "P2"), ("P1", "P3"), ("P2", "P3"), ("P6", "P7"), ("D1", "D2"), ("D5", "D6")}


def test_matches(spark):
    got = {}
    for r in linkage.matches(*frames(spark)).collect():
        got.setdefault(r["decision_id"], set()).add(r["player_id"])
        assert 0.5 <= r["confidence"] <= 1
    assert got == {"D1": {"P1", "P2", "P3"}, "D2": {"P1", "P2", "P3"}, "D3": {"P4"}, "D4": {"P6", "P7"}}


def test_empty_tables(spark):
    assert names.found(*frames(spark, [], [])).count() == 0
    assert linkage.matches(*frames(spark, [], [])).count() == 0
    assert linkage.matches(*frames(spark, ROWS, [])).count() == 0
    assert names.found(*frames(spark, [], DECISIONS)).count() == 1


REWORDED = [
    ("D1", "E2010", "T. Jakeville", "Club A", None, "no_match", "his jersey says 10", at), ("D2", "E2011", "Theo Jakevillé", "bbb", "Théo Jakevillé", "confirmed", "", at),
    ("D3", "E2010", "T. Jakevillé", "CCC", None, "rejected", "#77, asked at the gate", at), ("D4", "E2010", "F. Pilma", "AAA", None, "confirmed", None, at), ("D9", "E2011", "Theo Jakevillé", None, None, None, "came over from Club B, 10 on his back", at),
]


def test_notes_in_other_words(spark):
    got = {(r["decision_id"], r["player_id"]) for r in linkage.matches(*frames(spark, decisions=REWORDED)).collect()}
    assert got == {(d, p) for d in ("D1", "D2", "D9") for p in ("P1", "P2", "P3")} | {("D3", "P4"), ("D4", "P6"), ("D4", "P7")}


def test_remarks_that_nobody_was_found_are_learnt(spark):
    rows = [(f"D{i}", "E2010", "X Y", None, None, "no_match", "sent home before tip-off", at, None, None) for i in range(60)]
    rows += [(f"C{i}", "E2010", "X Y", None, "X Y", "confirmed", "fine with the desk", at, None, None) for i in range(80)]
    said = people.remark_words(spark.createDataFrame(rows, DEC))
    assert said["tip"] > 1 and said["desk"] < -1 and people.remark_words(spark.createDataFrame([], DEC)) == {"": 0.0}


def test_label_model_learns_who_is_right():
    r = np.random.default_rng(1)
    y = r.random(20000) < 0.3
    levels = {k: (-1, 0, 1) for k in "abcdefgh"}
    x = np.zeros((len(y), len(levels)), dtype=int)
    for k in range(len(levels)):
        right = r.random(len(y)) < (0.9 if k % 2 else 0.7)
        x[:, k] = np.where(y == right, 2, 0)
    x[:, 5] = x[:, 4]  # one function that only repeats another
    patterns, at_, counts = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    m = labelmodel.LabelModel(levels, dict.fromkeys(levels, 0.5), 0.0, patterns, counts)
    q = m.q[at_.ravel()]
    assert ((q > 0.5) == y).mean() > 0.95
    assert m.parent[4] == 5 or m.parent[5] == 4
    assert m.accuracies()["b"] > m.accuracies()["a"]


@pytest.mark.parametrize(("text", "code"), [("Club A", "AAA"), ("club a ii", "AAA"), ("tvaa", "AAA"), ("-", None), (None, None), ("nowhere", None)])
def test_club_names(text, code):
    assert people.ClubNames([("aaa", "AAA"), ("club a", "AAA"), ("tva", "AAA"), ("bbb", "BBB")]).find(text) == code


def test_clubs_mentioned():
    c = people.ClubNames([("aaa", "AAA"), ("solmodal basket", "AAA"), ("basket rivona", "BBB")])
    assert c.mentioned("moved from Solmodal; plays guard") == ("AAA", {"SOLMODAL"})
    assert c.mentioned("Rivona, then solmodal basket")[0] is None and c.mentioned("") == (None, set())
