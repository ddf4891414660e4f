from datetime import date, datetime

from hoopflow.operators import references as R

CLUBS = "code string, team string, tv string, added_on date, removed_on date"


def frames(spark, box, header, decisions, clubs):
    return (
        spark.createDataFrame(box, "season_code string, delivery_id long, team_id string, game_id string, code string"),
        spark.createDataFrame(header, "game_id string, date date"),
        spark.createDataFrame(decisions, "season_code string, decision_id string, stats_team string, decided_at timestamp_ntz"),
        spark.createDataFrame(clubs, CLUBS),
    )


def test_orphans_per_day(spark):
    d = date(2020, 5, 1)
    f = frames(
        spark,
        [
            ("E2019", 1, " abc\t", "E2019-1", "x"), ("E2019", 2, "Old Club", "e2019_001", "x"), ("E2019", 3, None, "E2019_1", "x"), ("E2019", 4, " ", "E2019_1", "x"),
            ("E2019", 5, "-", "E2019_1", "x"), ("E2019", 6, "ABC", "E2019_9", "x"), ("E2019", 7, "zzz", "E2019_9", "x"), (None, 8, "zzz", None, "x"), ("E2019", 9, "ABC", "E2019_2", "x"),
        ],
        [("E2019_001", d), ("E2019_001", d), ("E2019_002", date(2019, 1, 1))],
        [("E2019", "D1", "abc fc", datetime(2020, 1, 1)), ("E2019", "D2", "OLD", datetime(2020, 1, 1)), ("E2019", "D3", None, None)],
        [("Abc ", "ABC FC", "ABCTV", date(2019, 6, 1), None), ("Abc ", "ABC FC", "ABCTV", date(2019, 6, 1), None), ("OLD", "Old Club", None, date(2000, 1, 1), d), (None, None, None, None, None)],
    )
    got = sorted((r["table_name"], r["row_key"]) for r in R.orphan_rows(*f).collect())
    box, dec = "euroleague_box_score", "player_name_decisions"
    # 2: removed on the day itself; 7 and 8: unknown at any time; 9: before it was added; 6 and 8 have no day
    assert got == [(box, "2"), (box, "7"), (box, "8"), (box, "9")]
    counts = {(r["table_name"], r["season_code"]): (r["n_references"], r["n_orphans"]) for r in R.orphan_counts(*f).collect()}
    assert counts == {(box, "E2019"): (5, 3), (box, None): (1, 1), (dec, "E2019"): (2, 0)}


def test_empty_tables(spark):
    assert R.orphan_rows(*frames(spark, [], [], [], [])).count() == 0
    f = frames(spark, [("E2019", 1, "abc", "E2019-1", "x")], [], [], [])
    assert [r["row_key"] for r in R.orphan_rows(*f).collect()] == ["1"]


def test_dense_ids(spark):
    df = spark.range(1000).repartition(7).selectExpr("cast(id as string) as ref")
    assert sorted(r["id"] for r in R.dense_ids(df).collect()) == list(range(1000))
