from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hoopflow.functions.ids import game_key, message_key, reference
from hoopflow.operators.deliveries import first_deliveries, player_messages
from hoopflow.session import work_dir
from hoopflow.streaming.seen import SeenStore, drop_repeats, repeats

BOX = "game_player_id string, game_id string, game string, dorsal string, delivery_id long, loaded_at timestamp_ntz, valuation int, delivery_ids string"


def rows(spark, data):
    return spark.createDataFrame([(*r, None) for r in data], BOX)


def at(day, hour=0):
    return datetime(2020, 1, day, hour)


DATA = [
    ("E2020_018_P1", "E2020_018", "AAA-BBB", "7", 1, at(1), 5),
    (" e2020-18-p1\t", "E2020-18", "AAA-BBB", "7", 2, at(2), 6),
    ("E2020_0018_P1 ", "E2020_018", "AAA-BBB", None, 3, at(1), 7),
    ("E2020_018_AAA", "E2020_018", "AAA-BBB", "TOTAL", 4, at(3), 50),
    ("E2020_018_AAA", "E2020_018", "AAA-BBB", None, 5, at(4), 51),
    ("E2021_018_P1", "E2021_018", "AAA-BBB", "7", 6, None, 1),
    ("E2021_018_P1", "E2021_018", "AAA-BBB", "7", 7, at(9), 2),
    (None, "E2021_018", "AAA-BBB", "7", 8, at(9), 3),
    ("odd", None, None, None, 9, None, None),
    ("odd", None, None, None, 9, None, None),
]


def test_keys(spark):
    df = spark.createDataFrame([(" e2020-018-p01 ", "E2020_0018", "  Solmodal II "), (None, None, " - "), ("", "x", None)], "m string, g string, r string")
    got = df.select(message_key(F.col("m")), game_key(F.col("g")), reference(F.col("r"))).collect()
    assert [tuple(r) for r in got] == [("E2020_18_P01", "E2020_18", "solmodal ii"), (None, None, None), ("", "X", None)]


def test_first_delivery_wins(spark):
    got = {r["message"]: r["delivery_id"] for r in first_deliveries(rows(spark, DATA), "delivery_id").collect()}
    assert got == {"E2020_18_P1": 1, "E2020_18_AAA": 4, "E2021_18_P1": 7, "ODD": 9}
    assert first_deliveries(rows(spark, []), "delivery_id").count() == 0


def test_total_rows_are_no_players(spark):
    assert {r["player_code"] for r in player_messages(rows(spark, DATA), "delivery_id").collect()} == {"P1", None}


@pytest.mark.parametrize(("files", "keep_days"), [(1, 0), (3, 0), (3, 30), (4, 2), (10, 30)])
def test_stream_drops_all_but_the_first(spark, tmp_path, files, keep_days):
    for k, r in enumerate(DATA):  # one file per delivery, later ones first
        rows(spark, [r]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = drop_repeats(spark, str(tmp_path / "in"), work_dir(spark, "t"), keep_days, files_per_batch=files).collect()
    assert sorted(r["delivery_id"] for r in got) == [2, 3, 5, 6]


def test_a_replayed_batch_changes_nothing(spark):
    store = SeenStore(spark, work_dir(spark, "t"), 0)
    store.process(rows(spark, DATA[:4]), 0)
    store.process(rows(spark, DATA[4:]), 1)
    once = sorted(r["delivery_id"] for r in store.dropped().collect())
    store.process(rows(spark, DATA[4:]), 1)
    assert sorted(r["delivery_id"] for r in store.dropped().collect()) == once == [2, 3, 5, 6]


def test_the_archive_is_merged_and_old_state_goes(spark):
    store = SeenStore(spark, work_dir(spark, "t"), 0)
    for k in range(10):
        store.process(rows(spark, [(f"E2020_{k}_P1", "E2020_1", "AAA-BBB", "7", k, at(1 + k), 5), (f"E2020_{k // 2}_P1", "E2020_1", "AAA-BBB", "7", 100 + k, at(1 + k), 5)]), k)
    last = store.record(9)
    assert len(last["archive"]) < 10 and max(level for level, _ in last["archive"]) >= 1
    assert sorted(r["id"] for r in store.archived(last["archive"]).unionByName(store._state(last["hot"]).selectExpr("*", "'' as season")).collect()) == list(range(10))
    assert {r["delivery_id"] for r in store.dropped().collect()} == {100 + k for k in range(10)}
    assert len(store.log.fs.listStatus(store.log.path("hot"))) == 2


def test_a_table_lands_in_several_batches(spark):
    base = work_dir(spark, "t")
    got = repeats(rows(spark, DATA), base)
    assert sorted(r["delivery_id"] for r in got.collect()) == [2, 3, 5, 6]
    assert len(SeenStore(spark, base).versions()) > 1
    assert repeats(rows(spark, []), work_dir(spark, "t")).count() == 0


def test_empty_stream(spark, tmp_path):
    rows(spark, []).write.parquet(str(tmp_path / "in"))
    assert drop_repeats(spark, str(tmp_path / "in"), work_dir(spark, "t")).count() == 0
