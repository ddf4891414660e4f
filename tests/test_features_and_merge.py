import random
import statistics
import zipfile

import pytest
from pyspark.sql import functions as F

from hoopflow.operators import features, merge, quality
from hoopflow.sources import sinks, tables

KPI = "player_normalized string, team_id string, position string, round int, game_id string, game_player_id string, valuation int, minutes_num double, quotation double"


def games(values, order=None):
    rows = [("p", "T", "G", i, f"g{i}", f"m{i}", v, float(i), 10.0 + i) for i, v in enumerate(values)]
    random.Random(order).shuffle(rows)
    return rows


def test_indicators_do_not_depend_on_row_order(spark):
    values = [100, 0, 10, 20, 30, 40]
    got = [features.player_kpis(spark.createDataFrame(games(values, k), KPI)).first().asDict() for k in (1, 2)]
    assert got[0] == got[1]
    k = got[0]
    assert (k["pir_p10"], k["pir_p50"], k["pir_p75"], k["pir_p90"]) == (4.0, 20.0, 30.0, 36.0)
    assert (k["pir_last"], k["pir_lag1"], k["pir_lag2"], k["pir_slow"], k["pir_fast"], k["crd_last"]) == (40.0, 30.0, 20.0, 20.0, 30.0, 15.0)
    assert k["pir_std"] == pytest.approx(statistics.stdev(values))


def test_one_game_is_filled(spark):
    k = features.fill_empty(features.player_kpis(spark.createDataFrame([("p", "T", "G", 1, "g", "m", 0, 0.0, 5.0)], KPI))).first()
    assert (k["pir_std"], k["mins_std"], k["pir_per_min"], k["pir_trend"], k["mins_trend"], k["pir_lag1"], k["pir_lag2"]) == (0.0, 0.0, 0.0, 1.0, 1.0, 0.0, 0.0)


def test_turns(spark):
    s = "gameday int, date string, hometeam string, homecode string, awayteam string, awaycode string"
    rows = [(3, "Sep 30, 2026", "A", "a", "B", "b"), (3, "Oct 2, 2026", "C", "c", "D", "d"), (3, "Oct 1, 2026", "E", "e", "F", "f"), (4, "Oct 9, 2026", "A", "a", "C", "c")]
    df = spark.createDataFrame(rows, s)
    assert {r["homecode"]: r["turn"] for r in features.round_games(df, 3).collect()} == {"a": 1, "c": 2, "e": 1}
    assert [r["turn"] for r in features.round_games(df, 4).collect()] == [1]
    assert sorted((r["team"], r["opponent"], r["venue"]) for r in features.by_team(features.round_games(df, 4)).collect()) == [("a", "c", "home"), ("c", "a", "away")]


def test_prepare(spark):
    s = "season_code string, game string, team_id string, dorsal string, minutes string"
    rows = [("E2026", "RED-BLU", "RED", "1", "10:30"), ("E2026", "RED-BLU", "BLU", None, "DNP"), ("E2026", "RED-BLU", "RED", "TOTAL", "200:00"), ("E2020", "RED-BLU", "RED", "1", "1:00")]
    got = [(r["team_id"], r["opponent"], r["homeaway"], r["minutes_num"]) for r in features.prepare_boxscore(spark.createDataFrame(rows, s), 2026).collect()]
    assert got == [("RED", "BLU", "home", 10.5), ("BLU", "RED", "away", 0.0)]


def test_merge_authority_and_drift(spark):
    s = "season_code string, k string"
    base, deltas = spark.createDataFrame([("E1", "a"), ("E2", "b")], s), spark.createDataFrame([("E2", "c")], s)
    assert sorted(r["k"] for r in merge.merge(base, deltas).collect()) == ["a", "c"]
    assert sorted(r["k"] for r in merge.merge(None, deltas).collect()) == ["c"]
    assert sorted(r["k"] for r in merge.merge(base, deltas, "E1").collect()) == ["a", "c"]
    with pytest.raises(ValueError, match="no rows"):
        merge.merge(base, deltas, "E9")
    with pytest.raises(ValueError, match="differ"):
        merge.merge(base, deltas.select("k", "season_code"))


def test_quality_reports_everything(spark):
    df = spark.createDataFrame([("1", "x"), ("1", "y"), (None, " "), ("2", None)], "id string, v string")
    with pytest.raises(quality.DataQualityError, match=r"1 blank row.*duplicate key.*1 \(2x\)"):
        quality.validate(df, ["id"], "t")
    with pytest.raises(quality.DataQualityError, match="missing key"):
        quality.validate(df, ["nope"], "t")
    assert quality.validate(spark.createDataFrame([], "id string"), ["id"], "t").count() == 0


def test_lowest_rank(spark):
    df = spark.createDataFrame([("r", 1, None, "n"), ("r", 1, 3, "b"), ("r", 1, 3, "a"), ("r", 2, 9, "z")], "round string, id int, rank int, name string")
    assert sorted(r["name"] for r in merge.lowest_rank(df, ["round", "id"], "rank", ("name",)).collect()) == ["a", "z"]


def test_files(spark, tmp_path):
    d = tmp_path / "deltas"
    d.mkdir()
    (d / "E1_delta_2.csv").write_text("season_code,k\nE1,1.0\n")
    (d / "E1_delta_1.csv").write_text("season_code,k\nE1,007\n")
    got = tables.read_deltas(spark, str(d)).orderBy("_file", "_at").collect()
    assert [r["k"] for r in got] == ["007", "1.0"]
    (d / "E1_delta_3.csv").write_text("k,season_code\n1,E1\n")
    with pytest.raises(ValueError, match="differ"):
        tables.read_deltas(spark, str(d))
    sinks.write_workbook({"a": spark.createDataFrame([(1, "x<y", None, 2.5)], "i int, s string, n string, f double")}, str(tmp_path / "w.xlsx"))
    assert "x&lt;y" in zipfile.ZipFile(tmp_path / "w.xlsx").read("xl/worksheets/sheet1.xml").decode()
