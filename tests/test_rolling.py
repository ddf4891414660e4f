import random
from datetime import date, datetime, timedelta

from hoopflow.operators import rolling as R
from hoopflow.session import work_dir

AMOUNTS = "player_id string, day date, val_sum long, val_n long, secs_sum long, secs_n long, games long"
D0 = date(2020, 1, 1)


def brute(amounts, windows):
    by = {}
    for p, d, *v in amounts:
        by.setdefault(p, []).append((d, v))
    out = {}
    for p, games in by.items():
        d = min(x for x, _ in games)
        while d < max(x for x, _ in games) + timedelta(days=max(windows)):
            out[p, d] = tuple(sum(v[k] for x, v in games if 0 <= (d - x).days < w) for w in windows for k in range(5))
            d += timedelta(days=1)
    return out


def states(df, windows):
    return {(r["player_id"], r["day"]): tuple(r[f"{p}_{w}"] for w in windows for p in R.PARTS) for r in df.collect()}


def sample(seed):
    r = random.Random(seed)
    return [(p, D0 + timedelta(days=k), r.randint(-9, 30), 1, r.randint(0, 2400), 1, 1) for p in ("a", "b", None) for k in sorted(r.sample(range(120), 12))]


def test_trailing_state_is_the_sum_of_each_window(spark):
    data = sample(1)
    assert states(R.trailing_state(spark.createDataFrame(data, AMOUNTS), (7, 30)), (7, 30)) == brute(data, (7, 30))
    assert R.trailing_state(spark.createDataFrame([], AMOUNTS), (7, 30)).count() == 0


def read(store, version=None):
    return R.expand(store.state(version), store.windows)


def test_versions_equal_a_fresh_build(spark):
    r = random.Random(5)
    data = [x for x in sample(2) if x[0]]
    store = R.RollingStore(spark, work_dir(spark, "t"))
    store.LAYERS = 3
    store.build(spark.createDataFrame(data, AMOUNTS))
    first = data[0]
    steps = [
        [("a", D0 + timedelta(days=200), 5, 1, 60, 1, 1), ("b", data[-3][1], 3, 1, 100, 1, 1), ("c", D0, 1, 1, 1, 1, 1)],
        [(first[0], first[1], -first[2], -1, -first[4], -1, -1)],  # a withdrawn first game
        [("c", D0, -1, -1, -1, -1, -1)],  # a player who is gone
        [("b", data[-1][1], 4, 0, 0, 0, 0), ("a", D0 - timedelta(days=90), 2, 1, 1, 1, 1)],  # another value; a game long before
        [],
        [("a", D0 + timedelta(days=200), -5, -1, -60, -1, -1)],  # a withdrawn last game, far behind the others
        *[[(p, D0 + timedelta(days=r.randint(-60, 200)), r.randint(-9, 9), 1, r.randint(0, 99), 1, 1) for p in r.sample("abcd", 2)] for _ in range(1)],
    ]
    counted = list(data)
    for rows in steps:
        version = store.advance(spark.createDataFrame(rows, AMOUNTS))
        counted += rows
        total = {}
        for p, d, *v in counted:
            total[p, d] = [x + y for x, y in zip(total.get((p, d), [0] * 5), v)]
        want = brute([(p, d, *v) for (p, d), v in total.items() if v[4]], (7, 30))
        got = read(store)
        assert states(got, (7, 30)) == want and got.count() == len(want), version
    assert states(read(store, 0), (7, 30)) == brute(data, (7, 30))  # old versions stay


def test_other_players_and_dates_are_not_written_again(spark):
    store = R.RollingStore(spark, work_dir(spark, "t"))
    store.build(spark.createDataFrame([x for x in sample(2) if x[0]], AMOUNTS))
    at = D0 + timedelta(days=60)
    v = store.advance(spark.createDataFrame([("a", at, 1, 1, 1, 1, 1)], AMOUNTS))
    written = store._get("state", v).collect()
    assert {x["player_id"] for x in written} == {"a"}
    assert min(x["day"] for x in written) == at and max(x["until"] for x in written) == at + timedelta(days=30)


BOX = "game_player_id string, delivery_id long, loaded_at timestamp_ntz, game_id string, game string, dorsal string, valuation int, minutes string, extra string"


def test_corrections_and_late_games(spark):
    at = lambda d: datetime(2020, 3, d)
    box = spark.createDataFrame(
        [
            ("E2019_1_P1", 1, at(2), "E2019_1", "A-B", "5", 10, "10:00", None), ("E2019_1_P1", 2, at(4), "E2019_1", "A-B", "5", 99, "99:00", None),
            ("E2019_2_P1", 3, at(3), "e2019-02", "A-B", None, 4, "DNP", None), ("e2019_2_p1", 4, at(1), "E2019_2", "A-B", None, 6, None, None),
            ("E2019_1_A", 5, at(2), "E2019_1", "A-B", "TOTAL", 70, "200:00", None), ("E2019_3_P1", 6, None, "E2019_3", "A-B", "5", 1, "", None), (None, 7, at(2), "E2019_1", "A-B", "5", 1, "1:00", None),
        ],
        BOX,
    )
    header = spark.createDataFrame([("E2019_1", date(2020, 3, 1)), ("E2019_01", date(2020, 3, 1)), ("E2019_2", date(2020, 3, 5)), ("E2019_3", date(2020, 4, 1))], "game_id string, date date")
    whole = R.trailing_days(box, header, work_dir(spark, "t"), ())
    for shares in ((0.3,), (0.2, 0.5, 0.8)):
        got = R.trailing_days(box, header, work_dir(spark, "t"), shares)
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    by = {r["day"]: r for r in whole.collect()}
    assert by[date(2020, 3, 5)]["valuation_total_7"] == 16 and by[date(2020, 3, 5)]["games_7"] == 2 and by[date(2020, 3, 5)]["minutes_avg_7"] == 10.0
    assert max(by) == date(2020, 4, 30) and by[date(2020, 4, 30)]["games_30"] == 1 and by[date(2020, 4, 30)]["minutes_avg_30"] is None
    assert R.trailing_days(box.limit(0), header, work_dir(spark, "t")).count() == 0


def test_minutes(spark):
    from pyspark.sql import functions as F

    data = ["12:30", "5:07", "DNP", " dnp ", "", " ", None, "x", "a:b", "12", "200:00"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in data], "m string").select(R.seconds(F.col("m"))).collect()]
    assert got == [750, 307, 0, 0, None, None, None, None, None, None, 12000]
