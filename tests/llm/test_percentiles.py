import math
import random
from collections import defaultdict

from pyspark.sql import functions as F

from hoopflow.llm import percentiles as P



def groups():
    return {"g": F.col("g")}


def brute(rows, q):
    by = defaultdict(list)
    for g, _, v in rows:
        if v is not None and not math.isnan(v):
            by[g].append(v)
    return {g: sorted(v)[max(1, (q * len(v) + 999) // 1000) - 1] for g, v in by.items()}


def sample(n=3000):
    r = random.Random(3)
    rows = [(r.choice(["a", "b", None]), r.choice(["s1", "s2"]), r.choice([r.gauss(0, 1e6), float(r.randint(-5, 5)), r.random() * 1e-9, -0.0])) for _ in range(n)]
    return [*rows, ("a", "s1", None), ("b", "s2", float("nan")), ("inf", "s1", math.inf), ("inf", "s1", -math.inf), ("inf", "s2", math.inf), ("none", "s1", None)]


SCHEMA = "g string, part string, v double"


def test_exact_percentiles(spark):
    rows = sample()
    got = {r["grp"]: r for r in P.percentiles(spark.createDataFrame(rows, SCHEMA), groups(), F.col("v")).collect()}
    for q in P.TARGETS:
        assert {g: r[f"p{q}"] for g, r in got.items()} == brute(rows, q)


def test_merged_states_stay_within_the_bound(spark):
    rows = [x for x in sample() if x[2] is None or not math.isinf(x[2])]
    df = spark.createDataFrame(rows, SCHEMA)
    for bits in (16, 24, 32):
        state = P.prefix_state(df, groups(), F.col("v"), F.col("part"), bits)
        halves = state.where("part = 's1'").unionByName(state.where("part = 's2'"))
        got = {r["grp"]: r for r in P.merge(halves, P.TARGETS, bits).collect()}
        for q in P.TARGETS:
            for g, v in brute(rows, q).items():
                assert abs(got[g][f"p{q}"] - v) <= abs(v) * 2.0 ** -(bits - 12)


def test_empty(spark):
    assert P.percentiles(spark.createDataFrame([], SCHEMA), groups(), F.col("v")).count() == 0
