"""The kernel against a plain enumeration of all squads and line-ups."""

import itertools
import random

import numpy as np
import pandas as pd
import pytest

from hoopflow.config import Optimization
from hoopflow.operators.squad import frame, kernel, solves


def universe(seed):
    r = random.Random(seed)
    pos = ["G"] * 6 + ["F"] * 5 + ["C"] * 3
    teams = ["A"] * 7 + ["B"] * 4 + ["D"] * 3
    r.shuffle(teams)
    prev = [0] * len(pos)
    if seed % 2:
        for p, n in kernel.SQUAD.items():
            for i in r.sample([i for i, x in enumerate(pos) if x == p], n):
                prev[i] = 1
    return kernel.Pool(
        [f"p{i:02d}" for i in range(len(pos))], teams, pos, [r.choice([1, 2]) for _ in pos], np.array([round(r.uniform(4, 15), 1) for _ in pos]), np.array(prev),
        np.array([r.uniform(-5, 25) for _ in pos]), np.array([r.uniform(-0.5, 0.5) for _ in pos]),
    )


def lineup(pool, squad):
    best = None
    for five in itertools.combinations(squad, 5):
        n = [sum(pool.position[i] == p for i in five) for p in "GFC"]
        if all(lo <= k <= hi for k, (lo, hi) in zip(n, kernel.FORMATIONS)):
            rest = [pool.score[i] for i in squad if i not in five]
            v = sum(pool.score[i] for i in five) + max(pool.score[i] for i in five) + 0.5 * sum(rest) + 0.5 * max(rest)
            best = v if best is None else max(best, v)
    return best


def enumerate_all(pool, rules):
    money = rules.cash + float((pool.price * pool.prev).sum())
    by = {p: [i for i, x in enumerate(pool.position) if x == p and pool.player[i] not in rules.avoid] for p in "GFC"}
    best = None
    for g, f, c in itertools.product(*[itertools.combinations(by[p], n) for p, n in kernel.SQUAD.items()]):
        squad = g + f + c
        if sum(pool.price[i] for i in squad) > money + 1e-9 or not rules.must <= {pool.player[i] for i in squad}:
            continue
        if rules.max_trades is not None and sum(1 - pool.prev[i] for i in squad) > rules.max_trades:
            continue
        if any(sum(pool.team[i] == t for i in squad) > 6 for t in "ABD") or any(sum(pool.turn[i] == t for i in squad) < k for t, k in enumerate(rules.turn_minimums, 1)):
            continue
        v = lineup(pool, squad) + rules.credit_value * sum(pool.growth[i] for i in squad)
        best = v if best is None else max(best, v)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_kernel_equals_enumeration(seed):
    pool = universe(seed)
    cash = 3.0 if pool.prev.any() else 85.0
    for rules in (
        kernel.Rules(cash), kernel.Rules(cash, 2 if pool.prev.any() else 10, 3.0), kernel.Rules(cash, turn_minimums=(5, 4)),
        kernel.Rules(cash + 5, must=frozenset(["p01"]), avoid=frozenset(["p07"])), kernel.Rules(cash * 0.5),
    ):
        want = enumerate_all(pool, rules)
        if want is None:
            with pytest.raises(kernel.Infeasible):
                kernel.solve(pool, rules)
            continue
        value, members = kernel.solve(pool, rules)
        assert value == pytest.approx(want)
        squad = [i for i, _, _ in members]
        five = [i for i, role, _ in members if role == "starter"]
        sixth = next(i for i, role, _ in members if role == "sixth")
        captain = next(i for i, _, c in members if c)
        scored = 0.5 * sum(pool.score[i] for i in squad) + 0.5 * sum(pool.score[i] for i in [*five, sixth]) + pool.score[captain]
        assert captain in five and scored + rules.credit_value * sum(pool.growth[i] for i in squad) == pytest.approx(want)


def table(spark, pool):
    return spark.createDataFrame(
        pd.DataFrame({"player": pool.player, "team": pool.team, "position": pool.position, "turn": pool.turn, "crd_last": pool.price, "in_prev_roster": pool.prev, "exp_pir": pool.score})
    )


def test_scenarios_end_to_end(spark):
    cfg = Optimization(cash=3.0, max_trades=2, credit_value=1.0)
    df = table(spark, universe(1))
    frame_ = solves.run_scenarios(df, cfg, [solves.Scenario("plain"), solves.Scenario("rich", None, (("cash", 50.0), ("unlimited_trades", True)))]).persist()
    solved = frame_.toPandas()
    s = {r["scenario"]: r for r in solves.sensitivity(frame_).collect()}
    assert s["plain"]["gain_of_trading"] >= 0 and s["rich"]["worth_of_a_credit"] >= 0 and s["rich"]["points_given_for_growth"] >= -1e-9
    assert solves.format_report(frame_, "plain").count("\n") >= 10 and solves.format_report(frame_, "void") == "void: no squad"
    value = solved.groupby(["scenario", "kind"]).objective.max()
    assert value["rich", "main"] >= value["plain", "main"] >= value["plain", "no_trade"]
    assert (solved[solved.selected == 1].groupby(["scenario", "kind"]).size() == 10).all()


@pytest.mark.parametrize(("column", "value", "word"), [("crd_last", -1.0, "price_not_positive"), ("position", "X", "unknown_position"), ("player", "p01", "repeated_player"), ("turn", 0, "turn_not_whole")])
def test_input_rules(spark, column, value, word):
    p = table(spark, universe(0)).toPandas()
    p.loc[0, column] = value
    with pytest.raises(ValueError, match=word):
        frame.check_input(frame.model_frame(spark.createDataFrame(p), Optimization()))


def test_empty_cells_and_missing_columns(spark):
    p = table(spark, universe(0))
    with pytest.raises(ValueError, match="lacks"):
        frame.model_frame(p.drop("turn"), Optimization())
    with pytest.raises(ValueError, match="empty"):
        frame.model_frame(p.selectExpr("* except (exp_pir)", "cast(null as double) as exp_pir"), Optimization())


def league(seed=7):
    """680 players: 20 clubs with 13 G, 13 F and 8 C each, and a legal current squad."""
    r = random.Random(seed)
    rows = [(f"{p}{c:02d}{k:02d}", f"T{c}", p, r.choice([1, 2]), round(r.uniform(4, 16), 1), r.uniform(-3, 22), r.uniform(-0.5, 0.5)) for c in range(20) for p, n in (("G", 13), ("F", 13), ("C", 8)) for k in range(n)]
    prev = {x for p, n in kernel.SQUAD.items() for x in r.sample([row[0] for row in rows if row[2] == p], n)}
    name, team, pos, turn, price, score, growth = zip(*rows)
    return kernel.Pool(list(name), list(team), list(pos), list(turn), np.array(price), np.array([int(x in prev) for x in name]), np.array(score), np.array(growth))


def test_680_candidates_in_time_and_twice_the_same():
    import time

    began = time.perf_counter()
    once, again = (kernel.solve(league(), kernel.Rules(1.5, 4, 3.0)) for _ in range(2))
    assert once == again and time.perf_counter() - began < 60


def test_a_credit_is_priced_without_the_growth_term(spark):
    df = table(spark, universe(1))
    solved = solves.solve_all(df, {"x": (Optimization(cash=3.0, max_trades=3, credit_value=40.0), None)}).persist()
    s = solves.sensitivity(solved).first()
    pool = universe(1)
    best = {c: enumerate_all(pool, kernel.Rules(c, 3, 0.0)) for c in (3.0, 4.0)}
    assert s["worth_of_a_credit"] == pytest.approx(best[4.0] - best[3.0])
    report = {(r["section"], r["metric"]): r["value"] for r in solves.report_sheet(solved, {"x": (Optimization(cash=3.0, max_trades=3, credit_value=40.0), None)}).collect()}
    money = {r["metric"]: r["value"] for r in solves.summary(solved).where("kind = 'main'").collect()}
    assert report["solver", "status"] == "optimal" and report["parameters", "max_trades"] == "3" and report["scenario", "roster"] == "table"
    assert float(report["squad", "cash_after"]) == pytest.approx(3.0 + money["cash_change"], abs=1e-6) and float(report["squad", "cash_before"]) == 3.0
    assert ("line-up", "pir_mean_points") not in report and float(report["line-up", "exp_pir_points"]) == pytest.approx(money["target_points"], abs=1e-5)
    assert "one more credit" in solves.format_credit_value(solved, "x") and solves.format_credit_value(solved, "y") == "y: no squad"


def test_scenarios_are_checked(spark, tmp_path):
    f = tmp_path / "s.toml"
    f.write_text('[home]\ncash = 5.0\n[away]\nroster = ["p01"]\n')
    known = solves.load_scenarios(str(f))
    assert [s.key for s in solves.select_scenarios(known, "away, home,away")] == ["away", "home"] and solves.select_scenarios(known, " all ") == known
    for bad, word in ((",", "names no"), ("homme", "close: ")):
        with pytest.raises(ValueError, match=word):
            solves.select_scenarios(known, bad)
    with pytest.raises(ValueError, match="p99.*close"):
        solves.run_scenarios(table(spark, universe(1)), Optimization(), [solves.Scenario("x", ("p01", "p99"))])
    f.write_text('[Bad Key]\n[two]\nroster = ["a", "a"]\n'.replace("[Bad Key]", '["Bad Key"]'))
    with pytest.raises(ValueError, match="Bad Key.*two"):
        solves.load_scenarios(str(f))
    with pytest.raises(ValueError, match="close"):
        frame.check_parameters(frame.model_frame(table(spark, universe(1)), Optimization()), Optimization(must_have=("p0l",)))
