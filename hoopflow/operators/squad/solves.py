"""Solving: one group of rows per solve, all solves of all scenarios in parallel, results as DataFrames."""

from __future__ import annotations

import difflib
import re
import time
import tomllib
from dataclasses import dataclass, fields, replace
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoopflow.config import Optimization, override
from hoopflow.operators.squad import kernel
from hoopflow.operators.squad.frame import check_input, check_parameters, close, model_frame, objective_components

ROW = "solve_id string, player string, role string, is_captain int, selected int, objective double, seconds double, problem string"
#: Columns of the input that are reported too, where it has them.
REFERENCE = ("exp_pir", "pir_mean", "pir_per_crd")
KINDS = ("main", "no_trade", "credit_value_0", "one_credit_more", "vanilla")


@dataclass(frozen=True)
class Scenario:
    key: str
    roster: tuple[str, ...] | None = None
    overrides: tuple[tuple[str, object], ...] = ()


SCENARIO_KEY = re.compile(r"[a-z0-9][a-z0-9_-]*")


def load_scenarios(path: str) -> list[Scenario]:
    """Scenarios of a TOML file: a table each, an optional roster of distinct names, other keys override settings."""
    out, problems = [], []
    for key, body in tomllib.loads(Path(path).read_text(encoding="utf-8")).items():
        if not isinstance(body, dict):
            problems.append(f"scenario {key!r} is no table")
            continue
        roster = body.pop("roster", None)
        if not SCENARIO_KEY.fullmatch(key):
            problems.append(f"scenario {key!r}: a key is made of small letters, digits, - and _")
        if roster is not None and not (isinstance(roster, list) and all(isinstance(n, str) and n.strip() for n in roster) and len(set(roster)) == len(roster)):
            problems.append(f"scenario {key!r}: the roster is no list of distinct names")
            roster = None
        out.append(Scenario(key, None if roster is None else tuple(roster), tuple(sorted((k, tuple(v) if isinstance(v, list) else v) for k, v in body.items()))))
    if problems or not out:
        raise ValueError("; ".join(problems) or f"{path} has no scenario")
    return out


def select_scenarios(scenarios: list[Scenario], wanted: str) -> list[Scenario]:
    """``all``, or the scenarios of a comma list in its order. A list that names nothing, or something unknown, is an error."""
    asked = dict.fromkeys(filter(None, map(str.strip, wanted.split(","))))
    if list(asked) == ["all"]:
        return scenarios
    by_key = {s.key: s for s in scenarios}
    strange = {k: difflib.get_close_matches(k, by_key, n=3, cutoff=0.6) for k in asked if k not in by_key}
    if strange or not asked:
        raise ValueError("; ".join(f"no scenario {k!r}{f' (close: {near})' if near else ''}" for k, near in strange.items()) or f"{wanted!r} names no scenario")
    return [by_key[k] for k in asked]


def variants(cfg: Optimization) -> dict[str, Optimization]:
    """The solves of one run: the run itself and what it is held against. A credit's worth in points is seen without the growth term."""
    return {
        "main": cfg, "no_trade": replace(cfg, max_trades=0, unlimited_trades=False), "credit_value_0": replace(cfg, credit_value=0.0), "one_credit_more": replace(cfg, credit_value=0.0, cash=cfg.cash + 1),
        "vanilla": replace(cfg, robustness_lambda=0.0, upside_beta=0.0, downside_gamma=0.0, credit_value=0.0),
    }


def _run(settings: dict[str, Optimization]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values("player", kind="stable", ignore_index=True)
        cfg = settings[p.solve_id[0]]
        pool = kernel.Pool(
            p.player.tolist(), p.team.tolist(), p.position.tolist(), p.turn.astype(int).tolist(), p.price.to_numpy("float64"), p.in_prev_roster.to_numpy("int64"),
            p.score.to_numpy("float64"), p.credit_growth.to_numpy("float64"),
        )
        rules = kernel.Rules(cfg.cash, cfg.trades, cfg.credit_value, cfg.min_players_per_turn, frozenset(cfg.must_have), frozenset(cfg.avoid))
        out = pd.DataFrame({"solve_id": p.solve_id, "player": p.player, "role": "none", "is_captain": 0, "selected": 0, "objective": np.nan, "seconds": np.nan, "problem": None})
        began = time.perf_counter()
        try:
            value, members = kernel.solve(pool, rules)
        except kernel.Infeasible as e:
            return out.assign(problem=str(e))
        for i, role, captain in members:
            out.loc[i, ["role", "is_captain", "selected"]] = [role, int(captain), 1]
        return out.assign(objective=value, seconds=time.perf_counter() - began)

    return run


def solve_all(table: DataFrame, runs: dict[str, tuple[Optimization, tuple[str, ...] | None]], kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """scenario, kind and the solved rows with their components. All runs are checked before any is solved.

    A run that has no legal squad has its reason in ``problem`` and nobody selected. Equal settings are solved once per run.
    """
    frames, settings = [], {}
    for key, (cfg, roster) in runs.items():
        if roster is not None:
            there = {r["player"] for r in table.where(F.col("player").isin(*roster)).select("player").collect()}
            if lost := [n for n in roster if n not in there]:
                raise ValueError(f"scenario {key!r}: not in the table: " + ", ".join(f"{n!r}{close(n, table)}" for n in lost))
        own = table.withColumn("in_prev_roster", F.col("player").isin(*roster).cast("int")) if roster is not None else table
        base = model_frame(own, cfg)
        check_input(base)
        check_parameters(base, cfg)
        for kind, variant in variants(cfg).items():
            if kind in kinds:
                solve_id = f"{key}|{kind}"
                settings[solve_id] = variant
                columns = ["player", "team", "position", "turn", "price", "in_prev_roster", "target", "risk_adjustment", "score", "credit_growth", "growth_value"]
                frames.append(objective_components(base, variant).select(F.lit(solve_id).alias("solve_id"), F.lit(float(cfg.cash)).alias("cash"), *columns))
    extra = [c for c in REFERENCE if c in table.columns]
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)
    solved = rows.groupBy("solve_id").applyInPandas(_run(settings), ROW)
    both = rows.join(solved, ["solve_id", "player"]).join(table.select("player", *[F.col(c).cast("double").alias(c) for c in extra]), "player", "left")
    both = both.withColumns({c: F.lit(None).cast("double") for c in REFERENCE if c not in extra})
    prev, new = F.col("in_prev_roster") == 1, F.col("selected") == 1
    action = F.when(prev & new, "keep").when(new, "buy").when(prev, "sell").otherwise("none")
    cut_id = F.split("solve_id", r"\|")
    return both.select(cut_id[0].alias("scenario"), cut_id[1].alias("kind"), "player", "team", "position", "turn", "price", "target", "selected", "role", action.alias("action"), "is_captain",
                       "risk_adjustment", "score", "credit_growth", "growth_value", "objective", "seconds", "problem", "cash", *REFERENCE)


def run_scenarios(table: DataFrame, cfg: Optimization, scenarios: list[Scenario]) -> DataFrame:
    return solve_all(table, {s.key: (override(cfg, dict(s.overrides)), s.roster) for s in scenarios})


def selection_sheet(solved: DataFrame) -> DataFrame:
    """The main solve, squad first by role, then those sold, then the rest; ``place`` is the order."""
    rank = F.when(F.col("role") == "starter", 0.0).when(F.col("role") == "sixth", 1.0).when(F.col("role") == "bench", 2.0).otherwise(3.0) - F.when(F.col("action") == "sell", 0.5).otherwise(0.0)
    return solved.where("kind = 'main'").withColumn("place", rank).orderBy("scenario", "place", "player")


def lineup_sum(column: str):
    """A column summed over the line-up: active players once, the bench half, the captain once more."""
    return F.sum(lineup_weight() * F.col(column))


def lineup_weight():
    return F.when(F.col("role").isin("starter", "sixth"), 1.0).when(F.col("role") == "bench", 0.5).otherwise(0.0) + F.col("is_captain")


def summary(solved: DataFrame) -> DataFrame:
    """scenario, kind, metric, value: objective and its parts, trades and money. ``cash_before`` is the run's, ``cash_after`` what is left."""
    buy, sell = F.when(F.col("action") == "buy", F.col("price")), F.when(F.col("action") == "sell", F.col("price"))
    change = F.coalesce(F.sum(sell), F.lit(0.0)) - F.coalesce(F.sum(buy), F.lit(0.0))
    squad = F.when(F.col("selected") == 1, F.col("pir_per_crd"))
    parts = {
        "objective": F.max("objective"), "active_points": lineup_sum("score"), "growth_credits": F.sum(F.col("selected") * F.col("credit_growth")), "growth_term": F.sum(F.col("selected") * F.col("growth_value")),
        "trades": F.count_if(F.col("action") == "buy").cast("double"), "cash_before": F.max("cash"), "cash_change": change, "cash_after": F.max("cash") + change, "squad_price": F.sum(F.col("selected") * F.col("price")),
        "target_points": lineup_sum("target"), "risk_points": lineup_sum("risk_adjustment"), "exp_pir_points": lineup_sum("exp_pir"), "pir_mean_points": lineup_sum("pir_mean"), "pir_per_credit": F.avg(squad),
        "candidates": F.count(F.lit(1)).cast("double"), "solve_seconds": F.max("seconds"),
    }
    g = solved.groupBy("scenario", "kind").agg(*[c.cast("double").alias(k) for k, c in parts.items()])
    return g.unpivot(["scenario", "kind"], list(parts), "metric", "value")


#: The sections of a report and their rows: kind of solve, metric of the summary.
REPORT = {
    "objective": [("main", "objective"), ("main", "active_points"), ("main", "growth_term"), ("main", "growth_credits"), ("no_trade", "objective")],
    "line-up": [("main", "target_points"), ("main", "risk_points"), ("main", "exp_pir_points"), ("main", "pir_mean_points"), ("main", "pir_per_credit")],
    "vanilla": [("vanilla", "target_points"), ("vanilla", "growth_credits")],
    "squad": [("main", "trades"), ("main", "cash_before"), ("main", "cash_after"), ("main", "squad_price")],
    "solver": [("main", "candidates"), ("main", "solve_seconds")],
}


def report_sheet(solved: DataFrame, runs: dict[str, tuple[Optimization, tuple[str, ...] | None]]) -> DataFrame:
    """scenario, section, metric, value (text): what a run reached, what it is held against, how it was solved, and all its parameters.

    Rows that a run has no value for are left out; a run without a squad has its reason as the status.
    """
    spark = solved.sparkSession
    wanted = spark.createDataFrame([(s, k, m) for s, rows in REPORT.items() for k, m in rows], "section string, kind string, metric string")
    numbers = summary(solved).where("value is not null").join(F.broadcast(wanted), ["kind", "metric"])
    name = F.when(F.col("kind") == "no_trade", F.lit("objective_keeping_the_squad")).when(F.col("kind") == "vanilla", F.concat(F.lit("vanilla_"), "metric")).otherwise(F.col("metric"))
    rows = numbers.select("scenario", "section", name.alias("metric"), F.round("value", 6).cast("string").alias("value"))
    more = sensitivity(solved).unpivot("scenario", ["gain_of_trading", "worth_of_a_credit", "points_given_for_growth"], "metric", "value").where("value is not null")
    rows = rows.unionByName(more.select("scenario", F.lit("objective").alias("section"), "metric", F.round("value", 6).cast("string").alias("value")))
    status = solved.where("kind = 'main'").groupBy("scenario").agg(F.max("problem").alias("p")).select("scenario", F.lit("solver").alias("section"), F.lit("status").alias("metric"), F.coalesce("p", F.lit("optimal")).alias("value"))
    cell = lambda v: str(list(v)) if isinstance(v, tuple) else str(v)
    settings = [(k, "parameters", f.name, cell(getattr(cfg, f.name))) for k, (cfg, _) in runs.items() for f in fields(cfg)]
    settings += [(k, "scenario", "roster", "scenario" if roster is not None else "table") for k, (_, roster) in runs.items()]
    return rows.unionByName(status).unionByName(spark.createDataFrame(settings, "scenario string, section string, metric string, value string"))


def sensitivity(solved: DataFrame) -> DataFrame:
    """One row per scenario: what trading gains, what one more credit is worth, what growth costs in points, and how far the squad is from
    the plain one (members that the solve without risk and growth terms doesn't have). Solves without a squad give nulls."""
    points = lineup_sum("score").alias("points")
    kinds = solved.groupBy("scenario").pivot("kind", list(KINDS)).agg(F.max("objective").alias("objective"), points)
    own, plain = solved.where("kind = 'main' and selected = 1"), solved.where("kind = 'vanilla' and selected = 1")
    changed = own.join(plain.select("scenario", "player"), ["scenario", "player"], "left_anti").groupBy("scenario").agg(F.count(F.lit(1)).alias("changed"))
    return kinds.join(changed, "scenario", "left").select(
        "scenario", F.col("main_objective").alias("objective"), (F.col("main_objective") - F.col("no_trade_objective")).alias("gain_of_trading"),
        (F.col("one_credit_more_points") - F.col("credit_value_0_points")).alias("worth_of_a_credit"), (F.col("credit_value_0_points") - F.col("main_points")).alias("points_given_for_growth"),
        F.coalesce("changed", F.lit(0)).alias("changed_from_plain"),
    )


def lineup_of(pdf: pd.DataFrame) -> pd.DataFrame:
    """season_code, team_id, points, captain of the best line-up of one squad; null points where it isn't made of 4 G, 4 F and 2 C."""
    p = pdf.sort_values("player_normalized", kind="stable", ignore_index=True)
    n, none = len(p), np.zeros(len(p))
    out = {"season_code": p.season_code[:1], "team_id": p.team_id[:1], "points": [None], "captain": [None]}
    if p.position.value_counts().to_dict() == kernel.SQUAD:
        pool = kernel.Pool(p.player_normalized.tolist(), [str(i // 5) for i in range(n)], p.position.tolist(), [1] * n, none + 1.0, (none + 1).astype("int64"), p.score.to_numpy("float64"), none)
        value, members = kernel.solve(pool, kernel.Rules(0.0))
        out |= {"points": [round(value, 4)], "captain": [pool.player[next(i for i, _, c in members if c)]]}
    return pd.DataFrame(out).astype({"points": "float64"})


def format_report(solved: DataFrame, scenario: str) -> str:
    """A text report of one scenario's main solve; a squad has ten rows."""
    rows = selection_sheet(solved).where((F.col("scenario") == scenario) & ((F.col("selected") == 1) | (F.col("action") == "sell"))).collect()
    if not rows:
        return f"{scenario}: no squad"
    lines = [f"{scenario}: objective {rows[0]['objective']:.2f}"]
    lines += [f"  {r['role']:8}{'*' if r['is_captain'] else ' '} {r['player']} ({r['team']}, {r['position']}) {r['price']:.1f} {r['action']}" for r in rows]
    return "\n".join(lines)


def format_credit_value(solved: DataFrame, scenario: str) -> str:
    """A text report of what a credit is worth in points and what the growth term costs."""
    r = sensitivity(solved).where(F.col("scenario") == scenario).first()
    if r is None or r["worth_of_a_credit"] is None:
        return f"{scenario}: no squad"
    return "\n".join([f"{scenario}: credit value", f"  one more credit of cash is worth {r['worth_of_a_credit']:.2f} points", f"  the growth term costs {r['points_given_for_growth']:.2f} points"])
