"""Command line: python -m hoopflow.cli merge | names | workbook | optimize | lineage."""

from __future__ import annotations

import argparse
import logging
from pathlib import Path

from pyspark.sql import functions as F

from hoopflow.config import load_config, override
from hoopflow.operators import entity, features, merge, quality
from hoopflow.operators.squad import solves
from hoopflow.plans.lineage import JOBS, Lineage, dag, discover
from hoopflow.session import local_session, ship
from hoopflow.sources import sinks, tables

log = logging.getLogger("hoopflow")


def _merge(a: argparse.Namespace, spark) -> None:
    base = tables.read_text(spark, a.history, tables.file_header(Path(a.history))) if a.history else None
    deltas = tables.read_deltas(spark, a.deltas, [c for c in base.columns if c[0] != "_"] if base else None)
    ranked = lambda df, k: df.withColumn("_rank", F.lit(k))
    merged = merge.merge(ranked(base, 0) if base is not None else None, ranked(deltas, 1), a.season)
    shown = [c for c in merged.columns if c[0] != "_"]
    quality.validate(merged.select(*shown), [a.key], a.out)
    sinks.write_ordered(merged, a.out, ["_rank", "_file", "_at"], shown)
    log.info("merged %s rows into %s", merged.count(), a.out)


def _names(a: argparse.Namespace, spark) -> int:
    box = tables.read_typed(spark, a.box, tables.BOX_TYPED)
    lookup = entity.team_lookup(entity.team_entries(tables.read_schedules(spark, a.schedules)))
    stats = spark.read.option("header", True).csv(a.players)
    rows = entity.match_rows(stats, lookup, entity.club_pool(box, lookup), entity.spelling_pool(box))
    entries = entity.map_entries(entity.apply_decisions(rows, entity.check_decisions(tables.read_decisions(spark, a.decisions))), entity.raw_spellings(box))
    sinks.write_map(quality.validate(entries, ["stats_team", "stats_name"], a.out), a.out)
    left = entity.hints(entity.box_only(box, entries, lookup), entries)
    for r in entity.status_counts(entries).orderBy("match_status", "matched_by").collect():
        log.info("%s by %s: %s names of %s", r["match_status"], r["matched_by"], r["names"], ", ".join(r["clubs"]))
    entity.audit_cases(entries, left).orderBy("case", "club").show(100, truncate=False)
    left.orderBy("team", "player").show(50, truncate=False)
    return int(load_config(a.config).transformation.names_mode == "pause" and not left.isEmpty())


def _workbook(a: argparse.Namespace, spark) -> None:
    box = tables.read_typed(spark, a.box, tables.BOX_TYPED)
    schedule = tables.read_schedules(spark, a.schedules)
    lookup, entries = entity.team_lookup(entity.team_entries(schedule)), tables.read_map(spark, a.map)
    raw = spark.read.option("header", True).csv(a.players).withColumn("quotation", F.col("quotation").cast("double"))
    stats = entity.resolve_players(entity.with_club(raw, "team", lookup, "_club"), "name", "_club", entries).withColumn("position", features.position_letter(F.col("position")))
    season_wide = stats.where("round <> 'all'").isEmpty()
    sheets = features.build_sheets(box, stats, schedule, a.year, entries, lookup, season_wide)
    sinks.write_sheets(sheets, a.out)
    if a.xlsx:
        sinks.write_workbook(sheets, f"{sinks.numbered(a.out, 'workbook', features.next_round(box))}.xlsx")


def _optimize(a: argparse.Namespace, spark) -> None:
    cfg = load_config(a.config).optimization
    if not Path(a.input).exists():
        raise SystemExit(f"{a.input} isn't there; the workbook job writes it as optimizer_input")
    table = spark.read.parquet(a.input)
    chosen = solves.select_scenarios(solves.load_scenarios(a.scenario_file), a.scenarios) if a.scenarios else [solves.Scenario("plain")]
    solved = solves.run_scenarios(table, cfg, chosen).persist()
    solved.write.mode("overwrite").partitionBy("scenario").parquet(f"{a.out}/selection")
    report = solves.report_sheet(solved, {s.key: (override(cfg, dict(s.overrides)), s.roster) for s in chosen}).persist()
    report.write.mode("overwrite").partitionBy("scenario").parquet(f"{a.out}/summary")
    for s in chosen:
        if a.xlsx:
            own = {"selection": solves.selection_sheet(solved), "summary": report}
            sinks.write_workbook({k: df.where(F.col("scenario") == s.key).drop("scenario") for k, df in own.items()}, f"{a.out}/squad_{s.key}.xlsx")
        print(solves.format_report(solved, s.key), solves.format_credit_value(solved, s.key), sep="\n")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="hoopflow")
    p.add_argument("--config")
    sub = p.add_subparsers(dest="job", required=True)
    for job, options in {
        "merge": ["--history", "--deltas!", "--season", "--key=game_player_id", "--out!"],
        "names": ["--box!", "--players!", "--schedules!", "--decisions!", "--out!"],
        "workbook": ["--box!", "--players!", "--schedules!", "--map!", "--out!"],
        "optimize": ["--input!", "--scenario_file", "--scenarios", "--out!"],
        "lineage": ["--root!"],
    }.items():
        s = sub.add_parser(job)
        for o in options:
            name, _, default = o.rstrip("!").partition("=")
            s.add_argument(name, required=o.endswith("!"), default=default or None)
        if job == "workbook":
            s.add_argument("--year", type=int, required=True)
        if job in ("workbook", "optimize"):
            s.add_argument("--xlsx", action="store_true")
        if job == "lineage":
            s.add_argument("--out")
    a = p.parse_args(argv)
    if a.job == "lineage":
        lineage = Lineage(discover(a.root) or list(JOBS))
        text = {"catalogue.md": lineage.catalogue(), "graph.mmd": lineage.mermaid(), "jobs.txt": dag(lineage, a.root, {})}
        for name, body in text.items():
            if a.out:
                Path(a.out).mkdir(parents=True, exist_ok=True)
                (Path(a.out) / name).write_text(body, encoding="utf-8")
            else:
                print(body, "\n")
        return 0
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    return {"merge": _merge, "names": _names, "workbook": _workbook, "optimize": _optimize}[a.job](a, ship(local_session("*"))) or 0


if __name__ == "__main__":
    raise SystemExit(main())
