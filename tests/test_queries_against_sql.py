"""Some queries over whole tables of the smallest scale, against their SQL."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: f"{float(v):.5g}" if isinstance(v, float) or type(v).__name__ == "Decimal" else str(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", ["p2_found", "p4_trailing_rounds", "p5_found", "player_kpis", "hist_wide", "schedule_grades", "map_variants", "audit_hint", "merge_deltas", "p4_versions", "merge_files", "kpis_by_map", "audit_cases", "live_box_rows", "live_header_rows", "best_lineup", "lineage_paths", "json_props"])
def test_equals_sql(spark, sql, name):
    df = entry.queries()[name](spark, str(DATA))
    told = sql.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in told.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain(df.collect(), df.columns) == plain(told.fetchall(), columns)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    for n in range(1, 10):
        assert any(q.startswith(f"p{n}_") for q in entry.queries()) or n in (1, 3, 6, 7, 8, 9)


def test_the_core_stands_alone(tmp_path):
    import shutil
    import subprocess
    import sys

    shutil.copytree(Path(entry.__file__).parent / "hoopflow", tmp_path / "hoopflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(entry.__file__, tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'p2_found' in q and 'p1_found' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_pools_of_the_map_are_made_of_distinct_rows(spark, monkeypatch):
    from hoopflow.operators import entity
    from hoopflow.plans import engine_queries

    read, pool = [], entity.raw_spellings
    monkeypatch.setattr(entity, "raw_spellings", lambda b: read.append(b) or pool(b))
    people = engine_queries._people(spark, str(DATA))
    assert engine_queries._entries(spark, str(DATA), people).count() > 0
    assert read[0].count() == people.select(*read[0].columns).distinct().count() < people.count()
