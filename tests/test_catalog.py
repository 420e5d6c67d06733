"""Every registered query against its DuckDB oracle (small scale), and entry()."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from lake_helpers import SF_SMALL, plan_text
from playlake.plans import catalog

NAMES = sorted(catalog.queries())  # the training-data queries have tests of their own


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("events",):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_SMALL}/{name}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries()) <= set(entry.queries())


def test_entry_works_without_the_training_data_part(tmp_path):
    """A copy without llm and the pipeline imports, and has the other queries."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(entry.__file__).resolve().parent
    skip = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(root / "playlake", tmp_path / "playlake", ignore=skip)
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.catalog.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert said.stdout.split() == ["True", str(len(catalog.oracle_sql()))]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
    # The executed (final adaptive) plan pairs no rows without a join key.
    plan = plan_text(df, "simple")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["media_id", "plays", "unique_visitors", "avg_watched_percent", "title", "channel"]


def test_pruned_source_is_read_by_day(spark):
    """The days before the least mark are not read for the pull, and only the null day for the rejects."""
    plan = plan_text(catalog.queries()["incremental_pruned"](spark, SF_SMALL))
    assert plan.count("PartitionFilters: [isnotnull(day") == 1 and plan.count("PartitionFilters: [isnull(day") == 1
