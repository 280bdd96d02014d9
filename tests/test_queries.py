"""Every registered query with SQL against DuckDB on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from compare import rows  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from sparlode import catalog  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_duckdb(spark, sf_dir, duck, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    ours = rows(df.columns, [tuple(r) for r in df.collect()])
    got = duck.execute(catalog.ORACLES[name])
    assert ours == rows([c[0] for c in got.description], got.fetchall())


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns == ["token", "n"] and out.count() == 50
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_sample_is_repeatable(spark, sf_dir):
    one, two = (sorted(r[0] for r in catalog.o_sample(spark, sf_dir).collect()) for _ in range(2))
    assert one == two and one
