"""The driver's correctness gate, run locally: every registered query against
its DuckDB statement on the smallest shared tables."""

import math

import duckdb
import pytest

from conftest import SF_SMALL
from __spark_entry__ import entry, oracle_sql
from jornada.registry import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def norm(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon(df.columns, rows) == _canon(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["Tipo_transaccion", "Nombre", "Cantidad_comprada", "Precio",
                          "Tipo_energia"]
    assert df.count() >= 0


def test_two_scales_in_one_application(spark):
    """entry() at one scale, then the queries at another, in the same session."""
    from jornada import registry as R
    a = R.curated_day(spark, SF_SMALL)[1]
    b = R.curated_day(spark, "/root/testdata/sf0.01")[1]
    assert a.table != b.table
    assert spark.table(a.table).count() > 0
    assert spark.table(b.table).count() == 60_000
