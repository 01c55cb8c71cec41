"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01)."""

import contextlib
import io

import duckdb
import pytest

import __spark_entry__ as entry
from metroframe.plans import catalog
from oracle_check import TABLES, rows_of
from type_audit import DUCK_TO_CLASS, SPARK_TO_CLASS

# the library's own queries; those of the optional subpackage have their own tests
QUERIES = {k: fn for k, fn in entry.queries().items() if k in catalog.queries()}
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, sf_small, key):
    sdf = QUERIES[key](spark, sf_small)
    s_rows = [r.asDict(recursive=True) for r in sdf.collect()]
    rel = con.sql(ORACLE[key])
    d_rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(sdf.columns) == sorted(rel.columns)
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in sdf.schema.fields:
        s_t, d_t = f.dataType.simpleString(), d_types[f.name]
        if not (s_t.startswith("decimal") and d_t.startswith("DECIMAL")):
            assert SPARK_TO_CLASS.get(s_t, s_t) == DUCK_TO_CLASS.get(d_t, d_t), (f.name, s_t, d_t)
    assert len(s_rows) == len(d_rows)
    cols = sorted(sdf.columns)
    assert rows_of(s_rows, cols, 6) == rows_of(d_rows, cols, 6)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_whole_tables_no_caps(spark, sf_small, key):
    """No registered query limits or samples its input; a limit appears only
    where it is the feature (the most-recent page)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[key](spark, sf_small).explain()
    plan = buf.getvalue()
    capped = any(word in plan for word in ("GlobalLimit", "LocalLimit", "CollectLimit", "TakeOrderedAndProject",
                                           "Sample"))
    assert capped == (key == "recent_top_k"), plan
