"""Every registered query against its DuckDB twin at sf0.001 (the driver's gate runs sf0.01)."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from workload.tables import TABLES

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "asDict"):
        return tuple(sorted((k, _norm(x)) for k, x in v.asDict().items()))
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["id", "label", "score"]


def test_every_query_has_oracle_or_is_listed():
    # the training-data queries have tests of their own
    rows_only = {q for q in set(QUERIES) - set(ORACLE) if q != "pipeline" and not re.match(r"op\d+_", q)}
    assert rows_only == {"count_estimate", "range_layout", "ann_ivf", "search_indexed_only", "ann_lsh",
                         "quant_scalar", "quant_binary", "quant_pq", "quant_rescore", "snapshot_checksum"}


@pytest.mark.parametrize("name", sorted(q for q in ORACLE if q != "pipeline" and not re.match(r"op\d+_", q)))
def test_query_matches_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, s_rows) == _rows(d_cols, d_rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() >= 0
