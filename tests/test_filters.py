"""Filters: property-based trees against a row-wise Python oracle, plus edge cases."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from pointframe.functions.filters import FilterError, build_filter

ROWS = [
    # id, label (nullable int), tags (array<int>, maybe empty/null), name, score, items (array<struct>)
    (1, 3, [3, 4], "alpha", 0.5, [{"q": 10, "f": "R"}, {"q": 50, "f": "A"}]),
    (2, None, [], "beta", -1.0, []),
    (3, 7, None, None, 2.5, None),
    (4, 0, [0, 1], "gamma", 10.0, [{"q": 47, "f": "R"}]),
    (5, 7, [7, 8], "alpha", None, [{"q": 1, "f": None}]),
    (6, 2, [2, 3], "delta", 3.25, [{"q": 45, "f": "N"}, {"q": 46, "f": "R"}]),
]
SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("label", T.IntegerType()),
    T.StructField("tags", T.ArrayType(T.IntegerType())), T.StructField("name", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("items", T.ArrayType(T.StructType([T.StructField("q", T.IntegerType()),
                                                     T.StructField("f", T.StringType())]))),
])
COLS = {"id": 0, "label": 1, "tags": 2, "name": 3, "score": 4, "items": 5}


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


# ---------------------------------------------------------------- Python oracle

def _values(row, key):
    v = row[COLS[key]]
    if v is None:
        return []
    return v if isinstance(v, list) else [v]


def _cond_scalar(x, kind, arg):
    if x is None:
        return False
    if kind == "match":
        if "value" in arg:
            return type(x) is type(arg["value"]) and x == arg["value"]
        if "any" in arg:
            return x in arg["any"]
        return x not in arg["except"]
    if kind == "range":
        return all([(arg.get("lt") is None or x < arg["lt"]), (arg.get("lte") is None or x <= arg["lte"]),
                    (arg.get("gt") is None or x > arg["gt"]), (arg.get("gte") is None or x >= arg["gte"])])
    raise AssertionError(kind)


def py_condition(row, c):
    if set(c) & {"must", "must_not", "should", "min_should"}:
        return py_filter(row, c)
    if "has_id" in c:
        return row[0] in c["has_id"]
    if "is_empty" in c:
        return len(_values(row, c["is_empty"]["key"])) == 0
    if "is_null" in c:
        return row[COLS[c["is_null"]["key"]]] is None
    if "nested" in c:
        items = row[COLS[c["nested"]["key"]]] or []
        return any(py_filter(it, c["nested"]["filter"], nested=True) for it in items)
    kind = next(k for k in c if k != "key")
    if kind == "values_count":
        n = len(_values(row, c["key"]))
        return _cond_scalar(n, "range", c[kind])
    return any(_cond_scalar(x, kind, c[kind]) for x in _values(row, c["key"]))


def py_filter(row, f, nested=False):
    if nested:
        # rows of a nested filter are dicts of the element struct
        def cond(c):
            kind = next(k for k in c if k != "key")
            return _cond_scalar(row[c["key"]], kind, c[kind])
    else:
        def cond(c):
            return py_condition(row, c)
    ok = True
    if "must" in f:
        ok &= all(cond(c) for c in f["must"])
    if "must_not" in f:
        ok &= not any(cond(c) for c in f["must_not"])
    if "should" in f and f["should"]:
        ok &= any(cond(c) for c in f["should"])
    if "min_should" in f:
        ok &= sum(cond(c) for c in f["min_should"]["conditions"]) >= f["min_should"]["min_count"]
    return ok


# ---------------------------------------------------------------- strategies

ints = st.integers(min_value=-1, max_value=9)
leaf = st.one_of(
    st.builds(lambda v: {"key": "label", "match": {"value": v}}, ints),
    st.builds(lambda v: {"key": "tags", "match": {"value": v}}, ints),
    st.builds(lambda vs: {"key": "label", "match": {"any": vs}}, st.lists(ints, min_size=1, max_size=3)),
    st.builds(lambda vs: {"key": "tags", "match": {"except": vs}}, st.lists(ints, min_size=1, max_size=3)),
    st.builds(lambda v: {"key": "name", "match": {"value": v}}, st.sampled_from(["alpha", "beta", "zeta"])),
    st.builds(lambda a, b: {"key": "score", "range": {"gte": min(a, b), "lt": max(a, b)}},
              st.floats(-2, 11, allow_nan=False), st.floats(-2, 11, allow_nan=False)),
    st.builds(lambda a: {"key": "label", "range": {"gt": a}}, ints),
    st.builds(lambda a: {"key": "tags", "values_count": {"gte": a}}, st.integers(0, 3)),
    st.just({"is_empty": {"key": "tags"}}),
    st.just({"is_null": {"key": "label"}}),
    st.just({"is_null": {"key": "name"}}),
    st.builds(lambda ids: {"has_id": ids}, st.lists(st.integers(1, 7), min_size=1, max_size=3)),
    st.builds(lambda q: {"nested": {"key": "items", "filter": {"must": [{"key": "q", "range": {"gte": q}},
                                                                       {"key": "f", "match": {"value": "R"}}]}}},
              st.integers(0, 60)),
)


def trees(depth):
    if depth == 0:
        return leaf
    sub = st.one_of(leaf, trees(depth - 1))
    return st.one_of(
        st.builds(lambda a: {"must": a}, st.lists(sub, min_size=1, max_size=3)),
        st.builds(lambda a: {"must_not": a}, st.lists(sub, min_size=1, max_size=2)),
        st.builds(lambda a: {"should": a}, st.lists(sub, min_size=0, max_size=3)),
        st.builds(lambda a, n: {"min_should": {"conditions": a, "min_count": n}},
                  st.lists(sub, min_size=1, max_size=3), st.integers(0, 3)),
        st.builds(lambda a, b: {"must": a, "must_not": b}, st.lists(sub, min_size=1, max_size=2),
                  st.lists(sub, min_size=1, max_size=2)),
    )


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(f=trees(2))
def test_random_filter_trees_match_python(df, f):
    got = sorted(r[0] for r in df.filter(build_filter(f, SCHEMA)).select("id").collect())
    want = sorted(r[0] for r in ROWS if py_filter(r, f))
    assert got == want, f


def test_unknown_keys_raise(df):
    with pytest.raises(FilterError):
        build_filter({"must": [{"key": "nope", "match": {"value": 1}}]}, SCHEMA)
    with pytest.raises(FilterError):
        build_filter({"must": [], "min_shoud": {}}, SCHEMA)
    with pytest.raises(FilterError):
        build_filter({"must": [{"key": "label", "match": {"value": 1}, "range": {"gt": 1}}]}, SCHEMA)


def test_must_not_keeps_missing(df):
    got = {r[0] for r in df.filter(build_filter({"must_not": [{"key": "label", "match": {"value": 7}}]},
                                                SCHEMA)).collect()}
    assert 2 in got  # label NULL is kept
    assert 3 not in got and 5 not in got


def test_type_strict_match(df):
    # a string never equals an integer field
    assert df.filter(build_filter({"must": [{"key": "label", "match": {"value": "3"}}]}, SCHEMA)).count() == 0


def test_filter_pushdown_reaches_scan(spark):
    from tests.conftest import SF_SMALL
    e = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    f = {"must": [{"key": "c_acctbal", "range": {"gt": 100}},
                  {"key": "c_mktsegment", "match": {"value": "BUILDING"}}]}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = e.filter(build_filter(f, e.schema, "c_custkey"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(c_acctbal,100" in plan and "EqualTo(c_mktsegment,BUILDING)" in plan


def test_variant_paths(spark):
    rows = [(1, '{"a": 5, "tags": ["x", "y"], "o": null}'), (2, '{"a": "5", "tags": []}'), (3, '{"b": 1}')]
    d = spark.createDataFrame(rows, "id long, j string").selectExpr("id", "parse_json(j) AS payload")
    sch = d.schema

    def ids(f):
        return sorted(r[0] for r in d.filter(build_filter(f, sch, "id", variant_payload="payload")).collect())
    assert ids({"must": [{"key": "a", "match": {"value": 5}}]}) == [1]          # kind-strict
    assert ids({"must": [{"key": "a", "match": {"value": "5"}}]}) == [2]
    assert ids({"must": [{"key": "tags", "match": {"value": "y"}}]}) == [1]     # any element
    assert ids({"must": [{"is_empty": {"key": "tags"}}]}) == [2, 3]            # [] and missing
    assert ids({"must": [{"is_null": {"key": "o"}}]}) == [1]                   # JSON null only
    assert ids({"must": [{"key": "tags", "values_count": {"gte": 2}}]}) == [1]


@pytest.mark.parametrize("center,radius", [({"lat": 10.0, "lon": 20.0}, 2500000.0),
                                           ({"lat": 60.0, "lon": 178.0}, 900000.0),
                                           ({"lat": -5.0, "lon": -179.5}, 3000000.0),
                                           ({"lat": 88.0, "lon": 0.0}, 500000.0)])
def test_geo_cells_radius_equals_plain_filter(spark, center, radius):
    from pointframe.operators import indexes as IX
    from workload import tables as W
    from tests.conftest import SF_CHECK
    cust = W.customers_geo(spark, SF_CHECK)
    idx = IX.geo_cell_index(cust, "c_custkey", "loc", 5.0)
    got = sorted(r[0] for r in IX.geo_radius_by_cells(idx, center, radius, 5.0).collect())
    f = {"must": [{"key": "loc", "geo_radius": {"center": center, "radius": radius}}]}
    want = sorted(r[0] for r in cust.filter(build_filter(f, cust.schema, "c_custkey")).select("c_custkey").collect())
    assert got == want and len(want) > 0
