"""Counts estimated from stored sketches: near the exact ones, without reading the collection."""

import pytest

from pointframe.operators.search import count
from pointframe.operators.sketches import build_count_sketches, estimate_count
from pointframe.sources.collection import make_collection


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    df = spark.range(20000).selectExpr("id", "if(id % 10 = 0, null, cast(id % 7 as int)) as a", "id % 2 = 0 as b",
                                       "if(id % 3 = 0, array('x', 'x', 'y'), array(concat('t', id % 5))) as tags")
    coll, path = make_collection(df, id="id"), str(tmp_path_factory.mktemp("sketches") / "s")
    build_count_sketches(coll, ["a", "b", "tags"], path)
    return coll, path


@pytest.mark.parametrize("filter", [
    None, {"must": [{"key": "a", "match": {"value": 3}}]}, {"must": [{"key": "a", "match": {"any": [1, 2, 99]}}]},
    {"should": [{"key": "a", "match": {"value": 3}}, {"key": "tags", "match": {"value": "x"}}]},
    {"must": [{"key": "b", "match": {"value": True}}, {"key": "tags", "match": {"any": ["y", "t1"]}}]},
    {"must": [{"key": "b", "match": {"value": False}}], "should": [{"key": "a", "match": {"value": 5}}, {"key": "a", "match": {"value": 6}}]},
    {"must": [{"key": "a", "match": {"value": 99}}]}])
def test_estimates_are_near(stored, filter):
    coll, path = stored
    spark = coll.df.sparkSession
    est = estimate_count(spark, path, filter)
    assert abs(est.first()[0] - count(coll, filter).first()[0]) <= 600  # 3 % of the largest set that is merged
    assert all(path in f for f in est.inputFiles())  # the collection is not in the plan


def test_what_sketches_cannot_answer(stored):
    coll, path = stored
    spark = coll.df.sparkSession
    one = {"key": "a", "match": {"value": 1}}
    for bad in ({"must_not": [one]}, {"must": [{"key": "a", "range": {"gt": 1}}]}, {"must": [one] * 5}, {"must": [{"key": "a", "match": {"except": [1]}}]}):
        with pytest.raises(ValueError):
            estimate_count(spark, path, bad)
    with pytest.raises(ValueError):
        build_count_sketches(coll, ["zz"], path)
