"""Mutations: fold = successive calls, checkpointed fold = plain fold, selectors, errors."""

import pytest
from pyspark.sql import functions as F

from pointframe.operators import mutate as U
from pointframe.sources.collection import make_collection
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def emb(spark):
    return make_collection(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"), id="vec_id",
                           vectors={"": ("embedding", 64, "Cosine")})


def _state(coll):
    return sorted((r["vec_id"], r["label"], tuple(r["embedding"]) if r["embedding"] is not None else None)
                  for r in coll.df.collect())


def _ops(emb):
    e = emb.df
    ins = e.filter(F.col("vec_id") % 10 == 1).select((F.col("vec_id") + 100000).alias("vec_id"), "embedding", "label")
    return [
        {"upsert": {"points": ins}},
        {"delete": {"filter": {"must": [{"key": "label", "range": {"gte": 8}}]}}},
        {"set_payload": {"payload": {"label": 42}, "points": [2, 4, 6, 100011]}},
        {"delete_payload": {"keys": ["label"], "points": [0, 1]}},
        {"update_vectors": {"points": e.filter(F.col("vec_id") % 50 == 0)
                            .select("vec_id", F.reverse("embedding").alias("embedding"))}},
        {"delete_vectors": {"vector": [""], "points": [3]}},
        {"clear_payload": {"filter": {"must": [{"key": "label", "match": {"value": 5}}]}}},
        {"overwrite_payload": {"payload": {"label": 7}, "points": [9]}},
    ]


def test_batch_equals_successive_calls(emb):
    ops = _ops(emb)
    folded = U.batch_update(emb, ops, checkpoint_every=0)
    state = emb
    for op in ops:
        state = U.apply_op(state, op)
    assert _state(folded) == _state(state)


def test_checkpointed_fold_equals_plain_fold(spark, emb):
    ops = _ops(emb)
    plain = U.batch_update(emb, ops, checkpoint_every=0)
    ck = U.batch_update(emb, ops, checkpoint_every=2)
    assert _state(ck) == _state(plain)
    # lineage was cut: the final plan starts from a checkpointed scan, not from all 8 operations
    plan = ck.df._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan or "ExistingRDD" in plan


def test_selector_rules(emb):
    with pytest.raises(ValueError):
        U.delete_points(emb)
    with pytest.raises(ValueError):
        U.set_payload(emb, {"label": 1})
    out = U.set_payload(emb, {"label": 77}, ids=[1], filter={"must": [{"key": "label", "match": {"value": 3}}]})
    got = {r["vec_id"] for r in out.df.filter(F.col("label") == 77).collect()}
    want = {r["vec_id"] for r in emb.df.filter((F.col("vec_id") == 1) | (F.col("label") == 3)).collect()}
    assert got == want


def test_upsert_duplicates_need_seq(spark, emb):
    dup = emb.df.filter(F.col("vec_id") < 3).unionByName(emb.df.filter(F.col("vec_id") < 3))
    with pytest.raises(ValueError):
        U.upsert(emb, dup)
    with_seq = dup.withColumn("seq", F.monotonically_increasing_id())
    assert U.upsert(emb, with_seq, seq="seq").df.count() == emb.df.count()


def test_changelog_equals_ordered_fold(spark, emb):
    e = emb.df
    v = F.col("vec_id")
    log = (e.filter(v % 10 == 0).select("vec_id", "embedding", (F.col("label") + 100).alias("label"),
                                         v.alias("seq"), F.lit("upsert").alias("op"))
           .unionByName(e.filter(v % 10 == 5).select("vec_id", F.lit(None).cast("array<float>").alias("embedding"),
                                                     F.lit(None).cast("int").alias("label"), v.alias("seq"),
                                                     F.lit("delete").alias("op")))
           .unionByName(e.filter(v % 10 == 0).select("vec_id", F.lit(None).cast("array<float>").alias("embedding"),
                                                     F.lit(55).alias("label"), (v + 1).alias("seq"),
                                                     F.lit("set_payload").alias("op"))))
    got = U.apply_changelog(emb, log)
    # the same events as an ordered fold of single operations
    state = U.upsert(emb, e.filter(v % 10 == 0).select("vec_id", "embedding", (F.col("label") + 100).alias("label")))
    state = U.delete_points(state, ids=e.filter(v % 10 == 5).select("vec_id"))
    state = U.set_payload(state, {"label": 55}, ids=e.filter(v % 10 == 0).select("vec_id"))
    assert _state(got) == _state(state)


def test_changelog_rejects_unknown_ops(spark, emb):
    log = emb.df.limit(1).select("vec_id", "embedding", "label", F.lit(1).alias("seq"), F.lit("merge").alias("op"))
    with pytest.raises(Exception):
        U.apply_changelog(emb, log).df.collect()


def test_variant_payload_merge(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": "x"}'), (2, '{"a": 2}')], "id long, j string") \
        .selectExpr("id", "parse_json(j) AS payload")
    coll = make_collection(df, id="id")
    out = U.set_payload(coll, {"b": "y", "c": [1, 2]}, ids=[1], variant_payload="payload")
    got = {r["id"]: r["j"] for r in out.df.selectExpr("id", "to_json(payload) AS j").collect()}
    assert got == {1: '{"a":1,"b":"y","c":[1,2]}', 2: '{"a":2}'}
    out = U.delete_payload(coll, ["a"], ids=[2], variant_payload="payload")
    got = {r["id"]: r["j"] for r in out.df.selectExpr("id", "to_json(payload) AS j").collect()}
    assert got == {1: '{"a":1,"b":"x"}', 2: '{}'}


def test_init_from_and_sharded_layout(spark, emb, tmpdir_path):
    import os
    from pointframe.sources.collection import init_from
    from pointframe.sources.profile import read_shard, write_sharded
    sub = init_from(emb, filter={"must": [{"key": "label", "range": {"lt": 3}}]})
    assert sub.df.count() == emb.df.filter(F.col("label") < 3).count()
    path = os.path.join(tmpdir_path, "sharded")
    write_sharded(emb.df, "label", path, rows_per_task=20)
    one = read_shard(spark, path, "label", 2)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(label" in plan  # only the shard's directory is listed
    assert one.count() == emb.df.filter(F.col("label") == 2).count()
