"""Streaming replay, stream search, snapshot round trip and tamper detection."""

import os

import pytest
from pyspark.sql import functions as F

from pointframe.sources import snapshot as SN
from pointframe.sources.collection import make_collection
from pointframe.streaming import ops as STR
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def emb(spark):
    return make_collection(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"), id="vec_id",
                           vectors={"": ("embedding", 64, "Cosine")})


def test_upsert_epoch_replay_is_noop(spark, emb, tmpdir_path):
    target = os.path.join(tmpdir_path, "table")
    fn = STR.upsert_batch_fn(emb, target, buckets=16)
    b0 = emb.df.filter(F.col("vec_id") < 5).withColumn("label", F.lit(100))
    b1 = emb.df.filter(F.col("vec_id") >= 495).withColumn("label", F.lit(200))
    fn(b0, 0)
    fn(b1, 1)
    fn(b1, 1)  # redelivered batch after a restart
    state = STR.read_state(spark, target)
    assert spark.read.parquet(f"{target}/_epochs").count() == 2
    assert state.count() == emb.df.count()
    assert state.filter(F.col("label") == 100).count() == 5
    assert state.filter(F.col("label") == 200).count() == 5
    # a crash after the overwrite but before the epoch log: the replay converges
    fn2 = STR.upsert_batch_fn(emb, target, buckets=16)
    b2 = emb.df.filter(F.col("vec_id") == 7).withColumn("label", F.lit(300))
    fn2(b2, 2)
    spark.read.parquet(f"{target}/_epochs").filter(F.col("epoch") < 2) \
        .write.mode("overwrite").parquet(f"{target}/_epochs_tmp")
    spark.read.parquet(f"{target}/_epochs_tmp").write.mode("overwrite").parquet(f"{target}/_epochs")
    fn2(b2, 2)
    again = STR.read_state(spark, target)
    assert again.count() == emb.df.count()
    assert again.filter(F.col("label") == 300).count() == 1


def test_upsert_touches_only_changed_buckets(spark, emb, tmpdir_path):
    import glob
    target = os.path.join(tmpdir_path, "t2")
    fn = STR.upsert_batch_fn(emb, target, buckets=16)
    fn(emb.df.limit(0), 0)
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{target}/state/_bucket=*/*.parquet")}
    fn(emb.df.filter(F.col("vec_id") == 3).withColumn("label", F.lit(9)), 1)
    after = {p: os.path.getmtime(p) for p in glob.glob(f"{target}/state/_bucket=*/*.parquet")}
    changed_dirs = {os.path.dirname(p) for p in set(after) ^ set(before)}
    assert len(changed_dirs) == 1  # only the bucket of id 3 was rewritten


def test_stream_search_appends_topk(spark, emb, tmpdir_path):
    schema = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").schema
    src = spark.readStream.schema(schema).parquet(f"{SF_SMALL}/embeddings*.parquet") \
        .filter(F.col("vec_id") < 3).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    sink = os.path.join(tmpdir_path, "hits")
    q = STR.stream_search(src, emb, sink, k=4, checkpoint_location=os.path.join(tmpdir_path, "ck"))
    q.processAllAvailable()
    q.stop()
    out = spark.read.parquet(sink)
    assert out.count() == 12
    assert {r["query_id"] for r in out.filter(F.col("rank") == 1).collect()} == {0, 1, 2}
    assert all(r["id"] == r["query_id"] for r in out.filter(F.col("rank") == 1).collect())


def test_stream_stats_append_mode_emits_closed_windows(spark, tmpdir_path):
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    src = spark.readStream.schema(schema).parquet(f"{SF_SMALL}/events*.parquet")
    sink = os.path.join(tmpdir_path, "stats")
    q = STR.stream_response_stats(src, "ts", "event_type", "value", sink, window="1 day", watermark="1 hour",
                                  checkpoint_location=os.path.join(tmpdir_path, "ck2"))
    q.processAllAvailable()
    q.stop()
    out = spark.read.parquet(sink)
    # append mode: only windows closed by the watermark, each exactly once
    assert out.count() > 0
    assert out.groupBy("window_start", "endpoint").count().filter(F.col("count") > 1).count() == 0


def test_snapshot_round_trip_and_tamper(spark, emb, tmpdir_path):
    path = os.path.join(tmpdir_path, "snap")
    m = SN.snapshot_write(emb.df, path, "emb").first()
    assert m["n_rows"] == emb.df.count() and m["size"] > 0
    back = SN.snapshot_restore(spark, path)
    assert SN.table_checksum(back).first()["checksum"] == m["checksum"]
    # checksum is order free
    assert SN.table_checksum(emb.df.repartition(5).orderBy(F.rand(1))).first()["checksum"] == m["checksum"]
    # tamper: replace the data with a modified copy
    bad = os.path.join(tmpdir_path, "snap_bad")
    emb.df.withColumn("label", F.col("label") + F.when(F.col("vec_id") == 3, 1).otherwise(0)) \
        .write.parquet(f"{bad}/data")
    spark.read.parquet(f"{path}/manifest").write.parquet(f"{bad}/manifest")
    with pytest.raises(ValueError):
        SN.snapshot_restore(spark, bad)


def test_full_snapshot_manifest(spark, tmpdir_path):
    tables = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("region", "nation")}
    m = SN.full_snapshot(tables, os.path.join(tmpdir_path, "full"))
    assert sorted((r["name"], r["n_rows"]) for r in m.collect()) == [("nation", 25), ("region", 5)]


def test_stream_search_replay_does_not_duplicate(spark, emb, tmpdir_path):
    sink = os.path.join(tmpdir_path, "hits2")
    fn = STR.search_batch_fn(emb, sink, k=3)
    q0 = emb.df.filter(F.col("vec_id") < 2).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    q1 = emb.df.filter(F.col("vec_id") == 9).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    fn(q0, 0)
    fn(q1, 1)
    fn(q0, 0)  # redelivered
    out = spark.read.parquet(sink)
    assert out.count() == 9
    assert out.filter(F.col("epoch") == 1).count() == 3


def test_encoding_tells_moved_values_apart(spark):
    def sums(rows, ddl):
        return [SN.table_checksum(spark.createDataFrame([r], ddl)).first()["checksum"] for r in rows]

    assert len(set(sums([(1, None), (None, 1), (None, None), (1, 1)], "a int, b int"))) == 4
    assert len(set(sums([([1, 2], [3]), ([1], [2, 3]), ([], [1, 2, 3]), ([1, None], [3]), (None, [3])], "a array<int>, b array<int>"))) == 5
    assert len(set(sums([(("x", "yz"), "w"), (("xy", "z"), "w"), (None, "w"), ((None, None), "w")], "s struct<p: string, q: string>, t string"))) == 4
    assert len(set(sums([({"a": 1, "b": 2},), ({"a": 2, "b": 1},), ({"b": 2, "a": 1},)], "m map<string, int>"))) == 2
    one, two = (SN.table_checksum(spark.createDataFrame([(1, 2)], ddl)).first()["checksum"] for ddl in ("a int, b int", "b int, a int"))
    assert one != two


def test_restore_names_the_damaged_buckets(spark, tmpdir_path):
    import hashlib
    path = os.path.join(tmpdir_path, "s")
    df = spark.range(500).selectExpr("id", "id % 7 as a", "if(id % 3 = 0, null, id) as b")
    m = SN.snapshot_write(df, path, "t", id="id").first()
    assert m["id_column"] == "id" and len(m["root"]) == 64 and SN.damaged_buckets(spark, path).count() == 0
    moved = df.selectExpr("id", "if(id = 33, null, a) as a", "if(id = 33, a, b) as b")  # a value moves to another column
    bad = SN.damaged_buckets(spark, path, moved).collect()
    assert [(r.bucket, r.n_rows == r.found_rows) for r in bad] == [(int(hashlib.md5(b"33").hexdigest()[:2], 16), True)]
    moved.write.mode("overwrite").parquet(f"{path}/data")
    with pytest.raises(ValueError, match=rf"damaged buckets \[{bad[0].bucket}\]"):
        SN.snapshot_restore(spark, path)
    tree = spark.read.parquet(f"{path}/tree").groupBy("level").count().collect()
    assert {r.level: r["count"] for r in tree} == {0: 256, 1: 16, 2: 1}
