"""Sparse top-k with upper bounds against plain sums; the collection's sparse vectors; options that are refused."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointframe.operators import sparse as SP
from pointframe.operators.sparse_kernel import BLOCK, Postings, pack_text, search_sparse, sparse_topk
from pointframe.plans.query import query, query_batch
from pointframe.sources.collection import make_collection

ROW = "id string, indices array<int>, values array<float>"


def made(rng, n, width, low=0.1):
    rows = []
    for k in range(n):
        idx = sorted(rng.sample(range(width), rng.randrange(0, 12)))
        rows.append((f"p{k:04d}", idx, [float(np.float32(rng.choice([0.0, 1.0, 2.0, rng.uniform(low, 4)]))) for _ in idx]))
    return rows


def brute(rows, queries, k):
    out = set()
    for q in {x[0] for x in queries}:
        w = {}
        for _, i, v in (x for x in queries if x[0] == q):
            w[i] = w.get(i, 0.0) + v
        hits = []
        for p, idx, val in rows:
            shared = [v * w[i] for i, v in zip(idx, val, strict=True) if i in w and v != 0]
            if shared:
                hits.append((-round(sum(shared), 6), p))
        out |= {(q, p, r + 1) for r, (_, p) in enumerate(sorted(hits)[:k])}
    return out


@pytest.mark.parametrize("low,weight", [(0.1, 0.1), (-3.0, 0.1), (0.1, -2.0)])
@pytest.mark.parametrize("blocks", [1, 3])
def test_topk_matches_plain_sums(spark, low, weight, blocks):
    rng = random.Random(f"{low}{weight}")
    rows = made(rng, 1500, 40, low)
    queries = [(q, i, rng.uniform(weight, 2)) for q in range(7) for i in rng.sample(range(45), 5)] + [(7, 44, 1.0), (3, 1, 0.5), (3, 1, 0.5)]
    points = spark.createDataFrame(rows, ROW).repartition(5)
    got = sparse_topk(points, spark.createDataFrame(queries, "query_id long, idx int, qval double"), 4,
                      max_broadcast_bytes=1 << 20 if blocks == 1 else -(-len(queries) * 20 // blocks))
    assert {(r.query_id, r.id, r.rank) for r in got.collect()} == brute(rows, queries, 4)


def test_ties_are_cut_by_id(spark):
    rows = [(f"p{k:04d}", [3], [1.0]) for k in random.Random(1).sample(range(3000), 3000)]
    got = sparse_topk(spark.createDataFrame(rows, ROW).repartition(7), spark.createDataFrame([(0, 3, 2.0)], "query_id long, idx int, qval double"), 5)
    assert [r.id for r in got.orderBy("rank").collect()] == [f"p{k:04d}" for k in range(5)]


def test_blocks_below_the_threshold_are_skipped():
    n = 40 * BLOCK
    val = np.linspace(1, 0.001, n)
    posts = Postings(np.arange(n + 1), np.zeros(n, np.int32), val, np.array([0]))
    w = np.array([1.0])
    assert len(posts.candidates(np.array([0]), w, -np.inf)) == n
    assert len(posts.candidates(np.array([0]), w, 0.99)) == BLOCK
    # an index whose largest value cannot lift the other over the threshold is not essential
    two = Postings(np.arange(n + 1), np.r_[np.zeros(n // 2, np.int32), np.ones(n // 2, np.int32)], np.r_[val[:n // 2], np.full(n // 2, 0.01)], np.array([0, 1]))
    assert two.candidates(np.array([0, 1]), np.array([1.0, 1.0]), 0.95).max() < n // 2


def test_text_is_packed_in_its_row(spark):
    docs = spark.createDataFrame([(1, "a b a c_d É"), (2, ""), (3, None), (4, "..."), (5, "b " * 3000)], "id long, text string")
    want = {r.id: (r.sparse.indices, r.sparse.values) for r in SP.text_to_sparse(docs, "id", "text").collect()}
    packed = pack_text(docs, "id", "text")
    assert {r.id: (r.indices, r["values"]) for r in packed.collect()} == want
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()


def test_no_pair_is_shuffled_before_the_cut(spark):
    points = spark.createDataFrame([(f"p{k}", [k % 5], [1.0]) for k in range(200)], ROW)
    df = sparse_topk(points, spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0)], "query_id long, idx int, qval double"), 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.index("Exchange") < plan.index("MapInArrow")  # the exchange stands above the kernel


@pytest.fixture()
def coll(spark):
    df = spark.createDataFrame([(k, ([k % 3, 5], [1.0, float(k)]) if k % 4 else None, k % 2) for k in range(1, 30)],
                               "id long, words struct<indices: array<int>, values: array<float>>, label int")
    return make_collection(df, id="id", sparse={"words": "words"})


def test_sparse_vectors_of_a_collection(coll):
    q = {"indices": [5, 1], "values": [1.0, 10.0]}
    rows = search_sparse(coll, q, limit=3, offset=1, filter={"must": [{"key": "label", "match": {"value": 1}}]}, with_vector=False).collect()
    score = {k: k + (10.0 if k % 3 == 1 else 0) for k in range(1, 30, 2)}
    want = sorted(score, key=lambda k: (-score[k], k))[1:4]
    assert [(r.id, r.score, r.label) for r in rows] == [(k, score[k], 1) for k in want]
    assert [r.id for r in query(coll, {"query": q, "using": "words", "limit": 3}).collect()] == sorted(
        (k for k in range(1, 30) if k % 4), key=lambda k: (-(k + (10.0 if k % 3 == 1 else 0)), k))[:3]
    with pytest.raises(ValueError):
        query(coll, {"query": q, "using": "other"})


def test_options_are_honoured_or_refused(spark, coll):
    with pytest.raises(ValueError):
        query(coll, {"query": {"sample": "random"}, "lookup_from": {"collection": "x"}}, lookup={"x": coll})
    with pytest.raises(ValueError):
        query(coll, {"query": {"indices": [1], "values": [1.0]}, "lookup_from": {"collection": "x"}}, lookup={"x": coll})
    assert query_batch(coll, []).columns == ["query_id", "id", "score"] and query_batch(coll, []).count() == 0
    from pointframe.operators.search import scroll
    with pytest.raises(ValueError):
        scroll(coll, order_by="label", offset=3)
    assert [r.id for r in scroll(coll, order_by="label", skip=1, limit=1).collect()] == [4]
    postings = spark.createDataFrame([(3, 5, 1.0), (4, 5, 2.0)], "id long, idx int, val double")
    got = query(coll, {"query": {"indices": [5], "values": [1.0]}, "with_payload": ["label"]}, sparse_postings=postings).collect()
    assert {(r.id, r.score, r.label) for r in got} == {(3, 1.0, 1), (4, 2.0, 0)}


def test_a_task_looks_at_few_entries_at_once(monkeypatch):
    """Large batches are taken in pieces: what a task holds does not depend on the rows or lengths of a batch; the hits do not change."""
    import pyarrow as pa

    from pointframe.operators import sparse_kernel as SK
    rng = np.random.default_rng(3)
    rows = [sorted(rng.choice(50, size=rng.integers(0, 30), replace=False).tolist()) for _ in range(2000)]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(np.arange(2000)), "indices": pa.array(rows, pa.list_(pa.int32())),
                                        "values": pa.array([[1.0 + i % 3 for i in r] for r in rows], pa.list_(pa.float32()))}).slice(100)
    queries = SK._Queries(np.array([0, 0, 1]), np.array([3, 7, 40]), np.array([1.0, 0.5, 2.0]))
    whole = [b.to_pydict() for b in SK._task(queries, 5)([batch])]
    seen, make = [], SK.Postings
    monkeypatch.setattr(SK, "Postings", lambda starts, idx, *a: (seen.append(len(idx)), make(starts, idx, *a))[1])
    monkeypatch.setattr(SK, "ENTRIES", 200, raising=False)
    assert [b.to_pydict() for b in SK._task(queries, 5)([batch])] == whole
    assert max(seen) <= 200 and sum(seen) == sum(map(len, rows[100:]))
