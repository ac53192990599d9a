"""Batch k-NN kernel: equal to the expression path, tie-safe, partition-invariant."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pointframe.operators import kernel
from pointframe.operators.batch import knn_join, search_batch
from pointframe.operators.search import search
from pointframe.sources.collection import make_collection
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def emb(spark):
    return make_collection(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"), id="vec_id",
                           vectors={"": ("embedding", 64, "Cosine")})


def _rows(df):
    return sorted((r["query_id"], r["id"], r["score"], r["rank"]) for r in df.collect())


@pytest.mark.parametrize("distance", ["Cosine", "Dot", "Euclid", "Manhattan"])
def test_kernel_equals_expression_path(spark, emb, distance):
    coll = make_collection(emb.df, id="vec_id", vectors={"": ("embedding", 64, distance)})
    qids = [3, 17, 250]
    queries = coll.df.filter(F.col("vec_id").isin(qids)).select(F.col("vec_id").alias("query_id"),
                                                                F.col("embedding").alias("vector"))
    got = knn_join(coll, queries, k=7)
    vecs = {r["vec_id"]: list(r["embedding"]) for r in queries.withColumnRenamed("query_id", "vec_id")
            .withColumnRenamed("vector", "embedding").collect()}
    want = []
    for q in qids:
        rows = search(coll, vecs[q], limit=7, with_payload=False).collect()
        want += [(q, r["id"], r["score"], i + 1) for i, r in enumerate(rows)]
    assert _rows(got) == sorted(want)


def test_one_block_and_many_blocks_agree(emb):
    q = emb.df.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    a = knn_join(emb, q, k=5)
    b = knn_join(emb, q, k=5, max_broadcast_bytes=100 * 8 * 64)
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and all("/found/" in f for f in b.inputFiles())  # each block has run, its candidates are written
    assert _rows(a) == _rows(b)


def test_ties_are_cut_by_id(spark):
    # 40 points with only 3 distinct directions: massive ties at every rank
    rows = [(i, [1.0, 0.0] if i % 3 == 0 else ([0.0, 1.0] if i % 3 == 1 else [1.0, 1.0])) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    coll = make_collection(df, id="id", vectors={"": ("v", 2, "Cosine")})
    q = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "query_id long, vector array<double>")
    for layout in (coll.df.repartition(7), coll.df.coalesce(1), coll.df.repartition(3, "id")):
        got = knn_join(coll.with_df(layout), q, k=5)
        res = _rows(got)
        assert [r[1] for r in res if r[0] == 0] == [0, 3, 6, 9, 12]
        assert [r[1] for r in res if r[0] == 1] == [1, 4, 7, 10, 13]


def test_k_larger_than_n_and_zero_and_null_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    coll = make_collection(df, id="id", vectors={"": ("v", 2, "Cosine")})
    q = spark.createDataFrame([(9, [1.0, 0.0])], "query_id long, vector array<double>")
    got = _rows(knn_join(coll, q, k=10))
    assert [r[1] for r in got] == [1, 4]  # zero vector has no cosine, null vector is skipped


def test_per_request_filters_and_limits(emb):
    v = [float(x) for x in np.sin(np.arange(64))]
    reqs = [{"vector": v, "limit": 4, "filter": {"must": [{"key": "label", "match": {"value": 2}}]}},
            {"vector": v, "limit": 2}]
    got = sorted(_rows(search_batch(emb, reqs)), key=lambda r: (r[0], r[3]))
    single0 = search(emb, v, limit=4, filter=reqs[0]["filter"]).collect()
    single1 = search(emb, v, limit=2).collect()
    assert [r[1] for r in got if r[0] == 0] == [r["id"] for r in single0]
    assert [r[1] for r in got if r[0] == 1] == [r["id"] for r in single1]


def test_topk_select_cuts_ties_by_id():
    q = np.zeros(6, dtype=np.int64)
    ids = np.array([5, 4, 3, 2, 1, 0])
    score = np.array([0.9, 0.9, 0.9, 0.5, 0.8, 0.1])
    keep = kernel._select(q, ids, score, np.array([2]), True)
    kept = set(ids[keep].tolist())
    assert kept == {3, 4}


def test_filters_work_with_many_blocks(spark, emb):
    reqs = [{"vector": [float((i * j) % 7 - 3) for j in range(64)], "limit": 4,
             **({"filter": {"must": [{"key": "label", "match": {"value": i % 3}}]}} if i % 2 else {})} for i in range(12)]
    from pointframe.operators.batch import search_batch
    assert _rows(search_batch(emb, reqs)) == _rows(search_batch(emb, reqs, max_broadcast_bytes=3 * 8 * 64))


@pytest.mark.parametrize("dim", [255, 256])
def test_string_ids_and_order_do_not_depend_on_the_dimension(spark, dim):
    rng = np.random.default_rng(0)
    rows = [(f"id-{i:03d}", [float(x) for x in rng.normal(size=dim)]) for i in range(60)]
    coll = make_collection(spark.createDataFrame(rows, "id string, v array<float>"), id="id", vectors={"": ("v", dim, "Euclid")})
    v = rows[7][1]
    got = [tuple(r) for r in search(coll, v, limit=9, offset=1, with_payload=False).collect()]
    want = [tuple(r) for r in search(coll, v, limit=9, offset=1, with_payload=False, engine="expression").collect()]
    assert got == want and len(got) == 9 and got[0][0] != "id-007"


def test_euclid_of_large_near_vectors_is_exact(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=256) * 1e4
    rows = [(i, [float(x) for x in base + np.eye(256)[i % 256] * 0.01 * (i + 1)]) for i in range(40)]
    coll = make_collection(spark.createDataFrame(rows, "id long, v array<double>"), id="id", vectors={"": ("v", 256, "Euclid")})
    v = [float(x) for x in base]
    got = [tuple(r) for r in search(coll, v, limit=10, with_payload=False, engine="kernel").collect()]
    assert got == [tuple(r) for r in search(coll, v, limit=10, with_payload=False, engine="expression").collect()]


def test_ties_leave_k_candidates_per_task(spark):
    df = spark.range(20000).select(F.col("id"), F.array(F.lit(1.0), F.lit(2.0)).alias("v")).repartition(3)
    q = pa.table({"query_id": pa.array([0]), "qvec": pa.array([[1.0, 2.0]]), "_k": pa.array([10], pa.int32()),
                  "_mask": pa.array([None], pa.int32()), "_excl": pa.array([None], pa.int64())})
    part, _ = kernel._block_candidates(df.select("id", F.col("v").alias("pvec")), q, "Cosine", 0, "long")
    tasks = part.rdd.getNumPartitions()
    assert part.count() <= tasks * 10


def test_rounding_is_sparks(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=3000), np.round(rng.normal(size=3000), 6) + 5e-7, [0.0, -0.0000005, 0.0000005, 1e9 + 0.1234565, 123456.7890125, 2.5e-7]])
    want = [r[0] for r in spark.createDataFrame([(float(v),) for v in x], "x double").select(F.round("x", 6)).collect()]
    assert kernel.round_half_up(x).tolist() == want


@pytest.mark.parametrize("name", ["search", "query_groups", "recommend_best_score", "discover", "sparse_search",
                                  "fusion_rrf", "matrix_pairs", "apply_changelog"])
def test_results_invariant_to_input_partitioning(spark, name):
    # metamorphic: the registered query over a reshuffled input gives the same rows
    import __spark_entry__ as entry
    from workload import tables as W
    q = entry.queries()[name]
    base = sorted(tuple(r) for r in q(spark, SF_SMALL).collect())
    real_load = W.load
    try:
        W.load = lambda s, d, t: real_load(s, d, t).repartition(5).orderBy(F.rand(7))
        shuffled = sorted(tuple(r) for r in q(spark, SF_SMALL).collect())
    finally:
        W.load = real_load
    assert shuffled == base


@pytest.mark.parametrize("distance", ["Cosine", "Dot", "Euclid", "Manhattan"])
def test_search_engines_agree(spark, emb, distance):
    coll = make_collection(emb.df, id="vec_id", vectors={"": ("embedding", 64, distance)})
    v = [float(x) for x in np.cos(np.arange(64) * 0.37)]
    thr = {"Cosine": 0.05, "Dot": 0.1, "Euclid": 1.45, "Manhattan": 9.5}[distance]
    cases = [dict(limit=7), dict(limit=5, offset=3), dict(limit=50, score_threshold=thr),
             dict(limit=6, filter={"must": [{"key": "label", "match": {"any": [1, 4]}}]}),
             dict(limit=3, with_vector=True, with_payload=False)]
    for kw in cases:
        a = search(coll, v, engine="expression", **kw)
        b = search(coll, v, engine="kernel", **kw)
        assert a.columns == b.columns, kw

        def rows(df):
            return sorted(tuple(tuple(x) if isinstance(x, list) else x for x in r) for r in df.collect())
        assert rows(a) == rows(b), (distance, kw)


def test_query_by_id_and_recommend_engines_agree(spark, emb):
    from pointframe.operators.recommend import recommend
    from pointframe.operators.search import query_by_id

    def rows(df):
        return sorted(tuple(r) for r in df.collect())
    for kw in (dict(limit=6), dict(limit=4, offset=2, filter={"must": [{"key": "label", "range": {"gte": 3}}]})):
        assert rows(query_by_id(emb, 7, engine="expression", **kw)) == rows(query_by_id(emb, 7, engine="kernel", **kw))
        a = recommend(emb, [7, 42, 99], [3, 250], limit=kw["limit"], offset=kw.get("offset", 0),
                      filter=kw.get("filter"), engine="expression")
        b = recommend(emb, [7, 42, 99], [3, 250], limit=kw["limit"], offset=kw.get("offset", 0),
                      filter=kw.get("filter"), engine="kernel")
        assert rows(a) == rows(b)
    assert query_by_id(emb, 10 ** 9, engine="kernel").count() == 0


def test_spread_never_runs_jobs_to_count_partitions(spark):
    # asking an adaptive plan with an exchange for its partitions would execute the
    # upstream stages; spread inspects plain scans only
    from pointframe.plans.partitioning import spread
    sc = spark.sparkContext
    shuffled = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").groupBy("l_orderkey").count()
    scan = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    sc.setJobGroup("pf_spread_check", "spread")
    try:
        assert spread(shuffled) is shuffled
        spread(scan)
        assert sc.statusTracker().getJobIdsForGroup("pf_spread_check") == []
    finally:
        sc.setJobGroup("", "")


@pytest.mark.parametrize("size", [1 << 28, 8 * 64])
def test_null_query_vectors_have_no_neighbours(spark, emb, size):
    q = spark.createDataFrame([(1, None), (2, [0.1] * 64)], "query_id long, vector array<double>")
    got = _rows(knn_join(emb, q, k=3, max_broadcast_bytes=size))
    assert {r[0] for r in got} == {2} and len(got) == 3


@pytest.mark.parametrize("size", [1 << 28, 8 * 64])
def test_wrong_dimension_points_are_skipped_like_the_expression_path(spark, size):
    rows = [(1, [1.0, 0.0]), (2, [1.0]), (3, [0.6, 0.8]), (4, [1.0, 0.0, 5.0]), (5, None)]
    coll = make_collection(spark.createDataFrame(rows, "id long, v array<float>"), id="id",
                           vectors={"": ("v", None, "Cosine")})
    q = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, vector array<double>")
    got = [r[1] for r in sorted(_rows(knn_join(coll, q, k=5, max_broadcast_bytes=size)), key=lambda r: r[3])]
    want = [r["id"] for r in search(coll, [1.0, 0.0], limit=5, with_payload=False, engine="expression").collect()]
    assert got == want == [1, 3]


@pytest.mark.parametrize("distance", ["Cosine", "Euclid"])
def test_grouped_search_engines_agree(spark, emb, distance):
    from pointframe.operators.groups import query_groups
    coll = make_collection(emb.df, id="vec_id", vectors={"": ("embedding", 64, distance)})
    v = [float(x) for x in np.sin(np.arange(64) * 0.21)]

    def rows(engine):
        return sorted(tuple(r) for r in query_groups(coll, v, group_by="label", group_size=3, limit=4,
                                                     engine=engine).collect())
    assert rows("kernel") == rows("expression")


def test_query_blocks_are_broadcast_in_turn(spark, emb, monkeypatch):
    """Queries are evaluated once, and no block is alive when the next is made."""
    from pyspark.core.broadcast import Broadcast

    from pointframe.operators import kernel
    alive, most, made = set(), [0], []
    make, destroy = kernel._block_candidates, Broadcast.destroy

    def counted(*a):
        out = make(*a)
        alive.add(id(out[1]))
        made.append(out[1])
        most[0] = max(most[0], len(alive))
        return out

    monkeypatch.setattr(kernel, "_block_candidates", counted)
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: (alive.discard(id(self)), destroy(self, *a))[1])
    q = emb.df.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")).limit(100)
    blocked = _rows(knn_join(emb, q, k=4, max_broadcast_bytes=30 * 8 * 64))
    assert len(made) >= 4 and most[0] == 1 and not alive
    monkeypatch.undo()
    assert blocked == _rows(knn_join(emb, q, k=4))


@pytest.mark.parametrize("distance", ["Cosine", "Euclid", "Manhattan"])
def test_many_blocks_meet_in_cells(spark, monkeypatch, distance):
    """More blocks than are broadcast in turn: cells of points and queries, filters, limits and left-out points included."""
    rng = np.random.default_rng(4)
    vecs = rng.normal(size=(90, 6)).round(1)
    rows = [(f"p{i % 80:02d}", None if i == 7 else [float(x) for x in vecs[i % 70]], i % 3 == 0) for i in range(90)]
    points = spark.createDataFrame(rows, "id string, v array<float>, odd boolean").repartition(3)
    queries = spark.createDataFrame([(i % 40, [float(x) for x in vecs[i]], 1 + i % 4, 0 if i % 2 else None, f"p{i:02d}") for i in range(45)] + [(None, [0.5] * 6, 2, None, None)],
                                    "query_id int, vector array<double>, lim int, f int, self string")
    monkeypatch.setattr(kernel, "_in_turn", lambda *a: pytest.fail("broadcast"))
    call = lambda size: kernel.knn(points, "id", "v", queries, k="lim", distance=distance, point_mask_cols=["odd"], query_mask_col="f",
                                   exclude_col="self", dim=6, max_broadcast_bytes=size)
    want = call(1 << 20)
    monkeypatch.setattr(kernel, "CELL_ROWS", 20)
    got = call(2 * 8 * 6)
    assert got.schema == want.schema
    key = lambda rows: sorted(map(str, map(tuple, rows)))
    assert key(got.collect()) == key(want.collect()) and want.count() > 60


def test_euclid_by_bounds_is_the_plain_cut():
    rng = np.random.default_rng(5)
    for scale in (1e-3, 1.0, 1e5):
        Q = rng.normal(size=(30, 8)) * scale
        P = np.vstack([Q, Q + 1e-7 * scale, Q[:5].round(3), rng.normal(size=(900, 8)) * scale])
        P[3], P[4], P[5] = np.nan, np.inf, 1e200
        ids = rng.permutation(len(P)).astype(np.int64)
        fast, plain = (kernel.TopK(np.full(30, 6), False) for _ in range(2))
        with np.errstate(all="ignore"):
            for a in range(0, len(P), 200):
                part = P[a:a + 200]
                fast.add_euclid(Q, part, np.arange(30), ids[a:a + 200], (Q * Q).sum(1), (part * part).sum(1))
                plain.add_scores(kernel.score_matrix(Q, part, "Euclid"), np.arange(30), ids[a:a + 200])
                fast.compact()
        assert [x.tolist() for x in fast.result()] == [x.tolist() for x in plain.result()]


def test_a_task_scores_little_at_once():
    n = 20_000
    ids = np.arange(n)
    batch = pa.RecordBatch.from_pydict({"id": ids, "pvec": pa.array([[float(i % 7), 1.0] for i in range(n)], pa.list_(pa.float32()))})
    m = {"qid": pa.array(np.arange(600)), "k": np.full(600, 3), "mask": np.full(600, -1), "excl": [None] * 600}
    import tracemalloc
    tracemalloc.start()
    out = list(kernel._scan([batch], np.ones((600, 2)), m, "Cosine", 0))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out[0].num_rows == 1800 and most < 96 << 20
