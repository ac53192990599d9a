"""The universal query request maps each kind to its operator; fusion arithmetic by hand."""

import pytest
from pyspark.sql import functions as F

from pointframe.operators import discover as XD
from pointframe.operators import recommend as R
from pointframe.operators import search as S
from pointframe.operators import sparse as SP
from pointframe.plans import fusion as FU
from pointframe.plans.query import query, query_batch
from pointframe.sources.collection import make_collection
from tests.conftest import SF_SMALL

QV = [((i * 7) % 11 - 5) / 5.0 for i in range(64)]


@pytest.fixture(scope="module")
def emb(spark):
    return make_collection(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"), id="vec_id",
                           vectors={"": ("embedding", 64, "Cosine")})


def _ids(df):
    return [r["id"] for r in df.collect()]


def test_kinds_dispatch_to_operators(spark, emb):
    assert _ids(query(emb, {"query": QV, "limit": 5})) == _ids(S.search(emb, QV, limit=5))
    assert _ids(query(emb, {"query": {"nearest": 7}, "limit": 5})) == _ids(S.query_by_id(emb, 7, limit=5))
    assert _ids(query(emb, {"query": 7, "limit": 5})) == _ids(S.query_by_id(emb, 7, limit=5))
    rec = {"positive": [1, 2], "negative": [3], "strategy": "best_score"}
    assert _ids(query(emb, {"query": {"recommend": rec}, "limit": 5})) == \
        _ids(R.recommend(emb, [1, 2], [3], "best_score", limit=5))
    ctx = [{"positive": 1, "negative": 2}]
    assert _ids(query(emb, {"query": {"discover": {"target": 5, "context": ctx}}, "limit": 5})) == \
        _ids(XD.discover(emb, 5, ctx, limit=5))
    assert _ids(query(emb, {"query": {"context": ctx}, "limit": 5})) == _ids(XD.context_search(emb, ctx, limit=5))
    assert _ids(query(emb, {"query": {"order_by": {"key": "label", "direction": "desc"}}, "limit": 5})) == \
        _ids(S.scroll(emb, limit=5, order_by={"key": "label", "direction": "desc"}))
    assert _ids(query(emb, {"query": {"sample": "random"}, "limit": 5})) == _ids(S.sample(emb, limit=5))
    assert len(_ids(query(emb, {"limit": 5}))) == 5


def test_sparse_kind(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    post = SP.token_counts(docs, "doc_id", "text")
    coll = make_collection(docs, id="doc_id")
    q = {"indices": [int(r["idx"]) for r in post.limit(3).collect()], "values": [1.0, 2.0, 0.5]}
    got = query(coll, {"query": q, "limit": 4}, sparse_postings=post)
    assert _ids(got) == _ids(SP.sparse_search(post, q, limit=4))


def test_unknown_request_keys_raise(emb):
    with pytest.raises(ValueError):
        query(emb, {"query": QV, "limt": 3})
    with pytest.raises(ValueError):
        query(emb, {"query": {"fusion": "rrf", "extra": 1}})


def test_rrf_and_dbsf_by_hand(spark):
    a = spark.createDataFrame([(1, 0.9), (2, 0.8), (3, 0.1)], "id long, score double")
    b = spark.createDataFrame([(3, 0.7), (1, 0.6)], "id long, score double")
    got = {r["id"]: r["score"] for r in FU.rrf([(a, "Cosine"), (b, "Cosine")]).collect()}
    assert got == {1: round(1 / 61 + 1 / 62, 6), 2: round(1 / 62, 6), 3: round(1 / 63 + 1 / 61, 6)}
    import statistics
    mu, sd = statistics.mean([0.9, 0.8, 0.1]), statistics.stdev([0.9, 0.8, 0.1])
    lo, hi = mu - 3 * sd, mu + 3 * sd
    mu2, sd2 = statistics.mean([0.7, 0.6]), statistics.stdev([0.7, 0.6])
    lo2, hi2 = mu2 - 3 * sd2, mu2 + 3 * sd2
    got = {r["id"]: r["score"] for r in FU.dbsf([(a, "Cosine"), (b, "Cosine")]).collect()}
    assert got[2] == round((0.8 - lo) / (hi - lo), 6)
    assert got[1] == round((0.9 - lo) / (hi - lo) + (0.6 - lo2) / (hi2 - lo2), 6)
    # distances are flipped so that higher is better inside fusion
    d = spark.createDataFrame([(1, 0.1), (2, 0.5)], "id long, score double")
    got = {r["id"]: r["score"] for r in FU.rrf([(d, "Euclid")]).collect()}
    assert got[1] > got[2]


def test_query_batch_mixes_kernel_and_plans(spark, emb):
    reqs = [{"query": QV, "limit": 3}, {"query": {"nearest": 4}, "limit": 2},
            {"query": [-x for x in QV], "limit": 2, "filter": {"must": [{"key": "label", "range": {"lt": 5}}]}}]
    got = query_batch(emb, reqs).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], set()).add(r["id"])
    assert by[0] == set(_ids(S.search(emb, QV, limit=3)))
    assert by[1] == set(_ids(S.query_by_id(emb, 4, limit=2)))
    assert by[2] == set(_ids(S.search(emb, [-x for x in QV], limit=2, filter=reqs[2]["filter"])))


def test_search_edge_cases(spark, emb):
    with pytest.raises(ValueError):
        S.search(emb, [1.0, 2.0])  # wrong dimension
    assert S.search(emb, QV, filter={"must": [{"key": "label", "range": {"gt": 1000}}]}).count() == 0
    assert S.query_by_id(emb, 10 ** 9).count() == 0  # missing id: empty, not an error
    assert S.search(emb, QV, limit=10 ** 6).count() == emb.df.count()  # k > N
    eu = make_collection(emb.df, id="vec_id", vectors={"": ("embedding", 64, "Euclid")})
    got = S.search(eu, QV, limit=1000, score_threshold=7.9).collect()
    assert all(r["score"] <= 7.9 for r in got)  # a maximum for distances
    assert [r["score"] for r in got] == sorted(r["score"] for r in got)


def test_scroll_order_by_key_outside_payload(spark):
    o = make_collection(spark.read.parquet(f"{SF_SMALL}/orders.parquet"), id="o_orderkey")
    got = S.scroll(o, limit=5, order_by={"key": "o_totalprice", "direction": "desc"}, with_payload=["o_orderstatus"])
    assert got.columns == ["id", "o_orderstatus"]
    want = [r["o_orderkey"] for r in o.df.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(5).collect()]
    assert [r["id"] for r in got.collect()] == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_results_do_not_depend_on_session_time_zone(spark):
    import __spark_entry__ as entry
    from tests.conftest import SF_CHECK
    qs = entry.queries()
    names = ["filter_datetime", "response_stats_windowed", "stream_response_stats"]

    def run():
        return {n: sorted(tuple(r) for r in qs[n](spark, SF_CHECK).collect()) for n in names}
    utc = run()
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        la = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert la == utc


def test_workers_import_the_package_from_any_directory(spark, tmpdir_path):
    # the kernels reference library functions by module: the package is shipped to
    # the Python workers, so a driver started elsewhere still works
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false').getOrCreate()\n"
            "import __spark_entry__ as e\n"
            "print(e.queries()['search_batch'](s, %r).count())\n") % (
        __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__))),
        "/root/testdata/sf0.001")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmpdir_path, capture_output=True, text=True, timeout=600)
    assert out.stdout.strip().splitlines()[-1] == "5000", out.stderr[-2000:]
