"""ANN and quantization invariants on planted clusters (the fixture vectors have none)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointframe.operators import ann as A
from pointframe.operators import quantize as Qz
from pointframe.operators.kernel import score_matrix
from pointframe.operators.search import search
from pointframe.sources.collection import make_collection

DIM = 16


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(1234)
    centers = rng.standard_normal((8, DIM)) * 4
    rows = []
    for i in range(800):
        v = centers[i % 8] + rng.standard_normal(DIM) * 0.3
        rows.append((i, [float(x) for x in v], i % 8))
    df = spark.createDataFrame(rows, "id long, v array<float>, label int").repartition(4)
    return make_collection(df, id="id", vectors={"": ("v", DIM, "Cosine")}), centers


def _ids(df):
    return [r["id"] for r in df.collect()]


def _exact(coll, q, k=10):
    return search(coll, q, limit=k, with_payload=False)


def test_ivf_subset_exact_scores_and_full_probe(clustered):
    coll, centers = clustered
    cents, idx = A.build_ivf(coll, n_cells=8, seed=1)
    icoll = coll.with_df(idx)
    q = [float(x) for x in centers[3]]
    exact = {r["id"]: r["score"] for r in _exact(coll, q).collect()}
    full = A.search_ivf(icoll, cents, q, nprobe=8, limit=10, with_payload=False)
    assert {r["id"]: r["score"] for r in full.collect()} == exact  # all cells probed = exact
    one = A.search_ivf(icoll, cents, q, nprobe=1, limit=10, with_payload=False).collect()
    for r in one:  # subset of points, exact scores
        assert exact.get(r["id"], r["score"]) == r["score"]
    recall1 = len({r["id"] for r in one} & set(exact)) / 10
    assert recall1 >= 0.9  # planted clusters: one cell holds the neighbours


def test_ivf_recall_rises_with_nprobe(clustered):
    coll, centers = clustered
    cents, idx = A.build_ivf(coll, n_cells=16, seed=2)
    icoll = coll.with_df(idx)
    rng = np.random.default_rng(5)
    q = [float(x) for x in centers[0] * 0.5 + centers[1] * 0.5 + rng.standard_normal(DIM)]
    exact = set(_ids(_exact(coll, q, 20)))
    recalls = []
    for p in (1, 4, 16):
        got = set(_ids(A.search_ivf(icoll, cents, q, nprobe=p, limit=20, with_payload=False)))
        recalls.append(len(got & exact) / 20)
    assert recalls == sorted(recalls) and recalls[-1] == 1.0


def test_lsh_returns_exact_scores(clustered):
    coll, centers = clustered
    idx, planes = A.build_lsh(coll, tables=6, bits=6, seed=3)
    q = [float(x) for x in centers[2]]
    exact = {r["id"]: r["score"] for r in search(coll, q, limit=800, with_payload=False).collect()}
    got = A.search_lsh(coll, idx, planes, q, limit=10, with_payload=False).collect()
    assert got and all(exact[r["id"]] == r["score"] for r in got)
    assert len({r["id"] for r in got} & set(_ids(_exact(coll, q)))) >= 8


def test_quantized_full_oversampling_rescore_is_exact(clustered):
    coll, centers = clustered
    q = [float(x) for x in centers[5] + 0.1]
    exact = _ids(_exact(coll, q))
    b = Qz.scalar_bounds(coll, 0.99)
    sq = Qz.scalar_quantize(coll, b)
    got = Qz.quantized_search(sq, q, method="scalar", bounds=b, limit=10, oversampling=80.0, rescore=True,
                              with_payload=False)
    assert _ids(got) == exact
    bq = Qz.binary_quantize(coll)
    got = Qz.quantized_search(bq, q, method="binary", limit=10, oversampling=80.0, rescore=True, with_payload=False)
    assert _ids(got) == exact
    assert _ids(Qz.quantized_search(sq, q, method="scalar", bounds=b, limit=10, ignore=True,
                                    with_payload=False)) == exact


def test_binary_codes_match_numpy(spark):
    rng = np.random.default_rng(7)
    vecs = rng.standard_normal((5, 70))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, v array<float>")
    coll = make_collection(df, id="id", vectors={"": ("v", 70, "Dot")})
    q = rng.standard_normal(70)
    got = (Qz.binary_quantize(coll).df
           .select("id", Qz.hamming(F.col("bcode"), Qz._query_words(q, 70)).alias("h")).orderBy("id").collect())
    want = [int(((vecs[i] > 0) != (q > 0)).sum()) for i in range(5)]
    assert [r["h"] for r in got] == want


def test_pq_scores_approximate_dot(clustered):
    coll, centers = clustered
    dot_coll = make_collection(coll.df, id="id", vectors={"": ("v", DIM, "Dot")})
    coded, books = Qz.build_pq(dot_coll, m=4, k=8, seed=4)
    q = [float(x) for x in centers[6]]
    # codes identify the cluster only, so every member of a cluster ties on the code score:
    # oversampling to the cluster size (100) lets the exact rescoring recover the true top 10
    got = Qz.quantized_search(coded, q, method="pq", codebooks=books, limit=10, rescore=True, oversampling=12.0,
                              with_payload=False)
    exact = _ids(search(dot_coll, q, limit=10, with_payload=False))
    assert _ids(got) == exact


@pytest.mark.parametrize("distance", ["Cosine", "Dot", "Euclid", "Manhattan"])
@pytest.mark.parametrize("coarse", [False, True])
def test_pq_scores_are_those_of_the_coded_vectors(spark, distance, coarse):
    """For every metric the score of a code is the metric's score of the vector that the code stands for."""
    rng = np.random.default_rng(3)
    v = np.abs(rng.standard_normal((300, 8))) + 3 * rng.integers(0, 2, (300, 1))
    rows = [(i, v[i].tolist(), int(i % 2), i % 3) for i in range(300)] + [(900, None, 0, 0), (901, [float("nan")] * 8, 0, 0), (902, [1.0], 0, 0)]
    coll = make_collection(spark.createDataFrame(rows, "id long, vec array<double>, cell int, label int"), id="id", vectors={"": ("vec", 8, distance)})
    cells = spark.createDataFrame([(0, [0.5] * 8), (1, [1.0] * 8)], "cell int, centroid array<double>") if coarse else None
    books = Qz.PQ.train_pq(coll, 4, 6, seed=1, train_rows=None, max_iter=5, coarse=cells)
    coded = Qz.PQ.encode_pq(coll, books, coarse=cells)
    held = {r.id: r.pqcode for r in coded.df.collect()}
    assert all(held[i] is None for i in (900, 901, 902)) and all(len(held[i]) == 4 for i in range(300))
    c = Qz.PQ.books_of(books)
    approx = np.stack([np.concatenate([c[s, held[i][s]] for s in range(4)]) + ((0.5 + 0.5 * (i % 2)) if coarse else 0) for i in range(300)])
    q = np.arange(8) / 4 + 0.5
    score = score_matrix(q[None, :], approx, distance)[0].round(6)
    best = sorted((i for i in range(300) if i % 3 == 1), key=lambda i: (-score[i] if distance in ("Cosine", "Dot") else score[i], i))[:7]
    got = Qz.quantized_search(coded, q.tolist(), method="pq", codebooks=books, coarse=cells, limit=7, rescore=False,
                              filter={"must": [{"key": "label", "match": {"value": 1}}]}).collect()
    assert [r.id for r in got] == best and [r.score for r in got] == pytest.approx([score[i] for i in best], abs=2e-6)


def test_pq_training_lowers_the_error(clustered):
    coll, _ = clustered[0], clustered[1]
    rows = [r for r in coll.df.collect()]
    x = np.stack([np.asarray(r[coll.vector().column], dtype=float) for r in rows])

    def error(rounds):
        books = Qz.PQ.books_of(Qz.PQ.train_pq(coll, 4, 8, seed=2, max_iter=rounds))
        codes = Qz.PQ.nearest_codes(x, books)
        width = books.shape[2]
        return sum(((x[:, s * width:(s + 1) * width] - books[s, codes[:, s]]) ** 2).sum() for s in range(4))

    assert error(8) < 0.8 * error(0)
