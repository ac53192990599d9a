"""Distance matrices in blocks against all pairs, with ties, null vectors and every metric."""

import numpy as np
import pytest

from pointframe.operators import matrix as M
from pointframe.operators.kernel import score_matrix
from pointframe.sources.collection import make_collection


@pytest.mark.parametrize("distance", ["Cosine", "Euclid"])
@pytest.mark.parametrize("block", [5, 1024])
def test_blocks_give_the_best_pairs(spark, distance, block):
    rng = np.random.default_rng(4)
    v = rng.integers(-2, 3, (60, 3)).astype(float)  # many ties, some zero vectors
    rows = [(f"p{i:03d}", v[i].tolist()) for i in range(60)] + [("q1", None), ("q2", [1.0]), ("q3", [float("nan")] * 3)]
    coll = make_collection(spark.createDataFrame(rows, "id string, v array<double>"), id="id", vectors={"": ("v", 3, distance)})
    s = score_matrix(v, v, distance).round(6)
    best = sorted(((-s[i, j] if distance == "Cosine" else s[i, j], i, j) for i in range(60) for j in range(i + 1, 60) if not np.isnan(s[i, j])))[:40]
    got = M.matrix_pairs(coll, sample=100, limit=40, block=block).collect()
    assert [(r.a, r.b, r.score) for r in got] == [(f"p{i:03d}", f"p{j:03d}", pytest.approx(abs(x) if distance == "Euclid" else -x, abs=1e-6)) for x, i, j in best]
    offsets = M.matrix_offsets(coll, sample=100, limit=40, block=block).collect()
    assert [(r.offsets_row, r.offsets_col) for r in offsets] == [(i, j) for _, i, j in best]
    assert M.matrix_pairs(coll, sample=1, limit=3, block=block).count() == 0
