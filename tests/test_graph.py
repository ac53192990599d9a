"""The stored neighbour graph: recall, what is read, parameters, and the points it leaves out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointframe.operators import graph as G
from pointframe.operators.search import search
from pointframe.sources.collection import make_collection


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """3,000 points around 40 centers, with two points that have no usable vector."""
    rng = np.random.default_rng(5)
    centers = rng.standard_normal((40, 16)) * 2
    v = centers[rng.integers(0, 40, 3000)] + 0.5 * rng.standard_normal((3000, 16))
    rows = [(f"p{i:05d}", [float(x) for x in v[i]], i % 7) for i in range(3000)] + [("none", None, 1), ("nan", [float("nan")] * 16, 1)]
    coll = make_collection(spark.createDataFrame(rows, "id string, vec array<float>, label int"), id="id", vectors={"": ("vec", 16, "Euclid")})
    cells = spark.createDataFrame([(k, [float(x) for x in centers[k]]) for k in range(8)], "cell int, centroid array<double>")
    path = str(tmp_path_factory.mktemp("graph") / "index")
    G.build_graph(coll, cells, path, degree=12, rounds=3, max_part=600, seed=1)
    index = G.open_graph(spark, coll, path)  # as another session would read it
    return coll, index, v


def exact(v, q, k, keep=None):
    d = np.sqrt(((v.astype(np.float32).astype(float) - q) ** 2).sum(axis=1)).round(6)
    order = [i for i in np.lexsort((np.arange(len(v)), d)) if keep is None or keep(i)]
    return [f"p{i:05d}" for i in order[:k]]


def test_recall_of_a_narrow_beam(planted):
    coll, index, v = planted
    queries = [[float(x) for x in v[i] + 0.05] for i in range(0, 3000, 100)]
    found = {}
    for r in G.probe_graph(index, queries, limit=10, nprobe=3, ef=48).collect():
        found.setdefault(r.query_id, set()).add(r.id)
    recall = np.mean([len(found[q] & set(exact(v, np.array(x), 10))) / 10 for q, x in enumerate(queries)])
    assert recall >= 0.9


def test_a_wide_beam_over_all_cells_is_exact(planted):
    coll, index, v = planted
    q = [float(x) for x in v[5]]
    got = search(coll, q, limit=10, filter={"must": [{"key": "label", "match": {"value": 3}}]}, index=index, nprobe=8,
                 params={"exact": False, "hnsw_ef": 3000}).collect()
    assert [r.id for r in got] == exact(v, np.array(q), 10, keep=lambda i: i % 7 == 3) and all(r.label == 3 for r in got)
    page = search(coll, q, limit=4, offset=3, index=index, nprobe=8, params={"exact": False, "hnsw_ef": 3000, "indexed_only": True}).collect()
    assert [r.id for r in page] == exact(v, np.array(q), 7)[3:]


def test_parts_are_bounded_and_linked(planted):
    coll, index, _ = planted
    rows = coll.df.sparkSession.read.parquet(f"{index.path}/points").collect()
    assert len(rows) == 3000 and {r.id for r in rows}.isdisjoint({"none", "nan"})
    parts = {}
    for r in rows:
        parts.setdefault((r.cell, r.part), {})[r.id] = r.neighbours
    assert all(len(p) <= 750 for p in parts.values()) and len(parts) > 8
    for p in parts.values():
        start = min(p)
        seen, todo = {start}, [start]
        while todo:
            fresh = set(p[todo.pop()]) - seen
            seen |= fresh
            todo += fresh
        assert seen == set(p)


def test_only_probed_directories_are_read(planted):
    coll, index, v = planted
    df = G.probe_graph(index, [[float(x) for x in v[5]]], limit=10, nprobe=2, ef=32)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan and "isnotnull(cell" in plan or "cell#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    files = df.sparkSession.read.parquet(f"{index.path}/points").filter(F.col("cell").isin(index.probes([[float(x) for x in v[5]]], 2)[0]))
    assert len({f.split("cell=")[1].split("/")[0] for f in [r[0] for r in files.select(F.input_file_name()).distinct().collect()]}) <= 2


def test_points_that_the_index_lacks(planted):
    coll, index, v = planted
    spark = coll.df.sparkSession
    q = [float(x) for x in v[5]]
    more = coll.with_df(coll.df.unionByName(spark.createDataFrame([("zz", q, 1)], "id string, vec array<float>, label int")))
    ids = lambda **p: [r.id for r in search(more, q, limit=3, index=index, nprobe=8, params={"exact": False, "hnsw_ef": 3000, **p}).collect()]
    assert "zz" in ids() and "zz" not in ids(indexed_only=True)
    with pytest.raises(ValueError):
        search(coll, q, index=index, params={"exact": False, "speed": 1})
    with pytest.raises(ValueError):
        search(coll, q, params={"exact": False})
    with pytest.raises(ValueError):
        G.probe_graph(index, [q], limit=0)
