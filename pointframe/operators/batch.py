"""Batch search (Q5): many searches in one job instead of one job per search."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointframe.functions.filters import build_filter
from pointframe.operators import kernel
from pointframe.operators.search import filtered
from pointframe.sources.collection import Collection


def knn_join(coll: Collection, queries: DataFrame, *, query_id: str = "query_id",
             vector: str = "vector", k: int | str = 10, using: str | None = None,
             filter: dict | None = None, exclude: str | None = None, **kw) -> DataFrame:
    """Top-``k`` points of ``coll`` for every row of ``queries`` (a DataFrame of any size).

    Returns ``query_id, id, score, rank``. ``filter`` restricts the points for all
    queries; ``exclude`` names a query column holding a point id to leave out.
    """
    spec = coll.vector(using)
    pts = filtered(coll, filter)
    kw.setdefault("dim", spec.size)
    return kernel.knn(pts, coll.id, spec.column, queries, query_id=query_id, query_vec=vector,
                      k=k, distance=spec.distance, exclude_col=exclude, **kw)


def search_batch(coll: Collection, requests: list[dict], *, using: str | None = None,
                 **kw) -> DataFrame:
    """Run a list of search requests (``{vector, limit=10, filter=None}``) as one job.

    Each distinct filter becomes one boolean column on the points, so the points
    are scanned once for the whole batch. ``query_id`` is the request's position.
    """
    spark = coll.df.sparkSession
    spec = coll.vector(using)
    filters: dict[str, int] = {}
    rows = []
    for i, r in enumerate(requests):
        bad = set(r) - {"vector", "limit", "filter", "using"}
        if bad:
            raise ValueError(f"request {i}: unknown keys {sorted(bad)}")
        if r.get("using", using) != using:
            raise ValueError("all requests of one batch must use the same vector")
        vec = [float(x) for x in r["vector"]]
        if spec.size is not None and len(vec) != spec.size:
            raise ValueError(f"request {i}: dimension {len(vec)} != {spec.size}")
        f = r.get("filter")
        fi = None
        if f:
            key = json.dumps(f, sort_keys=True)
            fi = filters.setdefault(key, len(filters))
        rows.append((i, vec, int(r.get("limit", 10)), fi))
    schema = T.StructType([T.StructField("query_id", T.LongType()),
                           T.StructField("vector", T.ArrayType(T.DoubleType())),
                           T.StructField("limit", T.IntegerType()),
                           T.StructField("filter_idx", T.IntegerType())])
    queries = spark.createDataFrame(rows, schema)
    pts = coll.df
    mask_cols = []
    for key, j in sorted(filters.items(), key=lambda kv: kv[1]):
        name = f"_f{j}"
        pts = pts.withColumn(name, build_filter(json.loads(key), coll.df.schema, coll.id))
        mask_cols.append(name)
    return kernel.knn(pts, coll.id, spec.column, queries, k="limit", distance=spec.distance,
                      point_mask_cols=mask_cols, query_mask_col="filter_idx" if mask_cols else None, **kw)
