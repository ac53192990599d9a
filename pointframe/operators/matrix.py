"""Distance matrix over a sample (M1, M2): a theta self-join in blocks.

``sample`` points are drawn once with the seeded order of ``search.sample``, numbered by id and written below the shared
folder; of all unordered pairs of them the ``limit`` best are returned, best first (ties by the two ids, the
smaller id is ``a``). The numbers are cut into blocks of ``block`` points, and each pair of blocks in the upper triangle is one
NumPy product, so every pair of points is scored once. The blocks of the diagonal go first: the
``limit``-th best score among them is a threshold that the others are cut with before anything leaves a task; each
passes on at most ``limit`` pairs. A task holds two blocks.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointframe.functions import distance as D
from pointframe.operators.kernel import round_half_up, score_matrix
from pointframe.operators.search import sample as draw
from pointframe.session import checkpoint_dir, ship_package
from pointframe.sources.collection import Collection

BLOCK = 1024


def drawn(coll: Collection, sample: int, seed: int, filter, using) -> DataFrame:
    """The sample, written: index (from 0, by id), id, vec. Points without a vector count as drawn and have no pairs."""
    spec = coll.vector(using)
    s = draw(coll, limit=sample, seed=seed, filter=filter, with_payload=False, with_vector=[using or ""] if using else True)
    # a row number in one partition: at most ``sample`` rows
    s = s.select((F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("id")) - 1).cast("long").alias("index"), "id", F.col(spec.column).alias("vec"))
    path = f"{checkpoint_dir(coll.df.sparkSession)}/sample-{uuid.uuid4().hex}"
    s.write.parquet(path)
    return coll.df.sparkSession.read.schema(s.schema).parquet(path)


def _pairs(points: DataFrame, dist: str, dim: int | None, limit: int, block: int) -> DataFrame:
    """a, b (indexes), score: the ``limit`` best pairs."""
    ship_package(points.sparkSession)
    higher = D.higher_is_better(dist)
    placed = points.select("index", "vec", F.floor(F.col("index") / block).cast("long").alias("blk"))
    schema = "a long, b long, score double"

    def best(threshold: float | None):
        def score(pdf: pd.DataFrame) -> pd.DataFrame:
            ok = [v is not None and (dim is None or len(v) == dim) and np.isfinite(np.asarray(v, dtype=np.float64)).all() for v in pdf["vec"]]
            pdf = pdf[np.array(ok, dtype=bool)].sort_values("index", ignore_index=True)
            low, high = pdf["low"].iloc[0] if len(pdf) else 0, pdf["high"].iloc[0] if len(pdf) else 0
            left, right = pdf[pdf["blk"] == low], pdf[pdf["blk"] == high]
            if not len(left) or not len(right):
                return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "score": np.zeros(0)})
            s = score_matrix(np.stack(left["vec"].to_numpy()).astype(float), np.stack(right["vec"].to_numpy()).astype(float), dist)
            a, b = left["index"].to_numpy(), right["index"].to_numpy()
            good = np.where(np.isnan(s), -np.inf, s if higher else -s)
            good[a[:, None] >= b[None, :]] = -np.inf
            if threshold is not None:
                good[good < (threshold if higher else -threshold) - 1e-6] = -np.inf
            i, j = np.nonzero(good > -np.inf)
            if len(i) > limit:  # a cheap superset first: whatever could round to the last place
                floor = np.partition(good[i, j], len(i) - limit)[len(i) - limit] - 2e-6
                i, j = (x[good[i, j] >= floor] for x in (i, j))
            value = round_half_up(s[i, j])
            order = np.lexsort((b[j], a[i], -value if higher else value))[:limit]
            return pd.DataFrame({"a": a[i][order], "b": b[j][order], "score": value[order]})
        return score

    order = [F.col("score").desc() if higher else F.col("score").asc(), "a", "b"]
    diagonal = placed.select("index", "vec", "blk", F.col("blk").alias("low"), F.col("blk").alias("high"))
    found = diagonal.groupBy("low", "high").applyInPandas(best(None), schema).orderBy(*order).limit(limit)
    blocks = placed.agg(F.max("blk")).first()[0] or 0
    if not blocks:
        return found
    path = f"{checkpoint_dir(points.sparkSession)}/matrix-{uuid.uuid4().hex}"
    found.write.parquet(path)
    found = points.sparkSession.read.schema(found.schema).parquet(path)
    n, last = found.agg(F.count("*"), F.min("score") if higher else F.max("score")).first()
    others = F.sequence(F.lit(0), F.lit(blocks))
    off = placed.select("index", "vec", "blk", F.explode(F.filter(others, lambda o: o != F.col("blk"))).alias("other")).select(
        "index", "vec", "blk", F.least("blk", "other").alias("low"), F.greatest("blk", "other").alias("high"))
    off = off.groupBy("low", "high").applyInPandas(best(last if n == limit else None), schema)
    return found.unionByName(off).orderBy(*order).limit(limit)


def matrix_pairs(coll: Collection, sample: int = 10, limit: int = 3, filter: dict | None = None,
                 seed: int = 0, using: str | None = None, block: int = BLOCK) -> DataFrame:
    """``a, b, score``: the ``limit`` best pairs a < b among the sampled points, best first."""
    spec = coll.vector(using)
    points = drawn(coll, sample, seed, filter, using)
    pairs = _pairs(points, spec.distance, spec.size, limit, block)
    ids = points.select("index", "id")
    best = F.col("score").desc() if D.higher_is_better(spec.distance) else F.col("score").asc()
    # at most ``limit`` rows are broadcast
    out = ids.select(F.col("index").alias("a"), F.col("id").alias("a_id")).join(F.broadcast(pairs), "a")
    out = ids.select(F.col("index").alias("b"), F.col("id").alias("b_id")).join(F.broadcast(out), "b")
    return out.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), "score").orderBy(best, "a", "b")


def matrix_ids(coll: Collection, sample: int = 10, filter: dict | None = None, seed: int = 0) -> DataFrame:
    """``index, id`` of the sampled points in ascending id order (the ``ids`` array of M2)."""
    s = draw(coll, limit=sample, seed=seed, filter=filter, with_payload=False).select("id")
    # the sample holds at most ``sample`` rows: a one-partition row number is bounded
    w = Window.partitionBy(F.lit(0)).orderBy("id")
    return s.withColumn("index", (F.row_number().over(w) - 1).cast("long")).select("index", "id")


def matrix_offsets(coll: Collection, sample: int = 10, limit: int = 3, filter: dict | None = None,
                   seed: int = 0, using: str | None = None, block: int = BLOCK) -> DataFrame:
    """COO form (M2): ``offsets_row, offsets_col, score`` indexing into ``matrix_ids``; the sample is drawn once."""
    spec = coll.vector(using)
    pairs = _pairs(drawn(coll, sample, seed, filter, using), spec.distance, spec.size, limit, block)
    return pairs.select(F.col("a").alias("offsets_row"), F.col("b").alias("offsets_col"), "score")
