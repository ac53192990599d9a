"""Approximate search (Q18, Q20) re-aimed as Spark-native indexes.

The remote engine's HNSW graph has no distributed counterpart, so approximate
search is offered as two partition-friendly indexes:

* **IVF** (inverted file): ``pyspark.ml`` k-means cells (cosine or Euclidean);
  every point carries its ``cell``. Written partitioned by ``cell``, a probe of
  ``nprobe`` cells reads only those directories. Search ranks the centroids
  (a ``n_cells``-row table), keeps the ``nprobe`` best (bounded, broadcast), semi
  joins the index on cell and re-scores exactly.
* **LSH** with random hyperplanes (Charikar, STOC 2002): ``tables`` signatures of
  ``bits`` bits; candidates share a signature with the query in any table.
  The hyperplanes are a seeded constant of size tables x bits x dim.

Both return exact scores for the candidates they find; recall depends on the
data (the fixture vectors have no cluster structure, see the README).
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointframe.functions import distance as D
from pointframe.operators.search import ranked
from pointframe.sources.collection import Collection

# ---------------------------------------------------------------- IVF


def training_sample(df: DataFrame, train_rows: int | None, train_fraction: float | None, seed: int) -> DataFrame:
    """Seeded sample for fitting a quantizer: ``train_fraction``, or about ``train_rows``
    rows (one count job); everything when the table is smaller. Only the fit uses
    it - every point is still assigned a code."""
    if train_fraction:
        return df.sample(fraction=min(1.0, train_fraction), seed=seed)
    if train_rows:
        n = df.count()
        if n > train_rows:
            return df.sample(fraction=train_rows / n, seed=seed)
    return df


def build_ivf(coll: Collection, n_cells: int = 16, *, using: str | None = None, seed: int = 0,
              max_iter: int = 20, train_fraction: float | None = None,
              train_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Train cells and assign every point: returns ``(centroids, index_df)``.

    ``centroids``: ``cell int, centroid array<double>`` (n_cells rows).
    ``index_df``: the collection's rows plus ``cell``. k-means is fitted on a
    seeded sample of about ``train_rows`` points (or ``train_fraction``), so the
    build costs a few passes over a bounded sample plus one assignment pass over
    the whole table, not ``max_iter`` passes over all of it.
    """
    spec = coll.vector(using)
    measure = "cosine" if spec.distance in (D.COSINE, D.DOT) else "euclidean"
    feats = coll.df.filter(F.col(spec.column).isNotNull()) \
                   .withColumn("_f", array_to_vector(F.col(spec.column).cast("array<double>")))
    train = training_sample(feats, train_rows, train_fraction, seed)
    model = KMeans(k=n_cells, seed=seed, maxIter=max_iter, featuresCol="_f", predictionCol="cell",
                   distanceMeasure=measure, initMode="k-means||").fit(train)
    # n_cells centers: a bounded constant
    spark = coll.df.sparkSession
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    centroids = spark.createDataFrame(centers, "cell int, centroid array<double>")
    index = model.transform(feats).drop("_f").withColumn("cell", F.col("cell").cast("int"))
    return centroids, index


def ivf_collection(coll: Collection, index_df: DataFrame) -> Collection:
    return coll.with_df(index_df)


def search_ivf(index: Collection, centroids: DataFrame, vector, *, nprobe: int = 4, limit: int = 10,
               using: str | None = None, filter: dict | None = None, with_payload=True,
               indexed_only: bool = False) -> DataFrame:
    """Approximate nearest points: probe the ``nprobe`` closest cells, score exactly.

    ``indexed_only`` (Q20) restricts to points that hold a cell (all points of a
    freshly built index; points appended later without a cell are skipped).
    """
    from pointframe.operators.search import filtered
    spec = index.vector(using)
    measure = D.COSINE if spec.distance in (D.COSINE, D.DOT) else D.EUCLID
    cell_scores = centroids.select("cell", D.score(F.col("centroid"), vector, measure).alias("s"))
    order = F.col("s").desc() if D.higher_is_better(measure) else F.col("s").asc()
    probe = cell_scores.orderBy(order, F.col("cell")).limit(nprobe).select("cell")
    pts = filtered(index, filter)
    cand = pts.join(F.broadcast(probe), "cell", "left_semi")
    if not indexed_only:
        cand = cand.unionByName(pts.filter(F.col("cell").isNull()))
    return ranked(index, cand, vector, using=using, limit=limit, with_payload=with_payload)


def search_indexed_only(coll: Collection, vector, *, index_col: str = "cell", limit: int = 10,
                        using: str | None = None, with_payload=True) -> DataFrame:
    """Exact search over the points that hold an index entry (Q20)."""
    return ranked(coll, coll.df.filter(F.col(index_col).isNotNull()), vector, using=using,
                  limit=limit, with_payload=with_payload)


# ---------------------------------------------------------------- LSH


def hyperplanes(dim: int, tables: int = 8, bits: int = 8, seed: int = 0) -> np.ndarray:
    """Seeded Gaussian hyperplanes, shape (tables, bits, dim)."""
    return np.random.default_rng(seed).standard_normal((tables, bits, dim))


def lsh_codes(vec: Column, planes: np.ndarray) -> Column:
    """``array<int>`` of one signature per table (bit j set when the vector is on the
    positive side of hyperplane j)."""
    codes = []
    for t in range(planes.shape[0]):
        code = F.lit(0)
        for j in range(planes.shape[1]):
            h = [float(x) for x in planes[t, j]]
            code = code + F.when(D.dot(vec, h) > 0, F.lit(1 << j)).otherwise(F.lit(0))
        codes.append(code)
    return F.array(*codes)


def build_lsh(coll: Collection, *, tables: int = 8, bits: int = 8, seed: int = 0,
              using: str | None = None) -> tuple[DataFrame, np.ndarray]:
    """Long LSH index ``table, code, id`` and the hyperplanes used."""
    spec = coll.vector(using)
    planes = hyperplanes(spec.size, tables, bits, seed)
    idx = (coll.df.filter(F.col(spec.column).isNotNull())
               .select(F.col(coll.id).alias("id"), F.posexplode(lsh_codes(F.col(spec.column), planes))
                       .alias("table", "code")))
    return idx, planes


def search_lsh(coll: Collection, lsh_index: DataFrame, planes: np.ndarray, vector, *, limit: int = 10,
               using: str | None = None, with_payload=True) -> DataFrame:
    """Candidates sharing a signature with the query in any table, scored exactly."""
    q = np.asarray(vector, dtype=np.float64)
    bits = (np.einsum("tbd,d->tb", planes, q) > 0).astype(np.int64)
    qcodes = (bits << np.arange(planes.shape[1])).sum(axis=1)
    spark = coll.df.sparkSession
    want = spark.createDataFrame([(int(t), int(c)) for t, c in enumerate(qcodes)], "table int, code int")
    cand_ids = lsh_index.join(F.broadcast(want), ["table", "code"], "left_semi").select(F.col("id").alias(coll.id))
    cand = coll.df.join(cand_ids, coll.id, "left_semi")
    return ranked(coll, cand, list(map(float, vector)), using=using, limit=limit, with_payload=with_payload)


def recall(approx: DataFrame, exact: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Share of exact result rows found by the approximate search (per ``keys`` group or overall)."""
    k = keys or []
    hit = exact.join(approx.select(*k, "id").withColumn("_hit", F.lit(1)), [*k, "id"], "left")
    return hit.groupBy(*k).agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"))
