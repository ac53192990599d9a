"""Approximate search over a stored neighbour graph (Q18): cells, NN-descent, beam search.

Build. Points are put into cells (nearest centroid; centroids are trained on a bounded
sample or given) and a cell of more than ``max_part`` points is cut by a hash of the id into parts, so no group
is unbounded, however many points fall into one cell. Inside a part NN-descent (Dong et al.,
WWW 2011) links every point with its nearest neighbours: each round every
point gathers a sample of its neighbours and of the points that name it, tries these on each
other, and keeps the ``degree`` best it has met. A round is three shuffles; both samples are cut by
``row_number`` (map-side first), so a point that very many name gathers no more than others. Every point
is also linked with its successors in a ring by id hash, so a part is connected.

Storage. One table, partitioned by cell: the collection's rows with ``cell``, ``part`` and
``neighbours`` (ids). The centroids are a small table beside it (one row a cell).

Search. The query's ``nprobe`` nearest cells are literals in the scan's partition
filter, so other directories are not read. Each part that is read runs a beam of width ``ef`` (``hnsw_ef``)
over its adjacency rows and returns its best ``limit`` points; they are cut once more.
Scores are exact for the points found. A filter restricts what is returned, not what the beam walks over.

Points without a vector, with a wrong dimension or a not finite component are not in the graph.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointframe.functions import distance as D
from pointframe.functions.filters import build_filter
from pointframe.operators.kernel import round_half_up, score_matrix
from pointframe.operators.search import project
from pointframe.session import checkpoint_dir, ship_package
from pointframe.sources.collection import Collection

DEFAULT_EF = 64
ENTRIES = 32


def _goodness(distance: str, scores: np.ndarray) -> np.ndarray:
    """Higher is nearer; no score is worst."""
    s = scores if D.higher_is_better(distance) else -scores
    return np.where(np.isnan(s), -np.inf, s)


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


@dataclass(frozen=True)
class GraphIndex:
    """A stored index: the folder with ``points`` and ``centroids``, and the collection's description of them."""

    path: str
    coll: Collection
    using: str | None
    cells: list[int]
    centroids: np.ndarray

    @property
    def measure(self) -> str:
        return D.COSINE if self.coll.vector(self.using).distance in (D.COSINE, D.DOT) else D.EUCLID

    def probes(self, vectors: list[list[float]], nprobe: int) -> list[list[int]]:
        """The ``nprobe`` nearest cells of every vector (ties by the cell)."""
        good = _goodness(self.measure, score_matrix(_matrix(vectors), self.centroids, self.measure))
        return [[self.cells[j] for j in np.lexsort((self.cells, -row))[:nprobe]] for row in good]


def assign_cells(coll: Collection, centroids: DataFrame, using: str | None = None) -> DataFrame:
    """The collection's rows that have a usable vector, with the ``cell`` of the nearest centroid (ties: the smaller cell).

    ``centroids``: cell, centroid; its rows are a parameter of the index, not data, and go along as an array.
    """
    spec = coll.vector(using)
    measure = D.COSINE if spec.distance in (D.COSINE, D.DOT) else D.EUCLID
    rows = sorted(centroids.select("cell", "centroid").collect(), key=lambda r: r["cell"])
    cells, held = np.array([r["cell"] for r in rows], dtype=np.int32), _matrix([r["centroid"] for r in rows])
    ship_package(coll.df.sparkSession)

    @F.pandas_udf("int")
    def nearest(s: pd.Series) -> pd.Series:
        if not len(s):
            return pd.Series([], dtype="int32")
        return pd.Series(cells[np.argmax(_goodness(measure, score_matrix(_matrix(s), held, measure)), axis=1)])

    v = F.col(spec.column)
    usable = v.isNotNull() & (F.size(v) == held.shape[1]) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return coll.df.filter(usable).withColumn("cell", nearest(v.cast("array<double>")))


def _written(df: DataFrame, folder: str, name: str, n: int) -> DataFrame:
    path = f"{folder}/{name}-{n}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pairs_of(dist: str):
    """Arrow step: of each row's gathered points (id, v) all ordered pairs with how near they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                got = part.column("got")
                ends = got.offsets.to_numpy() - got.offsets[0].as_py()
                flat = got.flatten()
                ids, vectors = flat.field("id"), flat.field("v")
                m = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
                left, right, row, good = [], [], [], []
                for k in range(len(part)):
                    n = ends[k + 1] - ends[k]
                    i, j = np.nonzero(~np.eye(n, dtype=bool))
                    own = m[ends[k]:ends[k + 1]]
                    good.append(_goodness(dist, score_matrix(own, own, dist))[i, j])
                    left.append(ends[k] + i)
                    right.append(ends[k] + j)
                    row.append(np.full(len(i), k))
                take = [pa.array(np.concatenate(x).astype(np.int64)) for x in (row, left, right)]
                yield pa.RecordBatch.from_pydict({"place": part.column("place").take(take[0]), "id": ids.take(take[1]), "nb": ids.take(take[2]),
                                                  "good": pa.array(np.concatenate(good))})

    return run


def nn_descent(points: DataFrame, dist: str, folder: str, *, degree: int, rounds: int, sample: int, seed: int) -> DataFrame:
    """Neighbours (place, id, nb, good) of ``points`` (place, id, v; written). A place is a (cell, part)."""
    kind = points.schema["id"].dataType.simpleString()
    spec = f"place struct<cell: int, part: int>, id {kind}, nb {kind}, good double"
    ship_package(points.sparkSession)

    def tried(gathered: DataFrame) -> DataFrame:
        return gathered.select("place", F.col("v_id").alias("id"), "got").mapInArrow(_pairs_of(dist), spec)

    def best(pairs: DataFrame) -> DataFrame:
        w = Window.partitionBy("place", "id").orderBy(F.col("good").desc(), F.col("nb"))
        once = pairs.groupBy("place", "id", "nb").agg(F.max("good").alias("good"))
        return once.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= degree).drop("rank")

    # first neighbours: groups of about ``sample`` points by a hash
    counts = points.groupBy("place").agg(F.count("*").alias("n"))
    at = points.join(counts, "place").withColumn("v_id", F.pmod(F.xxhash64(F.lit(seed), "id"), F.ceil(F.col("n") / sample)))
    first = at.groupBy("place", "v_id").agg(F.collect_list(F.struct("id", "v")).alias("got"))
    graph = _written(best(tried(first.withColumn("v_id", F.lit(None).cast(kind)))), folder, "graph", 0)
    for k in range(rounds):
        draw = F.xxhash64(F.lit(seed + k + 1), "id", "nb")
        both = graph.select("place", F.col("id").alias("v_id"), F.col("nb").alias("id"), draw.alias("draw"), F.lit(0).alias("side")).unionByName(
            graph.select("place", F.col("nb").alias("v_id"), "id", draw.alias("draw"), F.lit(1).alias("side")))
        drawn = both.withColumn("r", F.row_number().over(Window.partitionBy("place", "v_id", "side").orderBy("draw", "id"))).where(F.col("r") <= sample // 2 + 1)
        named = drawn.select("place", "v_id", "id").distinct().join(points, ["place", "id"])
        gathered = named.groupBy("place", "v_id").agg(F.collect_list(F.struct("id", "v")).alias("got"))
        graph = _written(best(graph.unionByName(tried(gathered))), folder, "graph", k + 1)
    return graph


def build_graph(coll: Collection, centroids: DataFrame, path: str, *, using: str | None = None, degree: int = 16, rounds: int = 4,
                sample: int = 12, ring: int = 2, max_part: int = 50_000, seed: int = 0) -> GraphIndex:
    """Builds the index of ``coll`` below ``path``. ``centroids``: cell, centroid (``ann.build_ivf`` trains some)."""
    spark = coll.df.sparkSession
    spec = coll.vector(using)
    folder = f"{checkpoint_dir(spark)}/graph-{uuid.uuid4().hex}"
    centroids.select("cell", F.col("centroid").cast("array<double>").alias("centroid")).write.mode("overwrite").parquet(f"{path}/centroids")
    rows = _written(assign_cells(coll, spark.read.parquet(f"{path}/centroids"), using), folder, "cells", 0)
    sizes = rows.groupBy("cell").agg(F.ceil(F.count("*") / max_part).cast("int").alias("parts"))  # a row a cell
    rows = rows.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64(F.lit(seed), coll.id), F.col("parts")).cast("int")).drop("parts")
    rows = _written(rows, folder, "parts", 0)
    points = rows.select(F.struct("cell", "part").alias("place"), F.col(coll.id).alias("id"), F.col(spec.column).alias("v"))
    graph = nn_descent(points, spec.distance, folder, degree=degree, rounds=rounds, sample=sample, seed=seed)
    near = graph.groupBy("place", "id").agg(F.sort_array(F.collect_list(F.struct((-F.col("good")).alias("far"), "nb"))).alias("n"))
    # the ring: the next ids in the order of a hash
    w = Window.partitionBy("place").orderBy(F.xxhash64(F.lit(seed + 99), "id"), "id")
    head = F.first("id").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rings = points.select("place", "id", F.array(*[F.coalesce(F.lead("id", j + 1).over(w), head) for j in range(ring)]).alias("ring"))
    linked = rings.join(near, ["place", "id"], "left").select(
        "place", "id", F.array_distinct(F.concat(F.coalesce(F.col("n")["nb"], F.array().cast(T.ArrayType(points.schema["id"].dataType))), "ring")).alias("neighbours"))
    linked = linked.select(F.col("place.cell").alias("cell"), F.col("place.part").alias("part"), F.col("id").alias(coll.id), "neighbours")
    stored = rows.join(linked, ["cell", "part", coll.id]).repartition("cell", "part").sortWithinPartitions("cell", "part", coll.id)
    stored.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/points")
    return open_graph(spark, coll, path, using=using)


def open_graph(spark: SparkSession, coll: Collection, path: str, *, using: str | None = None) -> GraphIndex:
    """A stored index; ``coll`` describes the columns (its own rows are not read)."""
    rows = sorted(spark.read.parquet(f"{path}/centroids").collect(), key=lambda r: r["cell"])
    return GraphIndex(path, coll, using, [r["cell"] for r in rows], _matrix([r["centroid"] for r in rows]))


def beam(vectors: np.ndarray, adjacency: list[np.ndarray], query: np.ndarray, dist: str, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores that a beam of width ``ef`` reaches from evenly spread entry points, best first."""
    n = len(vectors)
    entry = np.unique(np.linspace(0, n - 1, min(n, max(ENTRIES, 2 * ef))).astype(np.int64))
    seen = np.zeros(n, dtype=bool)
    seen[entry] = True
    held = entry
    score = score_matrix(query[None, :], vectors[entry], dist)[0]
    opened = np.zeros(n, dtype=bool)
    while True:
        order = np.lexsort((held, -_goodness(dist, score)))[:ef]
        held, score = held[order], score[order]
        todo = held[~opened[held]]
        if not len(todo):
            return held, score
        opened[todo] = True
        fresh = np.unique(np.concatenate([adjacency[i] for i in todo]))
        fresh = fresh[~seen[fresh]]
        seen[fresh] = True
        if len(fresh):
            held = np.concatenate([held, fresh])
            score = np.concatenate([score, score_matrix(query[None, :], vectors[fresh], dist)[0]])


def probe_graph(index: GraphIndex, vectors: list[list[float]], *, limit: int = 10, nprobe: int = 4, ef: int = DEFAULT_EF,
                filter: dict | None = None) -> DataFrame:
    """query_id, id, score, rank: the best ``limit`` points that the beams find for each vector (a literal list)."""
    if ef < 1 or nprobe < 1 or limit < 1:
        raise ValueError("limit, nprobe and ef must be 1 or more")
    spec, spark = index.coll.vector(index.using), index.coll.df.sparkSession
    for v in vectors:
        D.check_dim(v, spec.size)
    probes = index.probes(vectors, nprobe)
    wanted: dict[int, list[int]] = {}
    for q, cells in enumerate(probes):
        for c in cells:
            wanted.setdefault(c, []).append(q)
    points = spark.read.parquet(f"{index.path}/points")
    ok = build_filter(filter, points.schema, index.coll.id) if filter else F.lit(True)
    rows = points.filter(F.col("cell").isin(sorted(wanted))).select(
        "cell", "part", F.col(index.coll.id).alias("id"), F.col(spec.column).alias("v"), "neighbours", ok.alias("ok"))
    queries, dist, width = _matrix(vectors), spec.distance, max(ef, limit)
    kind = rows.schema["id"].dataType.simpleString()
    ship_package(spark)

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        m, ids = _matrix(pdf["v"]), pdf["id"].to_numpy()
        number = {x: k for k, x in enumerate(ids)}
        adjacency = [np.array([number[x] for x in a], dtype=np.int64) for a in pdf["neighbours"]]
        good = pdf["ok"].to_numpy(dtype=bool)
        out = []
        for q in wanted[int(pdf["cell"].iloc[0])]:
            at, score = beam(m, adjacency, queries[q], dist, width)
            keep = good[at] & ~np.isnan(score)
            at, score = at[keep], round_half_up(score[keep])  # ranks are by the rounded score, then the id
            order = np.lexsort((at, -_goodness(dist, score)))[:limit]
            at, score = at[order], score[order]
            out.append(pd.DataFrame({"query_id": np.full(len(at), q, dtype=np.int64), "id": ids[at], "score": score}))
        return pd.concat(out, ignore_index=True)

    found = rows.groupBy("cell", "part").applyInPandas(walk, f"query_id long, id {kind}, score double")
    found = found.withColumn("score", F.round("score", D.SCORE_DIGITS))
    w = Window.partitionBy("query_id").orderBy(*D.order_columns(dist))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit).withColumn("rank", F.col("rank").cast("long"))


def search_graph(index: GraphIndex, vector, *, limit: int = 10, offset: int = 0, nprobe: int = 4, ef: int = DEFAULT_EF, filter: dict | None = None,
                 with_payload=True, with_vector=False, score_threshold: float | None = None) -> DataFrame:
    """Approximate nearest points with their payload: id, payload columns, score. Only the probed cells are read."""
    spec, spark = index.coll.vector(index.using), index.coll.df.sparkSession
    hits = probe_graph(index, [list(vector)], limit=offset + limit, nprobe=nprobe, ef=ef, filter=filter)
    hits = hits.filter(F.col("rank") > offset).select("id", "score", "rank")
    threshold = D.passes_threshold(F.col("score"), score_threshold, spec.distance)
    hits = hits if threshold is None else hits.filter(threshold)
    stored = spark.read.parquet(f"{index.path}/points").filter(F.col("cell").isin(index.probes([list(vector)], nprobe)[0]))
    rows = project(index.coll, stored, with_payload, with_vector)
    out = rows.join(F.broadcast(hits), "id").orderBy("rank")  # at most offset + limit rows
    return out.select("id", *[c for c in rows.columns if c != "id"], "score")
