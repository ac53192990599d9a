"""Sparse vectors and sparse search.

A sparse vector is ``struct<indices: array<int>, values: array<float>>``. For
scoring it is used in long form ``(id, idx, val)``: a query's entries join the
points' entries on ``idx`` and the products are summed per point - an
inverted-index dot product written as a join plus a partial/final aggregation.
Only points that share at least one index with the query get a score.

A literal query (one request) is broadcast explicitly - its size is the
request's - so a frequent index (a stop word in a third of all documents)
causes no skewed shuffle partition. A query *DataFrame* (a batch of any size)
gets no hint: AQE broadcasts it when its runtime size is under the threshold,
otherwise the join shuffles on ``idx`` and AQE splits skewed partitions. The
per-point sum is pre-aggregated before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointframe.functions import distance as D
from pointframe.functions import text as TX
from pointframe.plans.partitioning import spread


def text_to_sparse(df: DataFrame, id_col: str, text_col: str, tokenizer: str = "word",
                   out: str = "sparse") -> DataFrame:
    """Token-count sparse vectors: index = hashed token (first 7 hex digits of md5),
    value = count; colliding tokens are summed. ``id, out`` with sorted indices."""
    long = token_counts(df, id_col, text_col, tokenizer)
    packed = (long.groupBy("id")
                  .agg(F.sort_array(F.collect_list(F.struct("idx", "val"))).alias("_e")))
    return packed.select("id", F.struct(F.transform("_e", lambda e: e["idx"]).alias("indices"),
                                        F.transform("_e", lambda e: e["val"]).alias("values")).alias(out))


def token_counts(df: DataFrame, id_col: str, text_col: str, tokenizer: str = "word") -> DataFrame:
    """Long form ``id, idx, val`` straight from text (no packing)."""
    src = spread(df.select(id_col, text_col))
    toks = src.select(F.col(id_col).alias("id"), F.explode(TX.tokens(F.col(text_col), tokenizer)).alias("t"))
    return (toks.groupBy("id", TX.sparse_index(F.col("t")).alias("idx"))
                .agg(F.count(F.lit(1)).cast("float").alias("val")))


def explode_sparse(df: DataFrame, id_col: str, sparse_col: str) -> DataFrame:
    """Packed sparse vectors -> ``id, idx, val`` (zero weights dropped before the explode)."""
    z = F.arrays_zip(F.col(sparse_col)["indices"].alias("idx"), F.col(sparse_col)["values"].alias("val"))
    return (df.select(F.col(id_col).alias("id"), F.explode(F.filter(z, lambda e: e["val"] != 0)).alias("e"))
              .select("id", F.col("e.idx").alias("idx"), F.col("e.val").alias("val")))


def query_frame(spark, query, query_id: int | None = None) -> DataFrame:
    """A literal ``{indices, values}`` as ``idx, qval`` rows (duplicate indices summed)."""
    rows = list(zip([int(i) for i in query["indices"]], [float(v) for v in query["values"]]))
    df = spark.createDataFrame(rows, "idx int, qval double").groupBy("idx").agg(F.sum("qval").alias("qval"))
    return df if query_id is None else df.withColumn("query_id", F.lit(query_id).cast("long"))


def _maybe_broadcast(df: DataFrame, bounded: bool) -> DataFrame:
    return F.broadcast(df) if bounded else df


def idf_weights(postings: DataFrame, idx: DataFrame, bounded: bool = False, n_points=None) -> DataFrame:
    """``idx, idf`` for the given indices: ln((N - df + 0.5) / (df + 0.5) + 1)
    (Robertson and Zaragoza, 2009), N = number of points holding any entry.

    Pass ``n_points`` (an int or a scalar Column) when N is known, e.g. from the
    collection; otherwise it is counted from the postings (one more aggregation).
    """
    if n_points is None:
        n = postings.agg(F.countDistinct("id").alias("n")).select("n").scalar()
    else:
        n = n_points if hasattr(n_points, "alias") else F.lit(int(n_points))
    want = idx.select("idx").distinct()
    df = (postings.join(_maybe_broadcast(want, bounded), "idx", "left_semi")
                  .groupBy("idx").agg(F.countDistinct("id").alias("df")))
    return df.select("idx", F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1).alias("idf"))


def sparse_scores(postings: DataFrame, query: DataFrame, modifier: str | None = None,
                  bounded_query: bool = False, n_points=None) -> DataFrame:
    """``[query_id,] id, raw`` dot products for every point sharing an index with the query.

    ``bounded_query=True`` (a literal request) broadcasts the query explicitly.
    """
    keys = ["query_id"] if "query_id" in query.columns else []
    q = query
    # a semi join on the grouping key is pushed below the postings aggregation by
    # Catalyst, so only entries of the query's indices are ever aggregated
    post = postings.join(_maybe_broadcast(query.select("idx"), bounded_query), "idx", "left_semi")
    if modifier == "idf":
        q = q.join(idf_weights(postings, query, bounded_query, n_points), "idx") \
             .withColumn("qval", F.col("qval") * F.col("idf"))
    elif modifier not in (None, "none"):
        raise ValueError(f"unknown sparse modifier {modifier!r}")
    j = post.join(_maybe_broadcast(q.select(*keys, "idx", "qval"), bounded_query), "idx")
    return j.groupBy(*keys, "id").agg(F.sum(F.col("val").cast("double") * F.col("qval")).alias("raw"))


def sparse_search(postings: DataFrame, query, *, limit: int = 10, modifier: str | None = None,
                  spark=None, n_points=None) -> DataFrame:
    """Top ``limit`` points by sparse dot product: ``id, score``."""
    literal = not isinstance(query, DataFrame)
    if literal:
        query = query_frame(spark or postings.sparkSession, query)
    s = sparse_scores(postings, query, modifier, bounded_query=literal, n_points=n_points)
    out = s.select("id", F.round("raw", D.SCORE_DIGITS).alias("score"))
    return out.orderBy(F.col("score").desc(), F.col("id").asc()).limit(limit)


def sparse_search_batch(postings: DataFrame, queries: DataFrame, *, limit: int = 10,
                        modifier: str | None = None, n_points=None) -> DataFrame:
    """Top ``limit`` per ``query_id`` (queries in long form ``query_id, idx, qval``)."""
    s = sparse_scores(postings, queries, modifier, n_points=n_points) \
        .withColumn("score", F.round("raw", D.SCORE_DIGITS))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc())
    return (s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)
             .select("query_id", "id", "score", F.col("rank").cast("long").alias("rank")))


def sparse_dot(a: Column, b: Column) -> Column:
    """Row-wise dot product of two packed sparse vectors (both with sorted indices)."""
    bm = F.map_from_arrays(b["indices"], b["values"])
    return F.aggregate(F.arrays_zip(a["indices"].alias("i"), a["values"].alias("v")), F.lit(0.0),
                       lambda acc, e: acc + F.coalesce(e["v"].cast("double") * bm[e["i"]].cast("double"), F.lit(0.0)))
