"""Recommendation from examples.

Strategies (names from the API, arithmetic our decision):
  * ``average_vector`` (Rocchio, 1971): target = mean(pos) + (mean(pos) - mean(neg)),
    or mean(pos) without negatives; then an ordinary nearest search.
  * ``best_score``: per point, p = best similarity to any positive, n = best to any
    negative; score = sigma(p) if p > n (or no negatives) else -sigma(n), with
    sigma(x) = 0.5 (1 + x / (1 + |x|)). For distances the similarity is -distance.
Example ids are excluded from the result. Higher score is better for best_score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointframe.functions import distance as D
from pointframe.operators import examples as X
from pointframe.operators.search import filtered, project, scored, top
from pointframe.sources.collection import Collection


def _target_frame(ex: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """Per group: ``target`` = 2 * mean(pos) - mean(neg), or mean(pos) (request-sized examples)."""
    return X.rocchio_targets(ex, group_cols)


def _candidates(coll: Collection, filter, exclude_ids) -> DataFrame:
    df = filtered(coll, filter)
    if exclude_ids:
        df = df.filter(~F.col(coll.id).isin(list(exclude_ids)))
    return df


def recommend_scored(coll: Collection, positive=(), negative=(), strategy: str = "average_vector", *,
                     using: str | None = None, filter: dict | None = None, with_payload=True,
                     with_vector=False, score_threshold: float | None = None,
                     lookup_from: Collection | None = None) -> tuple[DataFrame, str]:
    """All candidate points with their recommend ``score`` (no ranking) and the score direction.

    NULL scores and ``score_threshold`` are applied by the consumer after its cut
    (``top`` or ``group_hits``), see ``search.scored``.
    """
    roles = {"pos": list(positive or []), "neg": list(negative or [])}
    if strategy not in ("average_vector", "best_score"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "average_vector" and not roles["pos"]:
        raise ValueError("average_vector needs at least one positive example")
    if not roles["pos"] and not roles["neg"]:
        raise ValueError("recommend needs examples")
    spec = coll.vector(using)
    ex = X.examples_frame(coll, roles, using, lookup_from)
    excl = X.example_ids(roles) if lookup_from is None else []
    df = _candidates(coll, filter, excl)
    if strategy == "average_vector":
        q = X.scalar_array(_target_frame(ex), "target")
        return scored(coll, df, q, using=using, with_payload=with_payload,
                      with_vector=with_vector), spec.distance
    # example norms are computed once by Spark inside the (request-sized) example array,
    # each point's norm once per row: one array pass per (point, example) pair
    arr = X.scalar_array(ex.agg(F.collect_list(F.struct("role", "vec", D.norm(F.col("vec")).alias("norm")))
                                .alias("a")), "a")
    df = df.withColumn("_ex", arr).withColumn("_vn", D.norm(F.col(spec.column)))
    s = best_score_expr(F.col(spec.column), F.col("_ex"), spec.distance, F.col("_vn"))
    out = project(coll, df, with_payload, with_vector, extra=[F.round(s, D.SCORE_DIGITS).alias("score")])
    return out, D.COSINE  # best_score: higher is better for every distance


def similarity(vec: Column, other: Column, distance: str, vec_norm: Column | None = None,
               other_norm: Column | None = None) -> Column:
    """Raw similarity where higher is better: the score, or -distance.

    With cosine, precomputed norms (``vec_norm``, ``other_norm``) save two array passes.
    """
    if D.canonical(distance) == D.COSINE and vec_norm is not None and other_norm is not None:
        return F.when((vec_norm > 0) & (other_norm > 0), D.dot(vec, other) / (vec_norm * other_norm))
    raw = D.raw_score(vec, other, distance)
    return raw if D.higher_is_better(distance) else -raw


def best_score_expr(vec: Column, examples: Column, distance: str, vec_norm: Column | None = None) -> Column:
    def best(role):
        return F.array_max(F.transform(F.filter(examples, lambda e: e["role"] == role),
                                       lambda e: similarity(vec, e["vec"], distance, vec_norm,
                                                            e["norm"] if vec_norm is not None else None)))
    p, n = best("pos"), best("neg")
    return (F.when(n.isNull(), D.sigmoid(p))
             .when(p.isNull(), -D.sigmoid(n))
             .when(p > n, D.sigmoid(p))
             .otherwise(-D.sigmoid(n)))


def recommend(coll: Collection, positive=(), negative=(), strategy: str = "average_vector", *,
              limit: int = 10, offset: int = 0, engine: str = "auto", **kw) -> DataFrame:
    """Top ``limit`` recommended points: ``id, <payload>, score``.

    ``average_vector`` is an ordinary nearest search for the Rocchio target, so it
    follows ``search``'s ``engine`` choice (the kernel from ``KERNEL_MIN_DIM`` dims).
    """
    from pointframe.operators.search import _kernel_search, use_kernel
    if strategy == "average_vector" and use_kernel(coll, kw.get("using"), engine) and kw.get("lookup_from") is None:
        roles = {"pos": list(positive or []), "neg": list(negative or [])}
        if not roles["pos"]:
            raise ValueError("average_vector needs at least one positive example")
        ex = X.examples_frame(coll, roles, kw.get("using"))
        target = _target_frame(ex).select(F.col("target").alias("vector"))
        points = _candidates(coll, kw.get("filter"), X.example_ids(roles))
        return _kernel_search(coll, target, using=kw.get("using"), limit=limit, offset=offset, filter=None,
                              points=points, with_payload=kw.get("with_payload", True),
                              with_vector=kw.get("with_vector", False), score_threshold=kw.get("score_threshold"))
    s, dist = recommend_scored(coll, positive, negative, strategy, **kw)
    return top(s, dist, limit, offset, kw.get("score_threshold"))


def recommend_batch(coll: Collection, requests: list[dict], *, using: str | None = None,
                    **kw) -> DataFrame:
    """Many ``average_vector`` recommendations as one k-NN job.

    Targets are computed per request by one grouped aggregation; the k-NN kernel
    fetches ``limit + number of example ids`` per request so that excluding the
    examples afterwards still leaves an exact top ``limit``.
    """
    from pointframe.operators import kernel
    spark = coll.df.sparkSession
    spec = coll.vector(using)
    reqs, excl_rows, limits = [], [], []
    for qid, r in enumerate(requests):
        bad = set(r) - {"positive", "negative", "limit", "strategy"}
        if bad:
            raise ValueError(f"request {qid}: unknown keys {sorted(bad)}")
        if r.get("strategy", "average_vector") != "average_vector":
            raise ValueError("recommend_batch runs the average_vector strategy")
        roles = {"pos": list(r.get("positive") or []), "neg": list(r.get("negative") or [])}
        if not roles["pos"]:
            raise ValueError(f"request {qid}: needs a positive example")
        reqs.append((qid, roles))
        ids = X.example_ids(roles)
        excl_rows += [(qid, str(i)) for i in ids]
        limits.append((qid, int(r.get("limit", 10)), int(r.get("limit", 10)) + len(set(ids))))
    ex = X.examples_table(coll, reqs, using)  # one scan resolves every example id
    targets = _target_frame(ex, ["query_id"])
    lim = spark.createDataFrame(limits, "query_id long, limit int, fetch int")
    queries = targets.join(lim, "query_id")
    cands = kernel.knn(coll.df, coll.id, spec.column, queries, query_vec="target", k="fetch",
                       distance=spec.distance, dim=spec.size, **kw)
    if excl_rows:
        # example ids come from the requests: a request-sized broadcast
        ex_df = F.broadcast(spark.createDataFrame(excl_rows, "query_id long, ex_id string"))
        cands = cands.join(ex_df, (cands.query_id == ex_df.query_id) &
                           (cands.id.cast("string") == ex_df.ex_id), "left_anti")
    from pyspark.sql import Window
    w = Window.partitionBy("query_id").orderBy(*D.order_columns(spec.distance))
    out = (cands.drop("rank").join(lim.select("query_id", "limit"), "query_id")
                .withColumn("rank", F.row_number().over(w)))
    return out.filter(F.col("rank") <= F.col("limit")).select("query_id", "id", "score", F.col("rank").cast("long").alias("rank"))
