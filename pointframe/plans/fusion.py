"""Rank fusion of several result lists (Q12, Q13).

* ``rrf``: score = sum over branches of 1 / (k + rank), k = 60, rank from 1
  (Cormack, Clarke and Buettcher, SIGIR 2009).
* ``dbsf``: each branch's scores are scaled by its own mean +/- 3 sample standard
  deviations to [0, 1] (clipped; a branch with zero spread gives 0.5), then summed.
Every branch is cut to its own limit before fusion, so each holds at most
``limit`` rows per query; rankings are computed per ``query_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointframe.functions import distance as D

RRF_K = 60


def _tag(branches: list[tuple[DataFrame, str]]) -> DataFrame:
    out = None
    for b, (df, dist) in enumerate(branches):
        qid = F.col("query_id") if "query_id" in df.columns else F.lit(0).cast("long")
        # similarity direction: higher is better inside fusion
        s = F.col("score") if D.higher_is_better(dist) else -F.col("score")
        t = df.select(qid.alias("query_id"), "id", s.alias("s"), F.lit(b).alias("branch"))
        out = t if out is None else out.unionByName(t)
    return out


def rrf(branches: list[tuple[DataFrame, str]], k: int = RRF_K) -> DataFrame:
    """``query_id, id, score`` by reciprocal rank fusion of ``(df, distance)`` branches."""
    t = _tag(branches)
    w = Window.partitionBy("query_id", "branch").orderBy(F.col("s").desc(), F.col("id").asc())
    r = t.withColumn("r", F.row_number().over(w))
    return (r.groupBy("query_id", "id").agg(F.sum(F.lit(1.0) / (F.lit(k) + F.col("r"))).alias("raw"))
             .select("query_id", "id", F.round("raw", D.SCORE_DIGITS).alias("score")))


def dbsf(branches: list[tuple[DataFrame, str]]) -> DataFrame:
    """``query_id, id, score`` by distribution-based score fusion."""
    t = _tag(branches)
    stats = t.groupBy("query_id", "branch").agg(F.avg("s").alias("mu"), F.stddev_samp("s").alias("sd"))
    j = t.join(stats, ["query_id", "branch"])
    lo = F.col("mu") - 3 * F.col("sd")
    hi = F.col("mu") + 3 * F.col("sd")
    norm = (F.when(F.col("sd").isNull() | (F.col("sd") == 0), F.lit(0.5))
             .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("s") - lo) / (hi - lo)))))
    return (j.groupBy("query_id", "id").agg(F.sum(norm).alias("raw"))
             .select("query_id", "id", F.round("raw", D.SCORE_DIGITS).alias("score")))


def top_per_query(df: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """Cut fused scores to ``limit`` per query (after ``offset``), ordered by score, id."""
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc())
    r = df.withColumn("rank", F.row_number().over(w))
    return r.filter((F.col("rank") > offset) & (F.col("rank") <= offset + limit)) \
            .withColumn("rank", (F.col("rank") - offset).cast("long"))
