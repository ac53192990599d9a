"""Grouped search (Q16, Q17, R4): the best ``limit`` groups, each with its best ``group_size`` hits.

Groups are ranked by their best hit (ties: group value ascending); rows with a
null group value are dropped; an array-valued group field puts the point in
every group it lists. Physical plan: ``row_number`` per group cut at
``group_size`` - planned as ``WindowGroupLimit`` on both sides of the shuffle,
so even a group holding a third of all rows sends at most ``group_size`` rows
per map partition - then the top groups by ``TakeOrderedAndProject`` over the
rank-1 hits (``limit`` rows, so broadcasting them is bounded) joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointframe.functions import distance as D
from pointframe.operators.search import filtered, payload_columns, score_filter, scored
from pointframe.sources.collection import Collection


def group_hits(scored_df: DataFrame, group_by: str, distance: str, group_size: int = 3,
               limit: int = 10, score_threshold: float | None = None) -> DataFrame:
    """``group_id, group_rank, id, score, rank, <payload...>`` from a scored DataFrame.

    One chain over the scored points, one shuffle:
    ``row_number`` per group cut at ``group_size`` (``WindowGroupLimit`` before
    and after the shuffle) -> one row per group packing its hits (a list bounded
    by ``group_size``; the aggregation reuses the window's partitioning, so it
    adds no shuffle) -> the best ``limit`` groups by ``TakeOrderedAndProject``
    -> exploded back to hit rows. The vectors are scanned and scored once.
    """
    dtype = scored_df.schema[group_by].dataType
    g = F.explode_outer(F.array_distinct(group_by)) if isinstance(dtype, T.ArrayType) else F.col(group_by)
    s = scored_df.select("*", g.alias("group_id")).filter(F.col("group_id").isNotNull())
    higher = D.higher_is_better(distance)
    hw = Window.partitionBy("group_id").orderBy(*D.order_columns(distance))
    # NULL scores sort last and the threshold is monotone in the order: filtering after
    # the cut is exact and keeps the score expression out of a pushed-down filter
    hits = (s.withColumn("rank", F.row_number().over(hw)).filter(F.col("rank") <= group_size)
             .filter(score_filter(distance, score_threshold)))
    rest = [c for c in scored_df.columns if c not in ("id", "score")]
    packed = hits.groupBy("group_id").agg(
        (F.max if higher else F.min)("score").alias("best"),
        F.collect_list(F.struct(F.col("rank").cast("long").alias("rank"), "id", "score", *rest)).alias("_h"))
    order_best = F.col("best").desc() if higher else F.col("best").asc()
    top_groups = packed.orderBy(order_best, F.col("group_id").asc()).limit(limit)
    gw = Window.partitionBy(F.lit(0)).orderBy(order_best, F.col("group_id").asc())
    # at most ``limit`` rows after the top-k: the one-partition rank is bounded
    ranked_groups = top_groups.withColumn("group_rank", F.row_number().over(gw).cast("long"))
    out = ranked_groups.select("group_id", "group_rank", F.explode("_h").alias("h"))
    return out.select("group_id", "group_rank", F.col("h.id").alias("id"), F.col("h.score").alias("score"),
                      F.col("h.rank").alias("rank"), *[F.col("h." + c).alias(c) for c in rest])


def with_lookup(groups: DataFrame, lookup: Collection, with_payload=True, prefix: str = "lookup_",
                with_vectors=False) -> DataFrame:
    """Attach the lookup collection's record for each group id (Q17), left join.

    Only the ids of the selected groups (``limit`` of them) are broadcast; the
    lookup table is scanned once with a semi join on them.
    """
    from pointframe.operators.search import payload_columns, vector_columns
    cols = payload_columns(lookup, with_payload) + vector_columns(lookup, with_vectors)
    gids = groups.select(F.col("group_id").alias("_gid")).distinct()
    lk = (lookup.df.join(F.broadcast(gids), F.col(lookup.id) == F.col("_gid"), "left_semi")
                   .select(F.col(lookup.id).alias("_lk_id"), *[F.col(c).alias(prefix + c) for c in cols]))
    return groups.join(lk, groups.group_id == lk._lk_id, "left").drop("_lk_id")


def query_groups(coll: Collection, vector, *, group_by: str, group_size: int = 3, limit: int = 10,
                 using: str | None = None, filter: dict | None = None, with_payload=True,
                 score_threshold: float | None = None, lookup: Collection | None = None,
                 lookup_payload=True, lookup_vectors=False, engine: str = "auto") -> DataFrame:
    """Grouped nearest search (Q16), optionally with a lookup record per group (Q17)."""
    spec = coll.vector(using)
    payload = payload_columns(coll, with_payload)
    if group_by not in payload:
        payload = [*payload, group_by]
    s = scored(coll, filtered(coll, filter), vector, using=using, with_payload=payload, engine=engine)
    out = group_hits(s, group_by, spec.distance, group_size, limit, score_threshold)
    return with_lookup(out, lookup, lookup_payload, with_vectors=lookup_vectors) if lookup is not None else out
