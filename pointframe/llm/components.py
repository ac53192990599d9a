"""Connected components of an edge list in Spark: distributed union-find by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointframe.llm.common import materialize, scratch


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Smallest reachable vertex per vertex: rows (v, root) for every vertex of ``edges`` (a, b).

    Every round each vertex hooks its root to the smallest root among its
    neighbours and then jumps to its root's root, so paths shorten by half and
    more; rounds are written below the shared folder, which cuts the lineage.
    Minima are combined map-side, so a vertex with very many edges is no
    bottleneck on the aggregating side. Vertices may be of any ordered type;
    loops and repeated edges change nothing.
    """
    with scratch() as keep:
        return keep(_components(edges, max_rounds), "components")


def _components(edges: DataFrame, max_rounds: int) -> DataFrame:
    both = edges.select("a", "b").where("a != b").distinct()
    both = materialize(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    if both.isEmpty():
        return both.select(F.col("a").alias("v"), F.col("b").alias("root"))
    roots = materialize(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("root")), "roots")
    for _ in range(max_rounds):
        near = (both.join(roots.select(F.col("v").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("m"))
                .select(F.col("a").alias("v"), "m"))
        found = roots.join(near, "v").select("v", "root", "m")
        # the root of a vertex learns the smallest root its members see, and so does the vertex
        hooks = found.select(F.col("root").alias("v"), "m").unionByName(found.select("v", "m")).groupBy("v").agg(F.min("m").alias("m"))
        hooked = roots.join(hooks, "v", "left").select("v", "root", F.least("root", "m").alias("next"))
        with scratch() as keep:
            hooked = materialize(hooked, "hooked")
            up = hooked.select(F.col("v").alias("next"), F.col("next").alias("top"))
            jumped = hooked.join(up, "next", "left").select("v", "root", F.coalesce("top", "next").alias("new"))
            jumped = keep(jumped, "jumped")
        roots = jumped.select("v", F.col("new").alias("root"))
        if jumped.where("new != root").isEmpty():
            return roots
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
