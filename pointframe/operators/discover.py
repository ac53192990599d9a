"""Discovery and context search.

Definitions (our decision; the API names the operations only):
  * pair score: +1 when a point is more similar to the pair's positive than to its
    negative, -1 when less, 0 on a tie;
  * ``discover(target, context)``: score = sum of pair scores + sigma(sim(target)),
    so points are ordered by pairs won minus lost, then by similarity to the target;
  * ``context(context)``: score = sum over pairs of min(sim(pos) - sim(neg), 0)
    (a triplet-loss style penalty, Schroff et al. 2015); 0 is the best.
sigma(x) = 0.5 (1 + x / (1 + |x|)). Similarity = score, or -distance.
Example ids (target and context) are excluded from the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointframe.functions import distance as D
from pointframe.operators import examples as X
from pointframe.operators.kernel import TopK, _matrix, arrow_ids, id_array, score_matrix, usable_rows
from pointframe.operators.recommend import similarity
from pointframe.operators.search import filtered, point_vector, project, top
from pointframe.session import ship_package
from pointframe.sources.collection import Collection


def _pairs_roles(context: list[dict]) -> dict[str, list]:
    pos, neg = [], []
    for pr in context:
        if set(pr) - {"positive", "negative"}:
            raise ValueError(f"context pair keys must be positive/negative, got {sorted(pr)}")
        pos.append(pr["positive"])
        neg.append(pr["negative"])
    return {"pos": pos, "neg": neg}


def _pairs_array(coll: Collection, context: list[dict], using, lookup_from) -> Column:
    """Scalar subquery: ``array<struct<p: array<double>, n: array<double>>>`` of the pairs."""
    ex = X.examples_frame(coll, _pairs_roles(context), using, lookup_from)
    p = ex.filter(F.col("role") == "pos").select("ord", F.col("vec").alias("p"), D.norm(F.col("vec")).alias("pn"))
    n = ex.filter(F.col("role") == "neg").select("ord", F.col("vec").alias("n"), D.norm(F.col("vec")).alias("nn"))
    pairs = p.join(n, "ord").agg(F.collect_list(F.struct("p", "n", "pn", "nn")).alias("a"))
    return X.scalar_array(pairs, "a")


def _pair_sum(vec: Column, pairs: Column, distance: str, fn, vn: Column | None) -> Column:
    return F.aggregate(F.transform(pairs, lambda pr: fn(similarity(vec, pr["p"], distance, vn, pr["pn"]),
                                                         similarity(vec, pr["n"], distance, vn, pr["nn"]))),
                       F.lit(0.0), lambda a, b: a + b)


def discover_score(vec: Column, target: Column, pairs: Column, distance: str,
                   vn: Column | None = None, tn: Column | None = None) -> Column:
    rank = _pair_sum(vec, pairs, distance, lambda sp, sn: F.signum(sp - sn), vn)
    return rank + D.sigmoid(similarity(vec, target, distance, vn, tn))


def context_score(vec: Column, pairs: Column, distance: str, vn: Column | None = None) -> Column:
    return _pair_sum(vec, pairs, distance, lambda sp, sn: F.least(sp - sn, F.lit(0.0)), vn)


def _excluded(target, context) -> list:
    ids = [] if isinstance(target, (list, tuple)) or target is None else [target]
    return ids + X.example_ids(_pairs_roles(context))


def discover(coll: Collection, target, context: list[dict], *, using: str | None = None,
             limit: int = 10, offset: int = 0, filter: dict | None = None, with_payload=True,
             with_vector=False, lookup_from: Collection | None = None) -> DataFrame:
    """Top points near ``target`` inside the region set by the context pairs."""
    spec = coll.vector(using)
    df = filtered(coll, filter)
    if lookup_from is None:
        excl = _excluded(target, context)
        if excl:
            df = df.filter(~F.col(coll.id).isin(excl))
    tgt = (F.lit([float(x) for x in target]) if isinstance(target, (list, tuple))
           else point_vector(coll, target, using, lookup_from))
    df = (df.withColumn("_t", tgt).withColumn("_pairs", _pairs_array(coll, context, using, lookup_from))
            .withColumn("_vn", D.norm(F.col(spec.column))))
    df = df.withColumn("_tn", D.norm(F.col("_t")))
    s = discover_score(F.col(spec.column), F.col("_t"), F.col("_pairs"), spec.distance, F.col("_vn"), F.col("_tn"))
    out = project(coll, df, with_payload, with_vector, extra=[F.round(s, D.SCORE_DIGITS).alias("score")])
    return top(out, D.COSINE, limit, offset)


def context_search(coll: Collection, context: list[dict], *, using: str | None = None,
                   limit: int = 10, offset: int = 0, filter: dict | None = None, with_payload=True,
                   with_vector=False, lookup_from: Collection | None = None) -> DataFrame:
    """Context-only query (X2): points that violate the fewest pair constraints."""
    spec = coll.vector(using)
    df = filtered(coll, filter)
    if lookup_from is None:
        excl = _excluded(None, context)
        if excl:
            df = df.filter(~F.col(coll.id).isin(excl))
    df = (df.withColumn("_pairs", _pairs_array(coll, context, using, lookup_from))
            .withColumn("_vn", D.norm(F.col(spec.column))))
    s = context_score(F.col(spec.column), F.col("_pairs"), spec.distance, F.col("_vn"))
    out = project(coll, df, with_payload, with_vector, extra=[F.round(s, D.SCORE_DIGITS).alias("score")])
    return top(out, D.COSINE, limit, offset)


def discover_batch(coll: Collection, requests: list[dict], *, using: str | None = None) -> DataFrame:
    """Many discover requests in one scan of the points (X3): ``query_id, id, score, rank``.

    Every example vector of every request is stacked into one matrix that is
    broadcast (its size is the request size); each Arrow batch of points is
    scored against it with one matrix multiply, pair scores and target terms are
    combined per request, and a local top-k per request is kept. A final window
    per request cuts to ``limit``.
    """
    spark = coll.df.sparkSession
    ship_package(spark)
    spec = coll.vector(using)
    reqs, meta = [], []
    for qid, r in enumerate(requests):
        if set(r) - {"target", "context", "limit"}:
            raise ValueError(f"request {qid}: unknown keys {sorted(r)}")
        roles = _pairs_roles(r["context"])
        roles["target"] = [r["target"]]
        reqs.append((qid, roles))
        meta.append((qid, len(r["context"]), int(r.get("limit", 10)), _excluded(r["target"], r["context"])))
    ex = X.examples_table(coll, reqs, using)  # one scan resolves every example id
    # bounded by the requests themselves: (#requests x (1 + 2 x #pairs)) vectors
    et = ex.select("query_id", "role", "ord", "vec").toArrow()
    E = _matrix(et.column("vec"))
    e_q = et.column("query_id").to_numpy(zero_copy_only=False).astype(np.int64)
    e_role = np.array(et.column("role").to_pylist())
    e_ord = et.column("ord").to_numpy(zero_copy_only=False).astype(np.int64)
    nq = len(requests)
    k = np.array([m[2] for m in meta], dtype=np.int64)
    excl = {m[0]: set(m[3]) for m in meta}
    bc = spark.sparkContext.broadcast((E, e_q, e_role, e_ord, k, excl))
    dist = spec.distance
    higher = D.higher_is_better(dist)

    def run(batches):
        E_, eq, er, eo, kk, ex_ids = bc.value
        top_ = TopK(kk, True)
        for b in batches:
            if b.num_rows == 0:
                continue
            ok = usable_rows(b.column("pvec"), E_.shape[1])
            if not ok.all():
                b = b.filter(pa.array(ok))
            if b.num_rows == 0:
                continue
            P = _matrix(b.column("pvec"))
            ids = id_array(b.column("id"))
            S = score_matrix(E_, P, dist)          # (examples x points)
            S = S if higher else -S
            out = np.full((nq, len(ids)), np.nan)
            for q in range(nq):
                sel = eq == q
                t = S[sel & (er == "target")]
                if len(t) == 0:
                    continue
                rank = np.zeros(len(ids))
                pos_rows = np.flatnonzero(sel & (er == "pos"))
                for pr in pos_rows:
                    nr = np.flatnonzero(sel & (er == "neg") & (eo == eo[pr]))
                    if len(nr):
                        rank += np.sign(S[pr] - S[nr[0]])
                tv = t[0]
                out[q] = rank + 0.5 * (1.0 + tv / (1.0 + np.abs(tv)))
                if ex_ids.get(q):
                    out[q, np.isin(ids, np.array(list(ex_ids[q]), dtype=ids.dtype if ids.dtype.kind == "i" else np.str_))] = np.nan
            top_.add_scores(out, np.arange(nq), ids)
        qi, pid, raw = top_.result()
        if len(qi):
            yield pa.RecordBatch.from_arrays([pa.array(qi.astype(np.int64)), arrow_ids(pid), pa.array(raw)],
                                             names=["query_id", "id", "raw"])

    id_type = "string" if coll.df.schema[coll.id].dataType.simpleString() == "string" else "long"
    pts = coll.df.select(F.col(coll.id).cast(id_type).alias("id"), F.col(spec.column).alias("pvec"))
    cands = pts.mapInArrow(run, f"query_id long, id {id_type}, raw double")
    lim = spark.createDataFrame([(m[0], m[2]) for m in meta], "query_id long, limit int")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc())
    ranked = (cands.withColumn("score", F.round("raw", D.SCORE_DIGITS)).drop("raw")
                   .join(lim, "query_id").withColumn("rank", F.row_number().over(w)))
    return ranked.filter(F.col("rank") <= F.col("limit")).select("query_id", "id", "score", F.col("rank").cast("long").alias("rank"))
