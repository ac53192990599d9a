"""The universal ``query`` request (Q6-Q15) as a composition of the operators.

A request is the API's JSON-able dict. Each kind of ``query`` maps to one
operator; ``prefetch`` runs inner requests first and either restricts the outer
query to their candidates (a semi join on at most sum-of-limits ids, broadcast)
or fuses their rankings. Nothing here plans or optimises: every branch is an
ordinary DataFrame and Catalyst plans the whole tree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointframe.functions import distance as D
from pointframe.operators import discover as XD
from pointframe.operators import recommend as R
from pointframe.operators import search as S
from pointframe.plans import fusion as FU
from pointframe.sources.collection import Collection

REQUEST_KEYS = {"query", "prefetch", "using", "filter", "params", "score_threshold", "limit",
                "offset", "with_payload", "with_vector", "lookup_from"}
DEFAULT_PREFETCH_LIMIT = 10


def _kind(q) -> str:
    if q is None:
        return "none"
    if isinstance(q, (list, tuple)):
        return "vector"
    if isinstance(q, dict):
        if set(q) == {"indices", "values"}:
            return "sparse"
        if len(q) != 1:
            raise ValueError(f"query must have exactly one kind, got {sorted(q)}")
        return next(iter(q))
    return "nearest_id"


def run(coll: Collection, request: dict, *, lookup: dict[str, Collection] | None = None,
        sparse_postings: DataFrame | None = None, candidates: DataFrame | None = None) -> tuple[DataFrame, str]:
    """Evaluate one request: ``(df, distance)`` where df has ``id, score?, <payload>``."""
    bad = set(request) - REQUEST_KEYS
    if bad:
        raise ValueError(f"unknown request keys {sorted(bad)}")
    limit = int(request.get("limit", 10))
    offset = int(request.get("offset", 0))
    using = request.get("using")
    filt = request.get("filter")
    payload = request.get("with_payload", True)
    with_vector = request.get("with_vector", False)
    thr = request.get("score_threshold")
    S.check_params(request.get("params"))

    def above(df: DataFrame) -> DataFrame:
        return df if thr is None else df.filter(F.col("score") >= thr)

    def no_threshold() -> None:
        if thr is not None:
            raise ValueError("score_threshold needs a query that scores points")

    src = None
    lf = request.get("lookup_from")
    if lf:
        src_coll = (lookup or {}).get(lf["collection"])
        if src_coll is None:
            raise ValueError(f"lookup_from collection {lf['collection']!r} not provided")
        src = (src_coll, lf.get("vector"))
    base = coll
    if candidates is not None:
        # restrict to prefetch candidates: at most sum of inner limits ids -> broadcast is bounded
        base = coll.with_df(coll.df.join(F.broadcast(candidates.select(F.col("id").alias(coll.id))),
                                         coll.id, "left_semi"))
    q = request.get("query")
    prefetch = request.get("prefetch")
    if prefetch:
        pre = prefetch if isinstance(prefetch, list) else [prefetch]
        branches = []
        for p in pre:
            p = dict(p)
            p.setdefault("limit", DEFAULT_PREFETCH_LIMIT)
            p["with_payload"] = False
            branches.append(run(base, p, lookup=lookup, sparse_postings=sparse_postings))
        kind = _kind(q)
        if kind == "fusion":
            fused = FU.rrf(branches) if q["fusion"] == "rrf" else (
                FU.dbsf(branches) if q["fusion"] == "dbsf" else None)
            if fused is None:
                raise ValueError(f"unknown fusion {q['fusion']!r}")
            if filt:  # of the fused ids those that meet the request's own filter
                fused = fused.join(S.filtered(base, filt).select(F.col(base.id).alias("id")), "id", "left_semi")
            top = FU.top_per_query(fused, limit, offset).select("id", "score")
            if thr is not None:
                top = top.filter(F.col("score") >= thr)
            cols = S.payload_columns(coll, payload) + S.vector_columns(coll, with_vector)
            if not cols:
                return top, D.COSINE
            attach = coll.df.select(F.col(coll.id).alias("id"), *cols)
            return top.join(attach, "id"), D.COSINE
        cand = None
        for df, _ in branches:
            ids = df.select("id")
            cand = ids if cand is None else cand.unionByName(ids)
        inner = dict(request)
        inner.pop("prefetch")
        return run(coll, inner, lookup=lookup, sparse_postings=sparse_postings, candidates=cand)
    kind = _kind(q)
    common = dict(limit=limit, offset=offset, with_payload=payload, with_vector=with_vector)
    if src is not None and kind in ("vector", "order_by", "sample", "none"):
        raise ValueError("lookup_from needs a query by id")
    if kind == "vector":
        return S.search(base, list(q), using=using, filter=filt, score_threshold=thr, **common), \
            base.vector(using).distance
    if kind in ("nearest", "nearest_id"):
        target = q["nearest"] if kind == "nearest" else q
        if isinstance(target, (list, tuple)):
            return S.search(base, list(target), using=using, filter=filt, score_threshold=thr, **common), \
                base.vector(using).distance
        if src is not None:
            return S.query_by_id(base, target, using=using, filter=filt, score_threshold=thr,
                                 lookup_from=src[0], lookup_using=src[1], **common), base.vector(using).distance
        return S.query_by_id(base, target, using=using, filter=filt, score_threshold=thr, **common), \
            base.vector(using).distance
    if kind == "recommend":
        r = q["recommend"]
        if set(r) - {"positive", "negative", "strategy"}:
            raise ValueError(f"unknown recommend keys {sorted(r)}")
        df = R.recommend(base, r.get("positive"), r.get("negative"), r.get("strategy", "average_vector"),
                         using=using, filter=filt, score_threshold=thr,
                         lookup_from=src[0] if src else None, **common)
        return df, (base.vector(using).distance if r.get("strategy", "average_vector") == "average_vector"
                    else D.COSINE)
    if kind == "discover":
        x = q["discover"]
        return above(XD.discover(base, x["target"], x["context"], using=using, filter=filt,
                                 lookup_from=src[0] if src else None, **common)), D.COSINE
    if kind == "context":
        x = q["context"]
        ctx = x["context"] if isinstance(x, dict) else x
        return above(XD.context_search(base, ctx, using=using, filter=filt,
                                       lookup_from=src[0] if src else None, **common)), D.COSINE
    if kind == "order_by":
        no_threshold()
        return S.scroll(base, filter=filt, limit=limit, skip=offset, order_by=q["order_by"], with_payload=payload,
                        with_vector=with_vector), D.COSINE
    if kind == "sample":
        if q["sample"] != "random":
            raise ValueError("sample must be 'random'")
        no_threshold()
        return S.sample(base, limit=limit, skip=offset, filter=filt, with_payload=payload, with_vector=with_vector), D.COSINE
    if kind == "sparse":
        if src is not None:
            raise ValueError("lookup_from needs a query by id")
        if sparse_postings is None:
            from pointframe.operators.sparse_kernel import search_sparse
            return search_sparse(base, q, using=using, filter=filt, score_threshold=thr, **common), D.COSINE
        from pointframe.operators import sparse as SP
        post = sparse_postings
        if candidates is not None or filt:
            keep = S.filtered(base, filt).select(F.col(base.id).alias("id"))
            post = post.join(keep, "id", "left_semi")
        hits = above(SP.sparse_search(post, q, limit=offset + limit).offset(offset))
        cols = S.payload_columns(base, payload) + S.vector_columns(base, with_vector)
        if cols:  # at most limit rows, in their order again
            hits = hits.join(base.df.select(F.col(base.id).alias("id"), *cols), "id").orderBy(F.col("score").desc(), "id")
        return hits, D.COSINE
    if kind == "none":
        no_threshold()
        return S.scroll(base, filter=filt, limit=limit, skip=offset, with_payload=payload, with_vector=with_vector), D.COSINE
    raise ValueError(f"unsupported query kind {kind!r}")


def query(coll: Collection, request: dict | None = None, **kw) -> DataFrame:
    """Universal query: ``query(coll, {"query": [...], "limit": 5, ...})`` or keyword form."""
    req = dict(request or {})
    req.update(kw)
    lookup = req.pop("lookup", None)
    postings = req.pop("sparse_postings", None)
    return run(coll, req, lookup=lookup, sparse_postings=postings)[0]


def query_batch(coll: Collection, requests: list[dict], **kw) -> DataFrame:
    """Many universal queries (Q15): ``query_id, id, score``.

    Plain dense-vector requests (optionally filtered) share one scan through the
    k-NN kernel; every other request is planned on its own and the results are
    unioned by name.
    """
    from pointframe.operators.batch import search_batch
    dense, other = [], []
    for i, r in enumerate(requests):
        simple = (_kind(r.get("query")) == "vector" and not r.get("prefetch") and not r.get("offset")
                  and r.get("score_threshold") is None and set(r) <= {"query", "limit", "filter", "using"})
        (dense if simple else other).append((i, r))
    parts = []
    if dense:
        using = {r.get("using") for _, r in dense}
        if len(using) == 1:
            reqs = [{"vector": r["query"], "limit": r.get("limit", 10), **({"filter": r["filter"]} if r.get("filter") else {})}
                    for _, r in dense]
            got = search_batch(coll, reqs, using=next(iter(using)))
            remap = coll.df.sparkSession.createDataFrame([(j, i) for j, (i, _) in enumerate(dense)],
                                                         "query_id long, orig long")
            parts.append(got.join(F.broadcast(remap), "query_id")
                            .select(F.col("orig").alias("query_id"), "id", "score"))
        else:
            other = dense + other
    for i, r in other:
        r = dict(r)
        r["with_payload"] = False
        df, _ = run(coll, r, **kw)
        if "score" not in df.columns:
            df = df.withColumn("score", F.lit(None).cast("double"))
        parts.append(df.select(F.lit(i).cast("long").alias("query_id"), "id", "score"))
    if not parts:
        kind = coll.df.schema[coll.id].dataType.simpleString()
        return coll.df.sparkSession.createDataFrame([], f"query_id long, id {kind}, score double")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
