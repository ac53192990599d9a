"""Registered Spark queries over the driver's tables: name -> (spark, sf_dir) -> DataFrame.

Each query runs over whole tables; a limit appears only where it is the
operator's feature (top-k, a page, a sample).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pointframe.operators import search as S
from pointframe.sources.collection import make_collection
from workload import tables as W

QV = W.QUERY_VECTOR
REGISTRY: dict = {}


def register(name):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- step 0-1: search family

SEARCH_FILTER = {"must": [{"key": "label", "range": {"gte": 2}}],
                 "must_not": [{"key": "label", "match": {"value": 5}}]}


@register("search")
def q_search(spark, sf):
    return S.search(W.embeddings(spark, sf), QV, limit=10, filter=SEARCH_FILTER)


@register("search_threshold")
def q_search_threshold(spark, sf):
    return S.search(W.embeddings(spark, sf), QV, limit=100, score_threshold=0.15)


@register("search_offset")
def q_search_offset(spark, sf):
    return S.search(W.embeddings(spark, sf), QV, limit=10, offset=5)


@register("search_named")
def q_search_named(spark, sf):
    return S.search(W.named_embeddings(spark, sf), QV[32:], using="back", limit=10)


@register("query_vector")
def q_query_vector(spark, sf):
    return S.search(W.named_embeddings(spark, sf), QV[:32], using="front", limit=10,
                    with_payload=False)


@register("query_by_id")
def q_query_by_id(spark, sf):
    return S.query_by_id(W.embeddings(spark, sf), W.QUERY_POINT, limit=10)


@register("query_lookup_from")
def q_query_lookup_from(spark, sf):
    named = W.named_embeddings(spark, sf)
    return S.query_by_id(named, W.QUERY_POINT, using="front", limit=10,
                         lookup_from=named, lookup_using="back")


@register("get_points")
def q_get_points(spark, sf):
    ids = W.load(spark, sf, "labels").select("doc_id")
    return S.get_points(W.embeddings(spark, sf), ids)


@register("get_point")
def q_get_point(spark, sf):
    return S.get_point(W.embeddings(spark, sf), W.QUERY_POINT, with_vector=False)


@register("scroll")
def q_scroll(spark, sf):
    flt = {"must": [{"key": "label", "match": {"any": [0, 1, 2]}}]}
    return S.scroll(W.embeddings(spark, sf), filter=flt, offset=100, limit=20)


@register("scroll_next_offset")
def q_scroll_next(spark, sf):
    flt = {"must": [{"key": "label", "match": {"any": [0, 1, 2]}}]}
    return S.scroll_next_offset(W.embeddings(spark, sf), filter=flt, offset=100, limit=20)


def orders(spark, sf):
    return make_collection(W.load(spark, sf, "orders"), id="o_orderkey")


@register("scroll_order_by")
def q_scroll_order_by(spark, sf):
    return S.scroll(orders(spark, sf), limit=15,
                    order_by={"key": "o_totalprice", "direction": "desc", "start_from": 300000.0})


@register("query_order_by")
def q_query_order_by(spark, sf):
    return S.scroll(W.embeddings(spark, sf), limit=10, order_by={"key": "label", "start_from": 3})


@register("query_sample")
def q_query_sample(spark, sf):
    return S.sample(W.embeddings(spark, sf), limit=10, seed=42)


@register("count_exact")
def q_count_exact(spark, sf):
    return S.count(W.embeddings(spark, sf), {"must": [{"key": "label", "range": {"gte": 3, "lt": 8}}]})


@register("count_estimate")
def q_count_estimate(spark, sf):
    return S.count(W.embeddings(spark, sf), None, exact=False)


@register("payload_selector")
def q_payload_selector(spark, sf):
    ids = W.load(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select("l_orderkey")
    return S.get_points(orders(spark, sf), ids, with_payload={"include": ["o_orderstatus", "o_totalprice"]})


for _d in ("cosine", "dot", "euclid", "manhattan"):
    def _mk(d):
        def fn(spark, sf):
            return S.scores(W.embeddings(spark, sf), QV, distance=d)
        return fn
    REGISTRY[f"dist_{_d}"] = _mk(_d)


# ---------------------------------------------------------------- step 2: filters

def customers(spark, sf):
    return make_collection(W.customers_geo(spark, sf), id="c_custkey")


def parts(spark, sf):
    return make_collection(W.load(spark, sf, "part"), id="p_partkey")


FILTERS = {
    "filter_must": ("customers", {"must": [{"key": "c_mktsegment", "match": {"value": "BUILDING"}},
                                           {"key": "c_acctbal", "range": {"gt": 0}}]}),
    "filter_must_not": ("customers", {"must_not": [{"key": "c_nationkey", "match": {"any": [1, 2, 3]}}]}),
    "filter_should": ("customers", {"should": [{"key": "c_mktsegment", "match": {"value": "AUTOMOBILE"}},
                                               {"key": "c_acctbal", "range": {"lt": 0}}]}),
    "filter_min_should": ("customers", {"min_should": {"conditions": [
        {"key": "c_mktsegment", "match": {"value": "BUILDING"}},
        {"key": "c_acctbal", "range": {"gt": 5000}},
        {"key": "c_nationkey", "range": {"lt": 10}}], "min_count": 2}}),
    "filter_recursive": ("customers", {"must": [
        {"should": [{"key": "c_mktsegment", "match": {"value": "MACHINERY"}},
                    {"must": [{"key": "c_nationkey", "range": {"gte": 20}},
                              {"key": "c_acctbal", "range": {"lte": 1000}}]}]},
        {"must_not": [{"key": "c_acctbal", "range": {"lt": -500}}]}]}),
    "filter_match": ("events", {"must": [{"key": "event_type", "match": {"value": "click"}}]}),
    "filter_any": ("parts", {"must": [{"key": "p_brand", "match": {"any": ["Brand#4", "Brand#19", "Brand#7"]}}]}),
    "filter_except": ("parts", {"must": [{"key": "p_type", "match": {"except": ["MEDIUM", "LARGE", "SMALL"]}}]}),
    "filter_range": ("parts", {"must": [{"key": "p_size", "range": {"gte": 10, "lt": 20}},
                                        {"key": "p_retailprice", "range": {"lte": 950.5}}]}),
    "filter_datetime": ("orders", {"must": [{"key": "o_orderdate", "datetime_range": {
        "gte": "1996-03-01T00:00:00Z", "lt": "1997-01-01T00:00:00Z"}}]}),
    "filter_geo_box": ("customers", {"must": [{"key": "loc", "geo_bounding_box": {
        "top_left": {"lat": 40.0, "lon": -20.0}, "bottom_right": {"lat": -10.0, "lon": 60.0}}}]}),
    "filter_geo_box_antimeridian": ("customers", {"must": [{"key": "loc", "geo_bounding_box": {
        "top_left": {"lat": 60.0, "lon": 150.0}, "bottom_right": {"lat": 0.0, "lon": -160.0}}}]}),
    "filter_geo_radius": ("customers", {"must": [{"key": "loc", "geo_radius": {
        "center": {"lat": 10.0, "lon": 20.0}, "radius": 2500000.0}}]}),
    "filter_geo_polygon": ("customers", {"must": [{"key": "loc", "geo_polygon": {
        "exterior": {"points": [{"lon": -60.0, "lat": -30.0}, {"lon": 60.0, "lat": -30.0},
                                {"lon": 80.0, "lat": 40.0}, {"lon": 0.0, "lat": 70.0},
                                {"lon": -70.0, "lat": 35.0}, {"lon": -60.0, "lat": -30.0}]},
        "interiors": [{"points": [{"lon": -10.0, "lat": -5.0}, {"lon": 15.0, "lat": -5.0},
                                  {"lon": 15.0, "lat": 20.0}, {"lon": -10.0, "lat": 20.0}]}]}}]}),
    "filter_values_count": ("emb_payload", {"must": [{"key": "tags", "values_count": {"gte": 1}}]}),
    "filter_is_empty": ("emb_payload", {"must": [{"is_empty": {"key": "tags"}}]}),
    "filter_is_null": ("emb_payload", {"must": [{"is_null": {"key": "label_n"}}]}),
    "filter_array_match": ("emb_payload", {"must": [{"key": "tags", "match": {"value": 4}}],
                                           "must_not": [{"key": "label_n", "match": {"value": 3}}]}),
    "filter_has_id": ("embeddings", {"must": [{"has_id": [3, 14, 15, 92, 65, 35, 89, 79, 323, 846]}]}),
    "filter_nested": ("orders_nested", {"must": [{"nested": {"key": "items", "filter": {"must": [
        {"key": "qty", "range": {"gte": 45}}, {"key": "flag", "match": {"value": "R"}}]}}}]}),
    "filter_variant": ("events_variant", {"must": [{"key": "payload.k", "range": {"gt": 50}},
                                                   {"key": "event_type", "match": {"any": ["view", "click"]}}]}),
}


def filter_source(spark, sf, kind):
    if kind == "customers":
        return customers(spark, sf), True
    if kind == "parts":
        return parts(spark, sf), True
    if kind == "orders":
        return orders(spark, sf), True
    if kind == "events":
        return make_collection(W.load(spark, sf, "events"), id="event_id"), ["event_type", "value"]
    if kind == "emb_payload":
        return W.embeddings_payload(spark, sf), True
    if kind == "embeddings":
        return W.embeddings(spark, sf), True
    if kind == "orders_nested":
        return make_collection(W.orders_nested(spark, sf), id="o_orderkey"), ["o_totalprice"]
    if kind == "events_variant":
        return make_collection(W.events_variant(spark, sf), id="event_id"), ["event_type", "value"]
    raise KeyError(kind)


def _filter_query(kind, spec):
    def fn(spark, sf):
        coll, payload = filter_source(spark, sf, kind)
        if kind == "customers":
            payload = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
        return S.select_points(coll, spec, with_payload=payload)
    return fn


for _name, (_kind, _spec) in FILTERS.items():
    REGISTRY[_name] = _filter_query(_kind, _spec)


@register("filter_text")
def q_filter_text(spark, sf):
    docs = make_collection(W.load(spark, sf, "documents"), id="doc_id")
    return S.select_points(docs, {"must": [{"key": "text", "match": {"text": "the with"}},
                                           {"key": "lang", "match": {"value": "en"}}]},
                           with_payload=["lang", "source"])


# ---------------------------------------------------------------- step 3: kernel, batch, matrix

from pointframe.operators import batch as B  # noqa: E402


def _self_queries(coll):
    return coll.df.select(F.col(coll.id).alias("query_id"), F.col("embedding").alias("vector"))


@register("search_batch")
def q_search_batch(spark, sf):
    e = W.embeddings(spark, sf)
    return B.knn_join(e, _self_queries(e), k=10)


@register("search_batch_blocked")
def q_search_batch_blocked(spark, sf):
    _shared_folder(spark)
    e = W.embeddings(spark, sf)
    return B.knn_join(e, _self_queries(e), k=10, max_broadcast_bytes=128 * 8 * 64)


@register("search_batch_euclid")
def q_search_batch_euclid(spark, sf):
    e = W.embeddings_as(spark, sf, "Euclid")
    q = e.df.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"),
                    F.col("vec_id").alias("self_id"))
    return B.knn_join(e, q, k=5, exclude="self_id")


BATCH_REQUESTS = [
    {"vector": QV, "limit": 5, "filter": {"must": [{"key": "label", "range": {"gte": 5}}]}},
    {"vector": QV[::-1], "limit": 10},
    {"vector": [-x for x in QV], "limit": 3, "filter": {"must": [{"key": "label", "match": {"any": [1, 2]}}]}},
    {"vector": QV, "limit": 4, "filter": {"must": [{"key": "label", "range": {"gte": 5}}]}},
]


@register("search_batch_requests")
def q_search_batch_requests(spark, sf):
    return B.search_batch(W.embeddings(spark, sf), BATCH_REQUESTS)


# ---------------------------------------------------------------- step 3b/4: matrix, groups, recommend, discover

from pointframe.operators import discover as XD  # noqa: E402
from pointframe.operators import groups as G  # noqa: E402
from pointframe.operators import matrix as M  # noqa: E402
from pointframe.operators import recommend as R  # noqa: E402

MATRIX = {"sample": 200, "limit": 50, "seed": 7}


@register("matrix_pairs")
def q_matrix_pairs(spark, sf):
    _shared_folder(spark)
    return M.matrix_pairs(W.embeddings(spark, sf), **MATRIX)


@register("matrix_pairs_blocked")
def q_matrix_pairs_blocked(spark, sf):
    """The same pairs from blocks of seven points."""
    _shared_folder(spark)
    return M.matrix_pairs(W.embeddings(spark, sf), **MATRIX, block=7)


@register("matrix_offsets")
def q_matrix_offsets(spark, sf):
    _shared_folder(spark)
    return M.matrix_offsets(W.embeddings(spark, sf), **MATRIX)


@register("matrix_ids")
def q_matrix_ids(spark, sf):
    return M.matrix_ids(W.embeddings(spark, sf), sample=MATRIX["sample"], seed=MATRIX["seed"])


@register("query_groups")
def q_query_groups(spark, sf):
    return G.query_groups(W.embeddings(spark, sf), QV, group_by="label", group_size=3, limit=4)


@register("query_groups_array")
def q_query_groups_array(spark, sf):
    return G.query_groups(W.embeddings_payload(spark, sf), QV, group_by="tags", group_size=2, limit=5,
                          with_payload=["tags"])


@register("query_groups_lookup")
def q_query_groups_lookup(spark, sf):
    nation = make_collection(W.load(spark, sf, "nation"), id="n_nationkey")
    return G.query_groups(W.embeddings(spark, sf), QV, group_by="label", group_size=2, limit=3,
                          lookup=nation, lookup_payload=["n_name"])


REC_POS, REC_NEG = [7, 42, 99], [3, 250]


@register("recommend_average")
def q_recommend_average(spark, sf):
    return R.recommend(W.embeddings(spark, sf), REC_POS, REC_NEG, "average_vector", limit=10)


@register("recommend_best_score")
def q_recommend_best_score(spark, sf):
    return R.recommend(W.embeddings(spark, sf), [7, 42], [3, 250, 400], "best_score", limit=10)


REC_BATCH = [{"positive": [7, 42, 99], "negative": [3, 250], "limit": 5},
             {"positive": [11], "limit": 4},
             {"positive": [100, 200], "negative": [300], "limit": 6}]


@register("recommend_batch")
def q_recommend_batch(spark, sf):
    return R.recommend_batch(W.embeddings(spark, sf), REC_BATCH)


@register("recommend_groups")
def q_recommend_groups(spark, sf):
    e = W.embeddings(spark, sf)
    s, dist = R.recommend_scored(e, REC_POS, REC_NEG, "average_vector")
    return G.group_hits(s, "label", dist, group_size=2, limit=3)


CONTEXT = [{"positive": 42, "negative": 3}, {"positive": 99, "negative": 250}]


@register("discover")
def q_discover(spark, sf):
    return XD.discover(W.embeddings(spark, sf), W.QUERY_POINT, CONTEXT, limit=10)


@register("context_search")
def q_context_search(spark, sf):
    ctx = CONTEXT + [{"positive": 11, "negative": 12}]
    return XD.context_search(W.embeddings(spark, sf), ctx, limit=10)


DISCOVER_BATCH = [{"target": 7, "context": CONTEXT, "limit": 5},
                  {"target": 300, "context": [{"positive": 11, "negative": 12}], "limit": 3}]


@register("discover_batch")
def q_discover_batch(spark, sf):
    return XD.discover_batch(W.embeddings(spark, sf), DISCOVER_BATCH)


import tempfile  # noqa: E402
import uuid  # noqa: E402

from pointframe.session import checkpoint_dir, ensure_checkpoint_dir  # noqa: E402


def _shared_folder(spark):
    """The session's shared folder; a folder of its own only for a local master without the setting."""
    if spark.sparkContext.master.startswith("local["):
        ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="pointframe-"))
    else:
        checkpoint_dir(spark)


# ---------------------------------------------------------------- step 5: prefetch, fusion, sparse

from pointframe.operators import sparse as SP  # noqa: E402
from pointframe.operators import sparse_kernel as SK  # noqa: E402
from pointframe.plans import query as PQ  # noqa: E402

PREFETCH = [{"query": QV[:32], "using": "front", "limit": 30},
            {"query": QV[32:], "using": "back", "limit": 30}]


@register("query_prefetch")
def q_query_prefetch(spark, sf):
    return PQ.query(W.multi_embeddings(spark, sf), {"prefetch": PREFETCH, "query": QV, "limit": 10})


@register("fusion_rrf")
def q_fusion_rrf(spark, sf):
    return PQ.query(W.multi_embeddings(spark, sf), {"prefetch": PREFETCH, "query": {"fusion": "rrf"}, "limit": 10})


@register("fusion_dbsf")
def q_fusion_dbsf(spark, sf):
    return PQ.query(W.multi_embeddings(spark, sf), {"prefetch": PREFETCH, "query": {"fusion": "dbsf"}, "limit": 10})


@register("fusion_filtered")
def q_fusion_filtered(spark, sf):
    """The request's own filter holds for what is fused, whatever its branches found."""
    return PQ.query(W.multi_embeddings(spark, sf), {"prefetch": PREFETCH, "query": {"fusion": "rrf"}, "limit": 10,
                                                    "filter": {"must": [{"key": "label", "range": {"gte": 3}}]}})


@register("search_not_finite")
def q_search_not_finite(spark, sf):
    """Every fifth vector has a component that is no number: no score, on either engine."""
    e = W.embeddings(spark, sf)
    odd = F.transform("embedding", lambda x, i: F.when((F.col("vec_id") % 5 == 0) & (i == 3), F.lit(float("nan")).cast("float")).otherwise(x))
    coll = e.with_df(e.df.withColumn("embedding", odd))
    one = S.search(coll, QV, limit=10, engine="expression").withColumn("engine", F.lit("expression"))
    return one.unionByName(S.search(coll, QV, limit=10, engine="kernel").withColumn("engine", F.lit("kernel")))


QUERY_BATCH = [
    {"query": QV, "limit": 5},
    {"query": [-x for x in QV], "limit": 3, "filter": {"must": [{"key": "label", "range": {"lt": 4}}]}},
    {"query": {"nearest": W.QUERY_POINT}, "limit": 4},
    {"query": {"recommend": {"positive": [7, 42], "negative": [3]}}, "limit": 3},
]


@register("query_batch")
def q_query_batch(spark, sf):
    return PQ.query_batch(W.embeddings(spark, sf), QUERY_BATCH)


def doc_postings(spark, sf, tokenizer="word"):
    return SP.token_counts(W.load(spark, sf, "documents"), "doc_id", "text", tokenizer)


def bench_query(spark, sf, item=0):
    b = W.load(spark, sf, "benchmark").filter(F.col("item_id") == item)
    return SP.token_counts(b, "item_id", "text").select("idx", F.col("val").cast("double").alias("qval"))


@register("sparse_vectors")
def q_sparse_vectors(spark, sf):
    sv = SP.text_to_sparse(W.load(spark, sf, "documents"), "doc_id", "text")
    return sv.select("id", F.col("sparse.indices").alias("indices"), F.col("sparse.values").alias("values"))


def packed_documents(spark, sf):
    """``documents`` as packed sparse vectors, read and tokenised once into a table below the shared folder."""
    _shared_folder(spark)
    path = f"{checkpoint_dir(spark)}/packed-{uuid.uuid4().hex}"
    SK.pack_text(W.load(spark, sf, "documents"), "doc_id", "text").write.parquet(path)
    return spark.read.parquet(path)


@register("sparse_search")
def q_sparse_search(spark, sf):
    _shared_folder(spark)
    docs = SK.pack_text(W.load(spark, sf, "documents"), "doc_id", "text")
    query = bench_query(spark, sf).withColumn("query_id", F.lit(0))
    return SK.sparse_topk(docs, query, 10).select("id", "score")


@register("sparse_idf")
def q_sparse_idf(spark, sf):
    query = bench_query(spark, sf).withColumn("query_id", F.lit(0))
    return SK.sparse_topk(packed_documents(spark, sf), query, 10, modifier="idf").select("id", "score")


def item_queries(spark, sf):
    return SP.token_counts(W.load(spark, sf, "benchmark"), "item_id", "text").select(
        F.col("id").alias("query_id"), "idx", F.col("val").cast("double").alias("qval"))


@register("sparse_search_batch")
def q_sparse_search_batch(spark, sf):
    _shared_folder(spark)
    docs = SK.pack_text(W.load(spark, sf, "documents"), "doc_id", "text")
    return SK.sparse_topk(docs, item_queries(spark, sf), 5)


@register("sparse_idf_batch")
def q_sparse_idf_batch(spark, sf):
    return SK.sparse_topk(packed_documents(spark, sf), item_queries(spark, sf), 5, modifier="idf")


SPARSE_FILTER = {"must": [{"key": "lang", "match": {"value": "en"}}]}


@register("sparse_payload")
def q_sparse_payload(spark, sf):
    """A collection's sparse vector, with filter and payload, through the universal query."""
    _shared_folder(spark)
    docs = W.load(spark, sf, "documents")
    vec = SK.pack_text(docs, "doc_id", "text").select(F.col("id").alias("doc_id"), F.struct("indices", "values").alias("words"))
    coll = make_collection(docs.select("doc_id", "lang", "source").join(vec, "doc_id", "left"), id="doc_id", sparse={"words": "words"})
    return PQ.query(coll, {"query": {"indices": W.SPARSE_QUERY[0], "values": W.SPARSE_QUERY[1]}, "using": "words", "filter": SPARSE_FILTER,
                           "limit": 10, "offset": 2, "with_payload": ["source"]})


# ---------------------------------------------------------------- step 7: indexes, profile, shards, stats

from pointframe.operators import indexes as IX  # noqa: E402
from pointframe.operators import stats as ST  # noqa: E402
from pointframe.sources import profile as PF  # noqa: E402


def _docs(spark, sf):
    return W.load(spark, sf, "documents")


for _tok, _kw in {"word": {}, "whitespace": {}, "multilingual": {},
                  "prefix": {"min_token_len": 2, "max_token_len": 4}}.items():
    def _mk_ti(tok, kw):
        def fn(spark, sf):
            return IX.text_dictionary(IX.text_postings(_docs(spark, sf), "doc_id", "text", tok, **kw))
        return fn
    REGISTRY[f"text_index_{_tok}"] = _mk_ti(_tok, _kw)


@register("text_search")
def q_text_search(spark, sf):
    return IX.text_search(IX.text_postings(_docs(spark, sf), "doc_id", "text"), "the with and")


@register("value_index")
def q_value_index(spark, sf):
    return IX.value_index_stats(W.load(spark, sf, "customer"), "c_custkey", "c_mktsegment")


@register("value_index_array")
def q_value_index_array(spark, sf):
    return IX.value_index_stats(W.embeddings_payload(spark, sf).df, "vec_id", "tags")


@register("range_layout")
def q_range_layout(spark, sf):
    laid = IX.range_layout(W.load(spark, sf, "orders"), "o_totalprice", 8)
    return IX.range_layout_summary(laid, "o_totalprice")


@register("geo_cells")
def q_geo_cells(spark, sf):
    return IX.geo_cells(W.customers_geo(spark, sf), "c_custkey", "loc", 10.0)


@register("geo_radius_cells")
def q_geo_radius_cells(spark, sf):
    idx = IX.geo_cell_index(W.customers_geo(spark, sf), "c_custkey", "loc", 10.0)
    return IX.geo_radius_by_cells(idx, {"lat": 10.0, "lon": 20.0}, 2500000.0, 10.0)


CAST_SCHEMA = {"o_orderpriority": "integer", "o_totalprice": "float", "o_orderdate": "datetime",
               "o_orderstatus": "keyword"}


@register("cast_payload")
def q_cast_payload(spark, sf):
    return IX.cast_payload(W.load(spark, sf, "orders"), CAST_SCHEMA)[1]


@register("collection_profile")
def q_collection_profile(spark, sf):
    return PF.collection_profile(W.multi_embeddings(spark, sf))


@register("payload_schema")
def q_payload_schema(spark, sf):
    return PF.payload_schema(make_collection(W.customers_geo(spark, sf), id="c_custkey"))


@register("payload_schema_variant")
def q_payload_schema_variant(spark, sf):
    return PF.variant_payload_schema(W.events_variant(spark, sf), "payload")


@register("shard_distribution")
def q_shard_distribution(spark, sf):
    return PF.shard_distribution(W.load(spark, sf, "customer"), "c_nationkey")


@register("drop_shard_key")
def q_drop_shard_key(spark, sf):
    return PF.drop_shard_key(W.load(spark, sf, "customer"), "c_nationkey", 3) \
        .select("c_custkey", "c_nationkey")


def _events(spark, sf):
    return W.load(spark, sf, "events")


@register("response_stats")
def q_response_stats(spark, sf):
    return ST.response_stats(_events(spark, sf), "event_type", "value")


@register("response_stats_windowed")
def q_response_stats_windowed(spark, sf):
    return ST.response_stats_windowed(_events(spark, sf), "ts", "event_type", "value", "1 day")


@register("response_stats_sliding")
def q_response_stats_sliding(spark, sf):
    return ST.response_stats_windowed(_events(spark, sf), "ts", "event_type", "value", "1 day", "12 hours")


@register("response_stats_session")
def q_response_stats_session(spark, sf):
    return ST.response_stats_windowed(_events(spark, sf), "ts", "event_type", "value",
                                      session_gap="30 minutes", key="user_id")


# ---------------------------------------------------------------- step 6: mutations

from pointframe.operators import mutate as U  # noqa: E402


def _emb_df(spark, sf):
    return W.load(spark, sf, "embeddings")


def _upsert_batch(spark, sf):
    e = _emb_df(spark, sf)
    upd = e.filter(F.col("vec_id") % 10 == 0).select("vec_id", "embedding", (F.col("label") + 100).alias("label"),
                                                     F.col("vec_id").alias("seq"))
    old = e.filter((F.col("vec_id") % 10 == 0)).select("vec_id", "embedding", F.lit(-1).alias("label"),
                                                       (F.col("vec_id") - 1).alias("seq"))
    ins = e.filter(F.col("vec_id") % 10 == 1).select((F.col("vec_id") + 100000).alias("vec_id"), "embedding",
                                                     "label", F.col("vec_id").alias("seq"))
    return upd.unionByName(old).unionByName(ins)


@register("upsert")
def q_upsert(spark, sf):
    return U.upsert(W.embeddings(spark, sf), _upsert_batch(spark, sf), seq="seq").df


@register("delete_points")
def q_delete_points(spark, sf):
    return U.delete_points(W.embeddings(spark, sf), ids=W.load(spark, sf, "labels").select("doc_id")).df


@register("delete_by_filter")
def q_delete_by_filter(spark, sf):
    return U.delete_points(W.embeddings(spark, sf), filter={"must": [{"key": "label", "range": {"gte": 8}}]}).df


@register("update_vectors")
def q_update_vectors(spark, sf):
    e = _emb_df(spark, sf)
    upd = (e.filter(F.col("vec_id") % 10 == 0).select("vec_id", F.reverse("embedding").alias("embedding"))
           .unionByName(e.filter(F.col("vec_id") % 10 == 0)
                        .select((F.col("vec_id") + 1000000).alias("vec_id"), "embedding")))
    return U.update_vectors(W.embeddings(spark, sf), upd).df


@register("delete_vectors")
def q_delete_vectors(spark, sf):
    return U.delete_vectors(W.embeddings(spark, sf), [""], filter={"must": [{"key": "label", "match": {"value": 3}}]}).df


@register("set_payload")
def q_set_payload(spark, sf):
    return U.set_payload(W.embeddings(spark, sf), {"label": 99, "flag": "hot"},
                         filter={"must": [{"key": "label", "match": {"value": 1}}]}).df


@register("set_payload_nested")
def q_set_payload_nested(spark, sf):
    c = make_collection(W.customers_geo(spark, sf).select("c_custkey", "c_nationkey", "loc"), id="c_custkey")
    out = U.set_payload(c, {"lat": 0.0}, key="loc",
                        filter={"must": [{"key": "c_nationkey", "match": {"value": 5}}]}).df
    return out.select("c_custkey", "c_nationkey", F.col("loc.lat").alias("lat"), F.col("loc.lon").alias("lon"))


@register("set_payload_variant")
def q_set_payload_variant(spark, sf):
    ev = make_collection(W.events_variant(spark, sf).select("event_id", "event_type", "payload"), id="event_id")
    out = U.set_payload(ev, {"k": 0, "flag": True}, variant_payload="payload",
                        filter={"must": [{"key": "event_type", "match": {"value": "error"}}]}).df
    return out.select("event_id", F.to_json("payload").alias("payload_json"))


@register("overwrite_payload")
def q_overwrite_payload(spark, sf):
    return U.overwrite_payload(W.embeddings_payload(spark, sf), {"label": -1},
                               filter={"must": [{"is_null": {"key": "label_n"}}]}).df


@register("delete_payload")
def q_delete_payload(spark, sf):
    return U.delete_payload(W.embeddings_payload(spark, sf), ["tags", "label_n"],
                            filter={"must": [{"key": "label", "range": {"gte": 5}}]}).df


@register("clear_payload")
def q_clear_payload(spark, sf):
    return U.clear_payload(W.embeddings_payload(spark, sf), ids=[0, 5, 10, 77],
                           filter={"must": [{"key": "label", "match": {"value": 9}}]}).df


def _batch_ops(spark, sf):
    e = _emb_df(spark, sf)
    ins = e.filter(F.col("vec_id") % 10 == 1).select((F.col("vec_id") + 100000).alias("vec_id"), "embedding", "label")
    return [
        {"upsert": {"points": ins}},
        {"delete": {"filter": {"must": [{"key": "label", "range": {"gte": 8}}]}}},
        {"set_payload": {"payload": {"label": 42}, "points": [2, 4, 6, 100002, 100011]}},
        {"delete_payload": {"keys": ["label"], "points": [0, 1], "filter": {"must": [{"key": "label", "match": {"value": 6}}]}}},
        {"update_vectors": {"points": e.filter(F.col("vec_id") % 50 == 0).select("vec_id", F.reverse("embedding").alias("embedding"))}},
    ]


@register("batch_update")
def q_batch_update(spark, sf):
    return U.batch_update(W.embeddings(spark, sf), _batch_ops(spark, sf), checkpoint_every=0).df


def changelog(spark, sf):
    e = _emb_df(spark, sf)
    v = F.col("vec_id")
    nul_vec = F.lit(None).cast("array<float>")
    parts = [
        e.filter(v % 10 == 0).select("vec_id", "embedding", (F.col("label") + 100).alias("label"), v.alias("seq"), F.lit("upsert").alias("op")),
        e.filter(v % 10 == 5).select("vec_id", nul_vec.alias("embedding"), F.lit(None).cast("int").alias("label"), v.alias("seq"), F.lit("delete").alias("op")),
        e.filter(v % 20 == 5).select("vec_id", "embedding", F.lit(500).alias("label"), (v + 1).alias("seq"), F.lit("upsert").alias("op")),
        e.filter(v % 10 == 1).select((v + 100000).alias("vec_id"), "embedding", "label", v.alias("seq"), F.lit("upsert").alias("op")),
        e.filter(v % 10 == 3).select("vec_id", nul_vec.alias("embedding"), F.lit(77).alias("label"), v.alias("seq"), F.lit("set_payload").alias("op")),
        e.filter(v % 10 == 0).select("vec_id", nul_vec.alias("embedding"), F.lit(55).alias("label"), (v + 2).alias("seq"), F.lit("set_payload").alias("op")),
        e.filter((v % 10 == 0) & (v > 0)).select("vec_id", nul_vec.alias("embedding"), F.lit(66).alias("label"), (v - 1).alias("seq"), F.lit("set_payload").alias("op")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("apply_changelog")
def q_apply_changelog(spark, sf):
    return U.apply_changelog(W.embeddings(spark, sf), changelog(spark, sf)).df


# operations that choose their points by a filter, between the events of the log
FILTERED_OPS = [{"seq": 60, "delete": {"filter": {"must": [{"key": "label", "range": {"gte": 105, "lt": 500}}]}}},
                {"seq": 120, "set_payload": {"payload": {"label": 1000}, "filter": {"must": [{"key": "label", "match": {"value": 77}}]}}},
                {"seq": 120, "clear_payload": {"filter": {"must": [{"key": "label", "range": {"lt": 2}}]}}}]


@register("apply_changelog_filters")
def q_apply_changelog_filters(spark, sf):
    _shared_folder(spark)
    return U.apply_staged_changelog(W.embeddings(spark, sf), changelog(spark, sf), FILTERED_OPS).df


# ---------------------------------------------------------------- step 8: ANN and quantization (rows-only + invariant tests)

from pointframe.operators import ann as A  # noqa: E402
from pointframe.operators import graph as GR  # noqa: E402
from pointframe.operators import quantize as Qz  # noqa: E402


@register("ann_ivf")
def q_ann_ivf(spark, sf):
    e = W.embeddings(spark, sf)
    cents, idx = A.build_ivf(e, n_cells=16, seed=3)
    return A.search_ivf(e.with_df(idx), cents, QV, nprobe=4, limit=10)


@register("search_indexed_only")
def q_search_indexed_only(spark, sf):
    e = W.embeddings(spark, sf)
    cents, idx = A.build_ivf(e, n_cells=8, seed=5)
    return A.search_ivf(e.with_df(idx), cents, QV, nprobe=8, limit=10, indexed_only=True)


@register("ann_lsh")
def q_ann_lsh(spark, sf):
    e = W.embeddings(spark, sf)
    idx, planes = A.build_lsh(e, tables=8, bits=8, seed=11)
    return A.search_lsh(e, idx, planes, QV, limit=10)


def _graph(spark, sf):
    """A stored graph over all embeddings; the cells' centroids are the points 0 to 7."""
    _shared_folder(spark)
    e = W.embeddings(spark, sf)
    cents = e.df.filter(F.col("vec_id") < 8).select(F.col("vec_id").cast("int").alias("cell"), F.col("embedding").alias("centroid"))
    return e, GR.build_graph(e, cents, f"{checkpoint_dir(spark)}/ann-{uuid.uuid4().hex}", degree=12, rounds=3, seed=7)


@register("ann_graph")
def q_ann_graph(spark, sf):
    """A beam as wide as a part reaches every point of the probed cells, so the answer is exact over them."""
    e, index = _graph(spark, sf)
    return S.search(e, QV, limit=10, filter={"must": [{"key": "label", "range": {"gte": 2}}]}, index=index, nprobe=3,
                    params={"exact": False, "hnsw_ef": 50_000, "indexed_only": True})


@register("ann_graph_beam")
def q_ann_graph_beam(spark, sf):
    e, index = _graph(spark, sf)
    return GR.probe_graph(index, [QV, [-x for x in QV], QV[32:] + QV[:32]], limit=10, nprobe=4, ef=100)


# fixed values: given bounds of the codes
SCALAR_BOUNDS = (-0.35, 0.35)


def _bounds(spark):
    return spark.range(1).select(F.lit(SCALAR_BOUNDS[0]).alias("lo"), F.lit(SCALAR_BOUNDS[1]).alias("hi"))


@register("quant_scalar_fitted")
def q_quant_scalar_fitted(spark, sf):
    """Bounds from the data; ten times the points of the result are scored exactly."""
    e = W.embeddings(spark, sf)
    b = Qz.scalar_bounds(e, 0.99)
    return Qz.quantized_search(Qz.scalar_quantize(e, b), QV, method="scalar", limit=10, bounds=b, oversampling=10.0)


@register("quant_scalar")
def q_quant_scalar(spark, sf):
    e, b = W.embeddings(spark, sf), _bounds(spark)
    return Qz.quantized_search(Qz.scalar_quantize(e, b), QV, method="scalar", limit=10, bounds=b, rescore=False)


@register("quant_binary")
def q_quant_binary(spark, sf):
    e = W.embeddings(spark, sf)
    return Qz.quantized_search(Qz.binary_quantize(e), QV, method="binary", limit=10, rescore=False)


def _given_books(spark, sf, m=8, k=16):
    """Codebooks by a rule: code j of every sub-space is that part of point j."""
    e = W.load(spark, sf, "embeddings").filter(F.col("vec_id") < k)
    sub = F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("sub")
    return e.select(sub, F.col("vec_id").cast("int").alias("code"), "embedding").select(
        "sub", "code", F.slice("embedding", F.col("sub") * (64 // m) + 1, F.lit(64 // m)).cast("array<double>").alias("centroid"))


def _pq(distance):
    def q(spark, sf):
        books = _given_books(spark, sf)
        coded = Qz.PQ.encode_pq(W.embeddings_as(spark, sf, distance), books)
        return Qz.quantized_search(coded, QV, method="pq", limit=10, codebooks=books, rescore=False)
    return q


for _distance in ("Cosine", "Dot", "Euclid", "Manhattan"):
    register("quant_pq" if _distance == "Cosine" else f"quant_pq_{_distance.lower()}")(_pq(_distance))


@register("quant_pq_rescore")
def q_quant_pq_rescore(spark, sf):
    """Codes choose 30 of the filtered points, the vectors rank them."""
    books = _given_books(spark, sf)
    coded = Qz.PQ.encode_pq(W.embeddings_as(spark, sf, "Euclid"), books)
    return Qz.quantized_search(coded, QV, method="pq", limit=10, codebooks=books, oversampling=3.0,
                               filter={"must": [{"key": "label", "range": {"gte": 2}}]})


@register("quant_rescore")
def q_quant_rescore(spark, sf):
    e, b = W.embeddings(spark, sf), _bounds(spark)
    return Qz.quantized_search(Qz.scalar_quantize(e, b), QV, method="scalar", limit=10, bounds=b,
                               oversampling=3.0, rescore=True)


# ---------------------------------------------------------------- step 9: sources, snapshots, streaming

from pointframe.sources import collection as SC  # noqa: E402
from pointframe.operators import sketches as SKC  # noqa: E402
from pointframe.sources import snapshot as SN  # noqa: E402
from pointframe.streaming import ops as STR  # noqa: E402


@register("validate_collection")
def q_validate_collection(spark, sf):
    return SC.validation_report(W.embeddings(spark, sf))


@register("validate_lineitem")
def q_validate_lineitem(spark, sf):
    li = W.load(spark, sf, "lineitem")
    return SC.validation_report(make_collection(li, id="l_orderkey"))


@register("from_batch")
def q_from_batch(spark, sf):
    e = _emb_df(spark, sf)
    # columnar batches of at most 16 points (the size of one request), built from the table
    blocks = (e.groupBy(F.floor(F.col("vec_id") / 16).alias("blk"))
               .agg(F.sort_array(F.collect_list(F.struct("vec_id", "embedding", "label"))).alias("b"))
               .select(F.transform("b", lambda x: x["vec_id"]).alias("ids"),
                       F.transform("b", lambda x: x["embedding"]).alias("vectors"),
                       F.transform("b", lambda x: x["label"]).alias("payloads")))
    return SC.from_batch(blocks)


@register("count_estimate_sketches")
def q_count_estimate_sketches(spark, sf):
    """Per label, and for pairs of a label and a tag, whether the estimate from sketches is near the exact count."""
    _shared_folder(spark)
    path = f"{checkpoint_dir(spark)}/sketches-{uuid.uuid4().hex}"
    coll = W.embeddings_payload(spark, sf)
    SKC.build_count_sketches(coll, ["label", "tags"], path, lg_k=14)
    out = None
    for label in range(4):
        for tags in (None, [label, label + 1]):
            must = [{"key": "label", "match": {"value": label}}] + ([{"key": "tags", "match": {"any": tags}}] if tags else [])
            exact = S.count(coll, {"must": must}).select(F.lit(label).alias("label"), F.lit(bool(tags)).alias("tagged"), "count")
            about = SKC.estimate_count(spark, path, {"must": must}).select("count").scalar()
            row = exact.withColumn("about", about)
            out = row if out is None else out.unionByName(row)
    return out.select("label", "tagged", "count", (F.abs(F.col("about") - F.col("count")) <= F.greatest(F.lit(3), 0.1 * F.col("count"))).alias("near"))


@register("snapshot_roundtrip")
def q_snapshot_roundtrip(spark, sf):
    _shared_folder(spark)
    path = f"{checkpoint_dir(spark)}/snapshot-{uuid.uuid4().hex}"
    SN.snapshot_write(W.embeddings(spark, sf).df, path, "embeddings", id="vec_id")
    return SN.snapshot_restore(spark, path)


@register("snapshot_damage")
def q_snapshot_damage(spark, sf):
    """The buckets that hold changed, lost or added rows, and how many rows they have."""
    _shared_folder(spark)
    path = f"{checkpoint_dir(spark)}/snapshot-{uuid.uuid4().hex}"
    df = W.embeddings(spark, sf).df
    SN.snapshot_write(df, path, "embeddings", id="vec_id")
    v = F.col("vec_id")
    other = df.filter(v % 101 != 50).withColumn("label", F.when(v % 97 == 0, F.lit(None)).otherwise(F.col("label")))
    other = other.unionByName(df.filter(v % 211 == 7).withColumn("vec_id", v + 1_000_000))
    return SN.damaged_buckets(spark, path, other)


@register("snapshot_checksum")
def q_snapshot_checksum(spark, sf):
    return SN.table_checksum(_emb_df(spark, sf))


@register("stream_response_stats")
def q_stream_response_stats(spark, sf):
    _shared_folder(spark)
    schema = W.load(spark, sf, "events").schema
    src = spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet")
    agg = STR.response_stats_stream(src, "ts", "event_type", "value", window="1 day", watermark="1 hour")
    name = "stats_" + uuid.uuid4().hex[:12]
    # complete mode keeps every window, so the order of the files does not matter; each
    # micro-batch replaces the table in the shared folder
    place = STR._location(spark, None, name)
    q = (agg.writeStream.outputMode("complete").option("checkpointLocation", place + "/ckpt")
         .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(place + "/table")).start())
    q.processAllAvailable()
    q.stop()
    return spark.read.parquet(place + "/table")


@register("stream_upsert")
def q_stream_upsert(spark, sf):
    _shared_folder(spark)
    schema = W.load(spark, sf, "embeddings").schema
    src = spark.readStream.schema(schema).parquet(f"{sf}/embeddings*.parquet")
    v = F.col("vec_id")
    changes = (src.filter(v % 10 == 0).select("vec_id", "embedding", (F.col("label") + 100).alias("label"))
               .unionByName(src.filter(v % 10 == 1).select((v + 100000).alias("vec_id"), "embedding", "label")))
    name = "upsert_" + uuid.uuid4().hex[:12]
    target = STR._location(spark, None, name) + "/table"
    q = STR.stream_upsert(changes, W.embeddings(spark, sf), target,
                          checkpoint_location=STR._location(spark, None, name) + "/ckpt")
    q.processAllAvailable()
    q.stop()
    return STR.read_state(spark, target)


@register("search_kernel")
def q_search_kernel(spark, sf):
    # the same filtered search as ``search``, scored by the Arrow kernel
    return S.search(W.embeddings(spark, sf), QV, limit=10, filter=SEARCH_FILTER, engine="kernel")


# ---------------------------------------------------------------- requests with offset, threshold, ids and payloads of other shapes

@register("query_order_by_offset")
def q_query_order_by_offset(spark, sf):
    return PQ.query(W.embeddings(spark, sf), {"query": {"order_by": {"key": "label", "start_from": 3}}, "limit": 10, "offset": 4})


CONTEXT_THRESHOLD = -0.02


@register("context_threshold")
def q_context_threshold(spark, sf):
    ctx = CONTEXT + [{"positive": 11, "negative": 12}]
    return PQ.query(W.embeddings(spark, sf), {"query": {"context": ctx}, "limit": 10, "score_threshold": CONTEXT_THRESHOLD})


@register("search_kernel_euclid")
def q_search_kernel_euclid(spark, sf):
    # components of the size of 1e4, so that a^2 + b^2 - 2ab would lose digits
    wide = _emb_df(spark, sf).withColumn("embedding", F.transform("embedding", lambda x: x.cast("double") * 10000.0))
    coll = make_collection(wide, id="vec_id", vectors={"": ("embedding", 64, "Euclid")})
    return S.search(coll, [x * 10000.0 for x in QV], limit=20, engine="kernel")


@register("search_string_ids")
def q_search_string_ids(spark, sf):
    named = _emb_df(spark, sf).withColumn("vec_id", F.concat(F.lit("p"), F.col("vec_id").cast("string")))
    coll = make_collection(named, id="vec_id", vectors={"": ("embedding", 64, "Cosine")})
    return S.search(coll, QV, limit=20, engine="kernel")


@register("search_batch_ties")
def q_search_batch_ties(spark, sf):
    # every vector comes four times under other ids: ties at every rank
    four = _emb_df(spark, sf).select(F.explode(F.array(*[F.col("vec_id") * 4 + i for i in range(4)])).alias("vec_id"), "embedding")
    coll = make_collection(four, id="vec_id", vectors={"": ("embedding", 64, "Cosine")})
    queries = _emb_df(spark, sf).where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return B.knn_join(coll, queries, k=6)


@register("query_groups_include")
def q_query_groups_include(spark, sf):
    return G.query_groups(W.embeddings(spark, sf), QV, group_by="label", group_size=3, limit=4, with_payload={"include": ["label"]})


@register("query_groups_array_dups")
def q_query_groups_array_dups(spark, sf):
    twice = _emb_df(spark, sf).withColumn("tags", F.array("label", "label", F.col("label") + 1))
    coll = make_collection(twice, id="vec_id", vectors={"": ("embedding", 64, "Cosine")})
    return G.query_groups(coll, QV, group_by="tags", group_size=3, limit=5, with_payload=["label"]).drop("tags")


def changelog_all_ops(spark, sf):
    """Every operation, with numbers below zero and an event that sets NULL."""
    e = _emb_df(spark, sf)
    v = F.col("vec_id")
    none = F.lit(None)

    def events(cond, op, seq, label=none, embedding=none, keys=None):
        k = F.array(*[F.lit(x) for x in keys]) if keys else F.lit(None)
        return e.filter(cond).select("vec_id", embedding.cast("array<float>").alias("embedding"), label.cast("int").alias("label"),
                                     seq.cast("long").alias("seq"), F.lit(op).alias("op"), k.cast("array<string>").alias("keys"))

    low = v - 100000
    parts = [events(v % 9 == 0, "upsert", low, F.lit(900), F.col("embedding")), events(v % 9 == 1, "delete", low),
             events(v % 9 == 2, "set_payload", low, keys=["label"]), events(v % 9 == 3, "overwrite_payload", low, F.lit(903)),
             events(v % 9 == 4, "clear_payload", low), events(v % 9 == 5, "delete_payload", low, keys=["label"]),
             events(v % 9 == 6, "update_vectors", low, embedding=F.reverse("embedding")), events(v % 9 == 7, "delete_vectors", low, keys=["embedding"]),
             events(v % 27 == 9, "set_payload", low, F.lit(77)), events(v % 27 == 13, "set_payload", low + 1, F.lit(78)),
             events(v % 27 == 1, "upsert", low + 1, F.lit(79), F.col("embedding"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("apply_changelog_all_ops")
def q_apply_changelog_all_ops(spark, sf):
    return U.apply_changelog(W.embeddings(spark, sf), changelog_all_ops(spark, sf)).df
