"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code paths: plain SQL over the driver's
views. Scores are rounded to 6 digits and every ranking breaks ties by id, as
in the library.
"""

from __future__ import annotations

import math

from workload import spark_queries as SQ
from workload.tables import QUERY_POINT, QUERY_VECTOR, SPARSE_QUERY

ORACLE: dict[str, str] = {}


def vec_lit(v) -> str:
    return "[" + ", ".join(repr(float(x)) for x in v) + "]::DOUBLE[]"


QV = vec_lit(QUERY_VECTOR)


def d(col: str) -> str:
    return f"CAST({col} AS DOUBLE[])"


def dot(a: str, b: str) -> str:
    return f"list_dot_product({a}, {b})"


def cos(a: str, b: str) -> str:
    return f"({dot(a, b)} / (sqrt({dot(a, a)}) * sqrt({dot(b, b)})))"


def euclid(a: str, b: str) -> str:
    return f"list_distance({a}, {b})"


def manhattan(a: str, b: str) -> str:
    return f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: abs(({a})[i] - ({b})[i])))"


E = d("embedding")

# ---------------------------------------------------------------- search family

ORACLE["search"] = f"""
SELECT vec_id AS id, label, round({cos(E, QV)}, 6) AS score FROM embeddings
WHERE label >= 2 AND NOT coalesce(label = 5, false)
ORDER BY score DESC, id LIMIT 10"""

ORACLE["search_threshold"] = f"""
SELECT * FROM (SELECT vec_id AS id, label, round({cos(E, QV)}, 6) AS score FROM embeddings)
WHERE score >= 0.15 ORDER BY score DESC, id LIMIT 100"""

ORACLE["search_offset"] = f"""
SELECT vec_id AS id, label, round({cos(E, QV)}, 6) AS score FROM embeddings
ORDER BY score DESC, id LIMIT 10 OFFSET 5"""

ORACLE["search_named"] = f"""
SELECT vec_id AS id, label, round({euclid(d('embedding[33:64]'), vec_lit(QUERY_VECTOR[32:]))}, 6) AS score
FROM embeddings ORDER BY score ASC, id LIMIT 10"""

ORACLE["query_vector"] = f"""
SELECT vec_id AS id, round({cos(d('embedding[1:32]'), vec_lit(QUERY_VECTOR[:32]))}, 6) AS score
FROM embeddings ORDER BY score DESC, id LIMIT 10"""

_QP = f"(SELECT {E} FROM embeddings WHERE vec_id = {QUERY_POINT})"
ORACLE["query_by_id"] = f"""
SELECT vec_id AS id, label, round({cos(E, _QP)}, 6) AS score FROM embeddings
WHERE vec_id <> {QUERY_POINT} ORDER BY score DESC, id LIMIT 10"""

_QPB = f"(SELECT {d('embedding[33:64]')} FROM embeddings WHERE vec_id = {QUERY_POINT})"
ORACLE["query_lookup_from"] = f"""
SELECT vec_id AS id, label, round({cos(d('embedding[1:32]'), _QPB)}, 6) AS score FROM embeddings
ORDER BY score DESC, id LIMIT 10"""

ORACLE["get_points"] = """
SELECT vec_id AS id, label FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels)"""

ORACLE["get_point"] = f"SELECT vec_id AS id, label FROM embeddings WHERE vec_id = {QUERY_POINT}"

ORACLE["scroll"] = """
SELECT vec_id AS id, label FROM embeddings WHERE label IN (0, 1, 2) AND vec_id >= 100
ORDER BY id LIMIT 20"""

ORACLE["scroll_next_offset"] = """
SELECT CASE WHEN count(*) > 20 THEN max(id) END AS next_page_offset FROM (
  SELECT vec_id AS id FROM embeddings WHERE label IN (0, 1, 2) AND vec_id >= 100 ORDER BY id LIMIT 21)"""

ORACLE["scroll_order_by"] = """
SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_totalprice IS NOT NULL AND o_totalprice <= 300000.0
ORDER BY o_totalprice DESC, id LIMIT 15"""

ORACLE["query_order_by"] = """
SELECT vec_id AS id, label FROM embeddings WHERE label IS NOT NULL AND label >= 3
ORDER BY label, id LIMIT 10"""

ORACLE["query_sample"] = """
SELECT vec_id AS id, label FROM embeddings
ORDER BY md5(CAST(vec_id AS VARCHAR) || '42'), id LIMIT 10"""

ORACLE["count_exact"] = "SELECT count(*) AS count FROM embeddings WHERE label >= 3 AND label < 8"

ORACLE["payload_selector"] = """
SELECT o_orderkey AS id, o_orderstatus, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"""

ORACLE["dist_cosine"] = f"SELECT vec_id AS id, round({cos(E, QV)}, 6) AS score FROM embeddings"
ORACLE["dist_dot"] = f"SELECT vec_id AS id, round({dot(E, QV)}, 6) AS score FROM embeddings"
ORACLE["dist_euclid"] = f"SELECT vec_id AS id, round({euclid(E, QV)}, 6) AS score FROM embeddings"
ORACLE["dist_manhattan"] = f"SELECT vec_id AS id, round({manhattan(E, QV)}, 6) AS score FROM embeddings"

# ---------------------------------------------------------------- filters

CUST = """(SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
  (c_custkey * 37 % 18000) / 100e0 - 90 AS lat, (c_custkey * 91 % 36000) / 100e0 - 180 AS lon
  FROM customer)"""
CUST_COLS = "c_custkey AS id, c_name, c_nationkey, c_acctbal, c_mktsegment"
EMB_PAYLOAD = """(SELECT vec_id, label,
  CASE WHEN vec_id % 7 = 0 THEN NULL ELSE label END AS label_n,
  CASE WHEN vec_id % 5 = 0 THEN CAST([] AS INT[]) ELSE [label, label + 1] END AS tags
  FROM embeddings)"""


def cust(where: str) -> str:
    return f"SELECT {CUST_COLS} FROM {CUST} WHERE {where}"


def haversine_sql(lat: str, lon: str, clat: float, clon: float) -> str:
    r = 6371008.8
    return (f"(2 * {r!r} * asin(least(1.0, sqrt(pow(sin((radians({clat!r}) - radians({lat})) / 2), 2)"
            f" + cos(radians({lat})) * cos(radians({clat!r})) * pow(sin((radians({clon!r}) - radians({lon})) / 2), 2)))))")


def ring_sql(lat: str, lon: str, ring) -> str:
    """Even-odd ray cast: count edges crossed by a ray going west from the point."""
    pts = [(float(p["lon"]), float(p["lat"])) for p in ring]
    if pts[0] == pts[-1]:
        pts = pts[:-1]
    terms = []
    for i in range(len(pts)):
        x1, y1 = pts[i]
        x2, y2 = pts[(i + 1) % len(pts)]
        if y1 == y2:
            continue
        slope = (x2 - x1) / (y2 - y1)
        terms.append(f"CASE WHEN {lat} > {min(y1, y2)!r} AND {lat} <= {max(y1, y2)!r} AND "
                     f"{lon} < {x1!r} + ({lat} - {y1!r}) * {slope!r} THEN 1 ELSE 0 END")
    return "((" + " + ".join(terms) + ") % 2 = 1)"


_poly = SQ.FILTERS["filter_geo_polygon"][1]["must"][0]["geo_polygon"]
_rad = SQ.FILTERS["filter_geo_radius"][1]["must"][0]["geo_radius"]
_dlat = math.degrees(_rad["radius"] / 6371008.8)

ORACLE.update({
    "filter_must": cust("c_mktsegment = 'BUILDING' AND c_acctbal > 0"),
    "filter_must_not": cust("NOT coalesce(c_nationkey IN (1, 2, 3), false)"),
    "filter_should": cust("c_mktsegment = 'AUTOMOBILE' OR c_acctbal < 0"),
    "filter_min_should": cust("(CAST(coalesce(c_mktsegment = 'BUILDING', false) AS INT) + "
                              "CAST(coalesce(c_acctbal > 5000, false) AS INT) + "
                              "CAST(coalesce(c_nationkey < 10, false) AS INT)) >= 2"),
    "filter_recursive": cust("(c_mktsegment = 'MACHINERY' OR (c_nationkey >= 20 AND c_acctbal <= 1000)) "
                             "AND NOT coalesce(c_acctbal < -500, false)"),
    "filter_match": "SELECT event_id AS id, event_type, value FROM events WHERE event_type = 'click'",
    "filter_any": """SELECT p_partkey AS id, p_name, p_brand, p_type, p_size, p_retailprice FROM part
                     WHERE p_brand IN ('Brand#4', 'Brand#19', 'Brand#7')""",
    "filter_except": """SELECT p_partkey AS id, p_name, p_brand, p_type, p_size, p_retailprice FROM part
                        WHERE p_type IS NOT NULL AND p_type NOT IN ('MEDIUM', 'LARGE', 'SMALL')""",
    "filter_range": """SELECT p_partkey AS id, p_name, p_brand, p_type, p_size, p_retailprice FROM part
                       WHERE p_size >= 10 AND p_size < 20 AND p_retailprice <= 950.5""",
    "filter_datetime": """SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                          o_orderpriority FROM orders
                          WHERE o_orderdate >= TIMESTAMP '1996-03-01 00:00:00'
                            AND o_orderdate < TIMESTAMP '1997-01-01 00:00:00'""",
    "filter_geo_box": cust("lat <= 40.0 AND lat >= -10.0 AND lon >= -20.0 AND lon <= 60.0"),
    "filter_geo_box_antimeridian": cust("lat <= 60.0 AND lat >= 0.0 AND (lon >= 150.0 OR lon <= -160.0)"),
    "filter_geo_radius": cust(f"lat >= {10.0 - _dlat!r} AND lat <= {10.0 + _dlat!r} AND "
                              f"{haversine_sql('lat', 'lon', 10.0, 20.0)} <= 2500000.0"),
    "filter_geo_polygon": cust(ring_sql("lat", "lon", _poly["exterior"]["points"]) + " AND NOT " +
                               ring_sql("lat", "lon", _poly["interiors"][0]["points"])),
    "filter_values_count": f"SELECT vec_id AS id, label, label_n, tags FROM {EMB_PAYLOAD} WHERE coalesce(len(tags), 0) >= 1",
    "filter_is_empty": f"SELECT vec_id AS id, label, label_n, tags FROM {EMB_PAYLOAD} WHERE tags IS NULL OR len(tags) = 0",
    "filter_is_null": f"SELECT vec_id AS id, label, label_n, tags FROM {EMB_PAYLOAD} WHERE label_n IS NULL",
    "filter_array_match": f"""SELECT vec_id AS id, label, label_n, tags FROM {EMB_PAYLOAD}
                              WHERE list_contains(tags, 4) AND NOT coalesce(label_n = 3, false)""",
    "filter_has_id": "SELECT vec_id AS id, label FROM embeddings WHERE vec_id IN (3, 14, 15, 92, 65, 35, 89, 79, 323, 846)",
    "filter_nested": """SELECT o_orderkey AS id, o_totalprice FROM orders WHERE o_orderkey IN
                        (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 45 AND l_returnflag = 'R')""",
    "filter_variant": """SELECT event_id AS id, event_type, value FROM events
                         WHERE TRY_CAST(json_extract(props, '$.k') AS DOUBLE) > 50
                           AND event_type IN ('view', 'click')""",
    "filter_text": r"""SELECT doc_id AS id, lang, source FROM documents
                       WHERE list_has_all(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), ['the', 'with'])
                         AND lang = 'en'""",
})


# ---------------------------------------------------------------- kernel, batch, matrix

def self_knn(score_sql: str, k: int, direction: str = "DESC", exclude_self: bool = False) -> str:
    where = "WHERE q.vec_id <> p.vec_id" if exclude_self else ""
    return f"""
SELECT query_id, id, score, rank FROM (
  SELECT query_id, id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score {direction}, id) AS rank
  FROM (SELECT q.vec_id AS query_id, p.vec_id AS id, round({score_sql}, 6) AS score
        FROM embeddings q, embeddings p {where}))
WHERE rank <= {k}"""


_PE, _QE = d("p.embedding"), d("q.embedding")
ORACLE["search_batch"] = self_knn(cos(_PE, _QE), 10)
ORACLE["search_batch_blocked"] = ORACLE["search_batch"]
ORACLE["search_batch_euclid"] = self_knn(euclid(_PE, _QE), 5, "ASC", exclude_self=True)


def _batch_requests_sql() -> str:
    where = {0: "label >= 5", 1: "true", 2: "label IN (1, 2)", 3: "label >= 5"}
    parts = []
    for i, r in enumerate(SQ.BATCH_REQUESTS):
        parts.append(f"""
SELECT {i}::BIGINT AS query_id, id, score, rank FROM (
  SELECT vec_id AS id, round({cos(E, vec_lit(r['vector']))}, 6) AS score,
         row_number() OVER (ORDER BY round({cos(E, vec_lit(r['vector']))}, 6) DESC, vec_id) AS rank
  FROM embeddings WHERE {where[i]}) WHERE rank <= {r['limit']}""")
    return " UNION ALL ".join(parts)


ORACLE["search_batch_requests"] = _batch_requests_sql()


# ---------------------------------------------------------------- matrix, groups, recommend, discover

def sig(x: str) -> str:
    return f"(0.5 * (1 + ({x}) / (1 + abs({x}))))"


_M = SQ.MATRIX
_SAMPLE = f"""(SELECT vec_id, label, embedding FROM embeddings
  ORDER BY md5(CAST(vec_id AS VARCHAR) || '{_M['seed']}'), vec_id LIMIT {_M['sample']})"""
_PAIRS = f"""(SELECT a, b, score FROM (
  SELECT a.vec_id AS a, b.vec_id AS b, round({cos(d('a.embedding'), d('b.embedding'))}, 6) AS score
  FROM {_SAMPLE} a, {_SAMPLE} b WHERE a.vec_id < b.vec_id ORDER BY score DESC, a, b LIMIT {_M['limit']}))"""
ORACLE["matrix_pairs"] = f"SELECT a, b, score FROM {_PAIRS}"
ORACLE["matrix_pairs_blocked"] = ORACLE["matrix_pairs"]
_IDS = f"(SELECT row_number() OVER (ORDER BY vec_id) - 1 AS index, vec_id AS id FROM {_SAMPLE})"
ORACLE["matrix_ids"] = f"SELECT index, id FROM {_IDS}"
ORACLE["matrix_offsets"] = f"""
SELECT ra.index AS offsets_row, rb.index AS offsets_col, p.score FROM {_PAIRS} p
JOIN {_IDS} ra ON ra.id = p.a JOIN {_IDS} rb ON rb.id = p.b"""


def groups_sql(scored: str, group_col: str, size: int, limit: int, extra_cols: str) -> str:
    return f"""
WITH s AS ({scored}),
g AS (SELECT {group_col} AS group_id, max(score) AS best FROM s WHERE {group_col} IS NOT NULL
      GROUP BY {group_col} ORDER BY best DESC, group_id LIMIT {limit}),
gr AS (SELECT group_id, row_number() OVER (ORDER BY best DESC, group_id) AS group_rank FROM g),
h AS (SELECT s.*, gr.group_id, gr.group_rank,
             row_number() OVER (PARTITION BY gr.group_id ORDER BY s.score DESC, s.id) AS rank
      FROM s JOIN gr ON s.{group_col} = gr.group_id)
SELECT group_id, group_rank, id, score, rank{extra_cols} FROM h WHERE rank <= {size}"""


_SCORED = f"SELECT vec_id AS id, label, round({cos(E, QV)}, 6) AS score FROM embeddings"
ORACLE["query_groups"] = groups_sql(_SCORED, "label", 3, 4, ", label")
ORACLE["query_groups_array"] = f"""
WITH s0 AS (SELECT vec_id AS id, tags, round({cos(E, QV)}, 6) AS score FROM ({EMB_PAYLOAD.strip()[1:-1].replace('FROM embeddings', ', embedding FROM embeddings')})),
s AS (SELECT id, tags, score, unnest(tags) AS g FROM s0),
g AS (SELECT g AS group_id, max(score) AS best FROM s GROUP BY g ORDER BY best DESC, group_id LIMIT 5),
gr AS (SELECT group_id, row_number() OVER (ORDER BY best DESC, group_id) AS group_rank FROM g),
h AS (SELECT s.*, gr.group_id, gr.group_rank,
             row_number() OVER (PARTITION BY gr.group_id ORDER BY s.score DESC, s.id) AS rank
      FROM s JOIN gr ON s.g = gr.group_id)
SELECT group_id, group_rank, id, score, rank, tags FROM h WHERE rank <= 2"""
ORACLE["query_groups_lookup"] = f"""
SELECT q.*, n.n_name AS lookup_n_name FROM ({groups_sql(_SCORED, 'label', 2, 3, ', label')}) q
LEFT JOIN nation n ON n.n_nationkey = q.group_id"""


def _in(ids) -> str:
    return "(" + ", ".join(str(i) for i in ids) + ")"


def mean_target_sql(pos, neg) -> str:
    neg_part = f"UNION ALL SELECT 'neg' AS role, embedding FROM embeddings WHERE vec_id IN {_in(neg)}" if neg else ""
    tgt = "list_transform(range(1, 65), lambda i: 2 * p.v[i] - n.v[i])" if neg else "p.v"
    frm = "m p, m n WHERE p.role = 'pos' AND n.role = 'neg'" if neg else "m p WHERE p.role = 'pos'"
    return f"""(WITH ex AS (SELECT 'pos' AS role, embedding FROM embeddings WHERE vec_id IN {_in(pos)} {neg_part}),
dims AS (SELECT role, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM ex, range(1, 65) t(i) GROUP BY role, i),
m AS (SELECT role, list(x ORDER BY i) AS v FROM dims GROUP BY role)
SELECT {tgt} FROM {frm})"""


ORACLE["recommend_average"] = f"""
SELECT vec_id AS id, label, round({cos(E, mean_target_sql(SQ.REC_POS, SQ.REC_NEG))}, 6) AS score
FROM embeddings WHERE vec_id NOT IN {_in(SQ.REC_POS + SQ.REC_NEG)}
ORDER BY score DESC, id LIMIT 10"""

ORACLE["recommend_best_score"] = f"""
WITH ex AS (SELECT 'pos' AS role, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IN (7, 42)
            UNION ALL SELECT 'neg', CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id IN (3, 250, 400)),
s AS (SELECT p.vec_id AS id, p.label,
             max(CASE WHEN ex.role = 'pos' THEN {cos(d('p.embedding'), 'ex.v')} END) AS bp,
             max(CASE WHEN ex.role = 'neg' THEN {cos(d('p.embedding'), 'ex.v')} END) AS bn
      FROM embeddings p, ex WHERE p.vec_id NOT IN (7, 42, 3, 250, 400) GROUP BY p.vec_id, p.label)
SELECT id, label, round(CASE WHEN bn IS NULL THEN {sig('bp')} WHEN bp IS NULL THEN -{sig('bn')}
                             WHEN bp > bn THEN {sig('bp')} ELSE -{sig('bn')} END, 6) AS score
FROM s ORDER BY score DESC, id LIMIT 10"""


def _rec_batch_sql() -> str:
    parts = []
    for qid, r in enumerate(SQ.REC_BATCH):
        pos, neg = r["positive"], r.get("negative", [])
        excl = pos + neg
        parts.append(f"""
SELECT {qid}::BIGINT AS query_id, id, score, rank FROM (
  SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS rank FROM (
    SELECT vec_id AS id, round({cos(E, mean_target_sql(pos, neg))}, 6) AS score FROM embeddings
    WHERE vec_id NOT IN {_in(excl)})) WHERE rank <= {r['limit']}""")
    return " UNION ALL ".join(parts)


ORACLE["recommend_batch"] = _rec_batch_sql()
ORACLE["recommend_groups"] = groups_sql(
    f"""SELECT vec_id AS id, label, round({cos(E, mean_target_sql(SQ.REC_POS, SQ.REC_NEG))}, 6) AS score
        FROM embeddings WHERE vec_id NOT IN {_in(SQ.REC_POS + SQ.REC_NEG)}""", "label", 2, 3, ", label")


def _pairs_sql(context) -> str:
    vals = ", ".join(f"({c['positive']}, {c['negative']})" for c in context)
    return f"""(SELECT CAST(a.embedding AS DOUBLE[]) AS pv, CAST(b.embedding AS DOUBLE[]) AS nv
  FROM (VALUES {vals}) x(pid, nid) JOIN embeddings a ON a.vec_id = x.pid JOIN embeddings b ON b.vec_id = x.nid)"""


def discover_sql(target, context, limit, qid=None) -> str:
    excl = [target] + [c["positive"] for c in context] + [c["negative"] for c in context]
    P = d("p.embedding")
    t = f"(SELECT {E} FROM embeddings WHERE vec_id = {target})"
    inner = f"""
SELECT p.vec_id AS id, p.label,
       round(sum(sign({cos(P, 'pr.pv')} - {cos(P, 'pr.nv')})) + {sig(cos(P, t))}, 6) AS score
FROM embeddings p, {_pairs_sql(context)} pr WHERE p.vec_id NOT IN {_in(excl)}
GROUP BY p.vec_id, p.label, p.embedding"""
    if qid is None:
        return f"SELECT id, label, score FROM ({inner}) ORDER BY score DESC, id LIMIT {limit}"
    return f"""SELECT {qid}::BIGINT AS query_id, id, score, rank FROM (
      SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS rank FROM ({inner})) WHERE rank <= {limit}"""


ORACLE["discover"] = discover_sql(QUERY_POINT, SQ.CONTEXT, 10)
_CTX = SQ.CONTEXT + [{"positive": 11, "negative": 12}]
ORACLE["context_search"] = f"""
SELECT p.vec_id AS id, p.label,
       round(sum(least({cos(d('p.embedding'), 'pr.pv')} - {cos(d('p.embedding'), 'pr.nv')}, 0)), 6) AS score
FROM embeddings p, {_pairs_sql(_CTX)} pr
WHERE p.vec_id NOT IN {_in([c['positive'] for c in _CTX] + [c['negative'] for c in _CTX])}
GROUP BY p.vec_id, p.label ORDER BY score DESC, id LIMIT 10"""
ORACLE["discover_batch"] = " UNION ALL ".join(
    discover_sql(r["target"], r["context"], r["limit"], qid) for qid, r in enumerate(SQ.DISCOVER_BATCH))


# ---------------------------------------------------------------- prefetch, fusion, sparse

_FRONT = cos(d("embedding[1:32]"), vec_lit(QUERY_VECTOR[:32]))
_BACK = euclid(d("embedding[33:64]"), vec_lit(QUERY_VECTOR[32:]))
_BR = f"""
b0 AS (SELECT vec_id AS id, round({_FRONT}, 6) AS s FROM embeddings ORDER BY s DESC, id LIMIT 30),
b1 AS (SELECT vec_id AS id, -round({_BACK}, 6) AS s FROM embeddings ORDER BY s DESC, id LIMIT 30)"""
ORACLE["query_prefetch"] = f"""
WITH {_BR}
SELECT vec_id AS id, label, round({cos(E, QV)}, 6) AS score FROM embeddings
WHERE vec_id IN (SELECT id FROM b0 UNION SELECT id FROM b1) ORDER BY score DESC, id LIMIT 10"""
ORACLE["fusion_rrf"] = f"""
WITH {_BR},
r AS (SELECT id, row_number() OVER (ORDER BY s DESC, id) AS r FROM b0
      UNION ALL SELECT id, row_number() OVER (ORDER BY s DESC, id) FROM b1),
f AS (SELECT id, round(sum(1.0 / (60 + r)), 6) AS score FROM r GROUP BY id)
SELECT f.id, f.score, e.label FROM f JOIN embeddings e ON e.vec_id = f.id ORDER BY score DESC, id LIMIT 10"""
ORACLE["fusion_dbsf"] = f"""
WITH {_BR},
t AS (SELECT 0 AS b, id, s FROM b0 UNION ALL SELECT 1, id, s FROM b1),
st AS (SELECT b, avg(s) AS mu, stddev_samp(s) AS sd FROM t GROUP BY b),
n AS (SELECT t.id, CASE WHEN sd IS NULL OR sd = 0 THEN 0.5
                        ELSE least(1.0, greatest(0.0, (s - (mu - 3 * sd)) / ((mu + 3 * sd) - (mu - 3 * sd)))) END AS v
      FROM t JOIN st USING (b)),
f AS (SELECT id, round(sum(v), 6) AS score FROM n GROUP BY id)
SELECT f.id, f.score, e.label FROM f JOIN embeddings e ON e.vec_id = f.id ORDER BY score DESC, id LIMIT 10"""


def _qb_sql() -> str:
    q0 = f"""SELECT 0::BIGINT AS query_id, id, score FROM (SELECT vec_id AS id, round({cos(E, QV)}, 6) AS score
             FROM embeddings ORDER BY score DESC, id LIMIT 5)"""
    nq = vec_lit([-x for x in QUERY_VECTOR])
    q1 = f"""SELECT 1::BIGINT, id, score FROM (SELECT vec_id AS id, round({cos(E, nq)}, 6) AS score
             FROM embeddings WHERE label < 4 ORDER BY score DESC, id LIMIT 3)"""
    q2 = f"""SELECT 2::BIGINT, id, score FROM (SELECT vec_id AS id, round({cos(E, _QP)}, 6) AS score
             FROM embeddings WHERE vec_id <> {QUERY_POINT} ORDER BY score DESC, id LIMIT 4)"""
    q3 = f"""SELECT 3::BIGINT, id, score FROM (SELECT vec_id AS id, round({cos(E, mean_target_sql([7, 42], [3]))}, 6) AS score
             FROM embeddings WHERE vec_id NOT IN (7, 42, 3) ORDER BY score DESC, id LIMIT 3)"""
    return " UNION ALL ".join([q0, q1, q2, q3])


ORACLE["query_batch"] = _qb_sql()

_TOK = r"list_filter(regexp_split_to_array(lower({t}), '[^\p{{L}}\p{{N}}_]+'), lambda x: length(x) > 0)"


def postings_sql(table: str, id_col: str, text: str, tok: str = _TOK) -> str:
    return f"""(SELECT id, ('0x' || substr(md5(t), 1, 7))::INT AS idx, CAST(count(*) AS FLOAT) AS val FROM
  (SELECT {id_col} AS id, unnest({tok.format(t=text)}) AS t FROM {table}) GROUP BY id, idx)"""


_POST = postings_sql("documents", "doc_id", "text")
_BQ = f"(SELECT idx, CAST(val AS DOUBLE) AS qval FROM {postings_sql('benchmark WHERE item_id = 0', 'item_id', 'text')})"
ORACLE["sparse_vectors"] = f"""
SELECT id, list(idx ORDER BY idx) AS indices, list(val ORDER BY idx) AS values
FROM {_POST} GROUP BY id"""
ORACLE["sparse_search"] = f"""
SELECT p.id, round(sum(CAST(p.val AS DOUBLE) * q.qval), 6) AS score FROM {_POST} p JOIN {_BQ} q USING (idx)
GROUP BY p.id ORDER BY score DESC, id LIMIT 10"""
ORACLE["sparse_idf"] = f"""
WITH post AS {_POST}, q AS {_BQ},
n AS (SELECT count(DISTINCT id) AS n FROM post),
df AS (SELECT idx, count(DISTINCT id) AS df FROM post WHERE idx IN (SELECT idx FROM q) GROUP BY idx),
qw AS (SELECT q.idx, q.qval * ln((n.n - df.df + 0.5) / (df.df + 0.5) + 1) AS qval FROM q JOIN df USING (idx), n)
SELECT p.id, round(sum(CAST(p.val AS DOUBLE) * qw.qval), 6) AS score FROM post p JOIN qw USING (idx)
GROUP BY p.id ORDER BY score DESC, id LIMIT 10"""
ORACLE["sparse_search_batch"] = f"""
WITH post AS {_POST},
q AS (SELECT id AS query_id, idx, CAST(val AS DOUBLE) AS qval FROM {postings_sql('benchmark', 'item_id', 'text')}),
s AS (SELECT q.query_id, p.id, round(sum(CAST(p.val AS DOUBLE) * q.qval), 6) AS score
      FROM post p JOIN q USING (idx) GROUP BY q.query_id, p.id)
SELECT query_id, id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s) WHERE rank <= 5"""


# ---------------------------------------------------------------- indexes, profile, shards, stats

_TOKS = {
    "word": r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda x: length(x) > 0)",
    "whitespace": r"list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: length(x) > 0)",
    "multilingual": r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: length(x) > 0)",
}


def _dict_sql(tok_expr: str) -> str:
    return f"""
SELECT token, count(*) AS n_points, CAST(sum(tf) AS BIGINT) AS n_occurrences FROM (
  SELECT token, id, count(*) AS tf FROM (SELECT doc_id AS id, unnest({tok_expr}) AS token FROM documents)
  GROUP BY token, id) GROUP BY token"""


for _t, _e in _TOKS.items():
    ORACLE[f"text_index_{_t}"] = _dict_sql(_e)
_PREFIX = (r"flatten(list_transform(" + _TOKS["word"] +
           r", lambda w: list_transform(range(2, least(4, length(w)) + 1), lambda n: substr(w, 1, n))))")
ORACLE["text_index_prefix"] = _dict_sql(_PREFIX)
ORACLE["text_search"] = f"""
SELECT doc_id AS id FROM documents WHERE list_has_all({_TOKS['word']}, ['the', 'with', 'and'])"""
ORACLE["value_index"] = """SELECT c_mktsegment AS value, count(DISTINCT c_custkey) AS n_points FROM customer
                           WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment"""
ORACLE["value_index_array"] = f"""SELECT value, count(DISTINCT vec_id) AS n_points FROM
  (SELECT vec_id, unnest(tags) AS value FROM {EMB_PAYLOAD}) WHERE value IS NOT NULL GROUP BY value"""
ORACLE["geo_cells"] = f"""SELECT CAST(floor(lat / 10.0) AS INT) AS cell_lat, CAST(floor(lon / 10.0) AS INT) AS cell_lon,
  count(*) AS n_points FROM {CUST} GROUP BY ALL"""
ORACLE["geo_radius_cells"] = f"""SELECT c_custkey AS id FROM {CUST}
  WHERE {haversine_sql('lat', 'lon', 10.0, 20.0)} <= 2500000.0"""
ORACLE["cast_payload"] = """
SELECT 'o_orderpriority' AS field, 'integer' AS type, count(o_orderpriority) AS n_values,
       CAST(sum(CASE WHEN o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS BIGINT) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_rejected FROM orders
UNION ALL SELECT 'o_totalprice', 'float', count(o_totalprice), 0::BIGINT FROM orders
UNION ALL SELECT 'o_orderdate', 'datetime', count(o_orderdate), 0::BIGINT FROM orders
UNION ALL SELECT 'o_orderstatus', 'keyword', count(o_orderstatus), 0::BIGINT FROM orders"""
ORACLE["collection_profile"] = """SELECT count(*) AS points_count,
  CAST(sum((embedding IS NOT NULL)::INT * 3) AS BIGINT) AS vectors_count, 0::BIGINT AS indexed_vectors_count FROM embeddings"""
ORACLE["payload_schema"] = """
SELECT 'c_name' AS key, 'keyword' AS data_type, count(c_name) AS points FROM customer
UNION ALL SELECT 'c_nationkey', 'integer', count(c_nationkey) FROM customer
UNION ALL SELECT 'c_acctbal', 'float', count(c_acctbal) FROM customer
UNION ALL SELECT 'c_mktsegment', 'keyword', count(c_mktsegment) FROM customer
UNION ALL SELECT 'loc', 'geo', count(*) FROM customer"""
ORACLE["payload_schema_variant"] = """
SELECT key, CASE WHEN t IN ('UBIGINT', 'BIGINT', 'INTEGER') THEN 'integer' WHEN t = 'DOUBLE' THEN 'float'
                 WHEN t = 'VARCHAR' THEN 'keyword' WHEN t = 'BOOLEAN' THEN 'bool' ELSE lower(t) END AS data_type,
       count(*) AS points
FROM (SELECT unnest(json_keys(props)) AS key, props FROM events)
CROSS JOIN LATERAL (SELECT json_type(props, '$.' || key) AS t) GROUP BY ALL"""
ORACLE["shard_distribution"] = "SELECT c_nationkey AS shard_key, count(*) AS points_count FROM customer GROUP BY c_nationkey"
ORACLE["drop_shard_key"] = "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IS DISTINCT FROM 3"

_AGG = "count(*) AS count, round(avg(value), 6) AS avg, min(value) AS min, max(value) AS max"
ORACLE["response_stats"] = f"SELECT event_type AS endpoint, {_AGG} FROM events GROUP BY event_type"
ORACLE["response_stats_windowed"] = f"""
SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
       event_type AS endpoint, {_AGG} FROM events GROUP BY ALL"""
ORACLE["response_stats_sliding"] = f"""
SELECT s AS window_start, s + INTERVAL '1 day' AS window_end, event_type AS endpoint, {_AGG} FROM (
  SELECT ts, event_type, value, unnest([time_bucket(INTERVAL '12 hours', ts),
                                        time_bucket(INTERVAL '12 hours', ts) - INTERVAL '12 hours']) AS s FROM events)
GROUP BY ALL"""
ORACLE["response_stats_session"] = f"""
WITH f AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                            OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL '30 minutes'
                          THEN 1 ELSE 0 END AS brk FROM events),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT min(ts) AS window_start, max(ts) + INTERVAL '30 minutes' AS window_end, user_id AS key, {_AGG}
FROM s GROUP BY user_id, sid"""


# ---------------------------------------------------------------- mutations

ORACLE["upsert"] = """
WITH new AS (
  SELECT vec_id, embedding, label + 100 AS label, vec_id AS seq FROM embeddings WHERE vec_id % 10 = 0
  UNION ALL SELECT vec_id, embedding, -1, vec_id - 1 FROM embeddings WHERE vec_id % 10 = 0
  UNION ALL SELECT vec_id + 100000, embedding, label, vec_id FROM embeddings WHERE vec_id % 10 = 1),
latest AS (SELECT vec_id, embedding, label FROM new QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY seq DESC) = 1)
SELECT vec_id, embedding, label FROM embeddings WHERE vec_id NOT IN (SELECT vec_id FROM latest)
UNION ALL SELECT vec_id, embedding, label FROM latest"""
ORACLE["delete_points"] = "SELECT vec_id, embedding, label FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels)"
ORACLE["delete_by_filter"] = "SELECT vec_id, embedding, label FROM embeddings WHERE NOT coalesce(label >= 8, false)"
ORACLE["update_vectors"] = """
SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN list_reverse(embedding) ELSE embedding END AS embedding, label FROM embeddings"""
ORACLE["delete_vectors"] = """
SELECT vec_id, CASE WHEN label = 3 THEN NULL ELSE embedding END AS embedding, label FROM embeddings"""
ORACLE["set_payload"] = """
SELECT vec_id, embedding, CASE WHEN label = 1 THEN 99 ELSE label END AS label,
       CASE WHEN label = 1 THEN 'hot' END AS flag FROM embeddings"""
ORACLE["set_payload_nested"] = f"""
SELECT c_custkey, c_nationkey, CASE WHEN c_nationkey = 5 THEN 0.0::DOUBLE ELSE lat END AS lat, lon FROM {CUST}"""
ORACLE["set_payload_variant"] = """
SELECT event_id, CASE WHEN event_type = 'error' THEN '{"flag":true,"k":0}' ELSE CAST(json(props) AS VARCHAR) END AS payload_json
FROM events"""
ORACLE["overwrite_payload"] = f"""
SELECT vec_id, CASE WHEN label_n IS NULL THEN -1 ELSE label END AS label,
       CASE WHEN label_n IS NULL THEN NULL ELSE label_n END AS label_n,
       CASE WHEN label_n IS NULL THEN NULL ELSE tags END AS tags, embedding
FROM (SELECT *, (SELECT embedding FROM embeddings e2 WHERE e2.vec_id = p.vec_id) AS embedding FROM {EMB_PAYLOAD} p)"""
ORACLE["delete_payload"] = f"""
SELECT vec_id, label, CASE WHEN label >= 5 THEN NULL ELSE label_n END AS label_n,
       CASE WHEN label >= 5 THEN NULL ELSE tags END AS tags, embedding
FROM (SELECT *, (SELECT embedding FROM embeddings e2 WHERE e2.vec_id = p.vec_id) AS embedding FROM {EMB_PAYLOAD} p)"""
ORACLE["clear_payload"] = f"""
SELECT vec_id, CASE WHEN sel THEN NULL ELSE label END AS label, CASE WHEN sel THEN NULL ELSE label_n END AS label_n,
       CASE WHEN sel THEN NULL ELSE tags END AS tags, embedding
FROM (SELECT *, (vec_id IN (0, 5, 10, 77) OR label = 9) AS sel,
             (SELECT embedding FROM embeddings e2 WHERE e2.vec_id = p.vec_id) AS embedding FROM {EMB_PAYLOAD} p)"""
ORACLE["batch_update"] = """
WITH s1 AS (SELECT vec_id, embedding, label FROM embeddings
            UNION ALL SELECT vec_id + 100000, embedding, label FROM embeddings WHERE vec_id % 10 = 1),
s2 AS (SELECT * FROM s1 WHERE NOT coalesce(label >= 8, false)),
s3 AS (SELECT vec_id, embedding, CASE WHEN vec_id IN (2, 4, 6, 100002, 100011) THEN 42 ELSE label END AS label FROM s2),
s4 AS (SELECT vec_id, embedding, CASE WHEN vec_id IN (0, 1) OR label = 6 THEN NULL ELSE label END AS label FROM s3)
SELECT vec_id, CASE WHEN vec_id % 50 = 0 AND vec_id < 100000 THEN list_reverse(embedding) ELSE embedding END AS embedding,
       label FROM s4"""
ORACLE["apply_changelog"] = """
WITH ev AS (
  SELECT vec_id, embedding, label, -1::BIGINT AS seq, 'base' AS op FROM embeddings
  UNION ALL SELECT vec_id, embedding, label + 100, vec_id, 'upsert' FROM embeddings WHERE vec_id % 10 = 0
  UNION ALL SELECT vec_id, NULL, NULL, vec_id, 'delete' FROM embeddings WHERE vec_id % 10 = 5
  UNION ALL SELECT vec_id, embedding, 500, vec_id + 1, 'upsert' FROM embeddings WHERE vec_id % 20 = 5
  UNION ALL SELECT vec_id + 100000, embedding, label, vec_id, 'upsert' FROM embeddings WHERE vec_id % 10 = 1
  UNION ALL SELECT vec_id, NULL, 77, vec_id, 'set_payload' FROM embeddings WHERE vec_id % 10 = 3
  UNION ALL SELECT vec_id, NULL, 55, vec_id + 2, 'set_payload' FROM embeddings WHERE vec_id % 10 = 0
  UNION ALL SELECT vec_id, NULL, 66, vec_id - 1, 'set_payload' FROM embeddings WHERE vec_id % 10 = 0 AND vec_id > 0),
fullrow AS (SELECT * FROM ev WHERE op IN ('base', 'upsert', 'delete')
            QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY seq DESC) = 1),
sp AS (SELECT e.vec_id, e.label FROM ev e JOIN fullrow f USING (vec_id)
       WHERE e.op = 'set_payload' AND e.label IS NOT NULL AND e.seq > f.seq
       QUALIFY row_number() OVER (PARTITION BY e.vec_id ORDER BY e.seq DESC) = 1)
SELECT f.vec_id, f.embedding, coalesce(sp.label, f.label) AS label FROM fullrow f LEFT JOIN sp USING (vec_id)
WHERE f.op <> 'delete'"""


# ---------------------------------------------------------------- sources, snapshots, streaming

ORACLE["validate_collection"] = """
SELECT count(*) AS n_points, CAST(sum(CASE WHEN vec_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_ids,
       CAST(count(*) - count(DISTINCT vec_id) - sum(CASE WHEN vec_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_ids,
       CAST(sum(CASE WHEN embedding IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS vector_null,
       CAST(sum(CASE WHEN embedding IS NOT NULL AND len(embedding) <> 64 THEN 1 ELSE 0 END) AS BIGINT) AS vector_bad_dim,
       CAST(sum(CASE WHEN embedding IS NOT NULL AND NOT list_bool_and(list_transform(embedding,
            lambda x: x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x))) THEN 1 ELSE 0 END) AS BIGINT) AS vector_non_finite
FROM embeddings"""
ORACLE["validate_lineitem"] = """
SELECT count(*) AS n_points, CAST(sum(CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_ids,
       CAST(count(l_orderkey) - count(DISTINCT l_orderkey) AS BIGINT) AS duplicate_ids FROM lineitem"""
ORACLE["from_batch"] = "SELECT vec_id AS id, embedding AS vector, label AS payload FROM embeddings"
ORACLE["stream_response_stats"] = ORACLE["response_stats_windowed"]
ORACLE["stream_upsert"] = """
WITH latest AS (
  SELECT vec_id, embedding, label + 100 AS label FROM embeddings WHERE vec_id % 10 = 0
  UNION ALL SELECT vec_id + 100000, embedding, label FROM embeddings WHERE vec_id % 10 = 1)
SELECT vec_id, embedding, label FROM embeddings WHERE vec_id NOT IN (SELECT vec_id FROM latest)
UNION ALL SELECT vec_id, embedding, label FROM latest"""
ORACLE["search_kernel"] = ORACLE["search"]


# ---------------------------------------------------------------- requests with offset, threshold, ids and payloads of other shapes

ORACLE["query_order_by_offset"] = """
SELECT vec_id AS id, label FROM embeddings WHERE label IS NOT NULL AND label >= 3 ORDER BY label, id LIMIT 10 OFFSET 4"""
ORACLE["context_threshold"] = f"SELECT * FROM ({ORACLE['context_search']}) WHERE score >= {SQ.CONTEXT_THRESHOLD}"
ORACLE["search_kernel_euclid"] = f"""
SELECT vec_id AS id, label, round({euclid('[x::DOUBLE * 10000.0::DOUBLE for x in embedding]', vec_lit([x * 10000.0 for x in QUERY_VECTOR]))}, 6) AS score
FROM embeddings ORDER BY score, id LIMIT 20"""
ORACLE["search_string_ids"] = f"""
SELECT 'p' || vec_id AS id, label, round({cos(E, QV)}, 6) AS score FROM embeddings ORDER BY score DESC, id LIMIT 20"""
ORACLE["search_batch_ties"] = f"""
SELECT query_id, id, score, rank FROM (
  SELECT q.vec_id AS query_id, p.id, round({cos(d('q.embedding'), d('p.embedding'))}, 6) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY round({cos(d('q.embedding'), d('p.embedding'))}, 6) DESC, p.id) AS rank
  FROM embeddings q, (SELECT vec_id * 4 + i AS id, embedding FROM embeddings, range(4) r(i)) p
  WHERE q.vec_id % 50 = 0) WHERE rank <= 6"""
ORACLE["query_groups_include"] = ORACLE["query_groups"]
ORACLE["query_groups_array_dups"] = f"""
WITH s AS (SELECT vec_id AS id, label, round({cos(E, QV)}, 6) AS score, unnest([label, label + 1]) AS g FROM embeddings),
g AS (SELECT g AS group_id, max(score) AS best FROM s GROUP BY g ORDER BY best DESC, group_id LIMIT 5),
gr AS (SELECT group_id, row_number() OVER (ORDER BY best DESC, group_id) AS group_rank FROM g),
h AS (SELECT s.*, gr.group_id, gr.group_rank, row_number() OVER (PARTITION BY gr.group_id ORDER BY s.score DESC, s.id) AS rank
      FROM s JOIN gr ON s.g = gr.group_id)
SELECT group_id, group_rank, id, score, rank, label FROM h WHERE rank <= 3"""
ORACLE["apply_changelog_all_ops"] = """
SELECT vec_id,
       CASE vec_id % 9 WHEN 6 THEN list_reverse(embedding) WHEN 7 THEN NULL ELSE embedding END AS embedding,
       CASE WHEN vec_id % 27 = 9 THEN 77 WHEN vec_id % 27 = 13 THEN 78 WHEN vec_id % 27 = 1 THEN 79
            WHEN vec_id % 9 = 0 THEN 900 WHEN vec_id % 9 = 3 THEN 903 WHEN vec_id % 9 IN (2, 4, 5) THEN NULL ELSE label END AS label
FROM embeddings WHERE vec_id % 9 <> 1 OR vec_id % 27 = 1"""

# ---------------------------------------------------------------- sparse vectors of a collection, weighted batches

ORACLE["sparse_idf_batch"] = f"""
WITH post AS {_POST},
q AS (SELECT id AS query_id, idx, CAST(val AS DOUBLE) AS qval FROM {postings_sql('benchmark', 'item_id', 'text')}),
n AS (SELECT count(DISTINCT id) AS n FROM post),
df AS (SELECT idx, count(DISTINCT id) AS df FROM post GROUP BY idx),
s AS (SELECT q.query_id, p.id, round(sum(CAST(p.val AS DOUBLE) * q.qval * ln((n.n - df.df + 0.5) / (df.df + 0.5) + 1)), 6) AS score
      FROM post p JOIN q USING (idx) JOIN df USING (idx), n GROUP BY q.query_id, p.id)
SELECT query_id, id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s) WHERE rank <= 5"""

ORACLE["sparse_payload"] = f"""
WITH q AS (SELECT unnest({SPARSE_QUERY[0]}) AS idx, unnest({SPARSE_QUERY[1]}) AS qval)
SELECT p.id, d.source, round(sum(CAST(p.val AS DOUBLE) * q.qval), 6) AS score
FROM {_POST} p JOIN q USING (idx) JOIN documents d ON d.doc_id = p.id WHERE d.lang = 'en'
GROUP BY p.id, d.source ORDER BY score DESC, p.id LIMIT 10 OFFSET 2"""

ORACLE["fusion_filtered"] = ORACLE["fusion_rrf"].replace("e.vec_id = f.id ORDER", "e.vec_id = f.id WHERE e.label >= 3 ORDER")
ORACLE["search_not_finite"] = f"""
SELECT id, label, score, unnest(['expression', 'kernel']) AS engine FROM (
  SELECT vec_id AS id, label, round({cos(E, QV)}, 6) AS score FROM embeddings WHERE vec_id % 5 <> 0
  ORDER BY score DESC, id LIMIT 10)"""

# ---------------------------------------------------------------- product quantization with given codebooks


def _pq_sql(total: str, order: str, where: str = "TRUE", limit: int = 10) -> str:
    """Code every sub-vector by the nearest of the points 0 to 15, add up the parts of the coded vector."""
    return f"""
WITH p AS (SELECT vec_id, label, s, CAST(embedding[8 * s + 1:8 * s + 8] AS DOUBLE[]) AS v FROM embeddings, range(8) t(s) WHERE {where}),
b AS (SELECT s, vec_id AS code, CAST(embedding[8 * s + 1:8 * s + 8] AS DOUBLE[]) AS c FROM embeddings, range(8) t(s) WHERE vec_id < 16),
n AS (SELECT vec_id, label, s, c FROM p JOIN b USING (s)
      QUALIFY row_number() OVER (PARTITION BY vec_id, s ORDER BY list_distance(v, c), code) = 1),
q AS (SELECT s, ({QV})[8 * s + 1:8 * s + 8] AS q FROM range(8) t(s))
SELECT vec_id AS id, label, round({total}, 6) AS score FROM n JOIN q USING (s)
GROUP BY vec_id, label ORDER BY score {order}, id LIMIT {limit}"""


_PQ_DOT = "sum(list_dot_product(c, q))"
_PQ_EUCLID = "sqrt(sum(list_distance(c, q) * list_distance(c, q)))"
ORACLE["quant_pq_dot"] = _pq_sql(_PQ_DOT, "DESC")
ORACLE["quant_pq"] = _pq_sql(f"{_PQ_DOT} / (sqrt(sum(list_dot_product(c, c))) * sqrt({dot(QV, QV)}))", "DESC")
ORACLE["quant_pq_euclid"] = _pq_sql(_PQ_EUCLID, "ASC")
ORACLE["quant_pq_manhattan"] = _pq_sql("sum(" + manhattan("c", "q") + ")", "ASC")
ORACLE["quant_pq_rescore"] = f"""
SELECT vec_id AS id, label, round({euclid(E, QV)}, 6) AS score FROM embeddings
WHERE vec_id IN (SELECT id FROM ({_pq_sql(_PQ_EUCLID, "ASC", "label >= 2", 30)})) ORDER BY score, id LIMIT 10"""

_LO, _HI = SQ.SCALAR_BOUNDS
_CODED = (f"list_transform({E}, lambda x: {_LO} + (least(255.0, greatest(0.0, round((x - {_LO}) * (255.0 / ({_HI} - {_LO})))))) * ({_HI} - {_LO}) / 255.0)")
ORACLE["quant_scalar"] = f"""
SELECT vec_id AS id, label, round({cos('c', QV)}, 6) AS score FROM (SELECT vec_id, label, {_CODED} AS c FROM embeddings)
ORDER BY score DESC, id LIMIT 10"""
ORACLE["quant_rescore"] = f"""
SELECT vec_id AS id, label, round({cos(E, QV)}, 6) AS score FROM embeddings WHERE vec_id IN (
  SELECT vec_id FROM (SELECT vec_id, {_CODED} AS c FROM embeddings) ORDER BY round({cos('c', QV)}, 6) DESC, vec_id LIMIT 30)
ORDER BY score DESC, id LIMIT 10"""
ORACLE["quant_binary"] = f"""
SELECT vec_id AS id, label, -list_sum(list_transform(range(1, 65), lambda i: CASE WHEN (embedding[i] > 0) <> (({QV})[i] > 0) THEN 1.0 ELSE 0.0 END))::DOUBLE AS score
FROM embeddings ORDER BY score DESC, id LIMIT 10"""

ORACLE["snapshot_roundtrip"] = "SELECT * FROM embeddings"
# buckets: the first byte of the id's MD5
ORACLE["snapshot_damage"] = """
WITH r AS (
  SELECT vec_id, 1 AS was, CASE WHEN vec_id % 101 <> 50 THEN 1 ELSE 0 END AS now,
         vec_id % 101 = 50 OR (vec_id % 97 = 0 AND label IS NOT NULL) AS odd FROM embeddings
  UNION ALL SELECT vec_id + 1000000, 0, 1, true FROM embeddings WHERE vec_id % 211 = 7 ),
b AS (SELECT ('0x' || substr(md5(vec_id::VARCHAR), 1, 2))::INT AS bucket, * FROM r)
SELECT bucket, CAST(sum(was) AS BIGINT) AS n_rows, CAST(sum(now) AS BIGINT) AS found_rows FROM b GROUP BY bucket HAVING bool_or(odd)"""

ORACLE["count_estimate_sketches"] = """
SELECT l::INT AS label, t AS tagged, (SELECT count(*) FROM embeddings WHERE label = l AND (NOT t OR vec_id % 5 <> 0)) AS count, true AS near
FROM range(4) a(l), (VALUES (true), (false)) b(t)"""

# ---------------------------------------------------------------- a log in stages


def _stage_sql(name: str, state: str, low: str, high: str) -> str:
    """CTEs that fold the events of ``ev`` with low < seq <= high into a state (vec_id, embedding, label)."""
    return f"""
{name}_e AS (SELECT vec_id, embedding, label, NULL::BIGINT AS seq, 'base' AS op FROM {state}
             UNION ALL SELECT * FROM ev WHERE seq > {low} AND seq <= {high}),
{name}_f AS (SELECT * FROM {name}_e WHERE op IN ('base', 'upsert', 'delete')
             QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY seq DESC NULLS LAST) = 1),
{name}_p AS (SELECT e.vec_id, e.label FROM {name}_e e JOIN {name}_f f USING (vec_id)
             WHERE e.op = 'set_payload' AND e.label IS NOT NULL AND (f.seq IS NULL OR e.seq > f.seq)
             QUALIFY row_number() OVER (PARTITION BY e.vec_id ORDER BY e.seq DESC) = 1),
{name} AS (SELECT f.vec_id, f.embedding, coalesce(p.label, f.label) AS label FROM {name}_f f LEFT JOIN {name}_p p USING (vec_id)
           WHERE f.op <> 'delete')"""


_EVENTS = ORACLE["apply_changelog"].split("UNION ALL", 1)[1].split("),\nfullrow")[0]
ORACLE["apply_changelog_filters"] = f"""
WITH ev(vec_id, embedding, label, seq, op) AS ({_EVENTS}),
{_stage_sql('a', 'embeddings', '-1000000', '60')},
a2 AS (SELECT * FROM a WHERE NOT coalesce(label >= 105 AND label < 500, false)),
{_stage_sql('b', 'a2', '60', '120')},
b2 AS (SELECT vec_id, embedding, CASE WHEN label = 77 THEN 1000 ELSE label END AS label FROM b),
b3 AS (SELECT vec_id, embedding, CASE WHEN label < 2 THEN NULL ELSE label END AS label FROM b2),
{_stage_sql('c', 'b3', '120', '1000000000')}
SELECT * FROM c"""

# ---------------------------------------------------------------- approximate search

# cells by the nearest of the points 0 to 7, the three cells nearest to the query, exact inside
ORACLE["ann_graph"] = f"""
WITH c AS (SELECT vec_id AS cell, {E} AS m FROM embeddings WHERE vec_id < 8),
a AS (SELECT vec_id, label, {E} AS v FROM embeddings),
n AS (SELECT vec_id, label, v, cell, row_number() OVER (PARTITION BY vec_id ORDER BY {cos('v', 'm')} DESC, cell) AS r FROM a, c),
p AS (SELECT cell FROM c ORDER BY {cos('m', QV)} DESC, cell LIMIT 3)
SELECT vec_id AS id, label, round({cos('v', QV)}, 6) AS score FROM n JOIN p USING (cell)
WHERE r = 1 AND label >= 2 ORDER BY score DESC, id LIMIT 10"""
