"""Sparse top-k over packed vectors with upper bounds (D5, D6, Q8; batch form).

Points are rows (id, indices, values); text becomes such rows inside its own row, without a
shuffle (``pack_text``). Each task scans its points in Arrow batches. Per batch the entries that
some query asks for form impact-ordered postings: the entries of an index, largest value first, in blocks
of ``BLOCK`` whose first entry is the block's largest. For each query the k-th best score so far in the task is a threshold:

* an index is essential while the others together could not reach the threshold;
* a block of an essential index is skipped, and all that follow it, when its largest value plus the
  other indices' largest stays below the threshold;
* only points in the blocks left are scored, from their own rows.

The bounds hold for values and weights of at least 0; a batch or query with negative ones is scored
without them. So a task passes on k points for each query, and these (tasks x queries x k rows) are all that is
shuffled. Points that share no index with a query have no score. Scores are ranked as Spark rounds them, then by
id; ids are those of a collection, so they do not repeat.

Queries (query_id, idx, qval) are broadcast in blocks of at most ``max_broadcast_bytes``, one at a time: with
several, each block's candidates are written below the shared folder before the next is read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointframe.functions import text as TX
from pointframe.operators.kernel import round_half_up
from pointframe.plans.partitioning import spread
from pointframe.session import checkpoint_dir, ship_package

BLOCK = 128
MAX_BROADCAST_BYTES = 64 << 20
# words or entries that a task looks at together
ENTRIES = 1 << 18


def _pieces(b: pa.RecordBatch, column: str, entries: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch whose lists hold about ``entries`` values at most (a longer list is a run of its own)."""
    ends = b.column(column).offsets.to_numpy()
    at = 0
    while at < b.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + entries, side="right")) - 1)
        yield b.slice(at, end - at)
        at = end


def pack_text(df: DataFrame, id_col: str, text_col: str, tokenizer: str = "word") -> DataFrame:
    """(id, indices, values) of every row with a token: hashed tokens (as ``text.sparse_index``) and their counts, indices ascending."""
    rows = spread(df.select(id_col, text_col)).select(F.col(id_col).alias("id"), TX.tokens(F.col(text_col), tokenizer).alias("t"))
    rows = rows.filter(F.size("t") > 0)
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for whole in batches for x in _pieces(whole, "t", ENTRIES)):
            column = b.column("t")
            ends = column.offsets.to_numpy() - column.offsets[0].as_py()
            words = column.flatten().dictionary_encode()
            index = np.array([int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in words.dictionary.to_pylist()], dtype=np.int64)
            row = np.repeat(np.arange(len(column)), np.diff(ends))
            key, count = np.unique((row << 28) | index[words.indices.to_numpy()], return_counts=True)
            starts = np.searchsorted(key >> 28, np.arange(len(column) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "id": b.column("id"), "indices": pa.ListArray.from_arrays(pa.array(starts), pa.array((key & ((1 << 28) - 1)).astype(np.int32))),
                "values": pa.ListArray.from_arrays(pa.array(starts), pa.array(count.astype(np.float32)))})

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, indices array<int>, values array<float>")


def pack_column(df: DataFrame, id_col: str, sparse_col: str, *extra) -> DataFrame:
    """(id, indices, values) of a sparse vector column."""
    c = F.col(sparse_col)
    return df.filter(c.isNotNull()).select(F.col(id_col).alias("id"), c["indices"].alias("indices"), c["values"].alias("values"), *extra)


class _Queries:
    """All queries as arrays: terms (sorted, distinct), and per query its places among them and weights."""

    def __init__(self, query: np.ndarray, idx: np.ndarray, weight: np.ndarray):
        self.ids, of = np.unique(query, return_inverse=True)
        self.terms, term = np.unique(idx, return_inverse=True)
        order = np.lexsort((term, of))
        of, term, weight = of[order], term[order], weight[order]
        # an index that comes twice in a query counts with the sum
        first = np.concatenate([[True], (of[1:] != of[:-1]) | (term[1:] != term[:-1])]) if len(of) else np.zeros(0, bool)
        at = np.flatnonzero(first)
        self.weight = np.add.reduceat(weight, at) if len(at) else weight
        self.term = term[at]
        self.starts = np.searchsorted(of[at], np.arange(len(self.ids) + 1))

    def one(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        here = slice(self.starts[q], self.starts[q + 1])
        return self.term[here], self.weight[here]


class Postings:
    """Impact-ordered postings of one batch, over the terms that queries ask for."""

    def __init__(self, starts: np.ndarray, idx: np.ndarray, val: np.ndarray, terms: np.ndarray):
        doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        place = np.minimum(np.searchsorted(terms, idx), max(0, len(terms) - 1))
        keep = (terms[place] == idx) & (val != 0) if len(terms) else np.zeros(len(idx), bool)
        self.doc, self.term, self.val = doc[keep], place[keep], val[keep].astype(np.float64)
        self.row = np.searchsorted(self.doc, np.arange(len(starts)))  # the entries of each point
        order = np.lexsort((-self.val, self.term))
        self.by_doc, self.by_val = self.doc[order], self.val[order]
        self.lists = np.searchsorted(self.term[order], np.arange(len(terms) + 1))
        self.bounded = not len(self.val) or self.val.min() >= 0

    def largest(self, t: np.ndarray) -> np.ndarray:
        empty = self.lists[t] == self.lists[t + 1]
        return np.where(empty, 0.0, self.by_val[np.minimum(self.lists[t], max(0, len(self.by_val) - 1))] if len(self.by_val) else 0.0)

    def candidates(self, terms: np.ndarray, weights: np.ndarray, threshold: float) -> np.ndarray:
        """Points that may reach the threshold, ascending."""
        if not self.bounded or (weights < 0).any() or threshold == -np.inf:
            return np.unique(np.concatenate([self.by_doc[self.lists[t]:self.lists[t + 1]] for t in terms]) if len(terms) else np.zeros(0, np.int64))
        most = weights * self.largest(terms)
        total, order = most.sum(), np.argsort(-most)
        found = []
        for j, k in enumerate(order):
            if most[order[j:]].sum() < threshold:  # from here on the indices are not essential
                break
            a, b = self.lists[terms[k]], self.lists[terms[k] + 1]
            heads = self.by_val[a:b:BLOCK] * weights[k] + (total - most[k])
            blocks = int(np.searchsorted(-heads, -threshold, side="right"))  # heads fall
            found.append(self.by_doc[a:min(b, a + blocks * BLOCK)])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def scores(self, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray, width: int) -> np.ndarray:
        """Dot products of the points with one query, from their own entries."""
        w = np.zeros(width)
        w[terms] = weights
        n = self.row[docs + 1] - self.row[docs]
        at = np.repeat(self.row[docs] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.bincount(np.repeat(np.arange(len(docs)), n), weights=self.val[at] * w[self.term[at]], minlength=len(docs))


def _cut(ids: pa.Array, score: np.ndarray, k: int) -> tuple[pa.Array, np.ndarray]:
    """The best k by (score, id); ids in their own order."""
    table = pa.table({"s": score, "id": ids})
    order = pc.sort_indices(table, sort_keys=[("s", "descending"), ("id", "ascending")])[:k]
    return ids.take(order), score[order.to_numpy()]


def _task(queries: _Queries, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[pa.Array, np.ndarray]] = {}
        for b in (x for whole in batches for x in _pieces(whole, "indices", ENTRIES)):
            column = b.column("indices")
            starts = column.offsets.to_numpy() - column.offsets[0].as_py()
            posts = Postings(starts, column.flatten().to_numpy(zero_copy_only=False), b.column("values").flatten().to_numpy(zero_copy_only=False), queries.terms)
            for q in range(len(queries.ids)):
                terms, weights = queries.one(q)
                held = best.get(q)
                full = held is not None and len(held[1]) == k
                docs = posts.candidates(terms, weights, held[1][-1] - 1e-6 if full else -np.inf)
                if not len(docs):
                    continue
                score = round_half_up(posts.scores(docs, terms, weights, len(queries.terms)))
                if full:
                    docs, score = docs[score >= held[1][-1]], score[score >= held[1][-1]]
                ids = b.column("id").take(pa.array(docs))
                if held is not None:
                    ids, score = pa.concat_arrays([held[0], ids]), np.concatenate([held[1], score])
                best[q] = _cut(ids, score, k)
        for q, (ids, score) in best.items():
            yield pa.RecordBatch.from_pydict({"query_id": pa.array(np.full(len(ids), queries.ids[q]), pa.int64()), "id": ids, "score": pa.array(score)})

    return run


def idf(points: DataFrame, queries: DataFrame) -> DataFrame:
    """``queries`` with qval times ln((N - df + 0.5) / (df + 0.5) + 1); N: points that hold an entry. Combines map-side."""
    held = points.select(F.filter(F.arrays_zip("indices", "values"), lambda e: e["values"] != 0)["indices"].alias("held")).filter(F.size("held") > 0)
    n = held.agg(F.count("*").alias("n")).select("n").scalar()
    wanted = queries.select("idx").distinct()
    df = held.select(F.explode(F.array_distinct("held")).alias("idx")).join(wanted, "idx", "left_semi").groupBy("idx").agg(F.count("*").alias("df"))
    return queries.join(df, "idx").select("query_id", "idx", (F.col("qval") * F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)).alias("qval"))


def sparse_topk(points: DataFrame, queries: DataFrame, k: int = 10, *, modifier: str | None = None,
                max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Top ``k`` points (id, indices, values) for every query (query_id, idx, qval): query_id, id, score, rank."""
    if k < 1:
        raise ValueError("k must be 1 or more")
    if modifier not in (None, "none", "idf"):
        raise ValueError(f"unknown sparse modifier {modifier!r}")
    spark = points.sparkSession
    ship_package(spark)
    queries = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("idx").cast("int").alias("idx"), F.col("qval").cast("double").alias("qval"))
    if modifier == "idf":
        queries = idf(points, queries)
    points = points.select("id", "indices", "values")
    kind = points.schema["id"].dataType.simpleString()
    schema = f"query_id long, id {kind}, score double"
    folder = f"{checkpoint_dir(spark)}/sparse-{uuid.uuid4().hex}"
    queries.write.parquet(f"{folder}/queries")
    queries = spark.read.parquet(f"{folder}/queries")
    blocks = max(1, -(-queries.count() * 20 // max_broadcast_bytes))
    found = None
    for j in range(blocks):
        own = queries if blocks == 1 else queries.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == j)
        held = own.toArrow()
        task = _task(_Queries(*[held.column(c).to_numpy() for c in ("query_id", "idx", "qval")]), k)
        part = points.mapInArrow(task, schema)
        if blocks > 1:
            part.write.parquet(f"{folder}/found-{j}")
            part = spark.read.schema(schema).parquet(f"{folder}/found-{j}")
        found = part if found is None else found.unionByName(part)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)


def literal(spark, query: dict) -> DataFrame:
    """``{indices, values}`` as query 0."""
    rows = [(0, int(i), float(v)) for i, v in zip(query["indices"], query["values"], strict=True)]
    return spark.createDataFrame(rows, "query_id long, idx int, qval double")


def search_sparse(coll, query: dict, *, using: str | None = None, limit: int = 10, offset: int = 0, filter: dict | None = None, with_payload=True,
                  with_vector=False, score_threshold: float | None = None, modifier: str | None = None) -> DataFrame:
    """Nearest points of a collection by one of its sparse vectors: id, payload, score."""
    from pointframe.operators.search import filtered, project
    if using is None and len(coll.sparse) == 1:
        using = next(iter(coll.sparse))
    if using not in coll.sparse:
        raise ValueError(f"unknown sparse vector {using!r}; have {sorted(coll.sparse)}")
    spark = coll.df.sparkSession
    queries = literal(spark, query)
    if modifier == "idf":  # weights come from the whole collection, whatever is filtered
        queries = idf(pack_column(coll.df, coll.id, coll.sparse[using]), queries)
    hits = sparse_topk(pack_column(filtered(coll, filter), coll.id, coll.sparse[using]), queries, offset + limit)
    hits = hits.filter(F.col("rank") > offset).select("id", "score", "rank")
    if score_threshold is not None:
        hits = hits.filter(F.col("score") >= score_threshold)
    rows = project(coll, coll.df, with_payload, with_vector)
    out = rows.join(F.broadcast(hits), "id").orderBy("rank")  # at most offset + limit rows
    return out.select("id", *[c for c in rows.columns if c != "id"], "score")
