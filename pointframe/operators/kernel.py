"""Many-query k-nearest-neighbour kernel (Q5, and the batch forms of R3, X3, M1, M2).

The query side is cut into blocks of at most ``max_broadcast_bytes`` and ``TURN_QUERIES``
queries (usually one block). Each block's matrix is broadcast in turn; each point partition
is scanned through ``mapInArrow`` (zero-copy Arrow -> NumPy), scored with matrix operations,
and keeps its k best rows per query. Points are never exchanged (a round-robin ``spread``
only when the scan yields fewer partitions than cores) and never copied per block; at most
``tasks x queries x k`` candidate rows move.

Queries that would take more than ``TURNS`` blocks are not broadcast at all: queries and
points are dealt into cells of at most about ``CELL_ROWS`` rows a side, every cell of points
meets every cell of queries in one group of a cogroup, and each group keeps its k best.
A group's time and memory do not depend on the size of the input, only their number does.

Every task cuts on exactly what the final cut uses: the score as Spark rounds it,
then the id. However many points tie, a task keeps k of them. The final cut is a
``row_number`` window per query (``WindowGroupLimit``). Ids keep their own type.
"""

from __future__ import annotations

import math
import uuid
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointframe.functions import distance as D
from pointframe.plans.partitioning import spread
from pointframe.session import checkpoint_dir, ship_package

TIE_EPS = 2e-6
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20
# elements of one score matrix chunk (queries x points) held at once in a task
SCORE_CHUNK_ELEMS = 1 << 20
# points scored at once
POINT_ROWS = 1 << 13
# queries of one broadcast, and how many broadcasts are made in turn at most
TURN_QUERIES = 1 << 14
TURNS = 8
# rows of a cell, of points as of queries
CELL_ROWS = 1 << 16


# ---------------------------------------------------------------- NumPy core

def _matrix(arr: pa.Array, dim: int | None = None) -> np.ndarray:
    """list<float> Arrow column -> (n, d) float64 matrix without per-row Python work."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if n == 0:
        return np.zeros((0, dim or 0))
    flat = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    d = len(flat) // n if n else 0
    offs = arr.offsets.to_numpy()
    if not np.all(np.diff(offs) == d):
        raise ValueError("vectors of different dimension in one batch")
    return flat.reshape(n, d)


def usable_rows(arr: pa.Array, dim: int) -> np.ndarray:
    """Rows with a vector of dimension ``dim``; others get no score, as on the
    expression path (where a NULL or mismatched vector yields a NULL score)."""
    import pyarrow.compute as pc
    lens = pc.list_value_length(arr).fill_null(-1).to_numpy(zero_copy_only=False)
    return np.asarray(lens == dim)


def score_matrix(Q: np.ndarray, P: np.ndarray, distance: str) -> np.ndarray:
    """(m queries x b points) raw scores; NaN where undefined (zero vector under cosine)."""
    d = D.canonical(distance)
    if d in (D.COSINE, D.DOT):
        S = Q @ P.T
        if d == D.COSINE:
            qn = np.sqrt(np.einsum("ij,ij->i", Q, Q))
            pn = np.sqrt(np.einsum("ij,ij->i", P, P))
            with np.errstate(divide="ignore", invalid="ignore"):
                S = S / (qn[:, None] * pn[None, :])
            S[~np.isfinite(S)] = np.nan
        return S
    # distances from the differences themselves: a^2 + b^2 - 2ab loses the digits of near points
    out = np.empty((Q.shape[0], P.shape[0]))
    step = max(1, SCORE_CHUNK_ELEMS // max(1, P.shape[0] * max(1, P.shape[1])))
    for s in range(0, Q.shape[0], step):
        diff = Q[s:s + step, None, :] - P[None, :, :]
        out[s:s + step] = (np.sqrt(np.einsum("ijk,ijk->ij", diff, diff)) if d == D.EUCLID
                           else np.abs(diff).sum(axis=2))
    return out


def round_half_up(x: np.ndarray, digits: int = D.SCORE_DIGITS) -> np.ndarray:
    """``x`` as Spark's ``round`` gives it: half up on the shortest decimal form."""
    scale = 10.0 ** digits
    up = np.abs(x) * scale
    out = np.sign(x) * np.floor(up + 0.5) / scale
    # near a half, and where doubles are coarser than the last digit, decide on the decimal form
    doubt = np.isfinite(x) & ((np.abs(up - np.floor(up) - 0.5) < 1e-3) | (up > 1e14))
    if doubt.any():
        some, at = np.unique(x[doubt], return_inverse=True)
        unit = Decimal(1).scaleb(-digits)
        exact = [float(Decimal(repr(float(v))).quantize(unit, ROUND_HALF_UP)) if abs(v) < 1e15 else float(v) for v in some]
        out[doubt] = np.asarray(exact)[at]
    return out + 0.0  # no negative zero


def id_array(column) -> np.ndarray:
    """An Arrow id column as int64 or as str, both in Spark's order."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.array(column.to_pylist(), dtype=np.str_)


def arrow_ids(ids: np.ndarray) -> pa.Array:
    return pa.array(ids) if ids.dtype.kind == "i" else pa.array(ids.tolist(), pa.string())


def _select(qidx: np.ndarray, ids: np.ndarray, score: np.ndarray, k: np.ndarray,
            higher: bool) -> np.ndarray:
    """Indices of the k best rows of each query by (rounded score, id)."""
    if len(score) == 0:
        return np.zeros(0, dtype=np.int64)
    order = np.lexsort((ids, -score if higher else score, qidx))
    q_sorted = qidx[order]
    starts = np.r_[0, np.flatnonzero(np.diff(q_sorted)) + 1]
    sizes = np.diff(np.r_[starts, len(order)])
    pos = np.arange(len(order)) - np.repeat(starts, sizes)
    return order[pos < k[q_sorted]]


class TopK:
    """Running candidate set of (query index, point id, rounded score) inside one task."""

    def __init__(self, k: np.ndarray, higher: bool):
        self.k = k
        self.higher = higher
        self.q: list[np.ndarray] = []
        self.i: list[np.ndarray] = []
        self.s: list[np.ndarray] = []
        self.n = 0
        # per query: no row whose score is worse than this by more than TIE_EPS is among the k best (worse is larger here)
        self.bound = np.full(len(k), np.inf)

    def add_scores(self, S: np.ndarray, q_index: np.ndarray, ids: np.ndarray,
                   mask: np.ndarray | None = None) -> None:
        """Add a (queries x points) score block; NaN and masked-out entries are skipped."""
        m, b = S.shape
        if m == 0 or b == 0:
            return
        kmax = int(self.k[q_index].max())
        key = -S if self.higher else S
        valid = key <= (self.bound[q_index] + TIE_EPS)[:, None]  # false for NaN
        if mask is not None:
            valid &= mask
        if b > kmax and np.count_nonzero(valid) > 2 * m * kmax:
            # a cheap superset first: whatever could round to the k-th best
            kth = np.partition(np.where(valid, key, np.inf), kmax - 1, axis=1)[:, kmax - 1]
            valid &= key <= (kth[:, None] + TIE_EPS)
            self.bound[q_index] = np.minimum(self.bound[q_index], kth)
        r, c = np.nonzero(valid)
        self._add(q_index[r].astype(np.int64), ids[c], round_half_up(S[r, c]), kmax)

    def add_euclid(self, Q: np.ndarray, P: np.ndarray, q_index: np.ndarray, ids: np.ndarray, q_sq: np.ndarray, p_sq: np.ndarray,
                   mask: np.ndarray | None = None) -> None:
        """Add the distances of a block of queries and points with the squared lengths ``q_sq`` and ``p_sq``. Products of matrices only
        bound the squared distances from below; of pairs that could be among the k best the distance comes from the differences."""
        m, b = len(Q), len(P)
        if m == 0 or b == 0:
            return
        kmax = int(self.k[q_index].max())
        loss = 4 * (P.shape[1] + 8) * np.finfo(np.float64).eps  # a product is off by less than this part of q_sq + p_sq
        with np.errstate(invalid="ignore", over="ignore"):
            low = (-2.0 * Q) @ P.T
            low += (1 - loss) * p_sq  # and (1 - loss) * q_sq, which stands on the other side
            most = float(q_sq.max()) + float(p_sq.max())
            if not most < 1e300:  # also NaN: squares that are no bound
                low[~np.isfinite(low) | ~(q_sq[:, None] + p_sq < 1e300)] = -np.inf

            def within() -> np.ndarray:
                limit = np.square(self.bound[q_index] + TIE_EPS) * (1 + 1e-12)
                return low <= np.where(limit < 1e300, limit - (1 - loss) * q_sq, np.inf)[:, None]

            valid = within()
            if mask is not None:
                valid &= mask
            if most < 1e300 and b > kmax and np.count_nonzero(valid) > 2 * m * kmax:
                kth = np.partition(np.where(valid, low, np.inf), kmax - 1, axis=1)[:, kmax - 1]
                kth += (1 - loss) * q_sq + 2 * loss * (q_sq + p_sq.max())  # the k smallest bounds belong to distances of at most this
                self.bound[q_index] = np.minimum(self.bound[q_index], np.sqrt(np.maximum(kth, 0)))
                valid &= within()
        r, c = np.nonzero(valid)
        step = max(1, SCORE_CHUNK_ELEMS // P.shape[1])
        for s in range(0, len(r), step):
            rs, cs = r[s:s + step], c[s:s + step]
            with np.errstate(invalid="ignore", over="ignore"):
                diff = Q[rs] - P[cs]
                dist = np.sqrt(np.einsum("ij,ij->i", diff, diff))
            known = ~np.isnan(dist)
            self._add(q_index[rs[known]].astype(np.int64), ids[cs[known]], round_half_up(dist[known]), kmax)

    def _add(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray, kmax: int) -> None:
        keep = _select(q, ids, score, self.k, self.higher)
        self.q.append(q[keep])
        self.i.append(ids[keep])
        self.s.append(score[keep])
        self.n += len(keep)
        if self.n > 3 * max(1, len(self.k)) * max(1, kmax) + 100_000:
            self.compact()

    def compact(self) -> None:
        if not self.q:
            return
        q, i, s = np.concatenate(self.q), np.concatenate(self.i), np.concatenate(self.s)
        keep = _select(q, i, s, self.k, self.higher)
        self.q, self.i, self.s = [q[keep]], [i[keep]], [s[keep]]
        self.n = len(keep)
        # rows come query by query, the best first: where there are k the last one is the bound
        held = np.bincount(self.q[0], minlength=len(self.k))
        full = (held >= self.k) & (held > 0)
        last = self.s[0][np.cumsum(held)[full] - 1]
        self.bound[full] = np.minimum(self.bound[full], -last if self.higher else last)

    def result(self):
        self.compact()
        if not self.q:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0)
        return self.q[0], self.i[0], self.s[0]


# ---------------------------------------------------------------- Spark plans

def _finish(cands: DataFrame, distance: str, k_literal: int | None) -> DataFrame:
    scored = cands.withColumn("score", F.round("raw", D.SCORE_DIGITS)).drop("raw")
    order = [F.col("score").desc() if D.higher_is_better(distance) else F.col("score").asc(),
             F.col("id").asc()]
    w = Window.partitionBy("query_id").orderBy(*order)
    ranked = scored.withColumn("rank", F.row_number().over(w))
    cut = F.col("rank") <= (F.lit(k_literal) if k_literal is not None else F.col("_k"))
    return ranked.filter(cut).select("query_id", "id", "score", F.col("rank").cast("long").alias("rank"))


def knn(points: DataFrame, id_col: str, vec_col: str, queries: DataFrame, *,
        query_id: str = "query_id", query_vec: str = "vector", k: int | str = 10,
        distance: str = D.COSINE, point_mask_cols: list[str] | None = None,
        query_mask_col: str | None = None, exclude_col: str | None = None,
        max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
        dim: int | None = None) -> DataFrame:
    """Top-``k`` points for every query row: ``query_id, id, score, rank``.

    ``k`` is an int or the name of a per-query column. ``point_mask_cols`` are
    boolean point columns (one per distinct filter) and ``query_mask_col`` holds,
    per query, the index into them (or NULL for no filter). ``exclude_col`` is a query column holding one point id to leave out
    (the query point itself in a self join).
    """
    distance = D.canonical(distance)
    k_lit = k if isinstance(k, int) else None
    id_type = "string" if points.schema[id_col].dataType.simpleString() == "string" else "long"
    qcols = [F.col(query_id).alias("query_id"), F.col(query_vec).alias("qvec"),
             (F.lit(k) if k_lit is not None else F.col(k)).cast("int").alias("_k"),
             (F.col(query_mask_col) if query_mask_col else F.lit(None)).cast("int").alias("_mask"),
             (F.col(exclude_col) if exclude_col else F.lit(None)).cast(id_type).alias("_excl")]
    # a query without a vector has no neighbours (and would break the batch matrix)
    q = queries.select(*qcols).filter(F.col("qvec").isNotNull())
    p = points.select(F.col(id_col).cast(id_type).alias("id"), F.col(vec_col).alias("pvec"),
                      *[F.col(c).alias(f"_m{j}") for j, c in enumerate(point_mask_cols or [])])
    if dim is None:
        dim = q.agg(F.max(F.size("qvec")).alias("d")).first()["d"] or 1
    # at most max_rows + 1 query rows reach the driver at once
    max_rows = max(1, min(max_broadcast_bytes // (8 * dim), TURN_QUERIES))
    fetched = q.limit(max_rows + 1).toArrow()
    n_masks = len(point_mask_cols or [])
    if fetched.num_rows <= max_rows:
        return _finish(_block_candidates(p, fetched, distance, n_masks, id_type)[0], distance, k_lit)
    return _finish(_in_blocks(p, q, max_rows, distance, n_masks, id_type, dim), distance, k_lit)


def _in_blocks(p: DataFrame, q: DataFrame, max_rows: int, distance: str, n_masks: int, id_type: str, dim: int) -> DataFrame:
    """Candidates of more queries than one block holds. The queries are evaluated once, into a table below the shared folder; few
    blocks are broadcast in turn, many meet the points in cells. The candidates are written below the shared folder either way."""
    spark = p.sparkSession
    folder = f"{checkpoint_dir(spark)}/knn-{uuid.uuid4().hex}"
    kept = q.withColumn("_block", F.xxhash64("query_id"))
    kept.write.parquet(f"{folder}/queries")
    kept = spark.read.schema(kept.schema).parquet(f"{folder}/queries")
    count = kept.count()
    n = math.ceil(1.5 * count / max_rows)
    if n > TURNS:
        part = _cells(p, kept.drop("_block"), count, distance, n_masks, id_type, dim)
        part.write.parquet(f"{folder}/found/0")
        return spark.read.schema(part.schema).parquet(f"{folder}/found/*")
    return _in_turn(p, kept, n, folder, distance, n_masks, id_type)


def _in_turn(p: DataFrame, kept: DataFrame, n: int, folder: str, distance: str, n_masks: int, id_type: str) -> DataFrame:
    """Each block of queries is broadcast, its candidates are written, and its broadcast is destroyed before the next is read.
    Blocks go by a hash of the id, each of about two thirds of the bound."""
    spark = p.sparkSession
    schema = None
    for i in range(n):
        table = kept.where(F.pmod("_block", F.lit(n)) == i).drop("_block").toArrow()
        if not table.num_rows:
            continue
        part, held = _block_candidates(p, table, distance, n_masks, id_type)
        schema = part.schema
        part.write.parquet(f"{folder}/found/{i}")
        held.destroy()
    return spark.read.schema(schema).parquet(f"{folder}/found/*")


def _cells(p: DataFrame, q: DataFrame, count: int, distance: str, n_masks: int, id_type: str, dim: int) -> DataFrame:
    """Candidates of every group of a cell of points and a cell of queries, dealt by hashes of whole rows."""
    spark = p.sparkSession
    ship_package(spark)
    rows = max(1, min(CELL_ROWS, (CELL_ROWS << 9) // (8 * dim)))
    across = max(1, math.ceil(count / rows))
    down = max(1, math.ceil(p.count() / rows), math.ceil(2 * spark.sparkContext.defaultParallelism / across))
    tasks = 4 * across * down  # so that few groups share a task
    where = lambda n, *c: F.pmod(F.xxhash64(*c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    points = p.withColumn("_x", where(down, "id", "pvec")).withColumn("_y", every(across)).repartition(tasks, "_x", "_y")
    queries = q.withColumn("_y", where(across, "query_id", "qvec")).withColumn("_x", every(down)).repartition(tasks, "_x", "_y")
    names, kind = ["query_id", "id", "raw", "_k"], _query_kind(q)

    def group(left: pa.Table, right: pa.Table) -> pa.Table:
        Q, meta = _query_block(right)
        found = list(_scan(left.to_batches(), Q, meta, distance, n_masks)) if len(Q) else []
        if not found:
            none = pa.array([], pa.string()), pa.array([], pa.int64())
            return pa.table([none[0] if kind == "string" else none[1].cast(pa.int32()) if kind == "int" else none[1],
                             none[0] if id_type == "string" else none[1], pa.array([], pa.float64()), pa.array([], pa.int32())], names=names)
        return pa.Table.from_batches(found)

    pairs = points.groupBy("_x", "_y").cogroup(queries.groupBy("_x", "_y"))
    return pairs.applyInArrow(group, f"query_id {kind}, id {id_type}, raw double, _k int")


def _query_kind(q: DataFrame) -> str:
    kind = q.schema["query_id"].dataType.simpleString()
    return kind if kind in ("string", "int") else "long"


def _query_block(qt: pa.Table) -> tuple[np.ndarray, dict]:
    """The matrix of a block of queries, and their ids, limits, filters and excluded points."""
    return _matrix(qt.column("qvec")), {
        "qid": qt.column("query_id").combine_chunks(),
        "k": qt.column("_k").to_numpy(zero_copy_only=False).astype(np.int64),
        "mask": qt.column("_mask").to_pandas().fillna(-1).to_numpy().astype(np.int64),
        "excl": qt.column("_excl").to_pylist(),
    }


def _scan(batches, Qm: np.ndarray, m: dict, distance: str, n_masks: int):
    """The k best points of the batches for each query of a block, as one batch (none if there are none)."""
    nq = Qm.shape[0]
    top = TopK(m["k"], D.higher_is_better(distance))
    euclid = distance == D.EUCLID
    q_sq = np.einsum("ij,ij->i", Qm, Qm) if euclid else None
    q_all = np.arange(nq)
    any_mask = (m["mask"] >= 0).any()
    excl = {}  # point id -> queries that leave it out
    for i, x in enumerate(m["excl"]):
        if x is not None:
            excl.setdefault(x, []).append(i)
    for batch in (b.slice(at, POINT_ROWS) for b in batches for at in range(0, b.num_rows, POINT_ROWS)):
        pv = batch.column("pvec")
        ok = usable_rows(pv, Qm.shape[1])
        ids = id_array(batch.column("id"))
        if not ok.all():
            batch = batch.filter(pa.array(ok))
            pv, ids = batch.column("pvec"), ids[ok]
            if batch.num_rows == 0:
                continue
        P = _matrix(pv)
        p_sq = np.einsum("ij,ij->i", P, P) if euclid else None
        masks = None
        if n_masks:
            masks = np.stack([np.asarray(batch.column(f"_m{j}").fill_null(False).to_numpy(zero_copy_only=False),
                                         dtype=bool) for j in range(n_masks)])
        out_q = out_p = None
        if excl:
            cells = [(i, j) for j, x in enumerate(ids.tolist()) if x in excl for i in excl[x]]
            out_q, out_p = (np.array(c, dtype=np.int64) for c in zip(*cells, strict=True)) if cells else (None, None)
        step = max(1, SCORE_CHUNK_ELEMS // max(1, P.shape[0]))
        for s in range(0, nq, step):
            qi = q_all[s:s + step]
            mk = None
            if any_mask:
                sel = m["mask"][qi]
                mk = np.ones((len(qi), len(P)), dtype=bool)
                has = sel >= 0
                mk[has] = masks[sel[has]]
            if out_q is not None:
                here = (out_q >= s) & (out_q < s + len(qi))
                if here.any():
                    mk = np.ones((len(qi), len(P)), dtype=bool) if mk is None else mk
                    mk[out_q[here] - s, out_p[here]] = False
            if euclid:
                top.add_euclid(Qm[qi], P, qi, ids, q_sq[qi], p_sq, mk)
            else:
                top.add_scores(score_matrix(Qm[qi], P, distance), qi, ids, mk)
    qi, ids, score = top.result()
    if len(qi):
        yield pa.RecordBatch.from_arrays(
            [m["qid"].take(pa.array(qi)), arrow_ids(ids), pa.array(score), pa.array(m["k"][qi].astype(np.int32))],
            names=["query_id", "id", "raw", "_k"])


def _block_candidates(p: DataFrame, qt: pa.Table, distance: str, n_masks: int, id_type: str) -> tuple[DataFrame, Broadcast]:
    """Candidates of one block of queries (at most ``max_broadcast_bytes``) from every point partition, and what was broadcast."""
    spark = p.sparkSession
    ship_package(spark)
    bc = spark.sparkContext.broadcast(_query_block(qt))

    def run(batches):
        Qm, m = bc.value
        yield from _scan(batches, Qm, m, distance, n_masks)

    qid = str(qt.schema.field("query_id").type)
    kind = "string" if "string" in qid else "int" if qid == "int32" else "long"
    # CPU-heavy scan: give it every core when the points arrive in fewer partitions
    return spread(p).mapInArrow(run, f"query_id {kind}, id {id_type}, raw double, _k int"), bc
