"""Product quantization with asymmetric distances (Q23; Jegou, Douze and Schmid, TPAMI 2011).

A vector is cut into ``m`` sub-vectors, each coded by the number of its nearest centroid (squared distance; ties: the
smaller number). With a coarse centroid per cell the residual is coded instead. A query is not coded: it makes a
table of its partial score with every centroid, and a code's score is a sum of look-ups. What is added up
hangs on the metric: products for Dot, products and the coded vector's own norm for Cosine,
squared differences for Euclid, absolute differences for Manhattan.

Training is one Lloyd job per round for all sub-spaces together: every task assigns its sample's sub-vectors and sends
one row of sums per (sub-space, centroid, component), so what moves and what the driver
holds is m x k x (dimension / m) numbers a task, whatever the sample. Coding and scoring are NumPy on Arrow batches;
a task passes on its best ``fetch`` points only.

Vectors that are null, of another dimension or hold a not finite component get no code and no score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointframe.functions import distance as D
from pointframe.operators.kernel import round_half_up
from pointframe.session import ship_package
from pointframe.sources.collection import Collection


def books_of(codebooks: DataFrame) -> np.ndarray:
    """The codebooks (sub, code, centroid), m x k rows, as an array (m, k, width)."""
    rows = codebooks.select("sub", "code", "centroid").collect()
    m, k = max(r["sub"] for r in rows) + 1, max(r["code"] for r in rows) + 1
    if len(rows) != m * k or len({(r["sub"], r["code"]) for r in rows}) != m * k:
        raise ValueError("every sub-space needs the same codes from 0 on, each once")
    out = np.empty((m, k, len(rows[0]["centroid"])))
    for r in rows:
        out[r["sub"], r["code"]] = r["centroid"]
    return out


def cells_of(coarse: DataFrame | None) -> dict[int, np.ndarray]:
    """Coarse centroids (cell, centroid), a parameter of the index, by cell."""
    return {} if coarse is None else {r["cell"]: np.asarray(r["centroid"], dtype=np.float64) for r in coarse.select("cell", "centroid").collect()}


def _usable(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors can be coded, and these as a matrix."""
    ok = pc.fill_null(pc.equal(pc.list_value_length(column), dim), False)
    held = column.filter(ok)
    flat = held.flatten()
    m = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(held), dim) if len(held) else np.zeros((0, dim))
    finite = np.isfinite(m).all(axis=1)
    which = np.flatnonzero(ok.to_numpy(zero_copy_only=False))
    return which[finite], m[finite]


def nearest_codes(m: np.ndarray, books: np.ndarray) -> np.ndarray:
    """(rows, m) numbers of the nearest centroids; differences are taken, so equal distances are equal."""
    out = np.empty((len(m), len(books)), dtype=np.int32)
    width = books.shape[2]
    for s, book in enumerate(books):
        sub = m[:, s * width:(s + 1) * width]
        for at in range(0, len(m), 4096):
            diff = sub[at:at + 4096, None, :] - book[None, :, :]
            out[at:at + 4096, s] = np.einsum("ijk,ijk->ij", diff, diff).argmin(axis=1)
    return out


def train_pq(coll: Collection, m: int = 8, k: int = 16, *, using: str | None = None, seed: int = 0, max_iter: int = 20,
             train_rows: int | None = 100_000, coarse: DataFrame | None = None, cell: str = "cell") -> DataFrame:
    """Codebooks (sub, code, centroid) fitted on a seeded sample of about ``train_rows`` points (all with None)."""
    spec = coll.vector(using)
    if spec.size % m:
        raise ValueError(f"dimension {spec.size} is not divisible by m={m}")
    from pointframe.operators.ann import training_sample
    spark, dim, width = coll.df.sparkSession, spec.size, spec.size // m
    v = F.col(spec.column)
    good = v.isNotNull() & (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    place = F.col(cell).cast("int") if coarse is not None else F.lit(0)
    rows = training_sample(coll.df.filter(good), train_rows, None, seed).select(v.cast("array<double>").alias("v"), place.alias("cell"))
    base = cells_of(coarse)
    first = rows.orderBy(F.xxhash64(F.lit(seed), "v")).limit(k).collect()  # k points start the centroids
    if len(first) < k:
        raise ValueError(f"{k} centroids need as many points, got {len(first)}")
    start = np.stack([np.asarray(r["v"]) - base.get(r["cell"], 0.0) for r in first])
    books = np.stack([start[:, s * width:(s + 1) * width] for s in range(m)])
    ship_package(spark)
    for _ in range(max_iter):
        held = books

        def sums(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros(held.shape), np.zeros(held.shape[:2])
            for b in batches:
                which, x = _usable(b.column("v"), dim)
                x = _residual(x, b.column("cell").to_numpy(zero_copy_only=False)[which], base)
                codes = nearest_codes(x, held)
                for s in range(m):
                    count[s] += np.bincount(codes[:, s], minlength=k)
                    for j in range(width):
                        total[s, :, j] += np.bincount(codes[:, s], weights=x[:, s * width + j], minlength=k)
            s, c, j = (a.ravel() for a in np.indices(held.shape))
            yield pa.RecordBatch.from_pydict({"sub": pa.array(s, pa.int32()), "code": pa.array(c, pa.int32()), "part": pa.array(j, pa.int32()),
                                              "total": pa.array(total.ravel()), "n": pa.array(count[s, c])})

        found = rows.mapInArrow(sums, "sub int, code int, part int, total double, n double").groupBy("sub", "code", "part").agg(
            F.sum("total").alias("total"), F.sum("n").alias("n")).collect()  # m x k x width rows
        books = held.copy()
        for r in found:
            if r["n"]:  # an empty centroid stays where it is
                books[r["sub"], r["code"], r["part"]] = r["total"] / r["n"]
        if np.allclose(books, held, rtol=0, atol=1e-9):
            break
    return spark.createDataFrame([(s, c, books[s, c].tolist()) for s in range(m) for c in range(k)], "sub int, code int, centroid array<double>")


def _residual(x: np.ndarray, cells: np.ndarray, base: dict[int, np.ndarray]) -> np.ndarray:
    return x - np.stack([base[int(c)] for c in cells]) if base and len(x) else x


def encode_pq(coll: Collection, codebooks: DataFrame, *, using: str | None = None, out: str = "pqcode", coarse: DataFrame | None = None,
              cell: str = "cell") -> Collection:
    """``coll`` with ``out`` (array<int>), the codes of every usable vector. With ``coarse`` (cell, centroid) residuals are coded."""
    spec, books, base = coll.vector(using), books_of(codebooks), cells_of(coarse)
    if books.shape[0] * books.shape[2] != spec.size:
        raise ValueError("the codebooks are of another dimension")
    ship_package(coll.df.sparkSession)
    dim, vector = spec.size, spec.column
    fields = [f for f in coll.df.schema.fields if f.name != out]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            which, x = _usable(b.column(vector), dim)
            x = _residual(x, b.column(cell).to_numpy(zero_copy_only=False)[which] if base else which, base)
            codes = nearest_codes(x, books)
            size = np.zeros(b.num_rows, dtype=np.int32)
            size[which] = books.shape[0]
            ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            coded = pa.ListArray.from_arrays(pa.array(ends), pa.array(codes.ravel()), mask=pa.array(size == 0))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], coded], names=[*names, out])

    from pyspark.sql import types as T
    df = coll.df.select(*names).mapInArrow(run, T.StructType([*fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))
    return coll.with_df(df)


def tables(books: np.ndarray, query: np.ndarray, base: np.ndarray, distance: str) -> tuple[np.ndarray, np.ndarray]:
    """The query's look-up tables (m, k): of what is added up, and of the coded vector's square."""
    m, _, width = books.shape
    q, b = query.reshape(m, 1, width), base.reshape(m, 1, width)
    square = ((books + b) ** 2).sum(axis=2)
    if distance in (D.DOT, D.COSINE):
        return ((books + b) * q).sum(axis=2), square
    diff = q - b - books
    return ((diff**2).sum(axis=2) if distance == D.EUCLID else np.abs(diff).sum(axis=2)), square


def code_scores(codes: np.ndarray, books: np.ndarray, query: np.ndarray, base: np.ndarray, distance: str) -> np.ndarray:
    """The asymmetric score of every row of codes."""
    table, square = tables(books, query, base, distance)
    sub = np.arange(codes.shape[1])
    total = table[sub, codes].sum(axis=1)
    if distance == D.EUCLID:
        return np.sqrt(total)
    if distance == D.COSINE:
        with np.errstate(divide="ignore", invalid="ignore"):
            total = total / (np.sqrt(square[sub, codes].sum(axis=1)) * np.sqrt(query @ query))
        total[~np.isfinite(total)] = np.nan
    return total


def pq_candidates(df: DataFrame, id_col: str, codebooks: DataFrame, vector, distance: str, fetch: int, *, code: str = "pqcode",
                  coarse: DataFrame | None = None, cell: str = "cell") -> DataFrame:
    """The best ``fetch`` points by code: id, score (rounded), nearest first. ``df`` is filtered already."""
    books, query, base = books_of(codebooks), np.asarray([float(x) for x in vector]), cells_of(coarse)
    dist = D.canonical(distance)
    higher = D.higher_is_better(dist)
    rows = df.select(F.col(id_col).alias("id"), F.col(code).alias("code"), (F.col(cell).cast("int") if base else F.lit(0)).alias("cell"))
    rows = rows.filter(F.col("code").isNotNull())
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            codes = b.column("code").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            at = b.column("cell").to_numpy(zero_copy_only=False)
            score = np.full(b.num_rows, np.nan)
            for c in np.unique(at):
                own = at == c
                score[own] = code_scores(codes[own], books, query, base.get(int(c), np.zeros_like(query)), dist)
            ok = ~np.isnan(score)
            part = pa.table({"id": b.column("id").filter(pa.array(ok)), "score": round_half_up(score[ok])})
            held = part if held is None else pa.concat_tables([held, part])
            order = pc.sort_indices(held, sort_keys=[("score", "descending" if higher else "ascending"), ("id", "ascending")])
            held = held.take(order[:fetch])
        if held is not None and held.num_rows:
            yield from held.combine_chunks().to_batches()

    found = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")
    return found.orderBy(*D.order_columns(dist)).limit(fetch)
