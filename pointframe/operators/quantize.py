"""Quantized search (Q21-Q24): compressed codes for a cheap first pass, exact rescoring after.

* **scalar int8**: global bounds [lo, hi] from the ``quantile`` of all vector
  components (``percentile_approx`` over the exploded values, one aggregation);
  code = round((x - lo) / (hi - lo) * 255) - 128, clipped.
* **binary**: one sign bit per dimension packed into ``array<bigint>`` words;
  distance = Hamming (``bit_count`` of XOR).
* **product**: see ``pq.py``; each metric has its own look-up tables.

``quantized_search`` takes ``limit * oversampling`` candidates by the code score,
then (``rescore=True``) joins them back to the original vectors - a broadcast of
at most limit * oversampling ids - and scores them exactly. ``ignore=True``
skips the codes and searches exactly.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointframe.functions import distance as D
from pointframe.operators import pq as PQ
from pointframe.operators.search import filtered, payload_columns, project, ranked, search
from pointframe.sources.collection import Collection

CODE_COLUMNS = ("qcode", "bcode", "pqcode")

# ---------------------------------------------------------------- scalar int8


def scalar_bounds(coll: Collection, quantile: float = 0.99, using: str | None = None) -> DataFrame:
    """One row ``lo, hi``: the central ``quantile`` of all vector components."""
    spec = coll.vector(using)
    vals = coll.df.select(F.explode(spec.column).alias("x0")).select(F.col("x0").cast("double").alias("x"))
    tail = (1.0 - quantile) / 2.0
    return vals.agg(F.percentile_approx("x", [tail, 1.0 - tail], 10000).alias("b")) \
               .select(F.col("b")[0].alias("lo"), F.col("b")[1].alias("hi"))


def scalar_quantize(coll: Collection, bounds: DataFrame, using: str | None = None,
                    out: str = "qcode") -> Collection:
    """Add ``out`` = int8 codes (``array<tinyint>``) computed with the given bounds."""
    spec = coll.vector(using)
    lo = bounds.select("lo").scalar()
    hi = bounds.select("hi").scalar()
    df = coll.df.withColumn("_lo", lo).withColumn("_hi", hi)
    scale = F.lit(255.0) / (F.col("_hi") - F.col("_lo"))
    code = F.transform(spec.column, lambda x: (F.least(F.lit(255.0), F.greatest(F.lit(0.0),
                       F.round((x.cast("double") - F.col("_lo")) * scale))) - 128).cast("tinyint"))
    return coll.with_df(df.withColumn(out, code).drop("_lo", "_hi"))


def scalar_dequantized(code: Column, lo: Column, hi: Column) -> Column:
    return F.transform(code, lambda c: lo + (c.cast("double") + 128) * (hi - lo) / 255.0)


# ---------------------------------------------------------------- binary


def binary_codes(vec: Column, dim: int) -> Column:
    """Sign bits packed into ``ceil(dim / 64)`` bigint words (bit j of word w = dim 64w + j)."""
    words = []
    for w in range(math.ceil(dim / 64)):
        acc = F.lit(0).cast("long")
        for j in range(min(64, dim - 64 * w)):
            bit = F.when(vec[64 * w + j] > 0, F.lit(1)).otherwise(F.lit(0)).cast("long")
            acc = acc.bitwiseOR(F.shiftleft(bit, j))
        words.append(acc)
    return F.array(*words)


def binary_quantize(coll: Collection, using: str | None = None, out: str = "bcode") -> Collection:
    spec = coll.vector(using)
    return coll.with_df(coll.df.withColumn(out, binary_codes(F.col(spec.column), spec.size)))


def _query_words(vector, dim: int) -> list[int]:
    bits = (np.asarray(vector, dtype=np.float64) > 0).astype(np.uint64)
    words = []
    for w in range(math.ceil(dim / 64)):
        chunk = bits[64 * w: 64 * w + 64]
        v = int(sum(int(b) << j for j, b in enumerate(chunk)))
        words.append(v - (1 << 64) if v >= (1 << 63) else v)
    return words


def hamming(code: Column, words: list[int]) -> Column:
    return F.aggregate(F.zip_with(code, F.lit(words).cast("array<bigint>"),
                                  lambda a, b: F.bit_count(a.bitwiseXOR(b)).cast("long")),
                       F.lit(0).cast("long"), lambda acc, x: acc + x)


# ---------------------------------------------------------------- product quantization


def build_pq(coll: Collection, m: int = 8, k: int = 16, *, using: str | None = None, seed: int = 0,
             max_iter: int = 20, train_rows: int | None = 100_000) -> tuple[Collection, DataFrame]:
    """Trains the codebooks (``pq.train_pq``) and codes every point: the collection with ``pqcode``, and the table ``sub, code, centroid``."""
    books = PQ.train_pq(coll, m, k, using=using, seed=seed, max_iter=max_iter, train_rows=train_rows)
    return PQ.encode_pq(coll, books, using=using), books


# ---------------------------------------------------------------- search with codes


def quantized_search(coll: Collection, vector, *, method: str, limit: int = 10, using: str | None = None,
                     oversampling: float = 2.0, rescore: bool = True, ignore: bool = False,
                     bounds: DataFrame | None = None, codebooks: DataFrame | None = None, coarse: DataFrame | None = None,
                     filter: dict | None = None, with_payload=True) -> DataFrame:
    """Two-stage search over codes (``method`` in scalar, binary, pq): ``id, <payload>, score``."""
    spec = coll.vector(using)
    if ignore:
        return search(coll, vector, using=using, limit=limit, filter=filter, with_payload=with_payload)
    q = [float(x) for x in vector]
    keep = [c for c in payload_columns(coll, with_payload) if c not in CODE_COLUMNS]
    fetch = max(limit, int(math.ceil(limit * oversampling)))
    if method == "scalar":
        lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
        df = filtered(coll, filter).withColumn("_lo", lo).withColumn("_hi", hi)
        approx = D.raw_score(scalar_dequantized(F.col("qcode"), F.col("_lo"), F.col("_hi")), q, spec.distance)
        higher = D.higher_is_better(spec.distance)
    elif method == "binary":
        df = filtered(coll, filter)
        approx = -hamming(F.col("bcode"), _query_words(q, spec.size)).cast("double")
        higher = True
    elif method == "pq":
        rows = filtered(coll, filter)
        hits = PQ.pq_candidates(rows, coll.id, codebooks, q, spec.distance, fetch, coarse=coarse)
        if rescore:
            exact = rows.join(F.broadcast(hits.select(F.col("id").alias(coll.id))), coll.id, "left_semi")
            return ranked(coll, exact, q, using=using, limit=limit, with_payload=keep)
        payload = project(coll, coll.df, keep).join(F.broadcast(hits.limit(limit)), "id")  # at most fetch rows
        return payload.select("id", *keep, "score").orderBy(*D.order_columns(spec.distance))
    else:
        raise ValueError("method must be scalar, binary or pq")
    first = project(coll, df, keep, extra=[F.round(approx, 6).alias("score")])
    order = [F.col("score").desc_nulls_last() if higher else F.col("score").asc_nulls_last(), F.col("id").asc()]
    # NULL codes sort last; filter after the cut so the code score is computed once per row
    cand = first.orderBy(*order).limit(fetch).filter(F.col("score").isNotNull())
    if not rescore:
        return cand.orderBy(*order).limit(limit)
    ids = cand.select(F.col("id").alias(coll.id))
    exact = coll.df.join(F.broadcast(ids), coll.id, "left_semi")
    return ranked(coll, exact, q, using=using, limit=limit, with_payload=keep)
