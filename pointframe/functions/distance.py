"""Similarity and distance expressions (D1-D4) as Spark Columns.

All arithmetic is in double. Cosine and Dot: higher is better. Euclid and
Manhattan return the raw distance: lower is better. A zero vector has no
cosine and yields NULL, so it drops out of every ranking.

The expressions are higher-order functions over ``array<float>`` columns; they
run inside the JVM next to the scan. Many-query workloads use the Arrow kernel
in ``pointframe.operators.kernel`` instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

COSINE, DOT, EUCLID, MANHATTAN = "Cosine", "Dot", "Euclid", "Manhattan"
DISTANCES = (COSINE, DOT, EUCLID, MANHATTAN)
SCORE_DIGITS = 6


def canonical(distance: str) -> str:
    for d in DISTANCES:
        if d.lower() == str(distance).lower():
            return d
    raise ValueError(f"unknown distance {distance!r}; expected one of {DISTANCES}")


def higher_is_better(distance: str) -> bool:
    return canonical(distance) in (COSINE, DOT)


def as_column(v) -> Column:
    """A query vector as a Column: a Column is kept, a Python sequence becomes a literal."""
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.col(v)
    return F.lit([float(x) for x in v])


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return _sum(F.zip_with(_col(a), as_column(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm(a) -> Column:
    a = as_column(a)
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def euclid(a, b) -> Column:
    # (x - y)^2 summed directly; a^2 + b^2 - 2ab loses precision near zero.
    return F.sqrt(_sum(F.zip_with(_col(a), as_column(b),
                                  lambda x, y: (x.cast("double") - y.cast("double")) *
                                               (x.cast("double") - y.cast("double")))))


def manhattan(a, b) -> Column:
    return _sum(F.zip_with(_col(a), as_column(b),
                           lambda x, y: F.abs(x.cast("double") - y.cast("double"))))


def cosine(a, b, b_norm: float | Column | None = None) -> Column:
    na = norm(a)
    nb = norm(b) if b_norm is None else (b_norm if isinstance(b_norm, Column) else F.lit(float(b_norm)))
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb))


def raw_score(vec, query, distance: str) -> Column:
    """Unrounded score of column ``vec`` against ``query`` (literal list or Column)."""
    d = canonical(distance)
    if d == COSINE:
        qn = None
        if not isinstance(query, (Column, str)):
            qn = math.sqrt(sum(float(x) * float(x) for x in query))
        return cosine(vec, query, qn)
    if d == DOT:
        return dot(vec, query)
    if d == EUCLID:
        return euclid(vec, query)
    return manhattan(vec, query)


def score(vec, query, distance: str) -> Column:
    """Score rounded to ``SCORE_DIGITS``; rankings sort on this value, then on id. What is not a number is no score."""
    return F.round(F.nanvl(raw_score(vec, query, distance), F.lit(None).cast("double")), SCORE_DIGITS)


def order_columns(distance: str, score_col: str = "score", id_col: str = "id") -> list[Column]:
    """Total order used by every ranking: score (by direction, NULL last), then id ascending."""
    s = F.col(score_col)
    return [s.desc_nulls_last() if higher_is_better(distance) else s.asc_nulls_last(), F.col(id_col).asc()]


def passes_threshold(score_col: Column, threshold: float | None, distance: str) -> Column | None:
    """``score_threshold`` is a minimum for similarities and a maximum for distances."""
    if threshold is None:
        return None
    return score_col >= threshold if higher_is_better(distance) else score_col <= threshold


def sigmoid(x: Column) -> Column:
    """Monotone squash to (0, 1) without exp: 0.5 * (1 + x / (1 + |x|))."""
    return F.lit(0.5) * (F.lit(1.0) + x / (F.lit(1.0) + F.abs(x)))


def check_dim(vector: Sequence[float], size: int | None) -> None:
    if size is not None and len(vector) != size:
        raise ValueError(f"query vector has dimension {len(vector)}, collection expects {size}")
