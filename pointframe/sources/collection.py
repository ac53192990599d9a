"""Collections: an ordinary DataFrame plus a frozen description of its vectors.

A point is one row: an id column, one column per named vector and any number
of payload columns (typed columns, or a VARIANT column for a dynamic payload).
Nothing here holds data; every function returns a lazy DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointframe.functions.distance import COSINE, canonical

DEFAULT_VECTOR = ""


@dataclass(frozen=True)
class VectorSpec:
    column: str
    size: int | None = None
    distance: str = COSINE

    def __post_init__(self):
        object.__setattr__(self, "distance", canonical(self.distance))


@dataclass(frozen=True)
class Collection:
    """``df`` with its id column, dense vectors by name and sparse vectors by name."""

    df: DataFrame
    id: str = "id"
    vectors: dict[str, VectorSpec] = field(default_factory=dict)
    sparse: dict[str, str] = field(default_factory=dict)

    def vector(self, using: str | None = None) -> VectorSpec:
        if using is None or using == DEFAULT_VECTOR:
            if DEFAULT_VECTOR in self.vectors:
                return self.vectors[DEFAULT_VECTOR]
            if len(self.vectors) == 1:
                return next(iter(self.vectors.values()))
            raise ValueError(f"collection has named vectors {sorted(self.vectors)}; pass using=")
        if using not in self.vectors:
            raise ValueError(f"unknown vector {using!r}; have {sorted(self.vectors)}")
        return self.vectors[using]

    @property
    def vector_columns(self) -> list[str]:
        return [v.column for v in self.vectors.values()] + list(self.sparse.values())

    @property
    def payload_columns(self) -> list[str]:
        skip = {self.id, *self.vector_columns}
        return [c for c in self.df.columns if c not in skip]

    def with_df(self, df: DataFrame) -> "Collection":
        return replace(self, df=df)


def make_collection(df: DataFrame, id: str = "id", vectors: dict | None = None,
                    sparse: dict | None = None) -> Collection:
    """Describe ``df`` as a collection. ``vectors`` maps name to (column, size, distance)
    or a VectorSpec; the unnamed vector uses the name ``""``."""
    specs = {}
    for name, v in (vectors or {}).items():
        specs[name] = v if isinstance(v, VectorSpec) else VectorSpec(*v)
    missing = [c for c in [id, *(s.column for s in specs.values()), *(sparse or {}).values()]
               if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in DataFrame: {missing}")
    return Collection(df=df, id=id, vectors=specs, sparse=dict(sparse or {}))


def _finite_all(col: Column) -> Column:
    return F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))


def validation_report(coll: Collection) -> DataFrame:
    """One row of defect counts over the whole table.

    Columns: n_points, null_ids, duplicate_ids, then for every dense vector
    ``<name>_null``, ``<name>_bad_dim``, ``<name>_non_finite``.
    Plan: a per-id count (with the per-row defect flags summed alongside; partial
    aggregation before the shuffle, so an id repeated in a third of all rows is
    combined map-side), then one global aggregation of those per-id rows.
    """
    df = coll.df
    flags = []
    for name, spec in sorted(coll.vectors.items()):
        label = name or "vector"
        c = F.col(spec.column)
        bad_dim = (F.size(c) != spec.size) if spec.size is not None else F.lit(False)
        flags += [
            (f"{label}_null", F.when(c.isNull(), 1).otherwise(0)),
            (f"{label}_bad_dim", F.when(c.isNotNull() & bad_dim, 1).otherwise(0)),
            (f"{label}_non_finite", F.when(c.isNotNull() & ~_finite_all(c), 1).otherwise(0)),
        ]
    per_id = df.groupBy(F.col(coll.id).alias("_id")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(e).alias(n) for n, e in flags])
    return per_id.agg(
        F.sum("_n").cast("long").alias("n_points"),
        F.coalesce(F.sum(F.when(F.col("_id").isNull(), F.col("_n"))), F.lit(0)).cast("long").alias("null_ids"),
        F.coalesce(F.sum(F.when(F.col("_id").isNotNull() & (F.col("_n") > 1), F.col("_n") - 1)), F.lit(0))
         .cast("long").alias("duplicate_ids"),
        *[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n, _ in flags])


def make_checked_collection(df: DataFrame, id: str = "id", vectors: dict | None = None,
                            sparse: dict | None = None, on_invalid: str = "raise") -> Collection:
    """``make_collection`` plus validation. ``on_invalid='raise'`` fails on any defect;
    ``'quarantine'`` keeps only rows with a non-null id, right-size finite vectors."""
    coll = make_collection(df, id, vectors, sparse)
    if on_invalid == "raise":
        row = validation_report(coll).first().asDict()
        bad = {k: v for k, v in row.items() if k != "n_points" and v}
        if bad:
            raise ValueError(f"invalid collection: {bad}")
        return coll
    if on_invalid == "quarantine":
        return coll.with_df(df.filter(valid_row(coll)))
    raise ValueError("on_invalid must be 'raise' or 'quarantine'")


def valid_row(coll: Collection) -> Column:
    cond = F.col(coll.id).isNotNull()
    for spec in coll.vectors.values():
        c = F.col(spec.column)
        ok = c.isNull() | _finite_all(c)
        if spec.size is not None:
            ok = c.isNull() | ((F.size(c) == spec.size) & _finite_all(c))
        cond = cond & F.coalesce(ok, F.lit(False))
    return cond


def from_batch(df: DataFrame, ids: str = "ids", vectors: str = "vectors",
               payloads: str | None = "payloads", id_name: str = "id",
               vector_name: str = "vector") -> DataFrame:
    """Columnar batch (parallel ``ids[]``, ``vectors[]``, ``payloads[]``) to one row per point.

    Arrays are zipped by position inside each input row, so work spreads with
    the input rows; unequal array lengths raise instead of padding silently.
    """
    n = F.size(ids)
    check = [F.size(vectors) == n]
    if payloads:
        check.append(F.size(payloads) == n)
    ok = check[0]
    for c in check[1:]:
        ok = ok & c
    # The length check sits in the row filter so column pruning cannot drop it.
    guarded = df.where(F.when(ok, n > 0).otherwise(
        F.raise_error(F.lit("from_batch: ids, vectors and payloads differ in length"))))
    parts = [F.col(ids).alias("i"), F.col(vectors).alias("v")] + ([F.col(payloads).alias("p")] if payloads else [])
    each = guarded.select(F.explode(F.arrays_zip(*parts)).alias("_e"))
    fields = [F.col("_e.i").alias(id_name), F.col("_e.v").alias(vector_name)]
    return each.select(*fields, *([F.col("_e.p").alias("payload")] if payloads else []))


def vector_type() -> T.DataType:
    return T.ArrayType(T.FloatType(), containsNull=False)


def init_from(source: Collection, filter: dict | None = None, vectors: list[str] | None = None) -> Collection:
    """A new collection seeded from another (S7): its rows (optionally filtered) and
    vector config (optionally only the named vectors). Write it to a new path to keep it."""
    from pointframe.functions.filters import build_filter
    df = source.df if not filter else source.df.filter(build_filter(filter, source.df.schema, source.id))
    specs = source.vectors if vectors is None else {n: source.vector(n) for n in vectors}
    drop = [s.column for n, s in source.vectors.items() if n not in specs]
    return Collection(df=df.drop(*drop), id=source.id, vectors=dict(specs), sparse=dict(source.sparse))
