"""Estimated counts from stored sketches (A2): mergeable HyperLogLog sketches of the ids per indexed payload value.

``build_count_sketches`` writes one row for every (key, value) that occurs (an array counts under each of its elements, a
null under no value) and one for all points, partitioned by key. Sketches are made map-side and merged, so a value
that a third of all points have is one row per task. ``estimate_count`` answers a filter from these
rows alone: ``match`` conditions read the sketches of their values, alternatives are merged,
and conditions that hold together are counted by inclusion and exclusion over merged sketches. Nothing of the
collection is read.

A sketch of 2^lg_k registers has a relative error of about 1.04 / sqrt(2^lg_k) (one standard deviation; 1.6 % at
12). An estimate of several conditions together adds the errors of the merged counts, which
are of the size of the larger sets: small intersections of large sets are rough.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointframe.sources.collection import Collection

ALL = "*"
MAX_TOGETHER = 4  # conditions that hold together; their subsets are counted one by one


def build_count_sketches(coll: Collection, keys: list[str], path: str, lg_k: int = 12) -> None:
    """Writes the sketches of ``coll`` for the payload ``keys``: key, value (as text), sketch."""
    known = set(coll.payload_columns)
    if set(keys) - known or ALL in keys:
        raise ValueError(f"unknown payload keys {sorted(set(keys) - known)}")

    def values(key: str) -> Column:
        kind = coll.df.schema[key].dataType
        text = F.col(key).cast("array<string>") if isinstance(kind, T.ArrayType) else F.array(F.col(key).cast("string"))
        distinct = F.filter(F.array_distinct(F.coalesce(text, F.array().cast("array<string>"))), lambda v: v.isNotNull())
        return F.transform(distinct, lambda v: F.struct(F.lit(key).alias("key"), v.alias("value")))

    every = F.array(F.struct(F.lit(ALL).alias("key"), F.lit(ALL).alias("value")))
    rows = coll.df.select(F.col(coll.id).alias("id"), F.explode(F.concat(every, *[values(k) for k in keys])).alias("at"))
    found = rows.groupBy("at.key", "at.value").agg(F.hll_sketch_agg("id", lg_k).alias("sketch"))
    found.write.mode("overwrite").partitionBy("key").parquet(path)


def _text(v) -> str:
    return str(v).lower() if isinstance(v, bool) else str(v)


def _condition(c: dict) -> list[tuple[str, str]]:
    """The (key, value) pairs of which one must hold."""
    match = c.get("match") if set(c) == {"key", "match"} else None
    if not match or len(match) != 1 or next(iter(match)) not in ("value", "any"):
        raise ValueError(f"sketches answer match.value and match.any, not {c}")
    kind, given = next(iter(match.items()))
    return [(c["key"], _text(v)) for v in (given if kind == "any" else [given])]


def estimate_count(spark: SparkSession, path: str, filter: dict | None = None) -> DataFrame:
    """One row: ``count``, the estimated number of points that meet ``filter`` (``must`` and ``should`` of match conditions)."""
    filter = filter or {}
    if set(filter) - {"must", "should"}:
        raise ValueError(f"sketches answer must and should, not {sorted(filter)}")
    together = [_condition(c) for c in filter.get("must") or []]
    if filter.get("should"):
        together.append([p for c in filter["should"] for p in _condition(c)])
    if len(together) > MAX_TOGETHER:
        raise ValueError(f"at most {MAX_TOGETHER} conditions can hold together, got {len(together)}")
    together = together or [[(ALL, ALL)]]
    stored = spark.read.parquet(path)
    keys = sorted({k for c in together for k, _ in c})
    rows = stored.filter(F.col("key").isin(keys))  # a partition filter

    def any_of(pairs: list[tuple[str, str]]) -> Column:
        return reduce(Column.__or__, [(F.col("key") == k) & (F.col("value") == v) for k, v in pairs], F.lit(False))

    # |A and B and ...| as a sum over merged sketches: + single ones, - of two, + of three ...
    parts = []
    for size in range(1, len(together) + 1):
        for some in combinations(together, size):
            merged = F.hll_union_agg(F.when(any_of([p for c in some for p in c]), F.col("sketch")), F.lit(True))
            parts.append((1 if size % 2 else -1) * F.coalesce(F.hll_sketch_estimate(merged), F.lit(0)))
    total = reduce(Column.__add__, parts)
    return rows.agg(F.greatest(F.lit(0), total).cast("long").alias("count"))
