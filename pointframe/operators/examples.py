"""Example sets for recommend and discover: ids or raw vectors -> a small DataFrame.

An example is a point id (its stored vector is looked up) or a raw vector. The
example lists come from requests, so they are bounded by the request size.
All ids of all requests are resolved in ONE filtered scan of the collection and
attached to their requests through a request-sized broadcast mapping; the
vectors then reach the scoring plan as scalar subqueries or through the kernel,
never via Python on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointframe.functions import distance as D
from pointframe.sources.collection import Collection

_ID_SCHEMA = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("ord", T.IntegerType()), T.StructField("ex_id", T.StringType())])
_VEC_SCHEMA = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("role", T.StringType()),
                            T.StructField("ord", T.IntegerType()), T.StructField("ex_id", T.StringType()),
                            T.StructField("vec", T.ArrayType(T.DoubleType()))])


def split_examples(items) -> tuple[list, list]:
    """Separate ids from raw vectors."""
    ids, vecs = [], []
    for x in items or []:
        if isinstance(x, (list, tuple)):
            vecs.append([float(v) for v in x])
        else:
            ids.append(x)
    return ids, vecs


def examples_table(coll: Collection, requests: list[tuple[int, dict[str, list]]], using: str | None = None,
                   source: Collection | None = None) -> DataFrame:
    """``query_id, role, ord, ex_id, vec`` for every example of every request.

    ``requests`` is ``[(query_id, {role: [id or vector, ...]})]``; ``ord`` is the
    position in its list. Ids are resolved in ``source`` (``lookup_from``) or in
    ``coll`` by one scan; an id that does not exist contributes nothing.
    """
    src = source or coll
    spec = src.vector(using)
    spark = coll.df.sparkSession
    id_rows, vec_rows, all_ids = [], [], []
    for qid, roles in requests:
        for role, items in roles.items():
            for j, item in enumerate(items or []):
                if isinstance(item, (list, tuple)):
                    vec_rows.append((int(qid), role, j, None, [float(v) for v in item]))
                else:
                    id_rows.append((int(qid), role, j, str(item)))
                    all_ids.append(item)
    out = spark.createDataFrame(vec_rows, _VEC_SCHEMA)
    if id_rows:
        pts = (src.df.filter(F.col(src.id).isin(sorted(set(all_ids), key=str)))
                     .select(F.col(src.id).cast("string").alias("ex_id"),
                             F.col(spec.column).cast("array<double>").alias("vec")))
        # request-sized mapping from (request, role, position) to id
        mapping = F.broadcast(spark.createDataFrame(id_rows, _ID_SCHEMA))
        out = out.unionByName(pts.join(mapping, "ex_id").select(*_VEC_SCHEMA.fieldNames()))
    return out


def examples_frame(coll: Collection, roles: dict[str, list], using: str | None = None,
                   source: Collection | None = None) -> DataFrame:
    """``role, ord, ex_id, vec`` for the examples of one request."""
    return examples_table(coll, [(0, roles)], using, source).drop("query_id")


def example_ids(roles: dict[str, list]) -> list:
    ids = []
    for items in roles.values():
        ids += split_examples(items)[0]
    return ids


def mean_vectors(ex: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """Per (group, role): the element-wise mean vector, as ``array<double>`` in dimension order.

    For example sets of any size: ``posexplode`` + ``avg`` runs as a partial +
    final aggregation, each output row holds one vector (bounded by the dimension).
    """
    g = list(group_cols or [])
    exploded = ex.select(*g, "role", F.posexplode("vec").alias("dim", "x"))
    per_dim = exploded.groupBy(*g, "role", "dim").agg(F.avg("x").alias("x"))
    return (per_dim.groupBy(*g, "role")
                   .agg(F.sort_array(F.collect_list(F.struct("dim", "x"))).alias("_s"))
                   .select(*g, "role", F.transform("_s", lambda s: s["x"]).alias("mean")))


def _mean_of(vecs: Column) -> Column:
    """Element-wise mean of an array of equal-length vectors (NULL for an empty array)."""
    n = F.size(vecs)
    zero = F.array_repeat(F.lit(0.0), F.size(F.element_at(vecs, 1)))
    total = F.aggregate(vecs, zero, lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b))
    return F.when(n > 0, F.transform(total, lambda x: x / n))


def rocchio_targets(ex: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """Per group: ``target`` = 2 * mean(pos) - mean(neg), or mean(pos) without negatives.

    The examples of one request are bounded by the request, so they are gathered
    with one grouped ``collect_list`` and averaged in the same step.
    """
    g = list(group_cols or [])
    per = ex.groupBy(*g).agg(F.collect_list(F.struct("role", "vec")).alias("_e"))
    pos = _mean_of(F.transform(F.filter("_e", lambda e: e["role"] == "pos"), lambda e: e["vec"]))
    neg = _mean_of(F.transform(F.filter("_e", lambda e: e["role"] == "neg"), lambda e: e["vec"]))
    with_means = per.select(*g, pos.alias("p"), neg.alias("n"))
    target = F.when(F.col("n").isNull(), F.col("p")).otherwise(
        F.zip_with("p", "n", lambda a, b: F.lit(2.0) * a - b))
    return with_means.filter(F.col("p").isNotNull()).select(*g, target.alias("target"))


def with_norms(ex: DataFrame) -> DataFrame:
    return ex.withColumn("norm", D.norm(F.col("vec")))


def scalar_array(df: DataFrame, col: str | Column) -> Column:
    """A one-row, one-column DataFrame's value as a scalar subquery Column."""
    c = F.col(col) if isinstance(col, str) else col
    return df.select(c.alias("_v")).scalar()
