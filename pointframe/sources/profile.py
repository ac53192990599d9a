"""Collection profile and payload schema (S8, S9), shard layout.

Each is one aggregation job over the whole table; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointframe.sources.collection import Collection


def collection_profile(coll: Collection, index_col: str | None = None) -> DataFrame:
    """``points_count, vectors_count, indexed_vectors_count``.

    vectors_count counts non-null vectors over all named dense vectors;
    indexed_vectors_count counts rows holding an ANN cell in ``index_col`` (0 without one).
    """
    vecs = [s.column for s in coll.vectors.values()]
    v = F.lit(0).cast("long")
    for c in vecs:
        v = v + F.when(F.col(c).isNotNull(), 1).otherwise(0)
    idx = F.count(F.col(index_col)) if index_col else F.lit(0).cast("long")
    return coll.df.agg(F.count(F.lit(1)).alias("points_count"),
                       F.sum(v).cast("long").alias("vectors_count"),
                       idx.cast("long").alias("indexed_vectors_count"))


def payload_type(dt: T.DataType) -> str:
    """Payload schema type name of a Spark type (arrays report their element type)."""
    if isinstance(dt, T.ArrayType):
        return payload_type(dt.elementType)
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return "keyword"
    if isinstance(dt, T.IntegralType):
        return "integer"
    if isinstance(dt, T.FractionalType):
        return "float"
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    if isinstance(dt, T.StructType) and {f.name for f in dt.fields} >= {"lat", "lon"}:
        return "geo"
    return dt.simpleString()


def payload_schema(coll: Collection) -> DataFrame:
    """``key, data_type, points`` for every typed payload column (S9): one ``agg`` and an unpivot."""
    cols = [c for c in coll.payload_columns if not isinstance(coll.df.schema[c].dataType, T.VariantType)]
    if not cols:
        spark = coll.df.sparkSession
        return spark.createDataFrame([], "key string, data_type string, points bigint")
    wide = coll.df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', '{payload_type(coll.df.schema[c].dataType)}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (key, data_type, points)")


def variant_payload_schema(df: DataFrame, col: str) -> DataFrame:
    """``key, data_type, points`` over the top-level keys of a VARIANT payload column.

    ``variant_explode`` yields one row per key and point; the per-(key, type)
    count is a partial + final aggregation.
    """
    kv = df.selectExpr(f"explode_outer(try_cast({col} AS map<string, variant>)) AS (key, value)")
    kind = F.lower(F.schema_of_variant("value"))
    mapped = (F.when(kind.isin("bigint", "int", "smallint", "tinyint") | kind.startswith("decimal(")
                     & kind.endswith(",0)"), "integer")
               .when(kind.isin("double", "float") | kind.startswith("decimal("), "float")
               .when(kind == "string", "keyword")
               .when(kind == "boolean", "bool")
               .otherwise(kind))
    return (kv.filter(F.col("key").isNotNull()).groupBy("key", mapped.alias("data_type"))
              .agg(F.count(F.lit(1)).alias("points")))


def shard_distribution(df: DataFrame, key: str) -> DataFrame:
    """Points per shard key value."""
    return df.groupBy(F.col(key).alias("shard_key")).agg(F.count(F.lit(1)).alias("points_count"))


def drop_shard_key(df: DataFrame, key: str, value) -> DataFrame:
    """All points except those of shard ``value`` (S15); NULL keys are kept."""
    return df.filter(~F.col(key).eqNullSafe(F.lit(value)))


def write_sharded(df: DataFrame, key: str, path: str, rows_per_task: int = 5_000_000, mode: str = "error") -> None:
    """Write one directory per shard key (S13), so reads of one shard prune the rest.

    Rows are shuffled on (key, salt). A shard's salts follow its counted rows, so a
    shard holding a third of the data is written by as many tasks as it needs.
    """
    salts = df.groupBy(F.col(key).alias("_k")).agg(F.ceil(F.count(F.lit(1)) / rows_per_task).alias("_n"))
    salted = df.join(salts, F.col(key).eqNullSafe(F.col("_k")))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c != key]), F.col("_n"))
    out = salted.withColumn("_salt", salt).repartition(F.col(key), F.col("_salt")).select(*df.columns)
    out.write.mode(mode).partitionBy(key).parquet(path)


def read_shard(spark, path: str, key: str, value) -> DataFrame:
    """Read one shard of a ``write_sharded`` layout (partition pruning)."""
    return spark.read.parquet(path).filter(F.col(key) == F.lit(value))
