"""The driver's tables as collections, plus the shapes derived from them by formula.

Only this package and the tests know the fixture tables; the library takes any
DataFrame and column names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointframe.sources.collection import Collection, make_collection

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# fixed values: the literal query vector used by the vector queries (64 dims)
QUERY_VECTOR = [round(math.sin(0.7 * i + 0.3), 6) for i in range(64)]
QUERY_POINT = 7
# fixed values: hashed words (the, of, and, in, license) and their weights
SPARSE_QUERY = ([150749894, 146770004, 199611859, 20667390, 119043991], [1.0, 0.5, 0.5, 0.25, 3.0])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> Collection:
    """``embeddings`` as a collection: id ``vec_id``, unnamed cosine vector, payload ``label``."""
    return make_collection(load(spark, sf_dir, "embeddings"), id="vec_id",
                           vectors={"": ("embedding", 64, "Cosine")})


def embeddings_as(spark: SparkSession, sf_dir: str, distance: str) -> Collection:
    return make_collection(load(spark, sf_dir, "embeddings"), id="vec_id",
                           vectors={"": ("embedding", 64, distance)})


def named_embeddings(spark: SparkSession, sf_dir: str) -> Collection:
    """Named vectors: ``front`` = dims 1-32, ``back`` = dims 33-64."""
    df = (load(spark, sf_dir, "embeddings")
          .select("vec_id", "label",
                  F.slice("embedding", 1, 32).alias("front"),
                  F.slice("embedding", 33, 32).alias("back")))
    return make_collection(df, id="vec_id", vectors={"front": ("front", 32, "Cosine"),
                                                     "back": ("back", 32, "Euclid")})


def embeddings_payload(spark: SparkSession, sf_dir: str) -> Collection:
    """Embeddings with nullable and array payloads: ``label_n`` is NULL when vec_id % 7 = 0,
    ``tags`` is [] when vec_id % 5 = 0, else [label, label + 1]."""
    df = (load(spark, sf_dir, "embeddings")
          .select("vec_id", "embedding", "label",
                  F.when(F.col("vec_id") % 7 == 0, F.lit(None).cast("int")).otherwise(F.col("label")).alias("label_n"),
                  F.when(F.col("vec_id") % 5 == 0, F.array().cast("array<int>"))
                   .otherwise(F.array(F.col("label"), F.col("label") + 1)).alias("tags")))
    return make_collection(df, id="vec_id", vectors={"": ("embedding", 64, "Cosine")})


def customers_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a derived geo point ``loc`` = struct(lat, lon)."""
    c = load(spark, sf_dir, "customer")
    lat = (F.col("c_custkey") * 37 % 18000) / F.lit(100.0).cast("double") - 90
    lon = (F.col("c_custkey") * 91 % 36000) / F.lit(100.0).cast("double") - 180
    return c.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
                    F.struct(lat.alias("lat"), lon.alias("lon")).alias("loc"))


def orders_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lineitems as a sorted array of structs (nested payload)."""
    li = load(spark, sf_dir, "lineitem")
    items = (li.groupBy("l_orderkey")
               .agg(F.sort_array(F.collect_list(F.struct(
                   F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("qty"),
                   F.col("l_discount").alias("discount"), F.col("l_returnflag").alias("flag")))).alias("items")))
    o = load(spark, sf_dir, "orders")
    return o.join(items, o.o_orderkey == items.l_orderkey, "left").drop("l_orderkey")


def events_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``props`` parsed to a VARIANT payload."""
    e = load(spark, sf_dir, "events")
    return e.select("event_id", "ts", "user_id", "event_type", "value",
                    F.parse_json("props").alias("payload"))


def multi_embeddings(spark: SparkSession, sf_dir: str) -> Collection:
    """Three named vectors over one table: ``full`` (cosine), ``front`` (cosine), ``back`` (Euclid)."""
    df = (load(spark, sf_dir, "embeddings")
          .select("vec_id", "label", "embedding",
                  F.slice("embedding", 1, 32).alias("front"),
                  F.slice("embedding", 33, 32).alias("back")))
    return make_collection(df, id="vec_id", vectors={"": ("embedding", 64, "Cosine"),
                                                     "front": ("front", 32, "Cosine"),
                                                     "back": ("back", 32, "Euclid")})
