"""Payload index jobs (I1-I9) re-aimed as Spark jobs that build derived tables.

Indexes are long tables (one row per value and point), never one collected
list per value: a value held by a third of all points stays spread over many
partitions. Text postings are ``token, id, tf``; lookups join them with a
broadcast of the query's tokens (bounded by the query length).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointframe.functions import text as TX
from pointframe.functions.filters import EARTH_RADIUS_M, haversine_m
from pointframe.plans.partitioning import spread

# ---------------------------------------------------------------- text (I4-I8)


def text_postings(df: DataFrame, id_col: str, field: str, tokenizer: str = "word",
                  min_token_len: int | None = None, max_token_len: int | None = None,
                  lowercase: bool = True) -> DataFrame:
    """Postings ``token, id, tf`` of a text field; tf = occurrences in the point's text."""
    toks = TX.tokens(F.col(field), tokenizer, lowercase, min_token_len, max_token_len)
    ex = spread(df.select(id_col, field)).select(F.col(id_col).alias("id"), F.explode(toks).alias("token"))
    return ex.groupBy("token", "id").agg(F.count(F.lit(1)).alias("tf"))


def text_dictionary(postings: DataFrame) -> DataFrame:
    """Per token: ``n_points`` holding it and ``n_occurrences`` (partial + final aggregation)."""
    return postings.groupBy("token").agg(F.count(F.lit(1)).alias("n_points"),
                                         F.sum("tf").cast("long").alias("n_occurrences"))


def text_search(postings: DataFrame, query: str, tokenizer: str = "word") -> DataFrame:
    """``id`` of every point whose text holds all distinct query tokens (I8)."""
    spark = postings.sparkSession
    q = spark.range(1).select(F.explode(F.array_distinct(TX.tokens(F.lit(query), tokenizer))).alias("token"))
    n = q.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    hits = postings.join(F.broadcast(q), "token").groupBy("id").agg(F.count(F.lit(1)).alias("m"))
    return hits.filter(F.col("m") == n).select("id")


# ---------------------------------------------------------------- values


def value_index(df: DataFrame, id_col: str, field: str) -> DataFrame:
    """Long value index ``value, id`` (arrays contribute every element; nulls skipped)."""
    dtype = df.schema[field].dataType
    v = F.explode(field) if isinstance(dtype, T.ArrayType) else F.col(field)
    return df.select(v.alias("value"), F.col(id_col).alias("id")).filter(F.col("value").isNotNull())


def value_index_stats(df: DataFrame, id_col: str, field: str) -> DataFrame:
    """``value, n_points`` per distinct value of ``field``."""
    return (value_index(df, id_col, field).groupBy("value")
            .agg(F.countDistinct("id").alias("n_points")))


# ---------------------------------------------------------------- ranges


def range_layout(df: DataFrame, field: str, partitions: int | None = None, id_col: str | None = None) -> DataFrame:
    """Range-partition and sort by ``field`` so parquet row-group min/max statistics
    let range filters skip files (I2). Write the result with ``df.write.parquet``."""
    # the id as second key splits a value that very many rows share
    keys = [F.col(field), *([F.col(id_col)] if id_col else [])]
    n = partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return df.repartitionByRange(int(n), *keys).sortWithinPartitions(*keys)


def range_layout_summary(df: DataFrame, field: str) -> DataFrame:
    """Per output partition of a range layout: ``part, lo, hi, n`` (to check that ranges do not overlap)."""
    return (df.withColumn("part", F.spark_partition_id())
              .groupBy("part").agg(F.min(field).alias("lo"), F.max(field).alias("hi"),
                                   F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- geo


def geo_cell_index(df: DataFrame, id_col: str, geo_col: str, cell_deg: float = 10.0) -> DataFrame:
    """``cell_lat, cell_lon, id, lat, lon`` with cells of ``cell_deg`` degrees."""
    lat, lon = F.col(geo_col)["lat"], F.col(geo_col)["lon"]
    return df.select(F.floor(lat / cell_deg).cast("int").alias("cell_lat"),
                     F.floor(lon / cell_deg).cast("int").alias("cell_lon"),
                     F.col(id_col).alias("id"), lat.alias("lat"), lon.alias("lon"))


def geo_cells(df: DataFrame, id_col: str, geo_col: str, cell_deg: float = 10.0) -> DataFrame:
    """Points per grid cell: ``cell_lat, cell_lon, n_points``."""
    return (geo_cell_index(df, id_col, geo_col, cell_deg).groupBy("cell_lat", "cell_lon")
            .agg(F.count(F.lit(1)).alias("n_points")))


def geo_radius_by_cells(index: DataFrame, center: dict, radius_m: float, cell_deg: float = 10.0) -> DataFrame:
    """Ids within ``radius_m`` of ``center`` using the cell index.

    The cells that can intersect the circle form a rectangle in (cell_lat,
    cell_lon) - two longitude ranges across the antimeridian - so they become
    range predicates on the cell columns (pushed to the scan, no join and no
    list of cells to ship); the exact haversine test then runs on their points.
    """
    dlat = math.degrees(radius_m / EARTH_RADIUS_M)
    lat0, lon0 = float(center["lat"]), float(center["lon"])
    lo_lat, hi_lat = max(-90.0, lat0 - dlat), min(90.0, lat0 + dlat)
    lat_ok = F.col("cell_lat").between(math.floor(lo_lat / cell_deg), math.floor(hi_lat / cell_deg))
    max_abs = max(abs(lo_lat), abs(hi_lat))
    if max_abs >= 89.9 or dlat >= 90:
        lon_ok = F.lit(True)  # the circle reaches a pole: every longitude
    else:
        dlon = dlat / math.cos(math.radians(max_abs))
        if dlon >= 180:
            lon_ok = F.lit(True)
        else:
            w, e = lon0 - dlon, lon0 + dlon
            c = F.col("cell_lon")
            if w < -180:
                lon_ok = c.between(math.floor(-180 / cell_deg), math.floor(e / cell_deg)) | \
                    (c >= math.floor((w + 360) / cell_deg))
            elif e > 180:
                lon_ok = c.between(math.floor(w / cell_deg), math.floor(180 / cell_deg)) | \
                    (c <= math.floor((e - 360) / cell_deg))
            else:
                lon_ok = c.between(math.floor(w / cell_deg), math.floor(e / cell_deg))
    cand = index.filter(lat_ok & lon_ok)
    return cand.filter(haversine_m(F.col("lat"), F.col("lon"), lat0, lon0) <= radius_m).select("id")


# ---------------------------------------------------------------- declared types

# fixed values: payload schema types and the Spark type each is coerced to
PAYLOAD_TYPES = {"keyword": "string", "integer": "bigint", "float": "double", "bool": "boolean",
                 "datetime": "timestamp", "text": "string", "uuid": "string", "geo": None}


def _coerce(col: str, kind: str):
    c = F.col(col)
    if kind == "uuid":
        ok = c.cast("string").rlike("^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")
        return F.when(ok, F.lower(c.cast("string")))
    if kind == "datetime":
        return F.coalesce(c.try_cast("timestamp"), F.try_to_timestamp(c.cast("string")))
    if kind == "geo":
        return c
    return c.try_cast(PAYLOAD_TYPES[kind])


def cast_payload(df: DataFrame, schema: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Coerce fields to declared payload types; return ``(converted, report)``.

    A value that does not convert becomes NULL; the report has one row per field:
    ``field, type, n_values, n_rejected`` (one aggregation job over the table).
    """
    bad = {k: v for k, v in schema.items() if v not in PAYLOAD_TYPES}
    if bad:
        raise ValueError(f"unknown payload types {bad}")
    conv = df.withColumns({f: _coerce(f, k) for f, k in schema.items()})
    aggs = []
    for f in schema:
        aggs += [F.count(F.col(f)).alias(f"{f}__n"),
                 F.sum(F.when(F.col(f).isNotNull() & _coerce(f, schema[f]).isNull(), 1).otherwise(0))
                  .cast("long").alias(f"{f}__bad")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{f}', '{k}', `{f}__n`, `{f}__bad`" for f, k in schema.items())
    report = wide.selectExpr(f"stack({len(schema)}, {stack}) AS (field, type, n_values, n_rejected)")
    return conv, report
