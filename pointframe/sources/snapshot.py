"""Snapshots (S10-S12): parquet export, a manifest row and a hash tree; a restore that names what is damaged.

Every row is encoded as text that tells nulls, lengths and borders apart (``encoded``), so
a null that moves to another column, an element that moves to another array or two
columns that change places give other text. The checksum is order-free: the sum of a 64-bit hash of
the encoded rows as DECIMAL(38,0), so it cannot overflow and does not depend on the
partitioning or row order.

The tree has ``BUCKETS`` leaves: a row's bucket is the first byte of the MD5 of its id (without an id
column: of its encoding), and a leaf holds the bucket's rows, and the sums of two 60-bit parts of their SHA-256.
Sixteen nodes make their parent's SHA-256, up to the root. A restore recomputes the leaves in one
aggregation and compares at most ``BUCKETS`` rows, so damage is located by reading the data once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS, FAN = 256, 16


def encoded(value: Column, kind: T.DataType) -> Column:
    """A value as text without ambiguity: ``n`` for null, else a tag, a length and the content."""
    if isinstance(kind, T.StructType):
        parts = F.concat(F.lit("s"), *[encoded(value[f.name], f.dataType) for f in kind.fields])
    elif isinstance(kind, T.ArrayType):
        parts = F.concat(F.lit("a"), F.size(value).cast("string"), F.lit(":"),
                         F.array_join(F.transform(value, lambda x: encoded(x, kind.elementType)), ""))
    elif isinstance(kind, T.MapType):  # entries in the order of their encodings
        entries = F.array_sort(F.transform(F.map_entries(value), lambda e: F.concat(encoded(e["key"], kind.keyType), encoded(e["value"], kind.valueType))))
        parts = F.concat(F.lit("m"), F.size(value).cast("string"), F.lit(":"), F.array_join(entries, ""))
    else:
        if isinstance(kind, T.BinaryType):
            text = F.hex(value)
        elif isinstance(kind, T.VariantType):
            text = F.to_json(value)
        else:
            text = value.cast("string")
        parts = F.concat(F.lit("v"), F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(value.isNull(), F.lit("n")).otherwise(parts)


def row_text(df: DataFrame) -> Column:
    """The encoding of a whole row, columns by name, so that their order does not matter but their names do."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    return F.concat(*[F.concat(F.lit(f"{len(f.name.encode())}:{f.name}"), encoded(F.col(f"`{f.name}`"), f.dataType)) for f in fields])


def table_checksum(df: DataFrame) -> DataFrame:
    """One row: ``n_rows, checksum`` (DECIMAL(38,0) sum of a 64-bit hash of every encoded row)."""
    h = F.xxhash64(row_text(df)).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)"))
                  .cast("decimal(38,0)").alias("checksum"))


def hash_leaves(df: DataFrame, id: str | None = None) -> DataFrame:
    """The leaves of the hash tree: ``bucket, n_rows, low, high`` for every bucket that has rows."""
    rows = df.select((F.col(f"`{id}`").cast("string") if id else F.lit(None).cast("string")).alias("id"), F.sha2(row_text(df), 256).alias("sha"))
    first = F.substring(F.md5(F.coalesce("id", "sha" if id is None else F.lit(""))), 1, 2)
    part = lambda at: F.conv(F.substring("sha", at, 15), 16, 10).cast("decimal(38,0)")
    return rows.groupBy(F.conv(first, 16, 10).cast("int").alias("bucket")).agg(
        F.count("*").alias("n_rows"), F.sum(part(1)).cast("decimal(38,0)").alias("low"), F.sum(part(16)).cast("decimal(38,0)").alias("high"))


def hash_tree(df: DataFrame, id: str | None = None) -> DataFrame:
    """All nodes: ``level`` (0: leaves), ``node``, ``n_rows``, ``digest``; the last level is the root. At most a few hundred rows."""
    spark = df.sparkSession
    leaves = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(hash_leaves(df, id), "bucket", "left")
    text = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit(0)).cast("string") for c in ("bucket", "n_rows", "low", "high")])
    nodes = leaves.select(F.lit(0).alias("level"), F.col("bucket").alias("node"), F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), F.sha2(text, 256).alias("digest"))
    out, width, level = nodes, BUCKETS, 0
    while width > 1:
        width, level = -(-width // FAN), level + 1
        kids = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda x: x["digest"]), "")
        nodes = nodes.groupBy(F.floor(F.col("node") / FAN).cast("int").alias("parent")).agg(F.sum("n_rows").alias("n_rows"), F.sha2(kids, 256).alias("digest"))
        nodes = nodes.select(F.lit(level).alias("level"), F.col("parent").alias("node"), "n_rows", "digest")
        out = out.unionByName(nodes)
    return out


def damaged_buckets(spark: SparkSession, path: str, data: DataFrame | None = None) -> DataFrame:
    """The buckets of the snapshot at ``path`` whose rows are not those of its tree: ``bucket, n_rows, found_rows``.

    ``data``: rows to hold against the tree instead of the snapshot's own.
    """
    kept = spark.read.parquet(f"{path}/tree").filter("level = 0").select(F.col("node").alias("bucket"), "n_rows", "digest")
    id = spark.read.parquet(f"{path}/manifest").select("id_column").first()[0]
    now = hash_tree(spark.read.parquet(f"{path}/data") if data is None else data, id).filter("level = 0").select(
        F.col("node").alias("bucket"), F.col("n_rows").alias("found_rows"), F.col("digest").alias("found"))
    return kept.join(F.broadcast(now), "bucket").filter("digest != found").select("bucket", "n_rows", "found_rows")  # BUCKETS rows


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def _size_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` via the Hadoop FileSystem of the cluster (metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(conf).getContentSummary(p).getLength())


def snapshot_write(df: DataFrame, path: str, name: str = "snapshot", id: str | None = None) -> DataFrame:
    """Write ``df`` to ``path/data``, its hash tree (buckets by ``id``) to ``path/tree`` and a manifest to ``path/manifest``; return the manifest.

    Manifest columns: ``name, creation_time, n_rows, size, checksum, id_column, root``.
    """
    spark = df.sparkSession
    df.write.mode("error").parquet(f"{path}/data")
    # the checksum is computed from what was written, so it certifies the files
    written = spark.read.parquet(f"{path}/data")
    cs = table_checksum(written)
    hash_tree(written, id).coalesce(1).write.mode("error").parquet(f"{path}/tree")
    root = spark.read.parquet(f"{path}/tree").orderBy(F.col("level").desc()).first()["digest"]
    size = _size_bytes(spark, f"{path}/data")
    created = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    manifest = cs.select(F.lit(name).alias("name"), F.lit(created).cast("timestamp_ntz").alias("creation_time"),
                         "n_rows", F.lit(size).cast("long").alias("size"), "checksum",
                         F.lit(id).cast("string").alias("id_column"), F.lit(root).alias("root"))
    manifest.write.mode("error").parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def snapshot_restore(spark: SparkSession, path: str, verify: bool = True,
                     checksum=None) -> DataFrame:
    """Read a snapshot back; with ``verify`` recompute the checksum and raise on mismatch.

    ``checksum`` (optional) is an expected value from elsewhere (e.g. a copied manifest).
    """
    data = spark.read.parquet(f"{path}/data")
    if verify:
        m = spark.read.parquet(f"{path}/manifest").select("n_rows", "checksum").first()
        got = table_checksum(data).first()
        want_sum = checksum if checksum is not None else m["checksum"]
        if got["n_rows"] != m["n_rows"] or got["checksum"] != want_sum:
            bad = "unknown (no tree was kept)"
            if _exists(spark, f"{path}/tree"):
                bad = sorted(r["bucket"] for r in damaged_buckets(spark, path).collect())  # at most BUCKETS
            raise ValueError(f"snapshot {path} failed verification: manifest {m}, data {got}; damaged buckets {bad}")
    return data


def full_snapshot(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Snapshot every named table under ``path/<name>`` and write one combined manifest."""
    if not tables:
        raise ValueError("no tables to snapshot")
    manifests = [snapshot_write(df, f"{path}/{name}", name) for name, df in tables.items()]
    out = manifests[0]
    for m in manifests[1:]:
        out = out.unionByName(m)
    spark = out.sparkSession
    out.write.mode("error").parquet(f"{path}/_manifest")
    return spark.read.parquet(f"{path}/_manifest")
