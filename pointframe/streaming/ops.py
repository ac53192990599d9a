"""Structured Streaming operators.

The reference has no streaming; its nearest concept is a write that is
acknowledged before it is applied. These re-aims are built on the standard
streaming primitives:

* ``stream_upsert``: ``foreachBatch`` applies each micro-batch as an upsert to
  the hash buckets its ids fall in (dynamic partition overwrite of only those
  buckets); the epoch id is logged, so a replayed batch (at-least-once delivery
  after a failure) is detected and skipped.
* ``stream_search``: top-k per arriving query against a static collection,
  ``foreachBatch`` + the batch k-NN kernel.
* ``stream_response_stats``: event-time windows (tumbling, sliding) with a
  watermark, or session windows, over a request log.

Checkpoints and versions live under ``spark.checkpoint.dir`` unless a location
is given; nothing is written to executor-local storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pointframe.operators.batch import knn_join
from pointframe.operators.mutate import upsert
from pointframe.session import checkpoint_dir
from pointframe.sources.collection import Collection


def _location(spark: SparkSession, given: str | None, name: str) -> str:
    return given or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


# ---------------------------------------------------------------- T1

BUCKET = "_bucket"


def _bucket_of(id_col: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(buckets)).cast("int")


def _epochs(spark: SparkSession, target: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{target}/_epochs")
    except Exception:  # nothing committed yet
        return None


def read_state(spark: SparkSession, target: str) -> DataFrame:
    """Current rows of a ``stream_upsert`` target (bucket column dropped)."""
    return spark.read.parquet(f"{target}/state").drop(BUCKET)


def upsert_batch_fn(base: Collection, target: str, seq: str | None = None, buckets: int = 64):
    """The ``foreachBatch`` function of ``stream_upsert`` (exposed for replay tests).

    State layout: parquet under ``target/state`` partitioned by ``_bucket`` =
    hash(id) mod ``buckets``. A micro-batch reads only the buckets its ids fall
    in (partition pruning), computes their new contents with ``upsert``, stages
    them and replaces exactly those buckets (dynamic partition overwrite); other
    buckets are not touched. The epoch is logged last. A batch delivered again
    after a restart finds its epoch and does nothing; a crash between the
    overwrite and the log entry replays the same upsert, which is idempotent.
    """
    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        ep = _epochs(spark, target)
        if ep is not None and ep.filter(F.col("epoch") == epoch_id).limit(1).count():
            return
        state_path = f"{target}/state"
        # Spark's success marker is written last: a base write that broke off is done again
        if ep is None and not _exists(spark, f"{target}/_base/_SUCCESS"):
            (base.df.withColumn(BUCKET, _bucket_of(base.id, buckets))
                 .write.mode("overwrite").partitionBy(BUCKET).parquet(state_path))
            spark.range(1).write.mode("overwrite").parquet(f"{target}/_base")
        changes = batch.withColumn(BUCKET, _bucket_of(base.id, buckets))
        # at most ``buckets`` small ints: the partition list used for pruning
        touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]
        if not touched:
            _log_epoch(spark, target, epoch_id)
            return
        old = spark.read.parquet(state_path).filter(F.col(BUCKET).isin(touched))
        state = base.with_df(old)
        new = upsert(state, changes, seq=seq, check=seq is None).df
        staging = f"{target}/_staging/e{epoch_id:010d}"
        new.write.mode("overwrite").partitionBy(BUCKET).parquet(staging)
        (spark.read.parquet(staging).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy(BUCKET).parquet(state_path))
        _log_epoch(spark, target, epoch_id)
    return apply


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def _log_epoch(spark: SparkSession, target: str, epoch_id: int) -> None:
    spark.createDataFrame([(int(epoch_id),)], "epoch long").write.mode("append").parquet(f"{target}/_epochs")


def stream_upsert(changes: DataFrame, base: Collection, target: str, *, seq: str | None = None,
                  buckets: int = 64, checkpoint_location: str | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """Keep ``target`` at the latest row per id of ``base`` plus every change."""
    spark = changes.sparkSession
    w = (changes.writeStream.foreachBatch(upsert_batch_fn(base, target, seq, buckets))
         .option("checkpointLocation", _location(spark, checkpoint_location, "upsert")))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


# ---------------------------------------------------------------- T2

def search_batch_fn(points: Collection, sink: str, *, k: int = 10, query_id: str = "query_id",
                    vector: str = "vector"):
    """The ``foreachBatch`` function of ``stream_search`` (exposed for replay tests).

    Each epoch's results replace exactly the sink partition ``epoch=<id>``
    (dynamic partition overwrite), so a batch delivered again after a restart
    rewrites its own rows instead of appending duplicates.
    """
    def apply(batch: DataFrame, epoch_id: int) -> None:
        res = knn_join(points, batch, query_id=query_id, vector=vector, k=k)
        (res.withColumn("epoch", F.lit(epoch_id).cast("long")).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(sink))
    return apply


def stream_search(queries: DataFrame, points: Collection, sink: str, *, k: int = 10,
                  query_id: str = "query_id", vector: str = "vector",
                  checkpoint_location: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Append the top-``k`` points of each arriving query to the parquet ``sink``."""
    spark = queries.sparkSession

    w = (queries.writeStream.foreachBatch(search_batch_fn(points, sink, k=k, query_id=query_id, vector=vector))
         .option("checkpointLocation", _location(spark, checkpoint_location, "search")))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


# ---------------------------------------------------------------- T3

def response_stats_stream(log: DataFrame, ts: str, endpoint: str, duration: str, *,
                          window: str = "1 hour", slide: str | None = None, watermark: str = "10 minutes",
                          session_gap: str | None = None, key: str | None = None) -> DataFrame:
    """Streaming DataFrame of per-window ``count, avg, min, max``.

    Event time must be a TIMESTAMP for watermarks; a TIMESTAMP_NTZ column is read
    as UTC (independent of the session time zone) and the window bounds are
    returned as TIMESTAMP_NTZ again.
    """
    from pointframe.operators.stats import response_stats_windowed
    ntz = dict(log.dtypes).get(ts) == "timestamp_ntz"
    tz = log.sparkSession.conf.get("spark.sql.session.timeZone")
    # NTZ wall clock -> the UTC instant with that wall clock, whatever the session zone,
    # so windows align exactly as in the batch twin; converted back at the end
    src = log.withColumn(ts, F.from_utc_timestamp(F.col(ts).cast("timestamp"), tz)) if ntz else log
    src = src.withWatermark(ts, watermark)
    out = response_stats_windowed(src, ts, endpoint, duration, window, slide, session_gap, key)
    if ntz:
        out = out.withColumn("window_start", F.to_utc_timestamp("window_start", tz).cast("timestamp_ntz")) \
                 .withColumn("window_end", F.to_utc_timestamp("window_end", tz).cast("timestamp_ntz"))
    return out


def stream_response_stats(log: DataFrame, ts: str, endpoint: str, duration: str, sink: str, *,
                          output_mode: str = "append", checkpoint_location: str | None = None,
                          trigger: dict | None = None, **kw) -> StreamingQuery:
    """Run ``response_stats_stream`` into a parquet ``sink`` (append: final windows only)."""
    spark = log.sparkSession
    agg = response_stats_stream(log, ts, endpoint, duration, **kw)
    w = (agg.writeStream.outputMode(output_mode).format("parquet").option("path", sink)
         .option("checkpointLocation", _location(spark, checkpoint_location, "stats")))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
