"""Partitioning helpers.

``spread`` gives CPU-heavy per-row work (tokenizing, hashing, vector kernels)
enough tasks when a scan yields fewer partitions than the cluster can run at
once - e.g. a single large row group. On a big input the scan already yields
more partitions than cores and ``spread`` returns the DataFrame unchanged, so
no shuffle is added at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def has_exchange(df: DataFrame) -> bool:
    """Whether the physical plan (planned, not executed) contains a shuffle or broadcast."""
    try:
        return "Exchange" in df._jdf.queryExecution().executedPlan().toString()
    except Exception:
        return True


def scan_partitions(df: DataFrame) -> int | None:
    """Number of input partitions of a plan without exchanges, found without running a job.

    Asking an adaptive plan that contains an exchange for its partitions would
    materialize the upstream stages eagerly, so such plans return None.
    """
    if has_exchange(df):
        return None
    try:
        return df.rdd.getNumPartitions()  # plans the scan (file listing), runs no job
    except Exception:  # streaming or unsupported plans
        return None


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition to the default parallelism when ``df`` has fewer partitions.

    Only plain scans are inspected; a plan that already shuffles is left as it is.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    n = scan_partitions(df)
    return df.repartition(target) if n is not None and n < target else df
