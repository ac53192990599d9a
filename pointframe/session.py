"""Session helpers: one place for the configs every job relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "pointframe") -> SparkSession:
    """Return the active session, or build one with the settings the operators assume.

    On a cluster the session normally exists already (spark-submit); then only
    SQL confs that are unset get a default, nothing cluster-wide is changed.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.driver.memory", os.environ.get("POINTFRAME_DRIVER_MEMORY", "16g")))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Lineage is cut only by writing to this folder (``checkpoint()`` or a
    parquet table below it), never to executor-local storage. Callers that run
    without a cluster setting (tests) must call ``ensure_checkpoint_dir`` first.
    """
    d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            spark.sparkContext.setCheckpointDir(d)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    return d


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's checkpoint dir; set ``fallback`` only when none is configured."""
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        spark.sparkContext.setCheckpointDir(fallback)
        return spark.sparkContext.getCheckpointDir() or fallback


def ship_package(spark: SparkSession) -> None:
    """Make ``pointframe`` importable in the Python workers (once per SparkContext).

    Arrow/pandas kernels reference library functions by module name, so executors
    must be able to import the package even when the driver found it through a
    path the workers do not share. The package is zipped once and registered with
    ``SparkContext.addPyFile``, which distributes it to every executor.
    """
    sc = spark.sparkContext
    if getattr(sc, "_pointframe_shipped", False):
        return
    import tempfile
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="pointframe-pkg-"), "pointframe.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            if "__pycache__" in d:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    sc._pointframe_shipped = True
