"""Helpers the training-data operators share: column picking, scratch tables, size-checked joins."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 32 << 20
# large shuffles are made in so many parts at most, one after the other, each of so many rows of a few numbers at least
PARTS, PART_ROWS = 4, 1 << 22
# with it shuffle files go at the end of the execution that wrote them, else when the driver happens to collect its garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# fixed value: a word is a maximal run of anything but the six ASCII white-space characters
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_MADE: list[tuple[SparkSession, str]] = []
# the tables of the innermost ``scratch`` block
_INNER: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("_INNER", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    Only a local master (tests) may run without the setting; it then gets a
    folder of its own. On a cluster a missing setting is an error.
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    d = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    spark.sparkContext.setCheckpointDir(d)
    return d


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed when the driver ends."""
    if not _MADE:
        atexit.register(_clean)
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    _MADE.append((spark, os.path.dirname(path)))
    return path


def _remove(made: list[tuple[SparkSession, str]]) -> None:
    for spark, path in made:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM may have ended already; the folder is scratch
            return


def _clean() -> None:
    _remove(_MADE)


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What is written in the block leaves no shuffle files: it is read back from its table, never from them."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def _written(df: DataFrame | Iterable[DataFrame], name: str, options: dict[str, str], block: list[tuple[SparkSession, str]] | None) -> DataFrame:
    frames = iter([df] if isinstance(df, DataFrame) else df)
    df = next(frames)
    path = new_path(df.sparkSession, name)
    if block is not None:
        block.append((df.sparkSession, os.path.dirname(path)))
    for part in chain([df], frames):
        with _shuffles_go(df.sparkSession):
            part.write.options(**options).mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame | Iterable[DataFrame], name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder (with the writer's ``options``) and read it back: lineage ends there.

    Several frames of one schema become one table; each is made when the one before is written, and its shuffle files are gone."""
    return _written(df, name, options, _INNER.get())


def parts_of(rows: int | None) -> int:
    """In how many parts so many rows are shuffled."""
    return max(1, min(PARTS, (rows or 0) // PART_ROWS))


def in_parts(df: DataFrame, parts: int, *cols: str) -> Iterator[DataFrame]:
    """``df`` part by part, equal values of ``cols`` in one; the filter moves below joins and aggregates that have them."""
    part = F.pmod(F.xxhash64(F.lit("part"), *cols), F.lit(parts))
    yield from [df] if parts == 1 else (df.where(part == k) for k in range(parts))


def parted(df: DataFrame, part: Column, width: int = 1) -> tuple[DataFrame, Iterator[DataFrame]]:
    """``df`` written by ``part`` (from 0 to below ``PARTS``): all of it, and its parts, each of which is deleted when the
    next is asked for. A table of few rows, counted ``width`` times each, is one part."""
    spark, path = df.sparkSession, new_path(df.sparkSession, "parted")
    if (block := _INNER.get()) is not None:
        block.append((spark, os.path.dirname(path)))
    with _shuffles_go(spark):
        df.withColumn("part_", part.cast("int")).write.partitionBy("part_").parquet(path)
    whole = spark.read.schema(df.withColumn("part_", F.lit(0)).schema).parquet(path)

    def each() -> Iterator[DataFrame]:
        if parts_of(whole.count() * width) == 1:
            yield whole.drop("part_")
            return
        for k in range(PARTS):
            yield whole.where(F.col("part_") == k).drop("part_")
            _remove([(spark, f"{path}/part_={k}")])

    return whole.drop("part_"), each()


@contextmanager
def scratch() -> Iterator[Callable[..., DataFrame]]:
    """Tables that ``materialize`` writes in the block are deleted at its end. The function that ``with``
    gives is a ``materialize`` whose tables stay: nothing else that is read later may depend on the block's."""
    outer, inner = _INNER.get(), []
    token = _INNER.set(inner)
    try:
        yield lambda df, name, **options: _written(df, name, options, outer)
    finally:
        _INNER.reset(token)
        _remove(inner)
        for made in inner:
            _MADE.remove(made)


def plain(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with columns c0, c1, ... and its own names: safe against clashing or odd names."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), df.columns


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Select columns by exact name under new names, whatever other columns are there."""
    tmp, names = plain(df)
    missing = [c for c in cols.values() if c not in names]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {names}")
    return tmp.select(*[tmp[f"c{names.index(c)}"].alias(new) for new, c in cols.items()])


def _width(kind: T.DataType, c: Column) -> Column:
    """Bytes that a value takes in memory, about."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
            return F.coalesce(F.aggregate(c, F.lit(16).cast("long"), lambda s, x: s + _width(kind.elementType, x)), F.lit(0))
        return F.greatest(F.size(c), F.lit(0)) * 8 + 16
    if isinstance(kind, T.StructType):
        return reduce(Column.__add__, [_width(f.dataType, c[f.name]) for f in kind.fields], F.lit(8))
    return F.lit(8)


def is_small(df: DataFrame, max_rows: int = 2_000_000, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a count proves that ``df`` (materialized, or it is computed for this) has at most so many rows and bytes."""
    width = reduce(Column.__add__, [_width(f.dataType, df[f.name]) for f in df.schema.fields], F.lit(16)).cast("long")
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


def sized(df: DataFrame, max_rows: int = 2_000_000, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it ``is_small``. Beyond that the plain frame comes back and the join shuffles; rows are the same."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def ascii_lower(c: Column | str) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def words(text: Column | str) -> Column:
    """The words of a text in order; null and blank texts have none."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.array_remove(F.split(t, SPACE, -1), "")


def word_count(text: Column | str) -> Column:
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.regexp_count(t, F.lit(WORD)).cast("long")
