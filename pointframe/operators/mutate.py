"""Point, vector and payload mutations (U1-U11) as DataFrame -> DataFrame transformations.

Parquet has no in-place update, so every mutation returns the new state of the
collection; the caller writes it to a new path (never over the path being read).

Selection (our decision): points are chosen by ``ids`` (list or DataFrame of ids)
and/or ``filter``; with both, a point is selected when either matches; with
neither, the call raises. Payload merges are shallow. Unknown ids in vector
updates are ignored. Within one upsert batch the row with the highest ``seq``
wins; duplicates without ``seq`` raise.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointframe.functions.filters import build_filter
from pointframe.session import checkpoint_dir
from pointframe.sources.collection import Collection


def _selected(coll: Collection, ids=None, filter: dict | None = None) -> tuple[DataFrame, Column]:
    """``(df, sel)``: df carries what ``sel`` needs; sel is a non-null boolean."""
    if ids is None and not filter:
        raise ValueError("select points with ids= and/or filter=")
    df = coll.df
    sel = F.lit(False)
    if isinstance(ids, DataFrame):
        marks = ids.select(F.col(ids.columns[0]).alias(coll.id)).distinct().withColumn("_by_id", F.lit(True))
        df = df.join(marks, coll.id, "left")
        sel = sel | F.coalesce(F.col("_by_id"), F.lit(False))
    elif ids is not None:
        ids = list(ids)
        if ids:
            sel = sel | F.coalesce(F.col(coll.id).isin(ids), F.lit(False))
    if filter:
        sel = sel | build_filter(filter, coll.df.schema, coll.id)
    return df, sel


def _finish(coll: Collection, df: DataFrame, extra_cols: list[str] | None = None) -> Collection:
    cols = [c for c in coll.df.columns] + [c for c in (extra_cols or []) if c not in coll.df.columns]
    return coll.with_df(df.select(*cols))


# ---------------------------------------------------------------- points

def dedup_latest(new: DataFrame, id_col: str, seq: str | None = None, check: bool = True) -> DataFrame:
    """One row per id: the highest ``seq`` (ties: raise is impossible to detect cheaply,
    the larger row struct wins so the result is deterministic). Without ``seq``,
    ``check=True`` runs one aggregation job and raises on duplicate ids."""
    if seq is None:
        if check:
            dup = new.groupBy(id_col).count().filter(F.col("count") > 1).limit(1).count()
            if dup:
                raise ValueError("duplicate ids in upsert batch and no seq column to order them")
        return new
    others = [c for c in new.columns if c != id_col]
    packed = new.groupBy(id_col).agg(F.max_by(F.struct(*others), F.struct(seq, *[
        c for c in others if c != seq and _orderable(new.schema[c].dataType)])).alias("_r"))
    return packed.select(id_col, *[F.col("_r." + c).alias(c) for c in others])


def _orderable(dt: T.DataType) -> bool:
    return not isinstance(dt, (T.MapType, T.VariantType))


def upsert(coll: Collection, new: DataFrame, seq: str | None = None, check: bool = True) -> Collection:
    """Insert new points or replace whole points on id match.

    ``new`` may omit payload columns (they become NULL: the point is replaced).
    Plan: anti join of the old state against the new ids, then a union.
    """
    latest = dedup_latest(new, coll.id, seq, check)
    if seq is not None and seq not in coll.df.columns:
        latest = latest.drop(seq)
    kept = coll.df.join(latest.select(coll.id), coll.id, "left_anti")
    out = kept.unionByName(latest, allowMissingColumns=True)
    return _finish(coll, out)


def delete_points(coll: Collection, ids=None, filter: dict | None = None) -> Collection:
    """Remove points by ids and/or filter."""
    if ids is None and not filter:
        raise ValueError("select points with ids= and/or filter=")
    df = coll.df
    if isinstance(ids, DataFrame):
        df = df.join(ids.select(F.col(ids.columns[0]).alias(coll.id)), coll.id, "left_anti")
    elif ids:
        df = df.filter(~F.coalesce(F.col(coll.id).isin(list(ids)), F.lit(False)))
    if filter:
        df = df.filter(~build_filter(filter, coll.df.schema, coll.id))
    return _finish(coll, df)


# ---------------------------------------------------------------- vectors

def update_vectors(coll: Collection, updates: DataFrame, seq: str | None = None) -> Collection:
    """Replace the vectors given in ``updates`` (``id`` + some vector columns).

    Vector columns absent from ``updates`` (or NULL in it) keep their value;
    payload is untouched; ids not in the collection are ignored.
    """
    vec_cols = [c for c in updates.columns if c in coll.vector_columns]
    if not vec_cols:
        raise ValueError(f"updates hold no vector column of {coll.vector_columns}")
    u = dedup_latest(updates.select(coll.id, *vec_cols, *([seq] if seq else [])), coll.id, seq, check=seq is None)
    u = u.select(coll.id, *[F.col(c).alias("_new_" + c) for c in vec_cols])
    j = coll.df.join(u, coll.id, "left")
    j = j.withColumns({c: F.coalesce(F.col("_new_" + c), F.col(c)) for c in vec_cols})
    return _finish(coll, j)


def delete_vectors(coll: Collection, names: list[str], ids=None, filter: dict | None = None) -> Collection:
    """Set the named vectors to NULL on the selected points, keep the others (U4)."""
    cols = [coll.vector(n).column for n in names]
    df, sel = _selected(coll, ids, filter)
    df = df.withColumns({c: F.when(sel, F.lit(None)).otherwise(F.col(c)) for c in cols})
    return _finish(coll, df)


# ---------------------------------------------------------------- payload

def _lit_for(value, dtype: T.DataType | None) -> Column:
    c = F.lit(value)
    return c.cast(dtype) if dtype is not None else c


def set_payload(coll: Collection, payload: dict, ids=None, filter: dict | None = None,
                key: str | None = None, variant_payload: str | None = None) -> Collection:
    """Merge ``payload`` keys into the selected points (U5); other keys stay.

    ``key`` (U6) names a struct column path to merge below. With
    ``variant_payload`` the keys are merged into that VARIANT column instead.
    New keys become new columns, NULL on unselected points.
    """
    df, sel = _selected(coll, ids, filter)
    if variant_payload:
        expr = _variant_merge(variant_payload, payload, remove=[])
        df = df.withColumn(variant_payload, F.when(sel, expr).otherwise(F.col(variant_payload)))
        return _finish(coll, df)
    if key:
        head, *rest = key.split(".")
        if head not in coll.df.columns or not isinstance(coll.df.schema[head].dataType, T.StructType):
            raise ValueError(f"nested key {key!r} must name a struct column")
        target = F.col(head)
        path = ".".join(rest)
        new = target
        for k, v in payload.items():
            new = new.withField(f"{path}.{k}" if path else k, F.lit(v))
        df = df.withColumn(head, F.when(sel, new).otherwise(target))
        return _finish(coll, df)
    schema = {f.name: f.dataType for f in coll.df.schema.fields}
    vec = set(coll.vector_columns) | {coll.id}
    bad = [k for k in payload if k in vec]
    if bad:
        raise ValueError(f"payload keys collide with id/vector columns: {bad}")
    updates = {}
    for k, v in payload.items():
        old = F.col(k) if k in schema else F.lit(None)
        updates[k] = F.when(sel, _lit_for(v, schema.get(k))).otherwise(old.cast(schema[k]) if k in schema else old)
    df = df.withColumns(updates)
    return _finish(coll, df, list(payload))


def overwrite_payload(coll: Collection, payload: dict, ids=None, filter: dict | None = None) -> Collection:
    """Replace the whole payload of the selected points (U7): listed keys set, all others NULL."""
    df, sel = _selected(coll, ids, filter)
    schema = {f.name: f.dataType for f in coll.df.schema.fields}
    updates = {}
    for c in coll.payload_columns:
        val = _lit_for(payload[c], schema[c]) if c in payload else F.lit(None).cast(schema[c])
        updates[c] = F.when(sel, val).otherwise(F.col(c))
    new_keys = [k for k in payload if k not in schema]
    for k in new_keys:
        updates[k] = F.when(sel, F.lit(payload[k]))
    df = df.withColumns(updates)
    return _finish(coll, df, new_keys)


def delete_payload(coll: Collection, keys: list[str], ids=None, filter: dict | None = None,
                   variant_payload: str | None = None) -> Collection:
    """Remove keys from the selected points (U8): typed columns become NULL; VARIANT keys are dropped."""
    df, sel = _selected(coll, ids, filter)
    if variant_payload:
        expr = _variant_merge(variant_payload, {}, remove=keys)
        return _finish(coll, df.withColumn(variant_payload, F.when(sel, expr).otherwise(F.col(variant_payload))))
    missing = [k for k in keys if k not in coll.payload_columns]
    if missing:
        raise ValueError(f"unknown payload keys {missing}")
    df = df.withColumns({k: F.when(sel, F.lit(None)).otherwise(F.col(k)) for k in keys})
    return _finish(coll, df)


def clear_payload(coll: Collection, ids=None, filter: dict | None = None) -> Collection:
    """Drop all payload of the selected points, keep ids and vectors."""
    df, sel = _selected(coll, ids, filter)
    df = df.withColumns({k: F.when(sel, F.lit(None)).otherwise(F.col(k)) for k in coll.payload_columns})
    return _finish(coll, df)


def _variant_merge(col: str, payload: dict, remove: list[str]) -> Column:
    """Shallow merge of ``payload`` into a VARIANT object, dropping ``remove`` keys."""
    drop = list(remove) + list(payload)
    m = F.expr(f"try_cast({col} AS map<string, variant>)")
    kept = F.map_filter(F.coalesce(m, F.create_map().cast("map<string, variant>")),
                        lambda k, v: ~k.isin(drop) if drop else F.lit(True))
    if payload:
        add = F.create_map(*[x for k, v in payload.items()
                             for x in (F.lit(k), F.parse_json(F.lit(json.dumps(v))))])
        kept = F.map_concat(kept, add)
    return F.to_variant_object(kept)


# ---------------------------------------------------------------- batches

OPS = {"upsert", "delete", "set_payload", "overwrite_payload", "delete_payload", "clear_payload",
       "update_vectors", "delete_vectors"}


def _sel_args(a: dict) -> dict:
    return {"ids": a.get("points"), "filter": a.get("filter")}


def apply_op(coll: Collection, op: dict) -> Collection:
    if len(op) != 1 or next(iter(op)) not in OPS:
        raise ValueError(f"operation must be one of {sorted(OPS)}, got {sorted(op)}")
    kind, a = next(iter(op.items()))
    if kind == "upsert":
        return upsert(coll, a["points"], a.get("seq"))
    if kind == "delete":
        return delete_points(coll, **_sel_args(a))
    if kind == "set_payload":
        return set_payload(coll, a["payload"], key=a.get("key"), **_sel_args(a))
    if kind == "overwrite_payload":
        return overwrite_payload(coll, a["payload"], **_sel_args(a))
    if kind == "delete_payload":
        return delete_payload(coll, a["keys"], **_sel_args(a))
    if kind == "clear_payload":
        return clear_payload(coll, **_sel_args(a))
    if kind == "update_vectors":
        return update_vectors(coll, a["points"])
    return delete_vectors(coll, a["vector"], **_sel_args(a))


def batch_update(coll: Collection, ops: list[dict], checkpoint_every: int = 8) -> Collection:
    """Apply operations in order (U10): a left fold of the transformations above.

    Every ``checkpoint_every`` operations the state is written to the shared
    checkpoint folder (``spark.checkpoint.dir``) so the lineage stays short and a
    lost executor recomputes from the last checkpoint, not from the first op.
    """
    state = coll
    for i, op in enumerate(ops, 1):
        state = apply_op(state, op)
        if checkpoint_every and i % checkpoint_every == 0 and i < len(ops):
            checkpoint_dir(state.df.sparkSession)
            state = state.with_df(state.df.checkpoint(eager=True))
    return state


# the order of events with one number: the row as a whole first, its end last
CHANGELOG_OPS = ("upsert", "overwrite_payload", "set_payload", "update_vectors", "delete_payload", "delete_vectors",
                 "clear_payload", "delete")


def apply_changelog(coll: Collection, log: DataFrame, seq: str = "seq", op: str = "op") -> Collection:
    """Apply a large id-keyed change log in one pass.

    ``log`` has the collection's columns plus ``seq`` and ``op``, one of
    ``CHANGELOG_OPS``, and may have ``keys`` (array of column names). An upsert or
    a delete fixes the whole row; later events write single columns:

    - set_payload: the payload columns named in ``keys``, NULL included; without
      ``keys`` those that are not NULL
    - overwrite_payload: every payload column; clear_payload: every one to NULL
    - delete_payload, delete_vectors: the columns named in ``keys`` to NULL
    - update_vectors: the vector columns that are not NULL

    Events apply in the order of ``seq`` (any long, the base row comes before all);
    of equal ``seq`` upserts come first and deletes last, and equal kinds are
    ordered by their rows, so the result never depends on the partitioning.

    Plan: only ids that occur in the log are aggregated - the base rows of those
    ids (semi join) and their events, grouped by id with partial aggregation, so
    an id with a huge number of events is combined map-side. Every other base row
    passes through an anti join untouched; a small log therefore never shuffles
    the whole collection (AQE broadcasts the log's ids when they are small).
    """
    cols = coll.df.columns
    payload = coll.payload_columns
    checked_op = F.when(F.col(op).isin(*CHANGELOG_OPS), F.col(op)).otherwise(
        F.raise_error(F.concat(F.lit("unknown changelog op: "), F.coalesce(F.col(op), F.lit("NULL")))))
    given = F.lit(None).cast("array<string>")
    if "keys" in log.columns and "keys" not in cols:
        known = F.array(*[F.lit(c) for c in cols if c != coll.id])
        odd = F.array_except("keys", known)
        given = F.when(F.size(odd) > 0, F.raise_error(F.concat(F.lit("unknown names in keys: "), F.array_join(odd, ", "))).cast("array<string>")
                       ).otherwise(F.col("keys"))
    ev = log.select(*[F.col(c) if c in log.columns else F.lit(None).cast(coll.df.schema[c].dataType).alias(c)
                      for c in cols], F.col(seq).cast("long").alias("_seq"), checked_op.cast("string").alias("_op"), given.alias("_keys"))
    ids = log.select(F.col(coll.id)).distinct()
    untouched = coll.df.join(ids, coll.id, "left_anti")
    touched = coll.df.join(ids, coll.id, "left_semi")
    base = touched.select(*cols, F.lit(None).cast("long").alias("_seq"), F.lit("base").alias("_op"),
                          F.lit(None).cast("array<string>").alias("_keys"))
    kind = F.array_position(F.array(*[F.lit(o) for o in CHANGELOG_OPS]), F.col("_op"))
    tie = F.xxhash64(*[c for c in cols if _orderable(coll.df.schema[c].dataType)])
    # the base row precedes every event, whatever the numbers of the log
    rows = base.unionByName(ev).withColumn("_at", F.struct(
        (F.col("_op") != "base").alias("event"), "_seq", kind.alias("kind"), tie.alias("tie")))
    others = [c for c in cols if c != coll.id]
    full = F.when(F.col("_op").isin("base", "upsert", "delete"), F.col("_at"))
    agg = [F.max(full).alias("_full"), F.max_by(F.struct("_op", *others), full).alias("_row")]
    named = F.col("_keys").isNotNull()
    for c in others:
        in_keys = named & F.coalesce(F.array_contains("_keys", c), F.lit(False))
        if c in payload:
            writes = (((F.col("_op") == "set_payload") & F.when(named, in_keys).otherwise(F.col(c).isNotNull()))
                      | F.col("_op").isin("overwrite_payload", "clear_payload") | ((F.col("_op") == "delete_payload") & in_keys))
        else:
            writes = ((F.col("_op") == "update_vectors") & F.col(c).isNotNull()) | ((F.col("_op") == "delete_vectors") & in_keys)
        value = F.when(~F.col("_op").isin("clear_payload", "delete_payload", "delete_vectors"), F.col(c))
        when = F.when(writes, F.col("_at"))
        agg += [F.max(when).alias(f"_when_{c}"), F.max_by(F.struct(value.alias("v")), when).alias(f"_set_{c}")]
    g = rows.groupBy(coll.id).agg(*agg).filter(F.col("_full").isNotNull()).filter(F.col("_row._op") != "delete")
    merged = g.select(F.col(coll.id), *[
        F.when(F.coalesce(F.col(f"_when_{c}") > F.col("_full"), F.lit(False)), F.col(f"_set_{c}.v")).otherwise(F.col("_row")[c]).alias(c)
        for c in others])
    return coll.with_df(untouched.select(*cols).unionByName(merged.select(*cols)))


# operations that a filter may select the points of
FILTERED_OPS = ("delete", "set_payload", "overwrite_payload", "delete_payload", "clear_payload", "delete_vectors")


def apply_staged_changelog(coll: Collection, log: DataFrame, filtered_ops: list[dict], *, seq: str = "seq", op: str = "op",
                           checkpoint_every: int = 4) -> Collection:
    """Apply a change log in which some operations choose their points by a filter.

    ``log`` holds the id-keyed events of ``apply_changelog``. ``filtered_ops`` is a list of
    ``{"seq": n, <operation>: {"filter": ..., ...}}`` with one of ``FILTERED_OPS``. Such an operation sees the
    points as all events up to and including its number have left them, and of several with one number the
    earlier of the list goes first; it is a barrier, since what it selects depends on everything before.

    The log is cut into stages at the barriers and written once, partitioned by stage, below the
    shared folder; a stage reads its own events only, and a stage without events costs nothing. Each stage is one
    ``apply_changelog`` and each barrier one filtered pass. Every ``checkpoint_every`` barriers the state is
    checkpointed there too, so neither the plan nor what a lost executor repeats grows with the log.
    """
    ops = []
    for i, o in enumerate(filtered_ops):
        kinds = [k for k in o if k != "seq"]
        if "seq" not in o or len(kinds) != 1 or kinds[0] not in FILTERED_OPS:
            raise ValueError(f"operation {i} needs seq and one of {FILTERED_OPS}, got {sorted(o)}")
        if not o[kinds[0]].get("filter") or o[kinds[0]].get("points") is not None:
            raise ValueError(f"operation {i} needs a filter and no points; events of single points belong into the log")
        ops.append((int(o["seq"]), i, {kinds[0]: o[kinds[0]]}))
    ops.sort(key=lambda x: x[:2])
    if not ops:
        return apply_changelog(coll, log, seq, op)
    spark = coll.df.sparkSession
    before = F.array(*[F.lit(n).cast("long") for n, _, _ in ops])  # a request's list
    stage = F.size(F.filter(before, lambda n: n < F.col(seq).cast("long")))  # the barriers that an event comes after
    path = f"{checkpoint_dir(spark)}/changelog-{uuid.uuid4().hex}"
    log.withColumn("_stage", stage).write.partitionBy("_stage").parquet(path)
    staged = spark.read.schema(T.StructType([*log.schema.fields, T.StructField("_stage", T.IntegerType())])).parquet(path)
    full = {r["_stage"] for r in staged.select("_stage").distinct().collect()}  # at most one row for each barrier and one
    state = coll
    for k in range(len(ops) + 1):
        if k in full:
            state = apply_changelog(state, staged.filter(F.col("_stage") == k).drop("_stage"), seq, op)
        if k < len(ops):
            state = apply_op(state, ops[k][2])
            if checkpoint_every and (k + 1) % checkpoint_every == 0:
                state = state.with_df(state.df.checkpoint(eager=True))
    return state
