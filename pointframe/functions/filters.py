"""Payload filters (F1-F19) compiled to one Spark Column.

``build_filter(spec, schema)`` turns a filter tree into a predicate and leaves
optimisation to Catalyst: comparisons on typed top-level columns reach the
parquet scan as pushed filters.

Semantics we fixed (the remote engine defined them, the API only names them):
  * two-valued logic: no condition is ever NULL (scalar leaves are
    ``isNotNull(v) AND pred(v)``, which Catalyst pushes to the scan; array and
    VARIANT leaves use ``coalesce(cond, false)``), so ``must_not`` keeps rows
    whose key is missing or null;
  * an array field satisfies a condition when any element does;
  * an empty ``should`` list is no constraint; ``min_should`` needs at least
    ``min_count`` of its conditions;
  * ``match.except`` holds when the field has a value outside the list;
  * ``values_count`` counts a scalar as 1 and null as 0;
  * ``is_empty``: missing, null or []; ``is_null``: present and null;
  * geo distances are haversine metres on a sphere of radius 6371008.8 m, a
    bounding box whose left edge is east of its right edge crosses the
    antimeridian, polygons use the even-odd rule (boundary unspecified).
Unknown keys anywhere in the tree raise: a silently dropped condition on a
delete would remove the wrong rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointframe.functions import text as text_fn

EARTH_RADIUS_M = 6371008.8
FILTER_KEYS = {"must", "must_not", "should", "min_should"}
FIELD_KEYS = {"match", "range", "datetime_range", "geo_bounding_box", "geo_radius",
              "geo_polygon", "values_count"}


class FilterError(ValueError):
    pass


@dataclass
class Field:
    """A resolved key: a Column plus its type, or a VARIANT path."""
    col: Column
    dtype: T.DataType
    variant_path: str | None = None  # set when col is a VARIANT and the key is a path in it


class Scope:
    """Where keys resolve: the top-level row, or an element of a nested array."""

    def __init__(self, schema: T.StructType, getter: Callable[[str], Column] = F.col,
                 id_col: str | None = "id", variant_payload: str | None = None,
                 text_tokenizer: str = "word"):
        self.schema = schema
        self.getter = getter
        self.id_col = id_col
        self.variant_payload = variant_payload
        self.text_tokenizer = text_tokenizer

    def resolve(self, key: str) -> Field:
        if not isinstance(key, str) or not key:
            raise FilterError(f"bad key {key!r}")
        parts = key.split(".")
        head = parts[0]
        arr_head = head.endswith("[]")
        name = head[:-2] if arr_head else head
        fields = {f.name: f.dataType for f in self.schema.fields}
        if name not in fields:
            if self.variant_payload and self.variant_payload in fields:
                return Field(self.getter(self.variant_payload), T.VariantType(), "$." + key)
            raise FilterError(f"unknown filter key {key!r}")
        col, dtype = self.getter(name), fields[name]
        rest = parts[1:]
        if isinstance(dtype, T.VariantType):
            return Field(col, dtype, "$" + "".join("." + p for p in rest) if rest else "$")
        for p in rest:
            flat = p.endswith("[]")
            p = p[:-2] if flat else p
            if isinstance(dtype, T.StructType):
                sub = {f.name: f.dataType for f in dtype.fields}
                if p not in sub:
                    raise FilterError(f"unknown filter key {key!r}")
                col, dtype = col[p], sub[p]
            elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
                sub = {f.name: f.dataType for f in dtype.elementType.fields}
                if p not in sub:
                    raise FilterError(f"unknown filter key {key!r}")
                col = F.transform(col, lambda e, p=p: e[p])
                dtype = T.ArrayType(sub[p])
                if isinstance(sub[p], T.ArrayType):
                    col, dtype = F.flatten(col), sub[p]
            elif isinstance(dtype, T.VariantType):
                return Field(col, dtype, "$." + p)
            else:
                raise FilterError(f"key {key!r}: {p!r} is not a field of {dtype.simpleString()}")
        return Field(col, dtype)


def build_filter(spec: dict | None, schema: T.StructType, id_col: str = "id",
                 variant_payload: str | None = None) -> Column:
    """Compile a filter tree to a boolean Column (never NULL)."""
    if spec is None:
        return F.lit(True)
    return _filter(spec, Scope(schema, F.col, id_col, variant_payload))


def _t(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _and(cs: list[Column]) -> Column:
    out = F.lit(True)
    for c in cs:
        out = out & c
    return out


def _or(cs: list[Column]) -> Column:
    out = F.lit(False)
    for c in cs:
        out = out | c
    return out


def _as_list(x):
    if x is None:
        return []
    return x if isinstance(x, list) else [x]


def _filter(spec: dict, scope: Scope) -> Column:
    if not isinstance(spec, dict):
        raise FilterError(f"filter must be an object, got {type(spec).__name__}")
    bad = set(spec) - FILTER_KEYS
    if bad:
        raise FilterError(f"unknown filter keys {sorted(bad)}")
    parts = []
    if spec.get("must") is not None:
        # cheap conditions first: AND short-circuits left to right, so a text or
        # geo test only runs on rows that passed the plain comparisons
        must = sorted(_as_list(spec["must"]), key=lambda c: _cost(c, scope))
        parts.append(_and([_condition(c, scope) for c in must]))
    if spec.get("must_not") is not None:
        parts.append(~_or([_condition(c, scope) for c in _as_list(spec["must_not"])]))
    if spec.get("should") is not None:
        conds = [_condition(c, scope) for c in _as_list(spec["should"])]
        if conds:
            parts.append(_or(conds))
    if spec.get("min_should") is not None:
        ms = spec["min_should"]
        if set(ms) - {"conditions", "min_count"}:
            raise FilterError(f"unknown min_should keys {sorted(set(ms) - {'conditions', 'min_count'})}")
        conds = [_condition(c, scope) for c in ms.get("conditions", [])]
        n = int(ms.get("min_count", 1))
        total = F.lit(0)
        for c in conds:
            total = total + _t(c).cast("int")
        parts.append(total >= n)
    return _and(parts)


def _cost(c, scope: Scope) -> int:
    """Rough evaluation cost of a condition, used only to order AND operands."""
    if not isinstance(c, dict):
        return 0
    if set(c) & FILTER_KEYS:
        subs = [x for k in FILTER_KEYS for x in _as_list(c.get(k) if k != "min_should"
                                                         else (c.get(k) or {}).get("conditions"))]
        return max([_cost(x, scope) for x in subs] or [0])
    if "nested" in c:
        return 6
    if "key" not in c:
        return 0  # has_id, is_null, is_empty
    try:
        fld = scope.resolve(c["key"])
    except FilterError:
        return 0  # reported when the condition itself is compiled
    kind = next((k for k in c if k != "key"), "")
    if kind == "match" and "text" in (c.get("match") or {}):
        return 8
    if fld.variant_path is not None:
        return 5
    if kind in ("geo_radius", "geo_polygon"):
        return 4
    if isinstance(fld.dtype, T.ArrayType) or kind == "geo_bounding_box":
        return 2
    return 0


def _condition(c: dict, scope: Scope) -> Column:
    if not isinstance(c, dict):
        raise FilterError(f"condition must be an object, got {c!r}")
    if set(c) & FILTER_KEYS:
        return _filter(c, scope)
    if "has_id" in c:
        _only(c, {"has_id"})
        if scope.id_col is None:
            raise FilterError("has_id is not allowed inside nested filters")
        ids = list(c["has_id"])
        idc = scope.getter(scope.id_col)
        return (idc.isNotNull() & idc.isin(ids)) if ids else F.lit(False)
    if "is_empty" in c:
        _only(c, {"is_empty"})
        return _is_empty(scope.resolve(_key_of(c["is_empty"])))
    if "is_null" in c:
        _only(c, {"is_null"})
        return _is_null(scope.resolve(_key_of(c["is_null"])))
    if "nested" in c:
        _only(c, {"nested"})
        n = c["nested"]
        if set(n) - {"key", "filter"}:
            raise FilterError(f"unknown nested keys {sorted(set(n) - {'key', 'filter'})}")
        return _nested(n["key"], n["filter"], scope)
    if "key" in c:
        kinds = set(c) - {"key"}
        if len(kinds) != 1 or not kinds <= FIELD_KEYS:
            raise FilterError(f"field condition needs exactly one of {sorted(FIELD_KEYS)}, got {sorted(kinds)}")
        kind = kinds.pop()
        return _field_condition(scope.resolve(c["key"]), kind, c[kind], scope)
    raise FilterError(f"unknown condition {sorted(c)}")


def _only(c: dict, allowed: set) -> None:
    if set(c) - allowed:
        raise FilterError(f"unexpected keys {sorted(set(c) - allowed)}")


def _key_of(x) -> str:
    if isinstance(x, dict):
        _only(x, {"key"})
        return x["key"]
    return x


# ---------------------------------------------------------------- field conditions

def _field_condition(fld: Field, kind: str, arg, scope: Scope) -> Column:
    """Leaf predicates are never NULL by construction: scalar ones are
    ``isNotNull(v) AND pred(v)`` so that Catalyst can push both parts to the
    scan; only array and VARIANT predicates (never pushable) use coalesce."""
    if fld.variant_path is not None:
        return _variant_condition(fld, kind, arg, scope)
    if kind == "values_count":
        return _range(_values_count(fld), arg)
    if kind == "match" and "text" in arg:
        return _t(_text_match(fld, arg["text"], scope))
    if isinstance(fld.dtype, T.ArrayType):
        elem = fld.dtype.elementType
        if kind == "match" and "except" in arg:
            vals = list(arg["except"])
            return _t(F.exists(fld.col, lambda x: x.isNotNull() & ~x.isin(vals) if vals else x.isNotNull()))
        return _t(F.exists(fld.col, lambda x: x.isNotNull() & _scalar(x, elem, kind, arg)))
    return fld.col.isNotNull() & _scalar(fld.col, fld.dtype, kind, arg)


def _scalar(v: Column, dtype: T.DataType, kind: str, arg) -> Column:
    if kind == "match":
        return _match(v, dtype, arg)
    if kind == "range":
        return _range(v, arg)
    if kind == "datetime_range":
        return _datetime_range(v, dtype, arg)
    if kind in ("geo_bounding_box", "geo_radius", "geo_polygon"):
        lat, lon = v["lat"], v["lon"]
        fn = {"geo_bounding_box": geo_in_box, "geo_radius": geo_in_radius, "geo_polygon": geo_in_polygon}[kind]
        return lat.isNotNull() & lon.isNotNull() & fn(lat, lon, arg)
    raise FilterError(f"unsupported condition {kind!r}")


def _kind_ok(value, dtype: T.DataType) -> bool:
    if isinstance(value, bool):
        return isinstance(dtype, T.BooleanType)
    if isinstance(value, (int, float)):
        return isinstance(dtype, T.NumericType)
    if isinstance(value, str):
        return isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))
    return False


def _match(v: Column, dtype: T.DataType, arg: dict) -> Column:
    kinds = set(arg) - {"text"}
    if len(arg) != 1 or not kinds <= {"value", "any", "except"}:
        raise FilterError(f"match needs exactly one of value, text, any, except; got {sorted(arg)}")
    if "value" in arg:
        val = arg["value"]
        return v == F.lit(val) if _kind_ok(val, dtype) else F.lit(False)
    if "any" in arg:
        vals = [x for x in arg["any"] if _kind_ok(x, dtype)]
        return v.isin(vals) if vals else F.lit(False)
    vals = [x for x in arg["except"] if _kind_ok(x, dtype)]
    return v.isNotNull() & (~v.isin(vals) if vals else F.lit(True))


def _range(v: Column, arg: dict) -> Column:
    if set(arg) - {"lt", "lte", "gt", "gte"}:
        raise FilterError(f"unknown range keys {sorted(set(arg) - {'lt', 'lte', 'gt', 'gte'})}")
    conds = []
    if arg.get("lt") is not None:
        conds.append(v < F.lit(arg["lt"]))
    if arg.get("lte") is not None:
        conds.append(v <= F.lit(arg["lte"]))
    if arg.get("gt") is not None:
        conds.append(v > F.lit(arg["gt"]))
    if arg.get("gte") is not None:
        conds.append(v >= F.lit(arg["gte"]))
    return _and(conds) & v.isNotNull()


def _ts_literal(s: str, dtype: T.DataType) -> Column:
    """A typed literal independent of the session time zone.

    An ISO string with a zone (``Z``, ``+02:00``) is converted to UTC; a string
    without one is read as UTC [our decision]. TIMESTAMP_NTZ columns compare with
    the UTC wall clock, TIMESTAMP columns with the UTC instant.
    """
    import datetime as _dt
    try:
        t = _dt.datetime.fromisoformat(str(s).strip())
    except ValueError as e:
        raise FilterError(f"bad datetime {s!r}") from e
    if t.tzinfo is not None:
        t = t.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    iso = t.isoformat(sep=" ")
    if isinstance(dtype, T.DateType):
        return F.expr(f"DATE '{t.date().isoformat()}'")
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"TIMESTAMP_NTZ '{iso}'")
    return F.expr(f"TIMESTAMP '{iso}+00:00'")


def _datetime_range(v: Column, dtype: T.DataType, arg: dict) -> Column:
    if set(arg) - {"lt", "lte", "gt", "gte"}:
        raise FilterError("unknown datetime_range keys")
    conv = {k: _ts_literal(x, dtype) for k, x in arg.items() if x is not None}
    conds = []
    if "lt" in conv:
        conds.append(v < conv["lt"])
    if "lte" in conv:
        conds.append(v <= conv["lte"])
    if "gt" in conv:
        conds.append(v > conv["gt"])
    if "gte" in conv:
        conds.append(v >= conv["gte"])
    return _and(conds) & v.isNotNull()


def _values_count(fld: Field) -> Column:
    if isinstance(fld.dtype, T.ArrayType):
        return F.coalesce(F.size(fld.col).cast("long"), F.lit(0).cast("long"))
    return F.when(fld.col.isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long")


def _is_empty(fld: Field) -> Column:
    if fld.variant_path is not None:
        node = F.variant_get(fld.col, fld.variant_path, "variant") if fld.variant_path != "$" else fld.col
        kind = F.schema_of_variant(node)
        return _t(node.isNull() | F.is_variant_null(node) |
                  (kind.startswith("ARRAY") & (F.size(node.cast("array<variant>")) == 0)))
    if isinstance(fld.dtype, T.ArrayType):
        return fld.col.isNull() | (F.size(fld.col) == 0)
    return fld.col.isNull()


def _is_null(fld: Field) -> Column:
    if fld.variant_path is not None:
        node = F.variant_get(fld.col, fld.variant_path, "variant") if fld.variant_path != "$" else fld.col
        return _t(F.is_variant_null(node))
    return fld.col.isNull()


def _text_match(fld: Field, query: str, scope: Scope) -> Column:
    q = text_fn.tokens(F.lit(query), scope.text_tokenizer)
    if isinstance(fld.dtype, T.ArrayType):
        toks = F.flatten(F.transform(fld.col, lambda s: text_fn.tokens(s, scope.text_tokenizer)))
    else:
        toks = text_fn.tokens(fld.col, scope.text_tokenizer)
    # every query token present <=> no query token left after removing the text's tokens
    # (one tokenization per row; forall(q, array_contains(tokens(text), t)) would redo it per token)
    return fld.col.isNotNull() & (F.size(F.array_except(q, toks)) == 0)


def _nested(key: str, spec: dict, scope: Scope) -> Column:
    fld = scope.resolve(key)
    if fld.variant_path is not None:
        arr = F.try_variant_get(fld.col, fld.variant_path, "array<variant>")
        inner_schema = T.StructType([T.StructField("_v", T.VariantType())])

        def pred(e):
            sub = Scope(inner_schema, lambda name: e, None, "_v", scope.text_tokenizer)
            return _filter(spec, sub)
        return _t(F.exists(arr, pred))
    if not (isinstance(fld.dtype, T.ArrayType) and isinstance(fld.dtype.elementType, T.StructType)):
        raise FilterError(f"nested key {key!r} must be an array of objects")
    elem = fld.dtype.elementType

    def pred(e):
        sub = Scope(elem, lambda name: e[name], None, None, scope.text_tokenizer)
        return _filter(spec, sub)
    return _t(F.exists(fld.col, pred))


# ---------------------------------------------------------------- VARIANT payloads

_NUMERIC_KINDS = ("TINYINT", "SMALLINT", "INT", "BIGINT", "DECIMAL", "FLOAT", "DOUBLE")


def _variant_node(fld: Field) -> Column:
    return fld.col if fld.variant_path == "$" else F.variant_get(fld.col, fld.variant_path, "variant")


def _variant_scalar(node: Column, kind: str, arg) -> Column:
    k = F.schema_of_variant(node)
    is_num = _or([k.startswith(p) for p in _NUMERIC_KINDS])
    is_str = k == F.lit("STRING")
    is_bool = k == F.lit("BOOLEAN")

    def typed(val):
        if isinstance(val, bool):
            return is_bool, F.try_variant_get(node, "$", "boolean")
        if isinstance(val, int):
            return is_num, F.try_variant_get(node, "$", "decimal(38,10)")
        if isinstance(val, float):
            return is_num, F.try_variant_get(node, "$", "double")
        if isinstance(val, str):
            return is_str, F.try_variant_get(node, "$", "string")
        raise FilterError(f"unsupported match value {val!r}")

    if kind == "match":
        if "value" in arg:
            ok, v = typed(arg["value"])
            return ok & (v == F.lit(arg["value"]))
        if "any" in arg:
            return _or([_variant_scalar(node, "match", {"value": x}) for x in arg["any"]])
        if "except" in arg:
            return (~F.is_variant_null(node)) & ~_or([_variant_scalar(node, "match", {"value": x})
                                                      for x in arg["except"]])
        if "text" in arg:
            s = F.try_variant_get(node, "$", "string")
            q = text_fn.tokens(F.lit(arg["text"]))
            toks = text_fn.tokens(s)
            return is_str & (F.size(F.array_except(q, toks)) == 0)
    if kind == "range":
        return is_num & _range(F.try_variant_get(node, "$", "double"), arg)
    if kind == "datetime_range":
        return _datetime_range(F.try_variant_get(node, "$", "timestamp"), T.TimestampType(), arg)
    if kind in ("geo_bounding_box", "geo_radius", "geo_polygon"):
        lat = F.try_variant_get(node, "$.lat", "double")
        lon = F.try_variant_get(node, "$.lon", "double")
        fn = {"geo_bounding_box": geo_in_box, "geo_radius": geo_in_radius, "geo_polygon": geo_in_polygon}[kind]
        return lat.isNotNull() & lon.isNotNull() & fn(lat, lon, arg)
    raise FilterError(f"unsupported condition {kind!r} on a VARIANT path")


def _variant_condition(fld: Field, kind: str, arg, scope: Scope) -> Column:
    node = _variant_node(fld)
    is_array = F.schema_of_variant(node).startswith("ARRAY")
    if kind == "values_count":
        cnt = (F.when(node.isNull() | F.is_variant_null(node), F.lit(0))
                .when(is_array, F.size(node.cast("array<variant>")))
                .otherwise(F.lit(1))).cast("long")
        return _t(_range(cnt, arg))
    if kind == "match" and "except" in arg:
        arr_c = F.exists(node.cast("array<variant>"),
                         lambda e: _variant_scalar(e, "match", arg))
        return _t(F.when(is_array, arr_c).otherwise(_variant_scalar(node, kind, arg)))
    arr_c = F.exists(F.try_variant_get(node, "$", "array<variant>"),
                     lambda e: _variant_scalar(e, kind, arg))
    return _t(F.when(is_array, arr_c).otherwise(_variant_scalar(node, kind, arg)))


# ---------------------------------------------------------------- geo

def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres between Columns/literals (degrees)."""
    def c(x):
        return x if isinstance(x, Column) else F.lit(float(x))
    p1, p2 = F.radians(c(lat1)), F.radians(c(lat2))
    dphi = p2 - p1
    dl = F.radians(c(lon2)) - F.radians(c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def geo_in_box(lat: Column, lon: Column, box: dict) -> Column:
    tl, br = box["top_left"], box["bottom_right"]
    lat_ok = (lat <= F.lit(float(tl["lat"]))) & (lat >= F.lit(float(br["lat"])))
    left, right = float(tl["lon"]), float(br["lon"])
    if left <= right:
        lon_ok = (lon >= F.lit(left)) & (lon <= F.lit(right))
    else:  # crosses the antimeridian
        lon_ok = (lon >= F.lit(left)) | (lon <= F.lit(right))
    return lat_ok & lon_ok


def geo_in_radius(lat: Column, lon: Column, arg: dict) -> Column:
    c = arg["center"]
    r = float(arg["radius"])
    # cheap latitude band first (exact: no point outside it can be within r)
    dlat = math.degrees(r / EARTH_RADIUS_M)
    band = (lat >= F.lit(float(c["lat"]) - dlat)) & (lat <= F.lit(float(c["lat"]) + dlat))
    return band & (haversine_m(lat, lon, c["lat"], c["lon"]) <= F.lit(r))


def _ring_contains(lat: Column, lon: Column, ring: list[dict]) -> Column:
    pts = [(float(p["lon"]), float(p["lat"])) for p in ring]
    if len(pts) > 1 and pts[0] == pts[-1]:
        pts = pts[:-1]
    crossings = F.lit(0)
    n = len(pts)
    for i in range(n):
        x1, y1 = pts[i]
        x2, y2 = pts[(i + 1) % n]
        if y1 == y2:
            continue
        straddles = (lat > F.lit(min(y1, y2))) & (lat <= F.lit(max(y1, y2)))
        x_cross = F.lit(x1) + (lat - F.lit(y1)) * F.lit((x2 - x1) / (y2 - y1))
        crossings = crossings + F.when(straddles & (lon < x_cross), 1).otherwise(0)
    return (crossings % 2) == 1


def geo_in_polygon(lat: Column, lon: Column, poly: dict) -> Column:
    inside = _ring_contains(lat, lon, poly["exterior"]["points"])
    for hole in poly.get("interiors") or []:
        inside = inside & ~_ring_contains(lat, lon, hole["points"])
    return inside
