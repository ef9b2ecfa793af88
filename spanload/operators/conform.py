"""Schema conformance (F1–F7): table-schema JSON → StructType → typed rows.

A table schema is a JSON list of ``{name, type, mode, description, fields}``
(the common warehouse convention).  :func:`schema_from_spec` turns it into a
``StructType`` (descriptions and modes kept in field metadata).  Loading a
cleaned JSON line into that schema (:func:`conform_lines`) follows load
semantics:

* F2 unknown fields are ignored,
* F3 missing fields become NULL; a missing REPEATED field becomes ``[]``,
* F4 a value that does not fit its type is a bad row — it fails the load
  (``on_bad="fail"``) or goes to the rejects (``on_bad="reject"``),
* F5 a REQUIRED field that is NULL, or a NULL element in a REPEATED field,
  is a bad row too (Spark itself does not enforce NOT NULL on files).
"""

from __future__ import annotations

import json
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DataType,
                               DateType, DecimalType, DoubleType, LongType,
                               StringType, StructField, StructType,
                               TimestampNTZType, TimestampType, VariantType)

from spanload.operators.clean import NON_FINITE, computed_once, nonfinite

# Schema type names (upper case) and their Spark types.
_SCALARS: dict[str, DataType] = {
    "STRING": StringType(),
    "INTEGER": LongType(),
    "INT64": LongType(),
    "FLOAT": DoubleType(),
    "FLOAT64": DoubleType(),
    "BOOLEAN": BooleanType(),
    "BOOL": BooleanType(),
    "BYTES": BinaryType(),
    "DATE": DateType(),
    "TIME": StringType(),
    "TIMESTAMP": TimestampType(),
    "DATETIME": TimestampNTZType(),
    "NUMERIC": DecimalType(38, 9),
    "DECIMAL": DecimalType(38, 9),
    "JSON": VariantType(),
}
_RECORDS = ("RECORD", "STRUCT")
_MODES = ("NULLABLE", "REQUIRED", "REPEATED")
# Fixed value: textual TIME of day, HH:MM:SS with up to 6 fraction digits.
TIME_PATTERN = r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]{1,6})?$"

BAD_VALUE = "bad value"
REQUIRED_MISSING = "required field missing"
NULL_IN_REPEATED = "null in repeated field"
BAD_TIME = "bad time value"


class SchemaError(ValueError):
    pass


def _field(spec: dict[str, Any], path: str) -> StructField:
    if not isinstance(spec, dict) or not spec.get("name"):
        raise SchemaError(f"field without a name at {path}")
    name = spec["name"]
    tname = str(spec.get("type", "")).upper()
    mode = str(spec.get("mode", "NULLABLE") or "NULLABLE").upper()
    if mode not in _MODES:
        raise SchemaError(f"unknown mode {mode!r} for {path}{name}")
    if tname in _RECORDS:
        subs = spec.get("fields") or []
        if not subs:
            raise SchemaError(f"record {path}{name} has no fields")
        dtype: DataType = StructType([_field(s, f"{path}{name}.") for s in subs])
    elif tname in _SCALARS:
        dtype = _SCALARS[tname]
    else:
        raise SchemaError(f"unsupported type {spec.get('type')!r} for {path}{name}")
    meta = {"type": tname, "mode": mode}
    if spec.get("description"):
        meta["description"] = spec["description"]
    if mode == "REPEATED":
        return StructField(name, ArrayType(dtype, True), True, meta)
    return StructField(name, dtype, mode != "REQUIRED", meta)


def schema_from_spec(spec: list[dict[str, Any]] | str) -> StructType:
    """F1 — a table schema (list or JSON text) → StructType; empty is an error."""
    if isinstance(spec, str):
        try:
            spec = json.loads(spec)
        except json.JSONDecodeError as e:
            raise SchemaError(f"invalid schema JSON: {e}") from e
    if not isinstance(spec, list):
        raise SchemaError("a table schema is a JSON list of fields")
    if not spec:
        raise SchemaError("empty schema")
    fields = [_field(s, "") for s in spec]
    names = [f.name for f in fields]
    if len(set(names)) != len(names):
        raise SchemaError("duplicate field names in schema")
    return StructType(fields)


def top_level_types(schema: StructType) -> dict[str, str]:
    """S6 — the input view: top-level name → declared type name (upper case)."""
    return {f.name: f.metadata.get("type", "") for f in schema.fields}


def string_fields(schema: StructType) -> list[str]:
    """Fields the cleaning step must turn into text when a record arrives."""
    return [n for n, t in top_level_types(schema).items() if t == "STRING"]


def parse_schema(schema: StructType) -> StructType:
    """The schema handed to the JSON parser: REQUIRED relaxed to nullable.

    Required-ness is checked explicitly afterwards so that a NULL is reported
    instead of silently written.
    """
    def relax(dt: DataType) -> DataType:
        if isinstance(dt, StructType):
            return StructType([StructField(f.name, relax(f.dataType), True, f.metadata)
                               for f in dt.fields])
        if isinstance(dt, ArrayType):
            return ArrayType(relax(dt.elementType), True)
        return dt
    return relax(schema)


def _fill_repeated(c: Column, field: StructField) -> Column:
    """F3 — missing REPEATED → ``[]``, recursively inside records."""
    dt = field.dataType
    if isinstance(dt, ArrayType):
        inner = dt.elementType
        if isinstance(inner, StructType) and _has_repeated(inner):
            c = F.transform(c, lambda x: _fill_struct(x, inner))
        return F.coalesce(c, F.array().cast(ArrayType(inner, True)))
    if isinstance(dt, StructType) and _has_repeated(dt):
        return F.when(c.isNull(), F.lit(None).cast(parse_schema(dt))).otherwise(_fill_struct(c, dt))
    return c


def _fill_struct(c: Column, st: StructType) -> Column:
    return F.struct(*[_fill_repeated(c[f.name], f).alias(f.name) for f in st.fields])


def _has_repeated(st: StructType) -> bool:
    for f in st.fields:
        if f.metadata.get("mode") == "REPEATED":
            return True
        if isinstance(f.dataType, StructType) and _has_repeated(f.dataType):
            return True
        if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StructType) \
                and _has_repeated(f.dataType.elementType):
            return True
    return False


def _violations(c: Column, field: StructField, path: str) -> list[tuple[Column, str]]:
    """(condition, reason) pairs for REQUIRED / REPEATED / TIME rules of one field."""
    out: list[tuple[Column, str]] = []
    mode = field.metadata.get("mode", "NULLABLE")
    tname = field.metadata.get("type", "")
    dt = field.dataType
    if mode == "REQUIRED":
        out.append((c.isNull(), f"{REQUIRED_MISSING}: {path}{field.name}"))
    if mode == "REPEATED":
        out.append((F.exists(c, lambda x: x.isNull()), f"{NULL_IN_REPEATED}: {path}{field.name}"))
        if tname == "TIME":
            out.append((F.exists(c, lambda x: ~x.rlike(TIME_PATTERN)),
                        f"{BAD_TIME}: {path}{field.name}"))
        elif isinstance(dt, ArrayType) and isinstance(dt.elementType, StructType):
            prefix = f"{path}{field.name}."
            for sub in dt.elementType.fields:
                rules = _violations(F.lit(None), sub, prefix)
                for i, (_, why) in enumerate(rules):
                    out.append((F.exists(c, _element_rule(sub, prefix, i)), why))
    elif tname == "TIME":
        out.append((~c.rlike(TIME_PATTERN), f"{BAD_TIME}: {path}{field.name}"))
    elif isinstance(dt, StructType):
        for sub in dt.fields:
            for cond, why in _violations(c[sub.name], sub, f"{path}{field.name}."):
                out.append((c.isNotNull() & F.coalesce(cond, F.lit(False)), why))
    return out


def _element_rule(sub: StructField, prefix: str, i: int):
    """Rule ``i`` of a record field, as a one-argument function of an array element."""
    def bad(x: Column) -> Column:
        cond = _violations(x[sub.name], sub, prefix)[i][0]
        return x.isNotNull() & F.coalesce(cond, F.lit(False))
    return bad


def _text_holds(c: Column, field: StructField, test) -> Column | None:
    """Whether ``test`` is true of a text in a STRING field, at any depth; None without one."""
    dt = field.dataType
    inner = dt.elementType if isinstance(dt, ArrayType) else dt

    def one(x: Column) -> Column | None:
        if not isinstance(inner, StructType):
            return test(x) if field.metadata.get("type") == "STRING" else None
        held = [h for sub in inner.fields if (h := _text_holds(x[sub.name], sub, test)) is not None]
        return reduce(Column.__or__, (F.coalesce(h, F.lit(False)) for h in held)) if held else None

    if not isinstance(dt, ArrayType):
        return one(c)
    return None if one(F.lit(None)) is None else F.exists(c, one)


def _nested_in_text(v: Column, field: StructField) -> Column:
    """F4 — whether a STRING field was sent an array or a record; ``v`` is the field's variant."""
    dt = field.dataType
    inner = dt.elementType if isinstance(dt, ArrayType) else dt

    def one(x: Column) -> Column:
        if not isinstance(inner, StructType):
            kind = F.schema_of_variant(x)
            return F.coalesce(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.lit(False))
        by_name = F.try_variant_get(x, "$", "map<string,variant>")
        return reduce(Column.__or__, (_nested_in_text(by_name[sub.name], sub) for sub in inner.fields
                                      if _text_holds(F.lit(None), sub, F.isnull) is not None))

    if not isinstance(dt, ArrayType):
        return one(v)
    return F.coalesce(F.exists(F.try_variant_get(v, "$", "array<variant>"), one), F.lit(False))


def conform_lines(df: DataFrame, schema: StructType, line: str = "line",
                  on_bad: str = "reject", reason: str = "reject_reason",
                  keep: list[str] | None = None) -> DataFrame:
    """F2–F5 — parse cleaned JSON lines into the typed schema.

    Returns the schema's columns (in schema order), the ``keep`` columns and
    ``reject_reason`` (NULL for good rows).  With ``on_bad="fail"`` the first
    bad row fails the job at its action, like a load without a bad-record
    allowance.  An array or a record sent to a STRING field, at any depth, is a bad
    value; text that merely looks like one is not.
    """
    if on_bad not in ("reject", "fail"):
        raise ValueError("on_bad must be 'reject' or 'fail'")
    corrupt = "_corrupt_record"
    pschema = StructType(parse_schema(schema).fields + [StructField(corrupt, StringType(), True)])
    parsed = df.withColumn("_r", F.from_json(F.col(line), pschema, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}))
    cols = [_fill_repeated(F.col("_r")[f.name], f).alias(f.name) for f in schema.fields]
    typed = parsed.select(*[F.col(k) for k in (keep or [])], *cols,
                          F.col("_r")[corrupt].alias("_bad"), F.col(line).alias("_line"))
    why = F.when(F.col("_line").isNull(), F.lit(BAD_VALUE)).when(
        F.col("_bad").isNotNull(), F.lit(BAD_VALUE))
    by_name = F.from_json("_line", "map<string,variant>")
    for f in schema.fields:
        # the parser takes arrays and records into text; only lines with such a text are looked at again
        bracket = _text_holds(F.col(f.name), f, lambda x: x.startswith("[") | x.startswith("{"))
        if bracket is not None:
            why = why.when(F.when(F.coalesce(bracket, F.lit(False)), _nested_in_text(by_name[f.name], f)), F.lit(BAD_VALUE))
        for cond, text in _violations(F.col(f.name), f, ""):
            why = why.when(F.coalesce(cond, F.lit(False)), F.lit(text))
    out = computed_once(typed.withColumn(reason, why).drop("_bad", "_line"), [*(f.name for f in schema.fields), reason])
    if on_bad == "fail":
        # A filter, not a column: column pruning cannot remove it, so the
        # first bad row fails whatever action reads this frame.
        out = out.where(F.assert_true(F.col(reason).isNull(), F.concat(
            F.lit("load failed: "), F.col(reason))).isNull())
    return out


def check_columns(target: StructType, incoming: StructType) -> None:
    """W8 guard — the incoming frame must carry exactly the target's columns."""
    want = [f.name for f in target.fields]
    have = [f.name for f in incoming.fields]
    missing = [c for c in want if c not in have]
    extra = [c for c in have if c not in want]
    if missing or extra:
        raise SchemaError(f"column sets differ: missing {missing}, unexpected {extra}")


# ---------------------------------------------------------------------------
# Typed sources: the same load rules without a JSON round trip


def _compatible(src: DataType, dst: DataType) -> bool:
    """True when a JSON round trip of ``src`` values would load into ``dst`` unchanged."""
    from pyspark.sql.types import ByteType, IntegerType, ShortType
    integral = (ByteType, ShortType, IntegerType, LongType)
    if isinstance(dst, LongType):
        return isinstance(src, integral)
    if isinstance(dst, DoubleType):
        # FLOAT32 is left to the JSON path: its text form rounds differently
        # from a binary widening.
        return isinstance(src, integral + (DoubleType,))
    if isinstance(dst, (StringType, BooleanType, DateType, BinaryType, TimestampNTZType)):
        return type(src) is type(dst)
    if isinstance(dst, TimestampType):
        return isinstance(src, (TimestampType, TimestampNTZType))
    if isinstance(dst, ArrayType):
        return isinstance(src, ArrayType) and _compatible(src.elementType, dst.elementType)
    if isinstance(dst, StructType):
        if not isinstance(src, StructType):
            return False
        names = {f.name: f.dataType for f in src.fields}
        return all(_compatible(names[f.name], f.dataType) for f in dst.fields if f.name in names)
    return False


def _renamed(name: str, rename_id: bool) -> str:
    return "id" if rename_id and name == "_id" else name


def typed_compatible(source: StructType, schema: StructType, rename_id: bool = True) -> bool:
    """Whether :func:`conform_typed` applies (else load through JSON documents)."""
    names = {_renamed(f.name, rename_id): f.dataType for f in source.fields}
    if rename_id and "_id" in source.names and "id" in source.names:
        return False
    for f in schema.fields:
        if f.name in names and not _compatible(names[f.name], f.dataType):
            return False
        if f.name in names and isinstance(f.dataType, StructType) and rename_id:
            if _nested_id(names[f.name]):
                return False
    return True


def _nested_id(dt: DataType) -> bool:
    """A nested ``_id`` field would be renamed in text; keep those on the JSON path."""
    if isinstance(dt, StructType):
        return any(f.name == "_id" or _nested_id(f.dataType) for f in dt.fields)
    if isinstance(dt, ArrayType):
        return _nested_id(dt.elementType)
    return False


def _typed_value(c: Column, src: DataType, field: StructField) -> Column:
    dst = field.dataType
    if isinstance(dst, StructType):
        names = {f.name: f.dataType for f in src.fields}
        subs = [(_typed_value(c[f.name], names[f.name], f) if f.name in names
                 else F.lit(None).cast(parse_schema(StructType([f]))[0].dataType)).alias(f.name)
                for f in dst.fields]
        return F.when(c.isNull(), F.lit(None).cast(parse_schema(dst))).otherwise(F.struct(*subs))
    if isinstance(dst, ArrayType):
        inner = StructField("x", dst.elementType, True, {"type": field.metadata.get("type", "")})
        return F.transform(c, lambda x: _typed_value(x, src.elementType, inner))
    return c.cast(dst)


def conform_typed(df: DataFrame, schema: StructType, on_bad: str = "reject",
                  reason: str = "reject_reason", keep: list[str] | None = None,
                  rename_id: bool = True) -> DataFrame:
    """F2–F5 (plus C1, C2, C5, C7) for a typed source whose types are compatible.

    Same outcome as writing each row as a JSON document, cleaning it and
    loading it into ``schema``: unknown columns are ignored, missing ones are
    NULL (REPEATED: ``[]``), a top-level ``[null]`` array counts as missing,
    ``_id`` becomes ``id``, NaN/±Infinity anywhere rejects the row, and the
    REQUIRED / REPEATED / TIME rules apply — but no text is produced or
    parsed.  Check :func:`typed_compatible` first.
    """
    if on_bad not in ("reject", "fail"):
        raise ValueError("on_bad must be 'reject' or 'fail'")
    src = {_renamed(f.name, rename_id): f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name in src:
            s = src[f.name]
            c = F.col(f"`{s.name}`")
            if isinstance(s.dataType, ArrayType):
                only_null = (F.size(c) == 1) & c[0].isNull()
                c = F.when(only_null, F.lit(None)).otherwise(c)  # C2
            v = _typed_value(c, s.dataType, f)
        else:
            v = F.lit(None).cast(parse_schema(StructType([f]))[0].dataType)
        cols.append(_fill_repeated(v, f).alias(f.name))
    bad = nonfinite(F.struct(*[F.col(f"`{c}`") for c in df.columns]),
                    StructType(df.schema.fields))
    typed = df.select(*[F.col(k) for k in (keep or [])], *cols,
                      (bad if bad is not None else F.lit(False)).alias("_nf"))
    why = None
    for f in schema.fields:
        for cond, text in _violations(F.col(f.name), f, ""):
            c = F.coalesce(cond, F.lit(False))
            why = F.when(c, F.lit(text)) if why is None else why.when(c, F.lit(text))
    schema_why = why if why is not None else F.lit(None).cast("string")
    # A non-finite row is a cleaning reject (it never reaches the load), so
    # it never fails the load; schema problems follow ``on_bad``.
    out = typed.withColumn("_sw", schema_why).withColumn(
        reason, F.when(F.col("_nf"), F.lit(NON_FINITE)).otherwise(F.col("_sw")))
    if on_bad == "fail":
        out = out.where(F.assert_true(F.col("_nf") | F.col("_sw").isNull(), F.concat(
            F.lit("load failed: "), F.col("_sw"))).isNull())
    return out.drop("_nf", "_sw")
