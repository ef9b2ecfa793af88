"""Document cleaning (C1–C8) with built-in variant and higher-order functions.

Raw documents arrive as one JSON text column.  Each is parsed once into a
VARIANT and viewed as ``map<string, variant>`` over its top-level fields;
then, on the top level only:

* C1 drop fields whose value is null,
* C2 drop fields whose value is exactly ``[null]`` (``[]`` and
  ``[null, null]`` stay),
* C3 turn a record into its JSON text where the schema says ``STRING``,
* C4 encode the document as one compact JSON line (keys sorted, as the
  variant stores them),
* C5 rename ``"_id":`` to ``"id":`` everywhere in the encoded text — text in
  string values is safe because its quotes are escaped.

Documents that cannot be handled are not silently dropped (C8): each row
gets ``reject_reason`` — ``undecodable``, ``non-finite number``,
``duplicate key``, ``not an object`` or ``duplicate id`` — and the caller
routes those rows to a reject output.  The reason is worked out with extra
parsing only for rows that already failed (CASE branches are lazy).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DoubleType, FloatType,
                               MapType, StructType)

# Reject reasons.
UNDECODABLE = "undecodable"
NON_FINITE = "non-finite number"
DUPLICATE_KEY = "duplicate key"
NOT_OBJECT = "not an object"
DUPLICATE_ID = "duplicate id"


def reject_reason(doc: Column, v: Column, m: Column, rename_id: bool = True) -> Column:
    """Why a raw document cannot be cleaned; NULL when it can."""
    lenient = F.from_json(doc, "map<string,variant>")
    strict = F.from_json(doc, "map<string,variant>", {"allowNonNumericNumbers": "false"})
    reason = (F.when(doc.isNull(), F.lit(UNDECODABLE))
              .when(v.isNull(), F.when(lenient.isNull(), F.lit(UNDECODABLE))
                    .when(strict.isNull(), F.lit(NON_FINITE))
                    .otherwise(F.lit(DUPLICATE_KEY)))
              .when(m.isNull(), F.lit(NOT_OBJECT)))
    if rename_id:
        reason = reason.when(F.map_contains_key(m, "_id") & F.map_contains_key(m, "id"),
                             F.lit(DUPLICATE_ID))
    return reason


def clean_map(m: Column, string_fields: Iterable[str] = ()) -> Column:
    """C1 + C2 + C3 on a ``map<string, variant>`` of top-level fields."""
    filtered = F.map_filter(
        m, lambda k, v: ~F.is_variant_null(v)
        & ~(F.is_variant_null(F.try_variant_get(v, "$[0]", "variant"))
            & F.try_variant_get(v, "$[1]", "variant").isNull()))
    fields = list(string_fields)
    if not fields:
        return filtered

    def to_text(k: Column, v: Column) -> Column:
        is_record = F.schema_of_variant(v).startswith("OBJECT")
        text = F.coalesce(F.to_json(v), F.lit("{}"))  # C6: failed stringify -> {}
        return F.when(k.isin(fields) & is_record, text.cast("variant")).otherwise(v)

    return F.transform_values(filtered, to_text)


def encode(m: Column, rename_id: bool = True) -> Column:
    """C4 + C5 — one compact JSON line; ``"_id":`` → ``"id":`` at every depth."""
    line = F.to_json(m)
    return rename_ids(line) if rename_id else line


def rename_ids(line: Column) -> Column:
    """C5 on encoded text: quotes inside string values are escaped, so only keys match."""
    return F.replace(line, F.lit('"_id":'), F.lit('"id":'))


def computed_once(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The same rows, columns ``names`` last and behind an optimizer barrier.

    They come out of a generator that makes one row of each.  A filter on what a generator
    makes isn't pushed below it, so what computes the columns (parsing) is planned once and
    isn't copied into the filter, whatever a caller filters or aggregates by.
    """
    names = list(names)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*rest, F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in names]))))


def clean_documents(df: DataFrame, doc: str = "doc", string_fields: Iterable[str] = (),
                    rename_id: bool = True, line: str = "line",
                    reason: str = "reject_reason") -> DataFrame:
    """Add the cleaned JSON ``line`` and ``reject_reason`` to every row.

    Exactly one of the two is non-null.  Other columns pass through, so a key
    or chunk column can travel with the document.  Each document is parsed once,
    however the result is filtered; only one that failed, or whose line holds
    both ``"_id":`` and ``"id":``, is looked at again.
    """
    d = F.col(doc)
    staged = (df.withColumn("_v", F.try_parse_json(d))
              .withColumn("_m", F.try_variant_get("_v", "$", "map<string,variant>")))
    why = reject_reason(d, F.col("_v"), F.col("_m"), rename_id)
    encoded = staged.withColumn(reason, why).withColumn(
        "_enc", F.when(F.col(reason).isNull(), encode(clean_map(F.col("_m"), string_fields),
                                                      rename_id=False)))
    out = encoded.withColumn(line, rename_ids(F.col("_enc")) if rename_id else F.col("_enc"))
    if rename_id:
        # A nested record holding both "_id" and "id" would carry two "id" keys
        # after the rename.  Only lines holding both texts are parsed again.
        enc, ln = F.col("_enc"), F.col(line)
        nested_dup = (F.instr(enc, '"_id":') > 0) & (F.instr(enc, '"id":') > 0) & \
            F.try_parse_json(ln).isNull()
        out = (out.withColumn(reason, F.when(F.col(reason).isNull() & nested_dup,
                                             F.lit(DUPLICATE_ID)).otherwise(F.col(reason)))
               .withColumn(line, F.when(F.col(reason).isNull(), F.col(line))))
    return computed_once(out.drop("_v", "_m", "_enc"), [reason, line])


def split_rejects(cleaned: DataFrame, reason: str = "reject_reason",
                  line: str = "line") -> tuple[DataFrame, DataFrame]:
    """(good rows without the reason column, rejected rows without the line)."""
    good = cleaned.where(F.col(reason).isNull()).drop(reason)
    bad = cleaned.where(F.col(reason).isNotNull()).drop(line)
    return good, bad


def reject_counts(cleaned: DataFrame, reason: str = "reject_reason") -> DataFrame:
    """C8 — documents per outcome (``ok`` or a reject reason), one aggregation."""
    return (cleaned.select(F.coalesce(F.col(reason), F.lit("ok")).alias("outcome"))
            .groupBy("outcome").agg(F.count(F.lit(1)).alias("docs")))


# ---------------------------------------------------------------------------
# Typed rows: documents made from a typed DataFrame


def nonfinite(c: Column, dtype: DataType) -> Column | None:
    """True where a double/float leaf anywhere in ``c`` is NaN or ±Infinity."""
    if isinstance(dtype, (DoubleType, FloatType)):
        return F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    if isinstance(dtype, ArrayType):
        inner = nonfinite(F.col("__x"), dtype.elementType)
        if inner is None:
            return None
        return F.exists(c, lambda x: F.coalesce(nonfinite(x, dtype.elementType), F.lit(False)))
    if isinstance(dtype, MapType):
        if nonfinite(F.col("__x"), dtype.valueType) is None:
            return None
        return F.exists(F.map_values(c),
                        lambda x: F.coalesce(nonfinite(x, dtype.valueType), F.lit(False)))
    if isinstance(dtype, StructType):
        parts = [nonfinite(c[f.name], f.dataType) for f in dtype.fields]
        parts = [F.coalesce(p, F.lit(False)) for p in parts if p is not None]
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out | p
        return out
    return None


def rows_to_documents(df: DataFrame, doc: str = "doc", keep: Iterable[str] = (),
                      reason: str = "reject_reason",
                      cols: list[str] | None = None) -> DataFrame:
    """C7 — typed rows to raw JSON documents; NaN/±Inf rows become rejects.

    JSON has no NaN or Infinity (Spark would write them as text), so such a
    row never becomes a document.  Nested nulls are written out, so the
    cleaning rules see the same document a document store would hold.
    """
    cols = cols or df.columns
    fields = StructType([df.schema[c] for c in cols])
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    cond = nonfinite(row, fields)
    text = F.to_json(row, {"ignoreNullFields": "false"})
    bad = cond if cond is not None else F.lit(False)
    return df.select(*[F.col(k) for k in keep],
                     F.when(~bad, text).alias(doc),
                     F.when(bad, F.lit(NON_FINITE)).alias(reason))
