"""Fitting an incoming frame to a table's schema, by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMismatchError(ValueError):
    """The incoming frame does not fit the table schema under the given flags."""


# Pairs of a type and one that holds more, to which it is cast. A batch of whole
# numbers infers bigint where earlier ones inferred double, so that is cast too.
_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_WIDENING = {(a, b) for i, a in enumerate(_WHOLE) for b in _WHOLE[i + 1 :]}
_WIDENING |= {(a, T.DoubleType) for a in [*_WHOLE, T.FloatType]}


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def nullable(kind: T.DataType) -> T.DataType:
    """The type with everything inside it nullable."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType), True)
    return kind


def _fit(value: Column, given: T.DataType, stored: T.DataType, merge: bool, where: str) -> tuple[Column, T.DataType]:
    """``value`` as the stored type, and that type with what merging added or widened."""
    if given == stored:
        return value, stored
    if isinstance(given, T.NullType) or (type(given), type(stored)) in _WIDENING:
        return value.cast(stored), stored
    if merge and (isinstance(stored, T.NullType) or (type(stored), type(given)) in _WIDENING):
        return value, given
    if isinstance(given, T.StructType) and isinstance(stored, T.StructType):
        columns, kind = _fit_fields(lambda name: value.getField(name), given, stored, merge, f"{where}.")
        return F.when(value.isNotNull(), F.struct(*columns)).cast(kind), kind
    if isinstance(given, T.ArrayType) and isinstance(stored, T.ArrayType):
        inner = _fit(F.lit(None), given.elementType, stored.elementType, merge, where)[1]
        fitted = F.transform(value, lambda x: _fit(x, given.elementType, stored.elementType, merge, where)[0])
        return fitted, T.ArrayType(inner, True)
    hint = "; set merge_schema=True to widen it" if (type(stored), type(given)) in _WIDENING else ""
    raise SchemaMismatchError(
        f"column {where!r} has type {given.simpleString()} but the table stores {stored.simpleString()}{hint}"
    )


def widened(value: Column, stored: T.DataType, now: T.DataType) -> Column:
    """A column read in the type it was stored in, as the table's type now."""
    return _fit(value, stored, now, True, "")[0]


def _fit_fields(get, given: T.StructType, stored: T.StructType, merge: bool, where: str) -> tuple[list[Column], T.StructType]:
    incoming = {f.name.lower(): f for f in given.fields}
    known = {f.name.lower() for f in stored.fields}
    extra = [f for f in given.fields if f.name.lower() not in known]
    if extra and not merge:
        raise SchemaMismatchError(
            f"columns {[where + f.name for f in extra]} are not in the table schema "
            f"{stored.names}; set merge_schema=True to add them"
        )
    columns, fields = [], []
    for field in stored.fields:
        source = incoming.get(field.name.lower())
        if source is None:
            column, kind = F.lit(None).cast(field.dataType), field.dataType
        else:
            column, kind = _fit(get(source.name), source.dataType, field.dataType, merge, where + field.name)
        columns.append(column.alias(field.name))
        fields.append(T.StructField(field.name, kind, True))
    columns += [get(f.name).alias(f.name) for f in extra]
    return columns, T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in extra])


def align(df: DataFrame, stored: T.StructType, merge_schema: bool) -> tuple[DataFrame, T.StructType]:
    """``df`` in the table's columns, matched by name (letter case ignored), in
    structs and arrays of structs too.

    Missing columns become NULL; extra ones are an error unless
    ``merge_schema`` adds them; values may be of a narrower type than the
    table's, and with ``merge_schema`` of a wider one, which the table then takes;
    whether nested values may be NULL does not matter.
    """
    given = nullable(df.schema)
    columns, merged = _fit_fields(lambda name: F.col(quote(name)), given, nullable(stored), merge_schema, "")
    return df.select(*columns), merged


def holds(stored: T.StructType, given: T.StructType) -> bool:
    """Whether a table takes such rows as they are: all columns known, by their
    exact names, and no type wider."""

    def same_names(a: T.DataType, b: T.DataType) -> bool:
        if isinstance(a, T.StructType) and isinstance(b, T.StructType):
            known = {f.name: f.dataType for f in b.fields}
            return all(f.name in known and same_names(f.dataType, known[f.name]) for f in a.fields)
        return not isinstance(a, T.ArrayType) or not isinstance(b, T.ArrayType) or same_names(a.elementType, b.elementType)

    try:
        _fit_fields(lambda name: F.lit(None), nullable(given), nullable(stored), False, "")
    except SchemaMismatchError:
        return False
    return same_names(given, stored)


def resolve_partitions(schema: T.StructType, partition_by) -> list[str]:
    names = {f.name.lower(): f.name for f in schema.fields}
    unknown = [c for c in partition_by or [] if c.lower() not in names]
    if unknown:
        raise SchemaMismatchError(f"partition column {unknown[0]!r} is not in the data columns {schema.names}")
    out = [names[c.lower()] for c in partition_by or []]
    if out and len(out) == len(schema.fields):
        raise SchemaMismatchError("cannot use all columns of a table as partition columns")
    return out
