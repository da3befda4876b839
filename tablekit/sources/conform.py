"""Conform a frame to a declared schema (S14, the typed-Dataset view).

``DataFrame.to(schema)`` neither casts (string -> bigint fails) nor accepts a
nullable column for a non-nullable field, and Parquet columns are always
nullable.  ``conform`` selects the fields by name in schema order (those of
nested structs as well), casts each, and turns a NULL in a non-nullable field
into a run-time error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType


def conform(df: DataFrame, schema: StructType, strict: bool = True,
            try_cast: bool = False) -> DataFrame:
    """Columns of ``schema`` in its order, types and nullability.

    ``strict`` raises (at analysis) when a field is missing; otherwise a missing
    nullable field becomes NULL.  ``try_cast`` turns unconvertible values into
    NULL instead of failing.  The NULL checks are part of a filter, so they run
    for every use of the result, also for one that reads no column such as
    ``count()``.  Fields of atomic type and structs carry the declared
    nullability; a non-nullable array or map is checked but stays nullable.
    """
    make = _Conformer(strict, try_cast)
    have = {c.lower(): (F.col(f"`{c}`"), df.schema[c].dataType) for c in df.columns}
    columns = [make.field(have, f, f.name).alias(f.name) for f in schema.fields]
    out = df.select(*columns)
    for f in schema.fields:
        if not f.nullable:
            c = F.col(f"`{f.name}`")
            out = out.where(F.when(c.isNull(), F.raise_error(
                F.lit(f"NULL in non-nullable field {f.name}")).cast("boolean")).otherwise(F.lit(True)))
    return out.select(*[_flagged(F.col(f"`{f.name}`"), f.dataType, f.nullable).alias(f.name) for f in schema.fields])


class _Conformer:
    def __init__(self, strict: bool, try_cast: bool):
        self.strict, self.try_cast = strict, try_cast

    def field(self, have: dict[str, tuple[Column, DataType]], want, path: str) -> Column:
        """The column for one declared field, from the fields there are by lower-case name."""
        found = have.get(want.name.lower())
        if found is None:
            if self.strict or not want.nullable:
                raise ValueError(f"column {path!r} is missing")
            return F.lit(None).cast(want.dataType)
        return self.value(*found, want.dataType, path)

    def value(self, c: Column, kind: DataType, want: DataType, path: str) -> Column:
        if isinstance(want, StructType) and isinstance(kind, StructType):
            have = {f.name.lower(): (c[f.name], f.dataType) for f in kind.fields}
            parts = []
            for f in want.fields:
                part = self.field(have, f, f"{path}.{f.name}")
                if not f.nullable:
                    part = F.when(c.isNotNull() & part.isNull(), F.raise_error(
                        F.lit(f"NULL in non-nullable field {path}.{f.name}")).cast(f.dataType)).otherwise(part)
                parts.append(part.alias(f.name))
            return F.when(c.isNotNull(), F.struct(*parts))
        if isinstance(want, ArrayType) and isinstance(kind, ArrayType) and isinstance(want.elementType, StructType):
            return F.transform(c, lambda x: self.value(x, kind.elementType, want.elementType, f"{path}[]"))
        return c.try_cast(want) if self.try_cast else c.cast(want)


_ZERO = {"string": "", "boolean": False, "date": "1970-01-01", "timestamp": "1970-01-01 00:00:00",
         "timestamp_ntz": "1970-01-01 00:00:00", "binary": ""}


def _flagged(c: Column, kind: DataType, nullable: bool) -> Column:
    """``c`` declared non-nullable: NULLs were rejected before, so the default is never seen."""
    name = kind.simpleString()
    if nullable or isinstance(kind, ArrayType) or name.startswith("map"):
        return c
    if isinstance(kind, StructType):
        return F.struct(*[_flagged(c[f.name], f.dataType, f.nullable).alias(f.name) for f in kind.fields])
    return F.coalesce(c, F.lit(_ZERO.get(name, 0)).cast(kind))
