"""Redaction of sensitive fields in rows of any shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsledger.functions import values as V


def _redact(value: Column, kind: T.DataType, fields: Sequence[str], token: str) -> Column:
    if isinstance(kind, T.StructType):
        parts = [_field(value[f.name], f.name, f.dataType, fields, token).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _redact(item, kind.elementType, fields, token))
    if isinstance(kind, T.MapType):
        def entry(key: Column, item: Column) -> Column:
            inner = _redact(item, kind.valueType, fields, token)
            if isinstance(kind.valueType, T.StringType):
                return F.when(F.lower(key).isin(list(fields)), F.lit(token)).otherwise(inner)
            # a sensitive key over a nested value: the value goes, the shape stays
            return F.when(F.lower(key).isin(list(fields)), F.lit(None).cast(kind.valueType)).otherwise(inner)

        return F.transform_values(value, entry)
    return value


def _field(value: Column, name: str, kind: T.DataType, fields: Sequence[str], token: str) -> Column:
    if name.lower() in fields:
        return F.lit(token)
    return _redact(value, kind, fields, token)


def redact_fields(
    df: DataFrame, fields: Sequence[str] = tuple(V.SENSITIVE_FIELDS), token: str = V.REDACTED
) -> DataFrame:
    """Replace every field named in `fields`, case aside and at any depth, by `token`.

    The schema is walked once on the driver; the rows only see the expressions built from it.
    """
    return df.select(*[_field(F.col(f"`{f.name}`"), f.name, f.dataType, fields, token).alias(f.name) for f in df.schema.fields])
