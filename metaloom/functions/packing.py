"""Rows with many lists, made small for the way from task to task.

A document has some sixty columns, and most of them are empty. As a row each list takes its own offsets and padding, whatever
is in it, and these do not compress. Packed, all text and all lists of text are one JSON text; it takes less than half.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: With fewer lists than this a row is small as it is.
LEAST_LISTS = 8
_TEXT, _LIST = T.StringType(), T.ArrayType(T.StringType())


def _parts(schema: T.StructType, keys: tuple[str, ...]) -> tuple[list[str], list[str]]:
    """Columns of text and of lists of text that are no keys; none if packing does not pay."""
    found = [f for f in schema if f.name not in keys]
    texts, lists = [f.name for f in found if f.dataType == _TEXT], [f.name for f in found if f.dataType == _LIST]
    return (texts, lists) if len(lists) >= LEAST_LISTS else ([], [])


def pack(df: DataFrame, *keys: str) -> DataFrame:
    """The rows with all text and lists of text in ``_packed``; ``keys`` and columns of other types stay as they are."""
    texts, lists = _parts(df.schema, keys)
    if not lists:
        return df
    none = F.array().cast(_LIST)
    whole = F.array(F.array(*[F.col(c) for c in texts]) if texts else none, *[F.col(c) for c in lists])
    others = [c for c in df.columns if c not in (*texts, *lists)]
    return df.select(*others, F.to_json(whole).alias("_packed"))


def unpack(df: DataFrame, schema: T.StructType, *keys: str) -> DataFrame:
    """The rows as they were before ``pack``; ``schema`` is that of the rows then. Columns that came later stay."""
    texts, lists = _parts(schema, keys)
    if not lists:
        return df
    read = df.withColumn("_packed", F.from_json("_packed", T.ArrayType(_LIST)))
    text = {c: F.get(F.get("_packed", F.lit(0)), F.lit(i)) for i, c in enumerate(texts)}
    found = text | {c: F.get("_packed", F.lit(i)) for i, c in enumerate(lists, 1)}
    more = [c for c in df.columns if c not in schema.fieldNames() and c != "_packed"]
    return read.select(*[found[f.name].alias(f.name) if f.name in found else F.col(f.name) for f in schema], *more)
