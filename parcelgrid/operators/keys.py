"""Keys for rows that hold shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_1, KEY_2 = "__k1", "__k2"
ROW_KEY = [KEY_1, KEY_2]


def _sorted_entries(value: Column) -> Column:
    return F.array_sort(F.map_entries(value))


def _entries(kind: T.MapType) -> T.ArrayType:
    return T.ArrayType(T.StructType().add("key", kind.keyType).add("value", kind.valueType))


def _elements(items: Column, kind: T.DataType) -> list[Column]:
    """What tells two arrays of one known size apart, as columns without nested arrays."""
    if isinstance(kind, T.MapType):
        return _elements(F.transform(items, _sorted_entries), _entries(kind))
    if isinstance(kind, T.ArrayType):
        nothing = F.array().cast(kind)
        sizes = F.transform(items, lambda v: F.coalesce(F.size(v), F.lit(-1)))
        inner = F.flatten(F.transform(items, lambda v: F.coalesce(v, nothing)))
        return [sizes, *_elements(inner, kind.elementType)]
    missing = F.transform(items, F.isnull)
    if isinstance(kind, T.StructType):
        return [missing, *(c for f in kind.fields for c in _elements(items[f.name], f.dataType))]
    return [missing, items]


def _encoded(value: Column, kind: T.DataType) -> list[Column]:
    """Columns whose hashes, in this order, say what ``value`` is.

    A NULL mark or a size comes before every value, so values of one type never read alike
    unless they are equal. Times are hashed as instants; both zeros are one, as in grouping.
    """
    if isinstance(kind, T.MapType):
        return _encoded(_sorted_entries(value), _entries(kind))
    if isinstance(kind, T.ArrayType):
        items = F.coalesce(value, F.array().cast(kind))
        return [F.coalesce(F.size(value), F.lit(-1)), *_elements(items, kind.elementType)]
    if isinstance(kind, T.StructType):
        return [value.isNull(), *(c for f in kind.fields for c in _encoded(value[f.name], f.dataType))]
    return [value.isNull(), value]


def with_row_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add a 128-bit hash of ``columns``, equal where all of them are equal.

    Plain hashing skips NULLs and does not see where a nested array ends, so the marks and
    sizes are hashed with the values.
    """
    parts = [c for name in columns for c in _encoded(F.col(f"`{name}`"), df.schema[name].dataType)]
    keys = (F.xxhash64(F.lit(seed), *parts).alias(key) for seed, key in enumerate(ROW_KEY, 1))
    return df.select("*", *keys)
