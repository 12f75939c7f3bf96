"""Nullable keys made plain.

``eqNullSafe`` makes Spark partition a join on expressions of the key, which no
window or aggregate on the key itself matches, so every such join shuffles both
sides again. Here each nullable key becomes two columns that are never NULL - its
value (a fixed one for NULL) and whether it is NULL - and joins, windows and
aggregates all use those with plain equality: one partitioning serves them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

VALUE, NULL = "_key_", "_null_"


def _filler(dtype) -> Column:
    if isinstance(dtype, StringType):
        return F.lit("")
    if isinstance(dtype, NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, BooleanType):
        return F.lit(False)
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return F.lit("1970-01-01").cast(dtype)
    raise TypeError(f"no filler for a key of type {dtype}")


def plain_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with each key replaced by its plain columns, and their names."""
    value = [F.coalesce(k, _filler(df.schema[k].dataType)).alias(VALUE + k) for k in keys]
    null = [F.col(k).isNull().alias(NULL + k) for k in keys]
    rest = [c for c in df.columns if c not in keys]
    return df.select(*value, *null, *rest), [VALUE + k for k in keys] + [NULL + k for k in keys]


def restored(keys: list[str]) -> list[Column]:
    """The keys themselves, from their plain columns."""
    return [F.when(~F.col(NULL + k), F.col(VALUE + k)).alias(k) for k in keys]
