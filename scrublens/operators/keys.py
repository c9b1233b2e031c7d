"""Keys of bounded width that stand for values in comparisons and shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrublens.operators.columns import column

_SHORT = 31  # bytes; below the 32 of a digest, so the two kinds of key never meet


def as_text(value: Column, data_type: T.DataType) -> Column:
    """A text that is equal for equal values."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        value = value + F.lit(0.0).cast(data_type)  # -0.0 equals 0.0
    elif isinstance(data_type, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(data_type, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        value = F.to_json(F.struct(value), {"ignoreNullFields": "false"})
    elif isinstance(data_type, T.BinaryType):
        value = F.hex(value)
    return value.cast("string")


def value_key(value: Column, data_type: T.DataType) -> Column:
    """At most 32 bytes that are equal for equal values: short texts stand for
    themselves, long ones are replaced by their SHA-256."""
    text = as_text(value, data_type)
    is_short = F.octet_length(text) <= _SHORT
    return F.when(is_short, text.cast("binary")).otherwise(F.unhex(F.sha2(text, 256)))


def digest_word(digest: Column, at: int) -> Column:
    """60 bits of a hexadecimal digest from its character ``at`` (from 1) as a number. NULL
    gives NULL."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")


def row_digest(df: DataFrame, names: Sequence[str]) -> Column:
    """SHA-256 of the values of some columns, in hexadecimal. NULL is a value of its own."""
    keys = [F.hex(value_key(column(name), df.schema[name].dataType)) for name in names]
    return F.sha2(F.concat_ws("|", *(F.coalesce(key, F.lit("-")) for key in keys)), 256)


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has."""
    taken = {name.lower() for name in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
