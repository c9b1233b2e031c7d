"""Counts, sizes, distinct values and duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrublens.operators.columns import column
from scrublens.operators.keys import digest_word, fresh_names, row_digest


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def size_bytes(df: DataFrame) -> DataFrame:
    """UTF-8 bytes of all values written as text; NULLs and empty tables count 0."""
    return df.agg(_total_bytes(df).alias("size_bytes"))


def count_and_size(df: DataFrame) -> DataFrame:
    """Both measures from one scan."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), _total_bytes(df).alias("size_bytes"))


def observed(df: DataFrame, observation: Observation) -> DataFrame:
    """``df``; whoever runs it gets both measures from its ``observation`` besides."""
    return df.observe(
        observation, F.count(F.lit(1)).alias("row_count"), _total_bytes(df).alias("size_bytes")
    )


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(column(name)).distinct()


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that differ in some column. The aggregate combines copies before the
    shuffle, so a row repeated any number of times is sent once per input partition."""
    return df.distinct()


def keep_first_by_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """For each key the row with the smallest ``order_by`` (NULL first). Of rows that agree
    in that too, the one whose other columns have the least digest; of rows that agree
    in everything, one. NULL is a key like any other.

    Which rows stay is settled without their texts: the key is two numbers, 120 bits of a
    digest, and each row one more that orders it, so a hash aggregate finds the least per
    key, combining before its shuffle. Then a semi join fetches the rows.
    """
    if order_by in keys:
        raise ValueError(f"{order_by!r} cannot be both key and order")
    rest = [name for name in df.columns if name not in keys and name != order_by]
    high, low, first, tie = fresh_names(df, "_high", "_low", "_first", "_tie")

    def word(names: Sequence[str], at: int) -> Column:
        # Never NULL, and said so: else the join would test for it and hash the texts again.
        return F.coalesce(digest_word(row_digest(df, names), at), F.lit(0).cast("long"))

    keyed = df.withColumns({high: word(keys, 1), low: word(keys, 16)})
    tied = word(rest, 1) if rest else F.lit(0).cast("long")
    whole = isinstance(df.schema[order_by].dataType, T.IntegralType)
    value = column(order_by)
    if whole:
        # Order and tie in one number of 126 bits, whose minimum a hash aggregate can keep.
        number = F.coalesce(value.cast("decimal(20,0)"), F.lit(str(-(2**63) - 1)).cast("decimal(20,0)"))
        ranked = (number * F.lit(2**60).cast("decimal(19,0)") + tied).cast("decimal(38,0)")
        keyed = keyed.withColumn(first, F.coalesce(ranked, F.lit(0).cast("decimal(38,0)")))
        firsts = keyed.groupBy(high, low).agg(F.min(first).alias(first))
        kept = keyed.join(firsts, [high, low, first], "left_semi")
    else:
        keyed = keyed.withColumn(tie, tied)
        least = F.min(F.struct(value.alias(first), F.col(tie).alias(tie))).alias("least")
        firsts = keyed.groupBy(F.col(high).alias("h"), F.col(low).alias("l")).agg(least)
        same = (F.col(high) == F.col("h")) & (F.col(low) == F.col("l"))
        same &= (F.col(tie) == F.col("least")[tie]) & value.eqNullSafe(F.col("least")[first])
        kept = keyed.join(firsts, same, "left_semi")
    # Rows that agree in everything are still there, next to each other.
    return kept.distinct().select(*(column(name) for name in df.columns))


def row_bytes(df: DataFrame) -> Column:
    """UTF-8 bytes of the row's values written as text."""
    total = F.lit(0).cast("long")
    for name in df.columns:
        text = column(name).cast("string")
        total = total + F.coalesce(F.octet_length(text).cast("long"), F.lit(0))
    return total


def _total_bytes(df: DataFrame) -> Column:
    return F.coalesce(F.sum(row_bytes(df)), F.lit(0))
