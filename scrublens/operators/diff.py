"""Compare a table before and after cleaning, row by row on an id column.

The answer to "did this id's value change" is defined over the pairs an inner join on
the id would give: an id has changed if some before row and some after row of it
differ. The pairs themselves are never built. Both tables are stacked and grouped
instead, which needs one shuffle, combines repeated ids before it, and stays linear
when an id repeats, however often. Ids found on one side only, and NULL ids, do not
count, as in the join.

Values are compared by keys of bounded width (see :mod:`keys` and :func:`_keys`), so
long texts are not shuffled.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrublens.operators.columns import column, require_columns
from scrublens.operators.keys import as_text, digest_word, value_key
from scrublens.operators.tables import row_bytes


def changed_pairs(
    before: DataFrame,
    after: DataFrame,
    mapping: Mapping[str, str],
    id_col: str,
    null_safe: bool = True,
) -> DataFrame:
    """Joined rows in which some mapped column differs, with its values before and
    after. ``null_safe=False`` does not count a change from or to NULL.

    The rows are the result here, so this ends in a join, of the rows whose ids have
    changed. An id may repeat on one side. One that repeats on both does not say which
    rows belong together, and the query fails when it meets one.
    """
    pairs = compared_pairs(before, after, mapping, id_col)
    flags = change_flags(before, after, mapping, id_col, null_safe, paired=True)
    changed = reduce(operator.or_, map(column, flags.columns[1:]))
    ids = flags.filter(changed).select(column(id_col))
    before = before.join(ids, on=id_col, how="left_semi")
    after = after.join(ids, on=id_col, how="left_semi")
    differs = F.lit(False)
    for origin, target in pairs:
        b, a = column(f"{origin}_before"), column(f"{target}_after")
        differs = differs | (~b.eqNullSafe(a) if null_safe else F.coalesce(b != a, F.lit(False)))
    return join_sides(before, after, pairs, id_col).filter(differs)


def repeated_ids(before: DataFrame, after: DataFrame, id_col: str) -> DataFrame:
    """The ids that name several rows on both sides."""
    ids = column(id_col)
    old = before.select(ids, F.lit(1).alias("b"), F.lit(0).alias("a"))
    new = after.select(ids, F.lit(0).alias("b"), F.lit(1).alias("a"))
    stacked = old.unionByName(new).filter(ids.isNotNull())
    per_id = stacked.groupBy(ids).agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    return per_id.filter("b > 1 AND a > 1").select(ids)


def join_sides(
    before: DataFrame, after: DataFrame, pairs: Sequence[tuple[str, str]], id_col: str
) -> DataFrame:
    """The inner join on the id: ``id, a_before, a_after, b_before, b_after, ...``.
    A repeated id gives a row for each before and after row of it."""
    old = _suffixed(before, id_col, [origin for origin, _ in pairs], "before")
    new = _suffixed(after, id_col, [target for _, target in pairs], "after")
    interleaved = [n for o, t in pairs for n in (f"{o}_before", f"{t}_after")]
    return old.join(new, on=id_col, how="inner").select(*map(column, (id_col, *interleaved)))


def change_flags(
    before: DataFrame,
    after: DataFrame,
    mapping: Mapping[str, str],
    id_col: str,
    null_safe: bool = True,
    paired: bool = False,
) -> DataFrame:
    """One row per id found on both sides, with a boolean column for each mapped pair,
    named ``<origin>_changed``. With ``paired`` an id that repeats on both is an error."""
    pairs = compared_pairs(before, after, mapping, id_col)
    old = _keys(before.filter(column(id_col).isNotNull()), id_col, [o for o, _ in pairs], "before")
    new = _keys(after.filter(column(id_col).isNotNull()), id_col, [t for _, t in pairs], "after")
    is_before = F.col("side") == "before"
    rows = [F.count_if(is_before).alias("rows_before"), F.count_if(~is_before).alias("rows_after")]
    per_id = old.unionByName(new).groupBy(column(id_col)).agg(*_measures(pairs, null_safe), *rows)
    found = _flags(pairs, null_safe)
    if paired:
        refused = F.raise_error(F.lit(f"{id_col!r} does not identify rows: it repeats on both sides"))
        repeats = F.expr("rows_before > 1 AND rows_after > 1")
        found = [F.when(repeats, refused.cast("boolean")).otherwise(flag) for flag in found]
    flags = [flag.alias(f"{o}_changed") for flag, (o, _) in zip(found, pairs)]
    return per_id.filter("in_before AND in_after").select(column(id_col), *flags)


def count_and_compare(
    before: DataFrame, after: DataFrame, mapping: Mapping[str, str], id_col: str
) -> DataFrame:
    """One row with the row count and size of both tables and the number of changed
    ids, from one pass over each: ``source_count, source_size, result_count,
    result_size, matched_count``. Rows without an id are counted but not compared."""
    pairs = compared_pairs(before, after, mapping, id_col)
    old = _keys(before, id_col, [o for o, _ in pairs], "before", row_bytes(before))
    new = _keys(after, id_col, [t for _, t in pairs], "after", row_bytes(after))
    totals = []
    for side in ("before", "after"):
        ours = F.col("side") == side
        totals.append(F.count(F.when(ours, 1)).alias(f"rows_{side}"))
        totals.append(F.sum(F.when(ours, F.col("bytes")).otherwise(0)).alias(f"bytes_{side}"))
    measures = _measures(pairs, null_safe=True)
    per_id = old.unionByName(new).groupBy(column(id_col)).agg(*measures, *totals)
    changed = reduce(operator.or_, _flags(pairs, null_safe=True))
    matched = column(id_col).isNotNull() & F.col("in_before") & F.col("in_after") & changed
    sums = {
        "source_count": "rows_before",
        "source_size": "bytes_before",
        "result_count": "rows_after",
        "result_size": "bytes_after",
    }
    return per_id.agg(
        *(F.coalesce(F.sum(total), F.lit(0)).alias(name) for name, total in sums.items()),
        F.count_if(matched).alias("matched_count"),
    )


def changed_ids(
    before: DataFrame,
    after: DataFrame,
    mapping: Mapping[str, str],
    id_col: str,
    null_safe: bool = True,
) -> DataFrame:
    """The ids with a change in some mapped column, each once."""
    flags = change_flags(before, after, mapping, id_col, null_safe)
    changed = reduce(operator.or_, map(column, flags.columns[1:]))
    return flags.filter(changed).select(column(id_col))


def matched_count(
    before: DataFrame,
    after: DataFrame,
    mapping: Mapping[str, str],
    id_col: str,
    null_safe: bool = True,
) -> DataFrame:
    """The number of changed ids."""
    ids = changed_ids(before, after, mapping, id_col, null_safe)
    return ids.agg(F.count(F.lit(1)).alias("matched_count"))


def changed_rows_per_column(
    before: DataFrame,
    after: DataFrame,
    mapping: Mapping[str, str],
    id_col: str,
    null_safe: bool = True,
) -> DataFrame:
    """For each mapped column the number of joined rows whose value differs.

    An id with m rows before and n after joins to m*n rows; those that agree number,
    for each value, its rows before times its rows after. So counting values per id is
    enough. Counting by (id, column, value) first spreads a repeated id over tasks.
    """
    pairs = compared_pairs(before, after, mapping, id_col)
    stacked = _cells(before, [o for o, _ in pairs], "before", id_col).unionByName(
        _cells(after, [t for _, t in pairs], "after", id_col)
    )
    if not null_safe:
        stacked = stacked.filter(F.col("key").isNotNull())
    is_before = F.col("side") == "before"
    per_value = stacked.groupBy(column(id_col), "position", "key").agg(
        F.count(F.when(is_before, 1)).alias("b"), F.count(F.when(~is_before, 1)).alias("a")
    )
    per_id = per_value.groupBy(column(id_col), "position").agg(
        F.sum("b").alias("b"), F.sum("a").alias("a"), F.sum(_product("b", "a")).alias("agree")
    )
    differ = _product("b", "a") - F.col("agree")
    totals = per_id.agg(
        *(F.sum(F.when(F.col("position") == i, differ)).alias(f"n_{i}") for i in range(len(pairs)))
    )
    counts = [F.coalesce(F.col(f"n_{i}"), F.lit(0)).cast("long") for i in range(len(pairs))]
    return _per_pair(totals, pairs, counts, "changed_rows")


def changed_columns(
    before: DataFrame, after: DataFrame, mapping: Mapping[str, str], id_col: str
) -> DataFrame:
    """The mapped pairs whose sets of distinct values differ, NULL being a value.

    This is a weaker test than comparing rows: two rows that swap their values leave
    the sets alike. Every column is settled by the same shuffle, in which a value is
    sent once per column and input partition however often it occurs.
    """
    pairs = compared_pairs(before, after, mapping, id_col)
    stacked = _cells(before, [o for o, _ in pairs], "before").unionByName(
        _cells(after, [t for _, t in pairs], "after")
    )
    return _differing(stacked, pairs)


def changed_columns_of_pairs(paired: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """The same from rows that hold both values, ``<origin>_before`` and
    ``<target>_after``: one scan gives both sets."""
    cells = [
        F.struct(
            F.lit(side).alias("side"),
            F.lit(i).alias("position"),
            value_key(column(name), paired.schema[name].dataType).alias("key"),
        )
        for i, (o, t) in enumerate(pairs)
        for side, name in (("before", f"{o}_before"), ("after", f"{t}_after"))
    ]
    return _differing(paired.select(F.inline(F.array(*cells))), pairs)


def _differing(stacked: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    is_before = F.col("side") == "before"
    per_value = stacked.groupBy("position", "key").agg(
        F.max(is_before).alias("b"), F.max(~is_before).alias("a")
    )
    one_sided = ~(F.col("b") & F.col("a"))
    found = per_value.agg(
        *(F.max((F.col("position") == i) & one_sided).alias(f"f_{i}") for i in range(len(pairs)))
    )
    flags = [F.coalesce(F.col(f"f_{i}"), F.lit(False)) for i in range(len(pairs))]
    return _per_pair(found, pairs, flags, "differs").filter("differs").select("origin", "target")


def compared_pairs(
    before: DataFrame, after: DataFrame, mapping: Mapping[str, str], id_col: str
) -> list[tuple[str, str]]:
    """The mapped pairs without the id column, which identifies rows and is not diffed."""
    pairs = [(o, t) for o, t in mapping.items() if id_col not in (o, t)]
    if not pairs:
        raise ValueError("no column to compare")
    require_columns(before, [id_col, *(o for o, _ in pairs)])
    require_columns(after, [id_col, *(t for _, t in pairs)])
    return pairs


def _measures(pairs: Sequence[tuple[str, str]], null_safe: bool) -> list[Column]:
    """What has to be known of an id's rows to tell whether its values changed."""
    is_before = F.col("side") == "before"
    measures = [F.max(is_before).alias("in_before"), F.max(~is_before).alias("in_after")]
    for i in range(len(pairs)):
        key = F.col(f"high_{i}")
        for word in (f"high_{i}", f"low_{i}"):
            measures += [F.min(word).alias(f"min_{word}"), F.max(word).alias(f"max_{word}")]
        if null_safe:
            measures.append(F.max(key.isNull()).alias(f"null_{i}"))
        else:
            measures.append(F.max(key.isNotNull() & is_before).alias(f"before_{i}"))
            measures.append(F.max(key.isNotNull() & ~is_before).alias(f"after_{i}"))
    return measures


def _flags(pairs: Sequence[tuple[str, str]], null_safe: bool) -> list[Column]:
    """For each pair whether some before and some after value of the id differ. Given
    rows on both sides that is so if their values taken together are not all alike."""
    flags = []
    for i in range(len(pairs)):
        words = (f"high_{i}", f"low_{i}")
        differ = [F.col(f"min_{word}") != F.col(f"max_{word}") for word in words]
        several = F.coalesce(reduce(operator.or_, differ), F.lit(False))
        if null_safe:
            flags.append(several | (F.col(f"null_{i}") & F.col(f"min_high_{i}").isNotNull()))
        else:
            flags.append(several & F.col(f"before_{i}") & F.col(f"after_{i}"))
    return flags


def _suffixed(df: DataFrame, id_col: str, names: list[str], suffix: str) -> DataFrame:
    # An origin may be mapped to one target only, but targets may coincide.
    return df.select(
        column(id_col), *(column(n).alias(f"{n}_{suffix}") for n in dict.fromkeys(names))
    )


def _keys(
    df: DataFrame, id_col: str, names: list[str], side: str, size: Column | None = None
) -> DataFrame:
    """Id, side and compared keys of each row, and its size if asked for.

    A key is two numbers, 120 bits of the value's SHA-256: unlike binary keys, a hash
    aggregation can keep their extremes without sorting.
    """
    digests = [
        F.sha2(as_text(column(n), df.schema[n].dataType), 256).alias(f"digest_{i}")
        for i, n in enumerate(names)
    ]
    words = [
        digest_word(F.col(f"digest_{i}"), at).alias(f"{word}_{i}")
        for i in range(len(names))
        for word, at in (("high", 1), ("low", 16))
    ]
    sizes = [] if size is None else [size.alias("bytes")]
    hashed = df.select(column(id_col), F.lit(side).alias("side"), *digests, *sizes)
    return hashed.select(column(id_col), "side", *words, *(["bytes"] if sizes else []))


def _cells(df: DataFrame, names: list[str], side: str, id_col: str | None = None) -> DataFrame:
    """One row per compared cell; with ``id_col`` only those of rows that have an id."""
    keys = F.array(*(value_key(column(n), df.schema[n].dataType) for n in names))
    cells = F.posexplode(keys).alias("position", "key")
    if id_col is None:
        return df.select(F.lit(side).alias("side"), cells)
    kept = df.filter(column(id_col).isNotNull())
    return kept.select(column(id_col), F.lit(side).alias("side"), cells)


def _product(left: str, right: str) -> Column:
    """Of two counts, exact beyond 64 bits."""
    return F.col(left).cast("decimal(19,0)") * F.col(right).cast("decimal(19,0)")


def _per_pair(
    one_row: DataFrame, pairs: Sequence[tuple[str, str]], values: Sequence[Column], name: str
) -> DataFrame:
    """Turn a row with a value for each pair into a row for each pair."""
    rows = [
        F.struct(F.lit(o).alias("origin"), F.lit(t).alias("target"), value.alias(name))
        for (o, t), value in zip(pairs, values, strict=True)
    ]
    return one_row.select(F.inline(F.array(*rows)))
