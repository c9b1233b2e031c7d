"""The side-by-side report of what cleaning changed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from scrublens.operators.columns import column
from scrublens.operators.diff import (
    changed_columns,
    changed_pairs,
    join_sides,
    repeated_ids,
)


def change_report(
    before: DataFrame,
    after: DataFrame,
    mapping: Mapping[str, str],
    id_col: str,
    only_changed: bool = False,
) -> DataFrame | None:
    """``id, a_before, a_after, ...`` for the changed columns, ordered by id; None if no
    column changed.

    Every matched id is listed, changed or not, unless ``only_changed``. Which columns
    changed is settled first, by their value sets, since it decides the layout.

    An id that repeats on one side has a line for each of its rows. One that repeats on
    both does not say which rows belong together: no report is begun but a
    ``ValueError`` raised, however few there are.
    """
    changed = _collect_changed(before, after, mapping, id_col)
    if not changed:
        return None
    if not repeated_ids(before, after, id_col).isEmpty():
        raise ValueError(
            f"{id_col!r} does not identify rows: it repeats on both sides; "
            "changed_ids and matched_count do not pair rows"
        )
    if only_changed:
        rows = changed_pairs(before, after, dict(changed), id_col)
    else:
        rows = join_sides(before, after, changed, id_col)
    return rows.orderBy(column(id_col))


def preview(
    before: DataFrame,
    after: DataFrame,
    mapping: Mapping[str, str],
    id_col: str,
    rows: int = 20,
    width: int = 20,
) -> DataFrame | None:
    """The first ``rows`` lines of the report, text cells cut to ``width`` characters.

    The lines are found from the ids alone; then only the rows of these, ``rows`` at
    most, are looked up in the two tables.
    """
    changed = _collect_changed(before, after, mapping, id_col)
    if not changed:
        return None
    ids = before.select(column(id_col)).join(
        after.select(column(id_col)), on=id_col, how="left_semi"
    )
    first = ids.distinct().orderBy(column(id_col)).limit(rows)  # so it may be broadcast
    old, new = (
        df.join(F.broadcast(first), on=id_col, how="left_semi") for df in (before, after)
    )
    old = _at_most(rows, old, id_col, [origin for origin, _ in changed])
    new = _at_most(rows, new, id_col, [target for _, target in changed])
    lines = join_sides(old, new, changed, id_col)
    top = lines.orderBy(column(id_col)).limit(rows)
    return top.select(*(cut(top, name, width) for name in top.columns))


def _at_most(rows: int, df: DataFrame, id_col: str, names: Sequence[str]) -> DataFrame:
    """No more rows of an id than a preview has lines; more could not show in it."""
    same_id = Window.partitionBy(column(id_col)).orderBy(*map(column, names))
    ranked = df.select(column(id_col), *map(column, dict.fromkeys(names)))
    numbered = ranked.withColumn("_row", F.row_number().over(same_id))
    return numbered.filter(F.col("_row") <= rows).drop("_row")


def _collect_changed(
    before: DataFrame, after: DataFrame, mapping: Mapping[str, str], id_col: str
) -> Sequence[tuple[str, str]]:
    """The changed pairs in mapping order; at most one row for each mapped column."""
    if all(id_col in pair for pair in mapping.items()):
        return []
    found = {tuple(row) for row in changed_columns(before, after, mapping, id_col).collect()}
    return [pair for pair in mapping.items() if pair in found]


def cut(df: DataFrame, name: str, width: int) -> Column:
    """A text column cut to ``width`` characters, the last three of them dots."""
    value = column(name)
    if not isinstance(df.schema[name].dataType, StringType):
        return value
    # Below four characters there is no room for the dots.
    short = (
        F.concat(F.substring(value, 1, width - 3), F.lit("..."))
        if width >= 4
        else F.substring(value, 1, width)
    )
    return F.when(F.length(value) > width, short).otherwise(value).alias(name)
