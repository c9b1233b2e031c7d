"""Before and after of a job that cleans row by row.

Its output is a projection of its source, so both values of a cell are two columns of one
projection. Reports of such a job need no join, read the source once, and show a line for each
row, whether or not its id repeats.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrublens.operators.columns import Cleaner, ColumnSpec, cleaned, column, require_columns
from scrublens.operators.diff import changed_columns_of_pairs
from scrublens.operators.keys import fresh_names
from scrublens.operators.report import cut


def keeps_rows(columns: Sequence[ColumnSpec], id_col: str) -> bool:
    """Whether the output's id is the source's, as it must be for rows to be told by it."""
    return any(spec.name == id_col and spec.origin == id_col for spec in columns)


def pair_rows(
    df: DataFrame,
    mapping: Mapping[str, str],
    cleaner: Cleaner | None,
    id_col: str,
    only: Iterable[str] | None = None,
) -> DataFrame:
    """``id, a_before, b_after, ...`` for each row that has an id and each mapped pair but
    that of the id."""
    pairs = value_pairs(mapping, id_col)
    require_columns(df, [id_col, *(origin for origin, _ in pairs)])
    values = [column(id_col)]
    for origin, target in pairs:
        values.append(column(origin).alias(f"{origin}_before"))
        after = cleaned(df, ColumnSpec(origin, target), cleaner, None if only is None else set(only))
        values.append(after.alias(f"{target}_after"))
    return df.filter(column(id_col).isNotNull()).select(*values)


def value_pairs(mapping: Mapping[str, str], id_col: str) -> list[tuple[str, str]]:
    return [pair for pair in mapping.items() if id_col not in pair]


def changed_columns(paired: DataFrame, mapping: Mapping[str, str], id_col: str) -> DataFrame:
    """The mapped pairs whose sets of distinct values differ, NULL being a value."""
    return changed_columns_of_pairs(paired, value_pairs(mapping, id_col))


def report(
    paired: DataFrame, mapping: Mapping[str, str], id_col: str, only_changed: bool = False
) -> DataFrame | None:
    """``id, a_before, a_after, ...`` for the changed columns, ordered by id; None if no
    column changed. Lists every row, or those in which one of these columns changed."""
    lines = _lines(paired, mapping, id_col, only_changed)
    return None if lines is None else lines.orderBy(column(id_col))


def preview(
    paired: DataFrame, mapping: Mapping[str, str], id_col: str, rows: int = 20, width: int = 20
) -> DataFrame | None:
    """The first ``rows`` lines of the report, text cells cut to ``width`` characters. Each task
    keeps that many lines; they are cut before they meet."""
    lines = _lines(paired, mapping, id_col, False)
    if lines is None:
        return None
    (order,) = fresh_names(lines, "_order")
    short = lines.select(
        column(id_col).alias(order), *(cut(lines, name, width) for name in lines.columns)
    )
    return short.orderBy(F.col(order)).limit(rows).drop(order)


def _lines(
    paired: DataFrame, mapping: Mapping[str, str], id_col: str, only_changed: bool
) -> DataFrame | None:
    pairs = value_pairs(mapping, id_col)
    if not pairs:
        return None
    # At most one row for each mapped column.
    found = {tuple(row) for row in changed_columns(paired, mapping, id_col).collect()}
    changed = [pair for pair in pairs if pair in found]
    if not changed:
        return None
    names = [name for o, t in changed for name in (f"{o}_before", f"{t}_after")]
    if not only_changed:
        return paired.select(*map(column, (id_col, *names)))

    def differs(row: Column) -> Column:
        flags = (~row[f"{o}_before"].eqNullSafe(row[f"{t}_after"]) for o, t in changed)
        return reduce(operator.or_, flags)

    # A filter would be pushed below the cleaning, which would then be done twice.
    row = F.struct(*map(column, names))
    return paired.select(column(id_col), F.inline(F.filter(F.array(row), differs)))
