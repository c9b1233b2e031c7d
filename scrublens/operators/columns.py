"""Choose, rename and clean columns in one projection."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

Cleaner = Callable[[Column], Column]

# The id column of tables without an "id".
FALLBACK_ID = "_idx"


@dataclass(frozen=True)
class ColumnSpec:
    """Output column ``name``, taken from input column ``origin``."""

    origin: str
    name: str


def keep_all(df: DataFrame) -> list[ColumnSpec]:
    """Specs that keep every column under its own name."""
    return [ColumnSpec(name, name) for name in df.columns]


def rename_columns(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Exactly the listed columns, renamed, in list order. Names may be swapped and
    one origin may feed several columns, since it all happens in one ``select``."""
    return clean_columns(df, columns, None)


def clean_columns(
    df: DataFrame,
    columns: Sequence[ColumnSpec],
    cleaner: Cleaner | None,
    only: Iterable[str] | None = None,
    skip: Iterable[str] = (),
) -> DataFrame:
    """Like :func:`rename_columns`, with ``cleaner`` applied to the string columns.

    ``only`` narrows the cleaning to these origins; ``skip`` exempts output names,
    such as the id column. Columns of other types, and strings inside arrays, structs
    or maps, pass through.
    """
    require_columns(df, [spec.origin for spec in columns])
    targets = None if only is None else set(only)
    exempt = set(skip)
    return df.select(
        *(
            cleaned(df, spec, None if spec.name in exempt else cleaner, targets).alias(spec.name)
            for spec in columns
        )
    )


def cleaned(
    df: DataFrame, spec: ColumnSpec, cleaner: Cleaner | None, only: Iterable[str] | None = None
) -> Column:
    """The value of one output column: cleaned if it is a string and, where ``only`` is
    given, its origin is one of these."""
    value = df[_quoted(spec.origin)]
    wanted = only is None or spec.origin in only
    is_text = isinstance(df.schema[spec.origin].dataType, StringType)
    return cleaner(value) if cleaner is not None and wanted and is_text else value


def target_mapping(columns: Sequence[ColumnSpec], targets: Iterable[str]) -> dict[str, str]:
    """Origin to output name, for the target columns that the output holds. The first
    spec wins where an origin is listed twice."""
    first: dict[str, str] = {}
    for spec in columns:
        first.setdefault(spec.origin, spec.name)
    return {origin: first[origin] for origin in targets if origin in first}


def resolve_id(before: DataFrame, after: DataFrame, id_col: str = "id") -> str:
    """``id_col`` if both tables have it, else ``_idx``. Ids are never generated: a
    table without one cannot be compared."""
    for candidate in (id_col, FALLBACK_ID):
        if candidate in before.columns and candidate in after.columns:
            return candidate
    raise ValueError(f"neither {id_col!r} nor {FALLBACK_ID!r} is a column of both tables")


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise if a name is not a column of ``df``."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}; the table has {df.columns}")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col(_quoted(name))
