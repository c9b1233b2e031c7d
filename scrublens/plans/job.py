"""A cleaning job: read, rename, clean, write, compare, report."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scrublens.functions import html, personal_info, text
from scrublens.operators import diff, report, tables
from scrublens.operators import rows as row_pairs
from scrublens.operators.columns import (
    FALLBACK_ID,
    Cleaner,
    ColumnSpec,
    clean_columns,
    rename_columns,
    resolve_id,
    target_mapping,
)
from scrublens.sources.tables import DEFAULT_FORMAT, read_table, same_columns, write_table

REMOVE_SPECIAL_CHAR = "REMOVE_SPECIAL_CHAR"
REMOVE_HTML_TAG = "REMOVE_HTML_TAG"
REMOVE_OUTLIER = "REMOVE_OUTLIER"
FILTERING_PERSONAL_INFO = "FILTERING_PERSONAL_INFO"
REMOVE_SPACE_TAB_NEWLINE = "REMOVE_SPACE_TAB_NEWLINE"
REMOVE_DUPLICATE_ROW = "REMOVE_DUPLICATE_ROW"


@dataclass(frozen=True)
class Options:
    """What a job type may need besides its columns."""

    kind: str | None = None
    content: str | None = None
    shortest: int | None = None
    longest: int | None = None


@dataclass(frozen=True)
class JobSpec:
    job_type: str
    input_path: str
    output_path: str
    columns: tuple[ColumnSpec, ...]
    targets: tuple[str, ...] = ()
    options: Options = field(default_factory=Options)
    id_col: str = "id"
    fmt: str = DEFAULT_FORMAT
    dedup_keys: tuple[str, ...] = ()
    job_id: str | None = None
    mode: str = "errorifexists"  # of the output; see sources.tables.write_table
    partition_by: tuple[str, ...] = ()  # output columns
    metrics_path: str | None = None  # a table the metrics row is added to
    where: str | None = None  # a condition on input columns, such as its partitions
    partitions: int | None = None  # spread the input over so many tasks

    def __post_init__(self) -> None:
        if self.job_type not in _CLEANERS and self.job_type != REMOVE_DUPLICATE_ROW:
            known = sorted({*_CLEANERS, REMOVE_DUPLICATE_ROW})
            raise ValueError(f"unknown job type {self.job_type!r}; known are {known}")
        if not self.columns:
            raise ValueError("the job names no output columns")
        if not self.input_path or not self.output_path:
            raise ValueError("the job needs an input and an output path")
        missing = set(self.partition_by) - {c.name for c in self.columns}
        if missing:
            raise ValueError(f"cannot partition by {sorted(missing)}: no output columns")
        if self.partitions is not None and self.partitions < 1:
            raise ValueError("the input is spread over one task at least")
        cleaner_for(self)

    @classmethod
    def from_params(cls, params: Mapping[str, Any] | object, **overrides: Any) -> JobSpec:
        """From a parameter record as callers send it, a dict or an object:
        ``preprocessType``, ``inputDataPath``, ``outputDataPath``, ``newTableColumns``,
        ``targetTableColumns``, ``optionType``, ``optionContent``, ``optionMin`` and
        ``optionMax``, the last two as text, and ``preprocessIdx``, the job's id."""
        if not isinstance(params, Mapping):
            params = vars(params)
        bounds = (params.get("optionMin"), params.get("optionMax"))
        shortest, longest = (None if bound is None else int(bound) for bound in bounds)
        job_id = params.get("preprocessIdx")
        fields = {
            "job_id": None if job_id is None else str(job_id),
            "job_type": params["preprocessType"],
            "input_path": params["inputDataPath"],
            "output_path": params["outputDataPath"],
            "columns": tuple(
                ColumnSpec(c["originColumnName"], c["columnName"])
                for c in params["newTableColumns"]
            ),
            "targets": tuple(c["columnName"] for c in params.get("targetTableColumns") or ()),
            "options": Options(
                params.get("optionType"), params.get("optionContent"), shortest, longest
            ),
        }
        return cls(**{**fields, **overrides})

    @property
    def mapping(self) -> dict[str, str]:
        return target_mapping(self.columns, self.targets)


@dataclass(frozen=True)
class JobResult:
    """The tables of a finished job. Comparisons are computed when asked for.

    The output of a job that cleans row by row is a projection of its source, so reports and
    changed columns take both values of a cell from the source's row and join nothing. Where
    the output's id is not the source's, and after duplicates were removed, the tables are
    compared by id.
    """

    spec: JobSpec
    source: DataFrame
    output: DataFrame
    metrics: DataFrame

    @property
    def id_col(self) -> str:
        return resolve_id(self.source, self.output, self.spec.id_col)

    @property
    def by_row(self) -> bool:
        """Whether before and after are known row by row."""
        cleans = self.spec.job_type != REMOVE_DUPLICATE_ROW
        return cleans and row_pairs.keeps_rows(self.spec.columns, self.id_col)

    def pairs(self) -> DataFrame:
        """Both values of each mapped cell, for jobs that clean row by row."""
        cleaner = cleaner_for(self.spec)
        return row_pairs.pair_rows(self.source, self.spec.mapping, cleaner, self.id_col)

    def changed_ids(self) -> DataFrame:
        return diff.changed_ids(self.source, self.output, self.spec.mapping, self.id_col)

    def changed_columns(self) -> DataFrame:
        if self.by_row:
            return row_pairs.changed_columns(self.pairs(), self.spec.mapping, self.id_col)
        return diff.changed_columns(self.source, self.output, self.spec.mapping, self.id_col)

    def report(self, only_changed: bool = False) -> DataFrame | None:
        if self.by_row:
            return row_pairs.report(self.pairs(), self.spec.mapping, self.id_col, only_changed)
        return report.change_report(
            self.source, self.output, self.spec.mapping, self.id_col, only_changed
        )

    def preview(self, rows: int = 20, width: int = 20) -> DataFrame | None:
        if self.by_row:
            return row_pairs.preview(self.pairs(), self.spec.mapping, self.id_col, rows, width)
        return report.preview(
            self.source, self.output, self.spec.mapping, self.id_col, rows, width
        )

    def save_report(self, only_changed: bool = False) -> str | None:
        """Write the report to ``<output>_report`` and return that path."""
        found = self.report(only_changed)
        if found is None:
            return None
        path = f"{self.spec.output_path}_report"
        write_table(found, path, self.spec.fmt)
        return path


def cleaner_for(spec: JobSpec) -> Cleaner | None:
    """The column function of the job, or None for a job on whole rows."""
    if spec.job_type == REMOVE_DUPLICATE_ROW:
        return None
    return _CLEANERS[spec.job_type](spec.options)


def clean(df: DataFrame, spec: JobSpec) -> DataFrame:
    """The job's output for ``df``. Nothing is run.

    Cleaning is one projection. Duplicate removal looks at ``dedup_keys``, or without
    them at all output columns but the id; of rows that agree the one with the smallest
    id stays. Without an id among the output columns, whole rows are compared.
    """
    if spec.job_type != REMOVE_DUPLICATE_ROW:
        has_id = any(c.name == spec.id_col for c in spec.columns)
        id_col = spec.id_col if has_id else FALLBACK_ID
        return clean_columns(df, spec.columns, cleaner_for(spec), skip=(id_col,))
    renamed = rename_columns(df, spec.columns)
    others = [name for name in renamed.columns if name != spec.id_col]
    keys = spec.dedup_keys or (others if len(others) < len(renamed.columns) else ())
    if keys:
        return tables.keep_first_by_key(renamed, keys, spec.id_col)
    return tables.drop_duplicate_rows(renamed)


def run_job(spark: SparkSession, spec: JobSpec, on_error: str = "raise") -> JobResult:
    """Clean the input table, write the output, and set up the comparison.

    With ``on_error="record"`` a failure yields a result whose metrics row has status
    ``error`` and the message, instead of an exception.

    With a ``metrics_path`` the metrics row is added to that table, and the result has the
    row as written; else it is computed whenever it is looked at.
    """
    if on_error not in ("raise", "record"):
        raise ValueError("on_error is 'raise' or 'record'")
    try:
        source = read_table(spark, spec.input_path, spec.fmt, where=spec.where)
        if spec.partitions is not None:
            source = source.repartition(spec.partitions)
        if spec.mapping:
            resolve_id(source, clean(source, spec), spec.id_col)  # before anything is written
        output, measured = _write(source, spec)
        metrics = _kept(job_metrics(source, output, spec, measured), spec)
    except Exception as error:
        if on_error == "raise":
            raise
        nothing = spark.createDataFrame([], "id long")
        return JobResult(spec, nothing, nothing, _kept(_failed(spark, spec, error), spec))
    return JobResult(spec, source, output, metrics)


def _write(source: DataFrame, spec: JobSpec) -> tuple[DataFrame, dict[str, int]]:
    """Write the output, counting and measuring the rows as they pass. The source of a job
    on whole rows may be read in several ways, so it is not measured here."""
    before, after = Observation(), Observation()
    by_row = spec.job_type != REMOVE_DUPLICATE_ROW
    seen = tables.observed(source, before) if by_row else source
    cleaned = clean(seen, spec)
    wrote = write_table(
        tables.observed(cleaned, after), spec.output_path, spec.fmt, spec.mode, spec.partition_by
    )
    measured = {}
    if wrote:
        for kind, observation in (("source", before), ("result", after)):
            if kind == "result" or by_row:
                found = observation.get
                measured[f"{kind}_count"] = found["row_count"]
                measured[f"{kind}_size"] = found["size_bytes"]
    # A reader puts the columns of partitions last and takes their types from the paths.
    schema = cleaned.schema if spec.partition_by else None
    output = read_table(source.sparkSession, spec.output_path, spec.fmt, schema)
    return same_columns(output, cleaned.columns), measured


def _kept(metrics: DataFrame, spec: JobSpec) -> DataFrame:
    """The metrics row, added to the table of metrics if the job names one."""
    if spec.metrics_path is None:
        return metrics
    row = metrics.sparkSession.createDataFrame(metrics.collect(), metrics.schema)  # one row
    write_table(row, spec.metrics_path, spec.fmt, "append")
    return row


def job_metrics(
    source: DataFrame, output: DataFrame, spec: JobSpec, measured: Mapping[str, int] | None = None
) -> DataFrame:
    """One row: the job's id, output columns, row counts and sizes of both tables, the number of
    changed ids, and the status. Counts and sizes that were ``measured`` while the output was
    written are taken from there; only the others are read again."""
    measured = dict(measured or {})
    id_col = resolve_id(source, output, spec.id_col) if spec.mapping else None
    mapping = {o: t for o, t in spec.mapping.items() if id_col not in (o, t)}
    if len(measured) == 4:
        row = source.sparkSession.range(1)
        row = diff.matched_count(source, output, mapping, id_col) if mapping else row
    elif mapping:
        row = diff.count_and_compare(source, output, mapping, id_col)
    else:
        before = tables.count_and_size(source).toDF("source_count", "source_size")
        after = tables.count_and_size(output).toDF("result_count", "result_size")
        both = before.unionByName(after, allowMissingColumns=True)
        row = both.agg(*(F.max(name).alias(name) for name in both.columns))
    if not mapping:
        row = row.withColumn("matched_count", F.lit(0).cast("long"))
    row = row.withColumns({name: F.lit(value).cast("long") for name, value in measured.items()})
    return row.select(
        F.lit(spec.job_id).cast("string").alias("job_id"),
        F.array(*(F.lit(c.name) for c in spec.columns)).alias("columns"),
        *_MEASURES,
        F.lit("ok").alias("status"),
        F.lit(None).cast("string").alias("message"),
    )


_MEASURES = ("source_count", "source_size", "result_count", "result_size", "matched_count")


def _failed(spark: SparkSession, spec: JobSpec, error: Exception) -> DataFrame:
    names = [c.name for c in spec.columns]
    measures = ", ".join(f"{name} long" for name in _MEASURES)
    return spark.createDataFrame(
        [(spec.job_id, names, 0, 0, 0, 0, 0, "error", str(error))],
        f"job_id string, columns array<string>, {measures}, status string, message string",
    )


def _special_char(options: Options) -> Cleaner:
    if options.kind == "all":
        return text.remove_all_special
    if options.content is None:
        raise ValueError("removing selected special characters needs their list (content)")
    return lambda cell: text.remove_selected_special(cell, options.content)


def _outlier(options: Options) -> Cleaner:
    if options.shortest is None or options.longest is None:
        raise ValueError("blanking outliers needs a shortest and a longest length")
    return lambda cell: text.blank_outlier(cell, options.shortest, options.longest)


def _personal_info(options: Options) -> Cleaner:
    modes: dict[str | None, Cleaner] = {
        "delete": personal_info.delete_matches,
        "masking": personal_info.mask_matches,
        "row_delete": personal_info.delete_lines,
    }
    return modes.get(options.kind, lambda cell: cell)


_CLEANERS: dict[str, Callable[[Options], Cleaner]] = {
    REMOVE_SPECIAL_CHAR: _special_char,
    REMOVE_HTML_TAG: lambda options: html.html_to_text,
    REMOVE_OUTLIER: _outlier,
    FILTERING_PERSONAL_INFO: _personal_info,
    REMOVE_SPACE_TAB_NEWLINE: lambda options: text.clean_space,
}
