"""A cleaning job that takes only what is new since its last run.

The input's files are read as a stream that ends when all files present have been cleaned. A
checkpoint remembers which these were, and the output remembers which batches it has, so a run
that was cut off goes on where it stopped and no file is cleaned twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from scrublens.plans.job import REMOVE_DUPLICATE_ROW, JobSpec, clean
from scrublens.sources.tables import read_table, same_columns


@dataclass(frozen=True)
class Increment:
    """What one run did, and the whole output so far."""

    rows: int
    batches: int
    output: DataFrame


def run_increment(
    spark: SparkSession,
    spec: JobSpec,
    checkpoint: str,
    schema: StructType | None = None,
    files_per_batch: int | None = None,
) -> Increment:
    """Clean the files that ``spec.input_path``, a folder or a pattern of files, has and did
    not have at the last run with the same ``checkpoint``, and add them to the table at
    ``spec.output_path``.

    Cleaning looks at one row at a time, so late files need no watermark and no state; the
    removal of duplicates would have to remember every row and is refused. ``schema`` is that
    of the input, read from its files if not given. ``files_per_batch`` bounds a batch, and
    so what is done again after a failure. Without new files nothing is written; a folder
    that has had no files at all gives an empty table.
    """
    if spec.job_type == REMOVE_DUPLICATE_ROW:
        raise ValueError("duplicates are removed from whole tables only")
    if spec.mode not in ("errorifexists", "append") or spec.partitions is not None:
        raise ValueError("an incremental job appends, and its files set its tasks")
    if schema is None:
        schema = read_table(spark, spec.input_path, spec.fmt).schema
    reader = spark.readStream.format(spec.fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(spec.input_path)
    cleaned = clean(stream if spec.where is None else stream.filter(spec.where), spec)
    writer = cleaned.writeStream.format(spec.fmt).outputMode("append")
    if spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    query = (
        writer.option("checkpointLocation", checkpoint)
        .option("path", spec.output_path)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()
    done = [step for step in query.recentProgress if step.numInputRows]
    output = read_table(spark, spec.output_path, spec.fmt, cleaned.schema)
    return Increment(
        rows=sum(step.numInputRows for step in done),
        batches=len(done),
        output=same_columns(output, cleaned.columns),
    )
