"""Jobs over what is new, writes that appear whole, and partitions."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from scrublens import ColumnSpec, JobSpec, Options, run_job
from scrublens.plans import job
from scrublens.sources.tables import clear_staging, drop_table, read_table, scratch_path, write_table
from scrublens.streaming.incremental import run_increment

SCHEMA = "id int, t string"


@pytest.fixture
def folder(spark):
    path = scratch_path(spark)
    write_table(spark.createDataFrame([(1, "a  b"), (2, "c!")], SCHEMA), path)
    return path


def spec(spark, path, **more):
    columns = (ColumnSpec("id", "id"), ColumnSpec("t", "body"))
    return JobSpec(job.REMOVE_SPACE_TAB_NEWLINE, path, scratch_path(spark), columns, **more)


def broken(df):
    """``df`` whose last rows cannot be computed, after others have been."""
    refused = F.raise_error(F.lit("broken row")).cast("string")
    return df.select("id", F.when(F.col("id") < 900, F.col("t")).otherwise(refused).alias("t"))


def many(spark):
    return spark.range(1000).repartition(8).select(F.col("id").cast("int").alias("id"), F.lit("x y").alias("t"))


def test_a_second_run_cleans_only_new_files(spark, folder):
    made, checkpoint = spec(spark, folder), scratch_path(spark)
    first = run_increment(spark, made, checkpoint)
    assert (first.rows, first.batches) == (2, 1)
    assert run_increment(spark, made, checkpoint).rows == 0
    write_table(spark.createDataFrame([(3, " d\te "), (4, None)], SCHEMA), folder, mode="append")
    second = run_increment(spark, made, checkpoint)
    assert second.rows == 2
    got = sorted(map(tuple, second.output.collect()))
    assert got == [(1, "a b"), (2, "c!"), (3, "d e"), (4, None)]
    assert second.output.columns == ["id", "body"]


def test_a_run_that_fails_goes_on_where_it_stopped(spark, folder):
    """The bad file is cleaned once it can be, and the good ones are not cleaned again."""
    made, checkpoint = spec(spark, folder), scratch_path(spark)
    run_increment(spark, made, checkpoint)
    bad = scratch_path(spark)
    write_table(many(spark).withColumnRenamed("t", "u"), bad)
    failing = replace(made, where="if(id > 2, raise_error('broken row'), true)")
    write_table(many(spark).filter("id > 2"), folder, mode="append")
    with pytest.raises(Exception, match="broken row"):
        run_increment(spark, failing, checkpoint)
    again = run_increment(spark, made, checkpoint, files_per_batch=3)
    assert again.output.count() == 2 + 997
    assert again.output.select("id").distinct().count() == 2 + 997


def test_batches_and_partitions(spark, folder):
    for i in range(3, 6):
        write_table(spark.createDataFrame([(i, f"x{i}")], SCHEMA).coalesce(1), folder, mode="append")
    made = spec(spark, folder, partition_by=("id",))
    found = run_increment(spark, made, scratch_path(spark), files_per_batch=1)
    assert found.rows == 5 and found.batches >= 4
    assert sorted(r.id for r in found.output.collect()) == [1, 2, 3, 4, 5]


def test_what_an_increment_refuses(spark, folder):
    made = spec(spark, folder)
    for wrong in (replace(made, job_type=job.REMOVE_DUPLICATE_ROW), replace(made, mode="overwrite")):
        with pytest.raises(ValueError):
            run_increment(spark, wrong, scratch_path(spark))
    empty = scratch_path(spark)
    write_table(spark.createDataFrame([], SCHEMA), empty)
    assert run_increment(spark, spec(spark, empty), scratch_path(spark)).output.count() == 0


@pytest.mark.parametrize("mode", ["errorifexists", "ignore", "overwrite"])
def test_a_failed_write_leaves_nothing(spark, mode):
    path = scratch_path(spark)
    with pytest.raises(Exception, match="broken row"):
        write_table(broken(many(spark)), path, mode=mode)
    assert clear_staging(spark, path) == 0
    assert write_table(many(spark), path, mode=mode)
    assert read_table(spark, path).count() == 1000


def test_a_failed_overwrite_keeps_the_table(spark, folder):
    with pytest.raises(Exception, match="broken row"):
        write_table(broken(many(spark)), folder, mode="overwrite")
    assert read_table(spark, folder).count() == 2
    assert write_table(read_table(spark, folder).filter("id = 1"), folder, mode="overwrite")
    assert [r.id for r in read_table(spark, folder).collect()] == [1]
    assert not write_table(many(spark), folder, mode="ignore")
    assert read_table(spark, folder).count() == 1


def test_leftovers_are_cleared(spark, folder):
    write_table(many(spark), f"{folder}.staging-0")
    assert clear_staging(spark, folder) == 1
    assert clear_staging(spark, folder) == 0
    assert read_table(spark, folder).count() == 2
    drop_table(spark, folder)
    with pytest.raises(Exception):
        read_table(spark, folder)


def test_a_failed_job_can_be_run_again(spark):
    path = scratch_path(spark)
    write_table(many(spark), path)
    made = spec(spark, path)
    failing = replace(made, where="if(id >= 900, raise_error('broken row'), true)")
    result = run_job(spark, failing, on_error="record")
    assert result.metrics.first().status == "error"
    assert run_job(spark, made).metrics.first().result_count == 1000


def test_partitions_are_pruned_and_replaced(spark):
    loaded, path = scratch_path(spark), scratch_path(spark)
    rows = [(i, f"t  {i}", "ab"[i % 2]) for i in range(10)]
    for place in (loaded, path):
        write_table(spark.createDataFrame(rows, "id int, t string, p string"), place, partition_by=["p"])
    one = read_table(spark, loaded, where="p = 'a' AND id > 2")
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(p" in plan and "PushedFilters: [IsNotNull(id), GreaterThan(id,2)]" in plan
    columns = tuple(ColumnSpec(c, c) for c in ("id", "t", "p"))
    made = JobSpec(
        job.REMOVE_SPACE_TAB_NEWLINE, loaded, path, columns, options=Options(), partition_by=("p",),
        mode="overwrite_partitions", where="p = 'a'", partitions=3,
    )
    result = run_job(spark, made)
    assert sorted(map(tuple, result.output.collect())) == [
        (i, t.replace("  ", " ") if p == "a" else t, p) for i, t, p in rows
    ]
    assert result.metrics.first().result_count == 5
    with pytest.raises(ValueError, match="which partitions"):
        write_table(one, path, mode="overwrite_partitions")
    with pytest.raises(ValueError, match="unknown mode"):
        write_table(one, path, mode="replace")


def test_counts_come_from_the_write(spark, folder):
    """Without targets the metrics read neither table again; of empty tables all is zero."""
    result = run_job(spark, spec(spark, folder))
    plan = result.metrics._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    row = result.metrics.first()
    assert (row.source_count, row.source_size, row.result_count, row.result_size) == (2, 8, 2, 7)
    compared = run_job(spark, spec(spark, folder, targets=("t",))).metrics
    assert compared.first().matched_count == 1
    plan = compared._jdf.queryExecution().toString()
    assert plan.count("FileScan") == 2 * plan.count("== Physical Plan ==")
    empty = scratch_path(spark)
    write_table(spark.createDataFrame([], SCHEMA), empty)
    for job_type in (job.REMOVE_SPACE_TAB_NEWLINE, job.REMOVE_DUPLICATE_ROW):
        row = run_job(spark, replace(spec(spark, empty, targets=("t",)), job_type=job_type)).metrics.first()
        assert (row.source_count, row.result_count, row.matched_count, row.status) == (0, 0, 0, "ok")
    kept = run_job(spark, replace(spec(spark, folder), output_path=result.spec.output_path, mode="ignore"))
    assert kept.metrics.first().result_count == 2
