from __future__ import annotations

from types import SimpleNamespace

import pytest

from scrublens import ColumnSpec, JobSpec, Options, run_job
from scrublens.plans import job
from scrublens.sources.tables import read_table, scratch_path, write_table

COLUMNS = (ColumnSpec("id", "id"), ColumnSpec("t", "body"), ColumnSpec("n", "n"))


@pytest.fixture
def source(spark):
    path = scratch_path(spark)
    rows = [(1, "a  b", 1), (2, "c 010-1234-5678", 2), (3, None, 3), (4, "a  b", 1)]
    write_table(spark.createDataFrame(rows, "id int, t string, n int"), path)
    return path


def spec(spark, source, job_type, options=None, **more):
    fields = {"columns": COLUMNS, "targets": ("t", "n"), **more}
    return JobSpec(job_type, source, scratch_path(spark), options=options or Options(), **fields)


def bodies(result):
    return [r.body for r in result.output.orderBy("id").collect()]


@pytest.mark.parametrize(
    ("job_type", "options", "expected"),
    [
        (job.REMOVE_SPACE_TAB_NEWLINE, None, ["a b", "c 010-1234-5678", None, "a b"]),
        (job.REMOVE_SPECIAL_CHAR, Options("all"), ["a  b", "c 010 1234 5678", None, "a  b"]),
        (job.REMOVE_SPECIAL_CHAR, Options("x", "c"), ["a  b", "  010-1234-5678", None, "a  b"]),
        (job.REMOVE_OUTLIER, Options(shortest=4, longest=4), ["a  b", "", None, "a  b"]),
        (
            job.FILTERING_PERSONAL_INFO,
            Options("masking"),
            ["a  b", "c ###-####-####", None, "a  b"],
        ),
        (job.FILTERING_PERSONAL_INFO, Options("delete"), ["a  b", "c ", None, "a  b"]),
        (job.FILTERING_PERSONAL_INFO, Options("row_delete"), ["a  b", "", None, "a  b"]),
        (job.FILTERING_PERSONAL_INFO, Options("?"), ["a  b", "c 010-1234-5678", None, "a  b"]),
        (job.REMOVE_HTML_TAG, None, ["a  b", "c 010-1234-5678", None, "a  b"]),
    ],
)
def test_each_type(spark, source, job_type, options, expected):
    result = run_job(spark, spec(spark, source, job_type, options))
    assert result.output.columns == ["id", "body", "n"]
    assert bodies(result) == expected


def test_duplicate_rows(spark, source):
    columns = (ColumnSpec("t", "body"), ColumnSpec("n", "n"))
    whole = spec(spark, source, job.REMOVE_DUPLICATE_ROW, columns=columns, targets=())
    assert run_job(spark, whole).output.count() == 3
    keyed = spec(spark, source, job.REMOVE_DUPLICATE_ROW, dedup_keys=("body",))
    result = run_job(spark, keyed)
    assert sorted(r.id for r in result.output.collect()) == [1, 2, 3]
    assert result.metrics.first().result_count == 3


def test_metrics_and_report(spark, source):
    result = run_job(spark, spec(spark, source, job.REMOVE_SPACE_TAB_NEWLINE))
    metrics = result.metrics.first().asDict()
    assert metrics == {
        "job_id": None,
        "columns": ["id", "body", "n"],
        "source_count": 4,
        "source_size": 4 + 4 + 23,
        "result_count": 4,
        "result_size": 4 + 4 + 21,
        "matched_count": 2,
        "status": "ok",
        "message": None,
    }
    assert sorted(r.id for r in result.changed_ids().collect()) == [1, 4]
    assert [tuple(r) for r in result.changed_columns().collect()] == [("t", "body")]
    assert result.report().columns == ["id", "t_before", "body_after"]
    assert [r.id for r in result.report(only_changed=True).collect()] == [1, 4]
    assert result.preview(rows=2).count() == 2
    path = result.save_report()
    assert path == f"{result.spec.output_path}_report"
    assert read_table(spark, path).count() == 4


def test_unchanged_job_has_no_report(spark, source):
    result = run_job(spark, spec(spark, source, job.REMOVE_HTML_TAG))
    assert result.report() is None
    assert result.preview() is None
    assert result.save_report() is None
    assert result.metrics.first().matched_count == 0


def test_text_id_is_not_cleaned(spark):
    path = scratch_path(spark)
    write_table(spark.createDataFrame([("a!", "b!")], "id string, t string"), path)
    columns = (ColumnSpec("id", "id"), ColumnSpec("t", "t"))
    made = spec(
        spark, path, job.REMOVE_SPECIAL_CHAR, Options("all"), columns=columns, targets=("t",)
    )
    assert [tuple(r) for r in run_job(spark, made).output.collect()] == [("a!", "b ")]


def test_fallback_id(spark):
    path = scratch_path(spark)
    write_table(spark.createDataFrame([("a!", "b!")], "_idx string, t string"), path)
    columns = (ColumnSpec("_idx", "_idx"), ColumnSpec("t", "t"))
    made = spec(
        spark, path, job.REMOVE_SPECIAL_CHAR, Options("all"), columns=columns, targets=("t",)
    )
    result = run_job(spark, made)
    assert result.id_col == "_idx"
    assert result.metrics.first().matched_count == 1
    assert result.output.first()._idx == "a!"


def test_missing_id_fails_before_writing(spark, source):
    made = spec(
        spark, source, job.REMOVE_HTML_TAG, columns=(ColumnSpec("t", "t"),), targets=("t",)
    )
    with pytest.raises(ValueError, match="_idx"):
        run_job(spark, made)
    with pytest.raises(Exception, match="(?i)not.exist"):
        read_table(spark, made.output_path).count()


def test_bad_specs(spark, source):
    with pytest.raises(ValueError, match="unknown job type"):
        spec(spark, source, "SHOUT")
    with pytest.raises(ValueError, match="list"):
        spec(spark, source, job.REMOVE_SPECIAL_CHAR, Options("some"))
    with pytest.raises(ValueError, match="shortest"):
        spec(spark, source, job.REMOVE_OUTLIER, Options(shortest=1))
    with pytest.raises(ValueError, match="columns"):
        spec(spark, source, job.REMOVE_HTML_TAG, columns=())
    with pytest.raises(ValueError, match="path"):
        JobSpec(job.REMOVE_HTML_TAG, "", "x", COLUMNS)
    with pytest.raises(ValueError, match="on_error"):
        run_job(spark, spec(spark, source, job.REMOVE_HTML_TAG), on_error="ignore")


def test_recorded_error(spark):
    made = JobSpec(job.REMOVE_HTML_TAG, "/nowhere/at/all", "/nowhere/else", COLUMNS)
    with pytest.raises(Exception, match="(?i)not.exist"):
        run_job(spark, made)
    row = run_job(spark, made, on_error="record").metrics.first()
    assert (row.status, row.source_count) == ("error", 0)
    assert "/nowhere/at/all" in row.message


def test_from_params():
    params = {
        "preprocessType": "REMOVE_OUTLIER",
        "inputDataPath": "/in",
        "outputDataPath": "/out",
        "newTableColumns": [{"originColumnName": "a", "columnName": "b"}],
        "targetTableColumns": [{"columnName": "a"}, {"columnName": "z"}],
        "optionMin": "3",
        "optionMax": "9",
    }
    made = JobSpec.from_params(params, fmt="orc")
    assert made.columns == (ColumnSpec("a", "b"),)
    assert made.mapping == {"a": "b"}
    assert (made.options.shortest, made.options.longest, made.fmt) == (3, 9, "orc")
    assert JobSpec.from_params(SimpleNamespace(**params), fmt="orc") == made


def test_duplicates_are_found_without_the_id(spark):
    path = scratch_path(spark)
    write_table(spark.createDataFrame([(2, "same"), (1, "same"), (3, "same")], "id int, t string"), path)
    record = {
        "preprocessType": "REMOVE_DUPLICATE_ROW",
        "inputDataPath": path,
        "outputDataPath": scratch_path(spark),
        "newTableColumns": [{"originColumnName": c, "columnName": c} for c in ("id", "t")],
        "targetTableColumns": [{"columnName": "t"}],
    }
    output = run_job(spark, JobSpec.from_params(record)).output
    assert [tuple(row) for row in output.collect()] == [(1, "same")]


def test_write_options_and_kept_metrics(spark, source):
    kept = scratch_path(spark)
    columns = (ColumnSpec("n", "n"), ColumnSpec("id", "id"), ColumnSpec("t", "body"))
    made = spec(
        spark,
        source,
        job.REMOVE_SPACE_TAB_NEWLINE,
        columns=columns,
        job_id="j1",
        mode="overwrite",
        partition_by=("body",),
        metrics_path=kept,
    )
    for _ in range(2):
        result = run_job(spark, made)
        assert result.output.columns == ["n", "id", "body"]
        assert bodies(result) == ["a b", "c 010-1234-5678", None, "a b"]
    rows = read_table(spark, kept).collect()
    assert rows == [result.metrics.first()] * 2
    assert (rows[0].job_id, rows[0].matched_count, rows[0].status) == ("j1", 2, "ok")
    with pytest.raises(ValueError, match="partition"):
        spec(spark, source, job.REMOVE_SPACE_TAB_NEWLINE, partition_by=("t",))


def test_failures_are_kept_too(spark):
    kept = scratch_path(spark)
    made = spec(
        spark, scratch_path(spark), job.REMOVE_SPACE_TAB_NEWLINE, job_id="j2", metrics_path=kept
    )
    run_job(spark, made, on_error="record")
    row = read_table(spark, kept).first()
    assert (row.job_id, row.status) == ("j2", "error")
