"""What Spark makes of the queries."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrublens.functions import html, personal_info, text
from scrublens.operators import diff, report, rows, tables
from scrublens.operators.columns import ColumnSpec, clean_columns
from tests.conftest import SF_DIR


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "function",
    [
        text.clean_space,
        text.remove_all_special,
        lambda c: text.remove_selected_special(c, "!?"),
        lambda c: text.keep_listed_special(c, "!?"),
        lambda c: text.blank_outlier(c, 1, 2),
        personal_info.mask_matches,
        personal_info.delete_matches,
        personal_info.delete_lines,
        html.unescape,
        html.html_to_text,
    ],
)
def test_cleaning_is_one_projection_without_python(spark, function):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = plan_of(clean_columns(documents, [ColumnSpec("text", "body")], function))
    assert "EvalPython" not in plan
    assert "Exchange" not in plan
    assert plan.count("Project") == 1
    assert re.search(r"ReadSchema: struct<text:string>", plan)


@pytest.mark.parametrize(
    "function", [text.clean_space, text.remove_all_special, lambda c: text.blank_outlier(c, 1, 2)]
)
def test_simple_cleaning_is_generated_code(spark, function):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    df = clean_columns(documents, [ColumnSpec("text", "body")], function)
    df.collect()
    assert re.search(r"\*\(1\) Project", plan_of(df))


def test_unescape_evaluates_its_input_once(spark):
    """A chain of steps that need their input twice must not double at each step."""
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    column = F.col("text")
    for _ in range(4):
        column = html.unescape(column)
    plan = plan_of(documents.select(column.alias("t")))
    assert len(re.findall(r"regexp_extract_all", plan)) == 4


def test_duplicates_are_combined_before_the_shuffle(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = plan_of(tables.drop_duplicate_rows(documents.select("text")))
    assert "Window" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Aggregate") == 2


def test_first_rows_are_found_without_their_texts(spark):
    """Numbers are grouped, in hash aggregates; texts only come with the rows that stay."""
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = plan_of(tables.keep_first_by_key(documents, ["text"], "doc_id"))
    assert "Window" not in plan and "SortAggregate" not in plan
    assert re.search(r"partial_min\(_first", plan) and "LeftSemi" in plan
    found = re.search(r"HashAggregate\(keys=\[([^]]*)\], functions=\[partial_min", plan)
    assert "text" not in found[1]
    by_text = documents.withColumn("doc_id", F.col("doc_id").cast("string"))
    plan = plan_of(tables.keep_first_by_key(by_text, ["text"], "doc_id"))
    assert not re.search(r"SortAggregate\(key=\[[^]]*text#", plan)


def test_row_reports_join_nothing(spark):
    """Both values of a cell come from one scan of the named columns."""
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = {"text": "body"}
    paired = rows.pair_rows(documents, names, text.clean_space, "doc_id")
    for only_changed in (False, True):
        plan = plan_of(rows.report(paired, names, "doc_id", only_changed))
        assert "Join" not in plan and plan.count("FileScan") == 1
        assert plan.count("regexp_replace") == 1  # cleaned once
        assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    plan = plan_of(rows.preview(paired, names, "doc_id"))
    assert "TakeOrderedAndProject" in plan and "Join" not in plan


def test_texts_are_not_shuffled_to_compare(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    plan = plan_of(diff.changed_ids(documents, documents, {"text": "text"}, "doc_id"))
    assert plan.count("sha2(") == 2
    assert "Join" not in plan


def test_report_joins_once(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    after = documents.withColumn("text", F.upper("text"))
    out = report.change_report(documents, after, {"text": "text", "lang": "lang"}, "doc_id")
    plan = plan_of(out)
    assert len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", plan)) == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_preview_looks_rows_up_by_a_bounded_join(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    after = documents.withColumn("text", F.upper("text"))
    plan = plan_of(report.preview(documents, after, {"text": "text"}, "doc_id"))
    assert len(re.findall(r"BroadcastHashJoin \[doc_id#\d+L\], \[doc_id#\d+L\], LeftSemi", plan)) >= 2
    assert "TakeOrderedAndProject" in plan
