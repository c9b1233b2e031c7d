"""Named queries: every operator of the library over whole tables.

The given tables hold few of the numbers the personal-information patterns look for,
and no Hangul. Queries that need such cells derive them from each row's own key (see
``with_contact`` and ``story``), so they grow with the table like any other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrublens.functions import html, personal_info, text
from scrublens.functions.charclass import bind
from scrublens.operators import diff, report, rows, tables
from scrublens.operators.columns import (
    Cleaner,
    ColumnSpec,
    clean_columns,
    keep_all,
    rename_columns,
)
from scrublens.plans import job
from scrublens.sources.tables import read_table, scratch_path, write_table
from scrublens.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

LISTED = "$%&#,.!^]-"
KEPT = ".,!?-'"
SHORTEST, LONGEST = 200, 5000
DOCUMENT_COLUMNS = (
    ColumnSpec("doc_id", "doc_id"),
    ColumnSpec("text", "body"),
    ColumnSpec("lang", "lang"),
    ColumnSpec("source", "origin"),
)
CUSTOMER_COLUMNS = (
    ColumnSpec("c_custkey", "id"),
    ColumnSpec("c_name", "c_mktsegment"),
    ColumnSpec("c_mktsegment", "c_name"),
    ColumnSpec("c_name", "label"),
    ColumnSpec("c_acctbal", "balance"),
)


#: Session setting: spread each table over so many partitions when it is read. A file is read
#: by as many tasks as it has row groups, which for a small table is one. Not set: as it is.
PARTITIONS = "spark.scrublens.partitions"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table = read_table(spark, f"{sf_dir}/{name}.parquet")
    partitions = spark.conf.get(PARTITIONS, None)
    return table if partitions is None else table.repartition(int(partitions))


def _cells(spark: SparkSession, sf_dir: str, table: str, key: str, cell: str) -> DataFrame:
    """Key and text column of a table."""
    return _table(spark, sf_dir, table).select(key, cell)


# --- cells derived from a key -----------------------------------------------


def _contact(key: Column) -> Column:
    """A line with one number of each kind and an e-mail address."""

    def digits(factor: int, width: int) -> Column:
        return (key * factor) % 10**width

    return F.format_string(
        "card %04d-%04d-%04d-%04d account %03d-%02d-%06d mobile 010-%04d - %04d "
        "line 02-%03d-%04d ~ %02d id %06d - 1%06d digits 9%012d 0%09d "
        "mail user.%d@shop-%d.example.co.kr end",
        *(digits(factor, 4) for factor in (7919, 7907, 7901, 7883)),
        *(digits(31, 3), digits(37, 2), digits(7877, 6)),
        *(digits(43, 4), digits(47, 4)),
        *(digits(53, 3), digits(59, 4), digits(61, 2)),
        *(digits(7873, 6), digits(7867, 6)),
        *(digits(7853, 12), digits(7841, 9)),
        *(key, digits(3, 1)),
    )


def with_contact(cell: Column, key: Column) -> Column:
    return F.concat(cell, F.lit("\n"), _contact(key), F.lit("\nend"))


def story(key: Column) -> Column:
    """HTML with Hangul: a sentence to cut, one to drop, and plain ones; a list, a table, an
    image, code, and brackets in quotes."""
    return F.format_string(
        "<p>첫 문장 %d 더보기 나머지. 두 번째 더 보기 끝! 뉴스 %d 제보? 본문 %d &middot; 끝.</p>"
        "<p>mail a%d@b.example.com or see www.site%d.org now !</p>"
        '<ol><li>one %d<li>two</ol><table><tr><th>k<th>v</tr><tr><td>%d<td>w</tr></table>'
        '<img alt="1 > 0" src="i%d.png"> <code>x%d</code> '
        '<a title="2>1" href="http://u.example/%d">link</a>. <p class="a>b">last %d.</p>',
        *(key,) * 11,
    )


# --- builders ---------------------------------------------------------------


def _documents(cleaner: Cleaner) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _cells(spark, sf_dir, "documents", "doc_id", "text")
        return df.select("doc_id", cleaner(F.col("text")).alias("text"))

    return query


def _documents_with_contact(cleaner: Cleaner) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _cells(spark, sf_dir, "documents", "doc_id", "text")
        cell = with_contact(F.col("text"), F.col("doc_id"))
        return df.select("doc_id", cleaner(cell).alias("text"))

    return query


def _pages(cleaner: Cleaner, name: str = "text") -> Query:
    """Over each page with a derived passage appended."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _cells(spark, sf_dir, "pages", "page_id", "html")
        cell = F.concat(F.col("html"), story(F.col("page_id")))
        return df.select("page_id", cleaner(cell).alias(name))

    return query


def _sentences_of_pages(step: Callable[[Column], Column]) -> Query:
    """A step on the sentence list, joined with a bar to keep the borders visible."""

    def over(cell: Column) -> Column:
        return F.array_join(step(html.split_sentences(text.clean_space(cell))), " | ")

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _cells(spark, sf_dir, "documents", "doc_id", "text")
        cell = F.concat(F.col("text"), F.lit(" "), story(F.col("doc_id")))
        return df.select("doc_id", over(cell).alias("text"))

    return query


def _job(
    table: str,
    key: str,
    columns: tuple[ColumnSpec, ...],
    job_type: str,
    options: job.Options | None = None,
    dedup_keys: tuple[str, ...] = (),
) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spec = _job_spec(spark, sf_dir, table, key, columns, job_type, options, dedup_keys)
        return job.run_job(spark, spec).output

    return query


def _job_spec(
    spark: SparkSession,
    sf_dir: str,
    table: str,
    key: str,
    columns: tuple[ColumnSpec, ...],
    job_type: str,
    options: job.Options | None = None,
    dedup_keys: tuple[str, ...] = (),
) -> job.JobSpec:
    partitions = spark.conf.get(PARTITIONS, None)
    return job.JobSpec(
        job_type=job_type,
        input_path=f"{sf_dir}/{table}.parquet",
        output_path=scratch_path(spark),
        columns=columns,
        options=options or job.Options(),
        id_col=key,
        dedup_keys=dedup_keys,
        partitions=int(partitions) if partitions else None,
    )


# --- before and after -------------------------------------------------------


def _before_after(
    spark: SparkSession,
    sf_dir: str,
    cleaner: Cleaner,
    columns: tuple[ColumnSpec, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """``documents`` and its cleaned copy."""
    before = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return before, clean_columns(before, columns or keep_all(before), cleaner, only=("text",))


SAME_NAMES = {"text": "text", "lang": "lang", "source": "source"}
NEW_NAMES = {"text": "body", "lang": "lang", "source": "origin"}


def _mask_or_null(cell: Column) -> Column:
    """Masked text; a cell too short or too long becomes NULL."""
    return bind(
        personal_info.mask_matches(cell), lambda masked: F.nullif(_outlier(masked), F.lit(""))
    )


def _changed_rows(null_safe: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        before, after = _before_after(spark, sf_dir, _mask_or_null)
        return diff.changed_pairs(before, after, {"text": "text"}, "doc_id", null_safe)

    return query


def _turns(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``conversations``, whose id repeats, and its cleaned copy."""
    before = _table(spark, sf_dir, "conversations").select("conv_id", "role", "text")
    return before, clean_columns(before, keep_all(before), text.clean_space)


TURN_NAMES = {"role": "role", "text": "text"}


def _changed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _before_after(spark, sf_dir, text.clean_space)
    return diff.changed_ids(before, after, SAME_NAMES, "doc_id")


def _changed_rows_per_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _turns(spark, sf_dir)
    return diff.changed_rows_per_column(before, after, TURN_NAMES, "conv_id")


def _matched_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _before_after(spark, sf_dir, _mask_or_null, DOCUMENT_COLUMNS)
    return diff.matched_count(before, after, NEW_NAMES, "doc_id")


def _changed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _before_after(spark, sf_dir, text.clean_space, DOCUMENT_COLUMNS)
    return diff.changed_columns(before, after, NEW_NAMES, "doc_id")


def _pairs(spark: SparkSession, sf_dir: str, cleaner: Cleaner) -> DataFrame:
    """Both values of the cells of ``documents``, whose texts are cleaned, row by row."""
    documents = _table(spark, sf_dir, "documents")
    return rows.pair_rows(documents, SAME_NAMES, cleaner, "doc_id", only=("text",))


def _report_same_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.report(_pairs(spark, sf_dir, text.clean_space), SAME_NAMES, "doc_id")


def _report_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _before_after(spark, sf_dir, text.remove_all_special, DOCUMENT_COLUMNS)
    return report.change_report(before, after, NEW_NAMES, "doc_id")


def report_only_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs(spark, sf_dir, personal_info.mask_matches)
    return rows.report(pairs, SAME_NAMES, "doc_id", only_changed=True)


def _report_only_changed_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _before_after(spark, sf_dir, personal_info.mask_matches)
    return report.change_report(before, after, SAME_NAMES, "doc_id", only_changed=True)


def _report_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs(spark, sf_dir, text.remove_all_special)
    return rows.preview(pairs, SAME_NAMES, "doc_id")


def _report_preview_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _before_after(spark, sf_dir, text.remove_all_special)
    return report.preview(before, after, SAME_NAMES, "doc_id")


# --- tables -----------------------------------------------------------------


def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer")


def _write_then_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark)
    write_table(_table(spark, sf_dir, "documents"), path)
    return read_table(spark, path)


def _rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_columns(_scan(spark, sf_dir), CUSTOMER_COLUMNS)


def _clean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _scan(spark, sf_dir)
    return clean_columns(customers, CUSTOMER_COLUMNS, text.remove_all_special, skip=("id",))


def _clean_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _scan(spark, sf_dir)
    return clean_columns(
        customers, CUSTOMER_COLUMNS, text.remove_all_special, only=("c_name",), skip=("id",)
    )


def _dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all rows, each twice, as after a load that ran again."""
    documents = _table(spark, sf_dir, "documents")
    return tables.drop_duplicate_rows(documents.unionByName(documents))


def _dedup_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("text", "lang")
    return tables.drop_duplicate_rows(documents)


def _dedup_by_text_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By two columns, keeping the row whose id is least as text; all rows come twice."""
    documents = _table(spark, sf_dir, "documents")
    documents = documents.withColumn("doc_id", F.col("doc_id").cast("string"))
    twice = documents.unionByName(documents)
    return tables.keep_first_by_key(twice, ["text", "lang"], "doc_id")


def _dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.keep_first_by_key(_table(spark, sf_dir, "documents"), ["text"], "doc_id")


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = job.JobSpec.from_params(
        {
            "preprocessType": "FILTERING_PERSONAL_INFO",
            "inputDataPath": f"{sf_dir}/documents.parquet",
            "outputDataPath": scratch_path(spark),
            "newTableColumns": [
                {"originColumnName": c.origin, "columnName": c.name} for c in DOCUMENT_COLUMNS
            ],
            "targetTableColumns": [{"columnName": "text"}, {"columnName": "lang"}],
            "optionType": "masking",
            "preprocessIdx": 17,
        },
        id_col="doc_id",
    )
    metrics = job.run_job(spark, spec).metrics
    return metrics.withColumn("columns", F.array_join("columns", ",")).drop("message")


def _saved_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a job, as it was saved beside its output and read again."""
    made = _job_spec(
        spark, sf_dir, "conversations", "conv_id", TURN_COLUMNS, job.REMOVE_SPACE_TAB_NEWLINE
    )
    result = job.run_job(spark, replace(made, targets=("text", "turn")))
    return read_table(spark, result.save_report(only_changed=True))


def _fallback_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changed ids of a table whose id column is ``_idx``."""
    path = scratch_path(spark)
    write_table(_table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "_idx"), path)
    spec = job.JobSpec(
        job_type=job.REMOVE_SPACE_TAB_NEWLINE,
        input_path=path,
        output_path=scratch_path(spark),
        columns=(ColumnSpec("_idx", "_idx"), ColumnSpec("text", "body")),
        targets=("text",),
    )
    return job.run_job(spark, spec).changed_ids()


def _guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of three jobs over one table: as it should be, with a column that the table
    does not have, and with none that identifies rows."""
    made = _job_spec(
        spark, sf_dir, "documents", "doc_id", DOCUMENT_COLUMNS, job.REMOVE_SPACE_TAB_NEWLINE
    )
    specs = {
        "right": made,
        "column": replace(made, columns=(*DOCUMENT_COLUMNS, ColumnSpec("nothing", "x"))),
        "id": replace(made, id_col="id", targets=("text",)),
    }
    found = []
    for name, spec in specs.items():
        spec = replace(spec, job_id=name, output_path=scratch_path(spark))
        found.append(job.run_job(spark, spec, on_error="record").metrics)
    names = ("job_id", "source_count", "result_count", "status")
    return reduce(DataFrame.unionByName, found).select(*names)


def _observed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and sizes of a job without targets, all from the write itself."""
    made = _job_spec(
        spark, sf_dir, "orders", "id", ORDER_COLUMNS, job.REMOVE_SPECIAL_CHAR, job.Options("all")
    )
    metrics = job.run_job(spark, made).metrics
    return metrics.select("source_count", "source_size", "result_count", "result_size", "status")


def _replaced_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in partitions by language, of which a job cleans one again and replaces it."""
    loaded, cleaned = scratch_path(spark), scratch_path(spark)
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    for path in (loaded, cleaned):
        write_table(documents, path, partition_by=["lang"])
    spec = job.JobSpec(
        job_type=job.REMOVE_SPECIAL_CHAR,
        input_path=loaded,
        output_path=cleaned,
        columns=tuple(keep_all(documents)),
        options=job.Options("all"),
        id_col="doc_id",
        mode="overwrite_partitions",
        partition_by=("lang",),
        where="lang = 'fr'",
    )
    return job.run_job(spark, spec).output


def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job over a folder that the table arrives in, in two loads, with a run after each and
    one that finds nothing new."""
    made = _job_spec(
        spark, sf_dir, "documents", "doc_id", DOCUMENT_COLUMNS, job.FILTERING_PERSONAL_INFO,
        job.Options("masking"),
    )
    made = replace(made, partitions=None)
    folder, checkpoint = scratch_path(spark), scratch_path(spark)
    documents = _table(spark, sf_dir, "documents")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    made = replace(made, input_path=folder)
    for load in (documents.filter(english), documents.filter(~english)):
        write_table(load, folder, mode="append")
        incremental.run_increment(spark, made, checkpoint)
    return incremental.run_increment(spark, made, checkpoint).output


# --- single queries ---------------------------------------------------------


def _custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caller's own operator: anything from Column to Column, a pandas UDF too."""

    @F.pandas_udf("string")
    def squeeze(cells: pd.Series) -> pd.Series:
        return cells.str.replace(r"([$%&*])[$%&*]+", r"\1", regex=True)

    documents = _cells(spark, sf_dir, "documents", "doc_id", "text")
    return clean_columns(documents, keep_all(documents), squeeze)


def _url_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _cells(spark, sf_dir, "pages", "page_id", "url").toDF("id", "text")
    documents = _cells(spark, sf_dir, "documents", "doc_id", "text").toDF("id", "text")
    stacked = pages.withColumn("kind", F.lit("page")).unionByName(
        documents.withColumn("kind", F.lit("document"))
    )
    return stacked.withColumn("text", html.delete_urls(F.col("text")))


def _sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _cells(spark, sf_dir, "documents", "doc_id", "text")
    sentences = F.posexplode(html.split_sentences(F.col("text"))).alias("position", "sentence")
    return documents.select("doc_id", sentences)


def _has_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of documents of which every other one ends in HTML, every third in escaped HTML."""
    documents = _cells(spark, sf_dir, "documents", "doc_id", "text")
    key = F.col("doc_id")
    ending = F.when(key % 2 == 0, story(key)).when(key % 3 == 0, "&lt;b&gt; x").otherwise(" < b>")
    cell = html.br_to_newline(html.unescape(F.concat("text", ending)))
    return documents.select("doc_id", html.has_element(cell).alias("has_tag"))


def _outlier(cell: Column) -> Column:
    return text.blank_outlier(cell, SHORTEST, LONGEST)


PAGE_COLUMNS = (ColumnSpec("page_id", "page_id"), ColumnSpec("html", "body"))
ORDER_COLUMNS = (
    ColumnSpec("o_orderkey", "id"),
    ColumnSpec("o_orderpriority", "priority"),
    ColumnSpec("o_totalprice", "total"),
    ColumnSpec("o_orderstatus", "status"),
)
TURN_COLUMNS = (
    ColumnSpec("conv_id", "conv_id"),
    ColumnSpec("turn", "turn"),
    ColumnSpec("text", "said"),
)

QUERIES: dict[str, Query] = {
    # tables
    "scan_table": _scan,
    "write_then_read": _write_then_read,
    "rename_columns": _rename,
    "clean_all_string_columns": _clean_all,
    "clean_target_columns": _clean_targets,
    "table_row_count": lambda spark, d: tables.row_count(_table(spark, d, "lineitem")),
    "table_size_bytes": lambda spark, d: tables.size_bytes(_table(spark, d, "documents")),
    "distinct_values": lambda spark, d: tables.distinct_values(
        _table(spark, d, "documents"), "text"
    ),
    "dedup_rows": _dedup_rows,
    "dedup_values": _dedup_values,
    "dedup_by_key": _dedup_by_key,
    "dedup_by_text_id": _dedup_by_text_id,
    "job_metrics": _metrics,
    # text
    "clean_space": _documents(text.clean_space),
    "special_remove_all": _documents(text.remove_all_special),
    "special_remove_selected": _documents(lambda c: text.remove_selected_special(c, LISTED)),
    "special_keep_listed": _documents(lambda c: text.keep_listed_special(c, KEPT)),
    "outlier_blank": _documents(_outlier),
    "custom_text_op": _custom,
    # personal information
    "pii_delete": _documents_with_contact(personal_info.delete_matches),
    "pii_mask": _documents_with_contact(personal_info.mask_matches),
    "pii_row_delete": _documents_with_contact(personal_info.delete_lines),
    "mask_card": _documents_with_contact(
        lambda cell: personal_info.mask_matches(cell, [personal_info.CARD])
    ),
    "mask_account": _documents_with_contact(
        lambda cell: personal_info.mask_matches(cell, [personal_info.ACCOUNT])
    ),
    "mask_phone": _documents_with_contact(
        lambda cell: personal_info.mask_matches(cell, [personal_info.PHONE])
    ),
    "mask_resident_no": _documents_with_contact(
        lambda cell: personal_info.mask_matches(cell, [personal_info.RESIDENT_NO])
    ),
    "mask_email": _documents_with_contact(
        lambda cell: personal_info.mask_matches(cell, [personal_info.EMAIL])
    ),
    # HTML
    "html_unescape": _pages(html.unescape),
    "html_br_to_newline": _pages(html.br_to_newline),
    "html_has_tag": _has_tag,
    "html_strip_tags": _pages(html.strip_tags),
    "url_delete": _url_delete,
    "token_delete": _pages(html.delete_tokens),
    "email_delete": _documents_with_contact(html.delete_emails),
    "sentence_split": _sentence_split,
    "html_drop_marker_sentences": _sentences_of_pages(html.drop_marked),
    "html_cut_more": _sentences_of_pages(html.cut_see_more),
    "html_to_text": _pages(html.html_to_text),
    # differences
    "changed_rows_ne": _changed_rows(null_safe=False),
    "changed_rows_null_safe": _changed_rows(null_safe=True),
    "changed_ids": _changed_ids,
    "matched_count": _matched_count,
    "changed_rows_per_column": _changed_rows_per_column,
    "changed_columns": _changed_columns,
    "change_report_same_name": _report_same_name,
    "change_report_renamed": _report_renamed,
    "change_report_only_changed": report_only_changed,
    "change_report_only_changed_joined": _report_only_changed_joined,
    "report_preview": _report_preview,
    "report_preview_joined": _report_preview_joined,
    # jobs
    "job_remove_special_char_end_to_end": _job(
        "orders", "id", ORDER_COLUMNS, job.REMOVE_SPECIAL_CHAR, job.Options("some", "-T")
    ),
    "job_remove_html_tag_end_to_end": _job(
        "pages", "page_id", PAGE_COLUMNS, job.REMOVE_HTML_TAG
    ),
    "job_remove_outlier_end_to_end": _job(
        "documents",
        "doc_id",
        DOCUMENT_COLUMNS,
        job.REMOVE_OUTLIER,
        job.Options(shortest=SHORTEST, longest=LONGEST),
    ),
    "job_filtering_personal_info_end_to_end": _job(
        "documents",
        "doc_id",
        DOCUMENT_COLUMNS,
        job.FILTERING_PERSONAL_INFO,
        job.Options("masking"),
    ),
    "job_remove_space_tab_newline_end_to_end": _job(
        "conversations", "conv_id", TURN_COLUMNS, job.REMOVE_SPACE_TAB_NEWLINE
    ),
    "job_remove_duplicate_row_end_to_end": _job(
        "documents", "doc_id", DOCUMENT_COLUMNS, job.REMOVE_DUPLICATE_ROW, dedup_keys=("body",)
    ),
    "job_saved_report": _saved_report,
    "job_fallback_id": _fallback_id,
    "job_guards": _guarded,
    "job_metrics_observed": _observed_metrics,
    "job_replaced_partitions": _replaced_partitions,
    "job_incremental": _incremental,
    "job_remove_duplicate_row_all_columns": _job(
        "documents", "doc_id", DOCUMENT_COLUMNS, job.REMOVE_DUPLICATE_ROW
    ),
}
