from __future__ import annotations

import itertools
import random

import pytest

from scrublens.functions.text import clean_space
from scrublens.operators import diff, report
from scrublens.operators.columns import clean_columns, keep_all
from tests.conftest import SF_DIR
from tests.test_plans import plan_of

LONG = "long " * 40


@pytest.fixture
def sides(spark):
    before = spark.createDataFrame(
        [
            (1, "a", "x", LONG),
            (2, "b", None, LONG + "1"),
            (3, "c", "z", LONG),
            (4, "only before", "q", ""),
            (None, "no id", "q", ""),
            (5, None, None, None),
        ],
        "id int, t string, u string, v string",
    )
    after = spark.createDataFrame(
        [
            (1, "A", "x", LONG),
            (2, "b", "new", LONG + "2"),
            (3, "c", "z", LONG),
            (6, "only after", "q", ""),
            (None, "changed", "q", ""),
            (5, None, "w", None),
        ],
        "id int, t2 string, u string, v string",
    )
    return before, after


MAPPING = {"t": "t2", "u": "u", "v": "v"}


def ids(df):
    return sorted(r.id for r in df.collect())


def test_changed_ids(sides):
    assert ids(diff.changed_ids(*sides, MAPPING, "id")) == [1, 2, 5]
    assert ids(diff.changed_ids(*sides, MAPPING, "id", null_safe=False)) == [1, 2]
    assert ids(diff.changed_ids(*sides, {"u": "u"}, "id", null_safe=False)) == []
    assert ids(diff.changed_ids(*sides, {"u": "u"}, "id")) == [2, 5]
    assert diff.matched_count(*sides, MAPPING, "id").first().matched_count == 3


def test_changed_pairs(sides):
    rows = diff.changed_pairs(*sides, MAPPING, "id").orderBy("id").collect()
    assert [r.id for r in rows] == [1, 2, 5]
    names = ["id", "t_before", "t2_after", "u_before", "u_after", "v_before", "v_after"]
    assert list(rows[0].asDict()) == names
    assert tuple(rows[0]) == (1, "a", "A", "x", "x", LONG, LONG)


def test_per_column(sides):
    counts = diff.changed_rows_per_column(*sides, MAPPING, "id").collect()
    assert [tuple(r) for r in counts] == [("t", "t2", 1), ("u", "u", 2), ("v", "v", 1)]


def test_changed_columns(spark, sides):
    found = {tuple(r) for r in diff.changed_columns(*sides, MAPPING, "id").collect()}
    assert found == {("t", "t2"), ("u", "u"), ("v", "v")}


def test_swapped_values_are_no_changed_column(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    after = spark.createDataFrame([(1, "b"), (2, "a")], "id int, t string")
    assert diff.matched_count(before, after, {"t": "t"}, "id").first()[0] == 2
    assert diff.changed_columns(before, after, {"t": "t"}, "id").count() == 0
    assert report.change_report(before, after, {"t": "t"}, "id") is None
    assert report.preview(before, after, {"t": "t"}, "id") is None


def test_id_is_not_compared(sides):
    before, after = sides
    with pytest.raises(ValueError, match="no column"):
        diff.changed_ids(before, after, {"id": "id"}, "id")
    assert report.change_report(before, after, {"id": "id"}, "id") is None
    assert ids(diff.changed_ids(before, after, {"id": "id", "t": "t2"}, "id")) == [1]


def test_unknown_columns(sides):
    with pytest.raises(ValueError, match="nope"):
        diff.changed_ids(*sides, {"nope": "t2"}, "id")
    with pytest.raises(ValueError, match="nope"):
        diff.changed_columns(*sides, {"t": "nope"}, "id")


def test_count_and_compare(sides):
    before, after = sides
    row = diff.count_and_compare(before, after, MAPPING, "id").first()
    sizes = [sum(len(str(v)) for r in df.collect() for v in r if v is not None) for df in sides]
    assert tuple(row) == (6, sizes[0], 6, sizes[1], 3)
    empty = diff.count_and_compare(before.limit(0), after.limit(0), MAPPING, "id").first()
    assert tuple(empty) == (0, 0, 0, 0, 0)


def test_empty_tables(sides):
    before, after = (df.limit(0) for df in sides)
    assert diff.matched_count(before, after, MAPPING, "id").first()[0] == 0
    counts = diff.changed_rows_per_column(before, after, MAPPING, "id").collect()
    assert [r.changed_rows for r in counts] == [0, 0, 0]
    assert diff.changed_columns(before, after, MAPPING, "id").count() == 0


def test_non_text_columns(spark):
    schema = "id int, d double, t timestamp, l array<int>, s struct<a:int>, b binary"
    import datetime

    day = datetime.datetime(2020, 1, 1)
    before = spark.createDataFrame(
        [(1, 0.0, day, [1], (1,), b"x"), (2, 1.0, day, [1, None], (None,), b"x")], schema
    )
    after = spark.createDataFrame(
        [(1, -0.0, day, [1], (1,), b"x"), (2, 1.5, None, [1], (2,), b"y")], schema
    )
    names = {n: n for n in ("d", "t", "l", "s", "b")}
    counts = diff.changed_rows_per_column(before, after, names, "id").collect()
    assert {r.origin: r.changed_rows for r in counts} == dict.fromkeys(names, 1)
    assert ids(diff.changed_ids(before, after, names, "id")) == [2]


@pytest.mark.parametrize("null_safe", [True, False])
def test_repeated_ids_like_joined_pairs(spark, null_safe):
    """Random tables with repeated and NULL ids and values, against all pairs."""
    rng = random.Random(11)

    def table():
        return [
            (
                rng.choice([None, *range(25)]),
                rng.choice([None, "a", "b"]),
                rng.choice([None, "p" * 50, "q" * 50, "p"]),
            )
            for _ in range(60)
        ]

    def differs(b, a):
        if not null_safe and (b is None or a is None):
            return False
        return b != a

    before, after = table(), table()
    pairs = [
        (b, a) for b, a in itertools.product(before, after) if b[0] is not None and b[0] == a[0]
    ]
    changed = [(b, a) for b, a in pairs if differs(b[1], a[1]) or differs(b[2], a[2])]
    counts = [sum(differs(b[i], a[i]) for b, a in pairs) for i in (1, 2)]

    schema = "id int, t string, u string"
    left, right = spark.createDataFrame(before, schema), spark.createDataFrame(after, schema)
    names = {"t": "t", "u": "u"}
    assert ids(diff.changed_ids(left, right, names, "id", null_safe)) == sorted(
        {b[0] for b, _ in changed}
    )
    per_column = diff.changed_rows_per_column(left, right, names, "id", null_safe).collect()
    assert [r.changed_rows for r in per_column] == counts
    # Rows are paired where an id repeats on one side only.
    with pytest.raises(Exception, match="does not identify rows"):
        diff.changed_pairs(left, right, names, "id", null_safe).collect()
    once = {a[0]: a for a in after}
    single = spark.createDataFrame(list(once.values()), schema)
    rows = diff.changed_pairs(left, single, names, "id", null_safe).collect()
    got = sorted(map(repr, (tuple(r) for r in rows)))
    kept = [(b, a) for b, a in changed if once[a[0]] is a]
    assert got == sorted(repr((b[0], b[1], a[1], b[2], a[2])) for b, a in kept)


def test_hot_id_stays_linear(spark):
    """One id on every row of both sides: its 10**10 pairs are counted, not built."""
    from pyspark.sql import functions as F

    n = 100_000
    before = spark.range(n).select(F.lit(7).alias("id"), F.col("id").cast("string").alias("t"))
    after = before.withColumn("t", F.concat("t", F.lit("!")))
    counts = diff.changed_rows_per_column(before, after, {"t": "t"}, "id").first()
    assert counts.changed_rows == n * n
    assert diff.matched_count(before, after, {"t": "t"}, "id").first()[0] == 1


def test_hot_id_in_reports(spark):
    """A preview of it is cheap; its report is refused if it repeats on both sides."""
    from pyspark.sql import functions as F

    before = spark.range(50_000).select(F.lit(7).alias("id"), F.col("id").cast("string").alias("t"))
    after = before.withColumn("t", F.concat("t", F.lit("!")))
    assert report.preview(before, after, {"t": "t"}, "id").count() == 20
    for only_changed in (False, True):
        with pytest.raises(ValueError, match="does not identify rows"):
            report.change_report(before, after, {"t": "t"}, "id", only_changed)
    for n in (2, 15, 25):
        with pytest.raises(ValueError, match="does not identify rows"):
            report.change_report(before.limit(n), after.limit(n), {"t": "t"}, "id")
        for only_changed in (False, True):
            lines = report.change_report(before.limit(n), after.limit(1), {"t": "t"}, "id", only_changed)
            assert lines.count() == n


def test_report(sides):
    rows = report.change_report(*sides, MAPPING, "id").collect()
    assert [r.id for r in rows] == [1, 2, 3, 5]
    assert rows[0].asDict().keys() == {
        *("id", "t_before", "t2_after", "u_before", "u_after", "v_before", "v_after")
    }
    only = report.change_report(*sides, MAPPING, "id", only_changed=True).collect()
    assert [r.id for r in only] == [1, 2, 5]


def test_report_holds_the_changed_ids(spark):
    """Over given documents: the ids of the report of changes are the changed ids."""
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang")
    after = clean_columns(documents, keep_all(documents), clean_space)
    names = {"text": "text", "lang": "lang"}
    changed = {r.doc_id for r in diff.changed_ids(documents, after, names, "doc_id").collect()}
    lines = report.change_report(documents, after, names, "doc_id", only_changed=True)
    assert {r.doc_id for r in lines.collect()} == changed
    assert 0 < len(changed) <= documents.count()


def test_report_shows_changed_columns_only(spark):
    before = spark.createDataFrame([(2, "a", "k"), (1, "b", "k")], "id int, t string, k string")
    after = spark.createDataFrame([(1, "b", "k"), (2, "A", "k")], "id int, t string, k string")
    out = report.change_report(before, after, {"t": "t", "k": "k"}, "id")
    assert out.columns == ["id", "t_before", "t_after"]
    assert [tuple(r) for r in out.collect()] == [(1, "b", "b"), (2, "a", "A")]


def test_preview(spark):
    before = spark.createDataFrame([(i, f"{i:04d}" * 6) for i in range(50)], "id int, t string")
    after = before.selectExpr("id", "reverse(t) AS t").where("id != 3")
    rows = report.preview(before, after, {"t": "t"}, "id", rows=5, width=10).collect()
    assert [r.id for r in rows] == [0, 1, 2, 4, 5]
    assert rows[1].t_before == "0001000..."
    assert report.preview(before, after, {"t": "t"}, "id").count() == 20


@pytest.mark.parametrize("id_type", ["timestamp", "date", "string", "decimal(20,2)", "double"])
def test_id_types(spark, id_type):
    """Also the two instants that a clock in New York shows alike."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        base = spark.range(6).selectExpr("id AS n", "concat('t', id) AS t")
        instants = "timestamp_seconds(1604206800 + n * 1800)"  # 2020-11-01T05:00Z on
        made = {"timestamp": instants, "date": "date_add(date'2020-01-01', cast(n AS int))"}
        made_id = made.get(id_type, f"cast(n AS {id_type})")
        before = base.selectExpr(f"{made_id} AS id", "t")
        after = before.selectExpr("id", "if(t = 't4', t, 'x') AS t")
        lines = report.change_report(before, after, {"t": "t"}, "id", only_changed=True)
        assert [r.t_before for r in lines.collect()] == ["t0", "t1", "t2", "t3", "t5"]
        shown = report.preview(before, after, {"t": "t"}, "id", rows=4)
        assert [r.t_before for r in shown.collect()] == ["t0", "t1", "t2", "t3"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_one_shuffle_by_id(sides):
    plan = plan_of(diff.matched_count(*sides, MAPPING, "id"))
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("null_safe", [True, False])
def test_comparisons_do_not_sort(sides, null_safe):
    for found in (
        diff.changed_ids(*sides, MAPPING, "id", null_safe),
        diff.matched_count(*sides, MAPPING, "id", null_safe),
        diff.count_and_compare(*sides, MAPPING, "id"),
    ):
        plan = plan_of(found)
        assert "HashAggregate" in plan
        assert "SortAggregate" not in plan
