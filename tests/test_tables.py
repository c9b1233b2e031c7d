from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from scrublens.functions import text
from scrublens.operators import tables
from scrublens.operators.columns import (
    ColumnSpec,
    clean_columns,
    keep_all,
    rename_columns,
    resolve_id,
    target_mapping,
)
from scrublens.sources.tables import read_table, scratch_path, write_table


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame(
        [
            (1, "a!b", "x#", 1.5, datetime.datetime(2020, 1, 2, 3, 4, 5), ["s!"], None),
            (2, None, "y", None, None, None, "n!"),
        ],
        "id int, a string, b string, d double, t timestamp, l array<string>, `odd.name` string",
    )


def test_rename_swap_and_copy(mixed):
    names = {"b": "a", "a": "b", "c": "a", "id": "id"}
    specs = [ColumnSpec(origin, name) for name, origin in names.items()]
    out = rename_columns(mixed, specs)
    assert out.columns == ["b", "a", "c", "id"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [
        ("a!b", "x#", "a!b", 1),
        (None, "y", None, 2),
    ]


def test_unknown_origin(mixed):
    with pytest.raises(ValueError, match="nope"):
        rename_columns(mixed, [ColumnSpec("nope", "x")])


def test_type_gate(mixed):
    out = clean_columns(mixed, keep_all(mixed), text.remove_all_special)
    first, second = out.orderBy("id").collect()
    assert (first.a, first.b, first["odd.name"]) == ("a b", "x ", None)
    assert (first.d, first.t, first.l) == (1.5, datetime.datetime(2020, 1, 2, 3, 4, 5), ["s!"])
    assert (second.a, second["odd.name"]) == (None, "n ")


def test_only_and_skip(mixed):
    specs = [ColumnSpec("a", "a"), ColumnSpec("b", "z")]
    narrowed = clean_columns(mixed, specs, text.remove_all_special, only=["a"]).collect()
    assert sorted((r.a or "", r.z) for r in narrowed) == [("", "y"), ("a b", "x#")]
    skipped = clean_columns(mixed, specs, text.remove_all_special, skip=["z"]).collect()
    assert sorted(r.z for r in skipped) == ["x#", "y"]


def test_target_mapping():
    specs = [ColumnSpec("a", "x"), ColumnSpec("a", "y"), ColumnSpec("b", "b")]
    assert target_mapping(specs, ["b", "a", "gone"]) == {"b": "b", "a": "x"}


def test_resolve_id(mixed):
    assert resolve_id(mixed, mixed) == "id"
    other = mixed.withColumnRenamed("id", "_idx")
    assert resolve_id(other, other) == "_idx"
    with pytest.raises(ValueError, match="_idx"):
        resolve_id(mixed, other)


def test_count_and_size(spark, mixed):
    df = spark.createDataFrame([("é", 10, None), (None, 7, "ab")], "s string, n int, t string")
    assert tables.row_count(df).first().row_count == 2
    assert tables.size_bytes(df).first().size_bytes == 2 + 2 + 1 + 2
    assert tuple(tables.count_and_size(df).first()) == (2, 7)
    assert tuple(tables.count_and_size(df.limit(0)).first()) == (0, 0)
    assert tables.size_bytes(mixed).first().size_bytes > 0


def test_distinct_and_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 1)], "s string, n int")
    assert tables.distinct_values(df, "s").count() == 2
    assert tables.drop_duplicate_rows(df).count() == 2


def test_keep_first_by_key(spark):
    rows = [(3, "a", "x"), (1, "a", "y"), (1, "a", "b"), (2, None, "z"), (None, None, "w")]
    df = spark.createDataFrame(rows, "id int, k string, v string")
    out = tables.keep_first_by_key(df, ["k"], "id")
    assert out.columns == df.columns
    assert {tuple(r) for r in out.collect()} == {(1, "a", "b"), (None, None, "w")}
    again = tables.keep_first_by_key(df.orderBy(F.col("v").desc()), ["k"], "id")
    assert set(again.collect()) == set(out.collect())  # ties do not depend on the order of rows
    with pytest.raises(ValueError, match="both"):
        tables.keep_first_by_key(df, ["id"], "id")


def test_write_refuses_existing_path(spark, mixed):
    path = scratch_path(spark)
    write_table(mixed, path)
    assert read_table(spark, path).count() == 2
    with pytest.raises(Exception, match="(?i)exists"):
        write_table(mixed, path)
    write_table(mixed, path, mode="append", partition_by=[])
    assert read_table(spark, path).count() == 4


def test_other_formats(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    for fmt in ("orc", "json"):
        path = scratch_path(spark)
        write_table(df, path, fmt, partition_by=["s"])
        assert {(r.id, r.s) for r in read_table(spark, path, fmt).collect()} == {(1, "a"), (2, "b")}


def test_functions_work_on_streams(spark):
    """Cleaners are stateless, so they apply to a streaming table as they are."""
    path = scratch_path(spark)
    df = spark.createDataFrame([(1, "a  b"), (2, "c\n")], "id int, s string")
    write_table(df, path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    cleaned = clean_columns(stream, keep_all(stream), text.clean_space)
    query = cleaned.writeStream.format("memory").queryName("cleaned").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    got = spark.table("cleaned").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "a b"), (2, "c")]


@pytest.mark.parametrize("id_type", ["long", "string", "timestamp", "double"])
def test_keep_first_like_a_sort(spark, id_type):
    """Copies of whole rows, NULL keys and ids, ids of several types, clashing names."""
    import random

    dice = random.Random(3)
    rows = [
        (dice.choice([None, *range(-9, 9)]), dice.choice([None, "a", "b", "c" * 50]), dice.choice([None, 1.5, 2.5]), "x")
        for _ in range(400)
    ]
    df = spark.createDataFrame([*rows, *rows], "_first long, k string, _HIGH double, _tie string")
    df = df.withColumn("_first", F.col("_first").cast("int").cast(id_type))
    out = tables.keep_first_by_key(df, ["k", "_HIGH"], "_first")
    order = "row_number() OVER (PARTITION BY k, _HIGH ORDER BY _first)"
    want = df.selectExpr("*", f"{order} AS n").filter("n = 1").drop("n")
    assert sorted(map(repr, out.collect())) == sorted(map(repr, want.collect()))
    assert out.columns == df.columns
    assert tables.keep_first_by_key(df.limit(0), ["k"], "_first").count() == 0
