"""Content-defined chunks and fingerprints against plain definitions."""

from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scrublens.llm import chunk_fingerprint as cf
from scrublens.llm import queries
from scrublens.llm.common import table
from tests.conftest import SF_DIR

MASK = 2**64 - 1


def plain_gear(point: int) -> int:
    x = (point + 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & MASK
    return x ^ x >> 31


def plain_boundaries(text: str) -> list[int]:
    """Character by character."""
    found, start = [], 0
    for end in range(1, len(text) + 1):
        window = text[max(0, end - cf.WINDOW) : end]
        value = sum(plain_gear(ord(c)) << i for i, c in enumerate(reversed(window))) & MASK
        size = end - start
        bits = cf.EARLY_BITS if size < cf.USUAL else cf.LATE_BITS
        cut = size >= cf.LEAST and value >> (64 - bits) == 0
        if cut or size == cf.MOST or end == len(text):
            found.append(end)
            start = end
    return found


@given(st.text(max_size=400))
@settings(max_examples=60, deadline=None)
def test_boundaries_like_plain(text):
    assert cf.boundaries(text) == plain_boundaries(text)


def test_boundaries_do_not_depend_on_steps(monkeypatch):
    text = "".join(random.Random(1).choices("abcdefg éß漢😀", k=3000))
    whole = cf.boundaries(text)
    assert whole == plain_boundaries(text)
    assert cf.boundaries(text, whole[20]) == whole[21:]
    monkeypatch.setattr(cf, "STEP", 37)
    assert cf.boundaries(text) == whole
    assert max(b - a for a, b in zip([0, *whole], whole)) <= cf.MOST


def test_an_insertion_moves_only_near_boundaries():
    text = "".join(random.Random(2).choices("abcdefghij klmnop", k=20_000))
    own = cf.shape(text)[1]
    moved = cf.shape("a new beginning " + text[:9000] + "XYZ" + text[9000:])[1]
    assert cf.containment(own, moved) > 0.98
    assert cf.containment(own, cf.shape(text[10_000:] + text[:10_000])[1]) > 0.98
    assert cf.containment(own, cf.shape(text[::-1])[1]) < 0.01
    assert cf.decode(cf.encode(own)) == own
    assert cf.containment({}, {}) == 1 and cf.containment({}, own) == 0 == cf.containment(own, {})


def expected(rows: list[tuple]) -> list[tuple]:
    found = []
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other, changed = (cf.shape(t)[1] for t in (text, after, edited))
        found.append((
            key, len(text), hashlib.sha256(edited.encode()).hexdigest(), cf.encode(own),
            cf.encode(changed), cf.containment(own, changed), cf.containment(own, other),
        ))
    return found


def test_query_over_whole_table(spark):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    rows = sorted(((r.doc_id, r.text or "") for r in docs), reverse=True)
    found = queries.op11_chunk_fingerprints(spark, SF_DIR)
    assert sorted(map(tuple, found.collect()), reverse=True) == expected(rows)


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_odd_rows(spark, partitions):
    """Nulls, empty and very long texts, shared ids, repeated rows, clashing names."""
    long = "long text, " * 30_000
    rows = [
        (9, "the first of all texts"), (7, ""), (5, long), (5, "b" * 200), (5, "b" * 200),
        (3, None), (None, "no id here at all"), (None, None), (2, "x"),
    ]
    schema = "doc_id long, text string, ghost string, bucket int, fingerprint string"
    docs = spark.createDataFrame([(*row, "g", 1, "f") for row in rows], schema)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = list(map(tuple, cf.compare_with_next(docs, "doc_id", "text").collect()))
        ties = docs.selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS tie")
        order = sorted(ties.collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.tie))
        assert sorted(found, key=repr) == sorted(expected([(r[0], r[1]) for r in order]), key=repr)
        assert cf.compare_with_next(docs.limit(0), "doc_id", "text").count() == 0
        single = cf.compare_with_next(docs.filter("doc_id = 9"), "doc_id", "text").collect()
        assert [(r.doc_id, r.near_next) for r in single] == [(9, 1.0)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    named = cf.fingerprints(docs, "text").collect()
    assert {r.fingerprint for r in named if not r.text} == {""} and len(named) == len(rows)


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "one"), ("a", "two"), ("é", "three")], "doc_id string, text string")
    found = {r.doc_id: r.edited_sha256 for r in cf.compare_with_next(docs, "doc_id", "text").collect()}
    assert found == {i: s for i, _, s, *_ in expected([("é", "three"), ("b", "one"), ("a", "two")])}
