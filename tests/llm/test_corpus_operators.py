"""The other operators and the pipeline against SQL, brute force and round trips."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from scrublens.llm import decontamination, exact_dedup, language_id, packing, queries, simhash, warc
from scrublens.llm.common import table
from tests.conftest import SF_DIR

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (4, "a b"), (None, "ab"), (7, "é" * 9000), (8, "é" * 9000 + " ")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", 0) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, name string, level int")


@pytest.mark.parametrize("name", queries.SQL)
def test_like_sql(spark, name):
    con = duckdb.connect()
    for view in ("documents", "pages"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SF_DIR}/{view}.parquet'")
    df = queries.QUERIES[name](spark, SF_DIR)
    names = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({queries.SQL[name]})").fetchall()
    got = [tuple(row) for row in df.select(*names).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_exact_duplicates_of_odd_rows(odd):
    found = exact_dedup.exact_duplicates(odd, "doc_id", "text", block=16)
    rows = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in found.collect()}
    assert rows == {
        (1, 3, 3, False), (2, 3, 3, False), (3, 3, 3, True),
        (4, 4, 3, True), (None, 4, 3, False), (7, 8, 2, False), (8, 8, 2, True),
    }
    assert found.count() == len(ODD)
    assert exact_dedup.exact_duplicates(odd.limit(0), "doc_id", "text").count() == 0


def test_near_duplicates_like_all_pairs(spark, odd):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text").limit(200)
    found = simhash.near_duplicates(docs, "doc_id", "text").collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in found}
    for doc in docs.limit(20).collect():
        assert prints[doc.doc_id] == simhash.fingerprint(doc.text) % 2**64
    best = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a, b in ((a, b) for a in prints for b in prints):
            if (prints[a] ^ prints[b]).bit_count() <= 4 and best[a] > best[b]:
                best[a], changed = best[b], True
    assert {r.doc_id: r.component_id for r in found} == best
    rows = simhash.near_duplicates(odd, "doc_id", "text").collect()
    assert len(rows) == len(ODD)
    assert {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert simhash.near_duplicates(odd.limit(0), "doc_id", "text").count() == 0


def test_planned_thresholds_miss_no_pair():
    rng = np.random.default_rng(2)
    both = rng.random((64, 64)) * 100
    both = (both + both.T) / 2
    for rows in (10, 10_000, 10_000_000):
        parts = simhash.plan_parts(rows, both)
        assert sorted(b for p in parts for b in p.bits) == list(range(64))
        assert sum(p.threshold for p in parts) == simhash.RADIUS - len(parts) + 1


def test_pieces_hold_each_token_once(spark, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, "doc_id", "text").collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for doc in docs.collect():
        ids = whole.encode(doc.text or "", add_special_tokens=False).ids + [0]
        at = 0
        for p in sorted(by_doc[doc.doc_id], key=lambda p: p.start):
            part = np.array(ids[at : at + p.length], "<u4").tobytes()
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(part))
            at += p.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    tokens = sum(p.length for p in pieces)
    assert len(by_sequence) * 1024 - tokens < 0.02 * tokens + 8 * 1024
    assert packing.pack(odd, "doc_id", "text").filter("start = 0").count() == len(ODD)


def test_added_tokens_in_a_text_are_one_id():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.Encoder("byte_bpe_50k")
    for text in ("x <|endoftext|>y", "<|endoftext|>", "a  <|endoftext|>\n b", "plain <|endoftex words"):
        want = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == want
    assert 50256 in np.frombuffer(encode("x <|endoftext|>y"), "<u4")


def test_planted_passages_are_found_and_others_left(spark):
    item = "If Anna buys 12 apples and 5 pears at the market on Monday, how many pieces of fruit does she carry home?"
    other = item.replace("12", "31").replace("Anna", "Peter")
    noise = "Some quite ordinary words that stand before and after the passage in question here. "
    docs = [(1, noise + item), (2, noise + other + " " + noise), (3, noise), (4, None), (5, ""), (5, "")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(9, item), (8, None)], "item_id long, text string")
    found = decontamination.contaminated(docs, "doc_id", "text", items, "item_id", "text").collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 9), (2, 9)}
    kept = decontamination.drop_contaminated(docs, "doc_id", "text", items, "item_id", "text")
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 5]
    none = decontamination.contaminated(docs, "doc_id", "text", items.limit(0), "item_id", "text")
    assert none.count() == 0


def _found(spark, items, docs):
    items = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = decontamination.contaminated(rows, "doc_id", "text", items, "item_id", "text").collect()
    return {(r.doc_id, r.item_id) for r in found}


def test_names_do_not_depend_on_what_stands_before(spark):
    france = "What is the capital city of France?"
    tom = "Tom runs 5 km in the park before school. Tom rests and then runs 3 km home again."
    slots = "In the morning Anna, Bert, Carla, Dora and Emil carry 12 boxes to the house and eat lunch there."
    docs = ["Question: " + france, "read this now " + france, tom.replace("Tom", "Mia"), tom.replace("Tom", "Mary Ann")]
    docs += [slots.replace(" ", "\n"), slots.lower(), slots.lower().replace("12", "31"), "x\u00a0" + slots.replace(" ", "\u00a0")]
    found = _found(spark, [france, tom, slots], [*docs, "Some clean words of a text that holds none of them."])
    assert found == {(0, 0), (1, 0), (2, 1), (3, 1), (4, 2), (5, 2), (6, 2), (7, 2)}


def test_no_item_is_left_out(spark):
    items = [
        "What Was The First Name Of The Famous Author Of This Book",
        "12 km + 7 km = 19 km",
        "Define entropy.",
        "\u6cd5\u56fd\u7684\u9996\u90fd\u662f\u54ea\u91cc\uff1f",
    ]
    docs = [f"Words before. {item} Words after it." for item in items[:3]] + ["\u95ee\u9898\uff1a" + items[3] + "\u7b54\u6848"]
    assert _found(spark, items, [*docs, "Words before. Words after it."]) == {(i, i) for i in range(4)}


def test_passages_with_words_put_in_and_halves(spark):
    long, longer = (" ".join(f"{stem}{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(n)) for stem, n in (("wo", 24), ("za", 200)))
    words = long.split()
    docs = [" ".join([*words[:12], "extra", *words[12:]]), " ".join([*words[:11], *words[13:]]), " ".join(words[:14])]
    docs += ["before " + " ".join(longer.split()[50:63]) + " after", "before " + " ".join(longer.split()[50:62]) + " after"]
    assert _found(spark, [long, longer], docs) == {(0, 0), (1, 0), (2, 0), (3, 1)}


def test_verbatim_passages_of_the_benchmark(spark):
    found = {(r.doc_id, r.item_id) for r in queries.op2_decontaminate(spark, SF_DIR).collect()}

    def words(text):
        return " " + " ".join(re.findall(r"\w+", (text or "").lower())) + " "

    items = [(r.item_id, words(r.text)) for r in table(spark, SF_DIR, "benchmark").collect()]
    for doc in table(spark, SF_DIR, "documents").select("doc_id", "text").collect():
        text = words(doc.text)
        for item, passage in items:
            if passage in text:
                assert (doc.doc_id, item) in found


def test_languages_of_held_out_documents(spark):
    found = queries.op10_language_id(spark, SF_DIR)
    truth = table(spark, SF_DIR, "documents").select("doc_id", "lang").filter("lang is not null")
    held = found.filter("held_out AND lang_pred != 'und'").join(truth, "doc_id").collect()
    right = sum(row.lang == row.lang_pred for row in held)
    assert len(held) > 20 and right / len(held) > 0.9
    assert found.filter("score < 0 OR score > 1").count() == 0


def test_texts_without_letters_have_no_language(spark):
    rows = [(1, "der die das", "de"), (2, "le la les", "fr"), (3, None, "fr"), (4, "12 !", None), (5, "", "de")]
    docs = spark.createDataFrame(rows, "id int, text string, lang string")
    from pyspark.sql import functions as F

    found = language_id.identify_languages(docs, "text", "lang", F.lit(True)).collect()
    assert {r.id: r.lang_pred for r in found} == {1: "de", 2: "fr", 3: "und", 4: "und", 5: "und"}
    none = language_id.identify_languages(docs, "text", "lang", F.lit(False)).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_archives_give_back_payloads(spark):
    rows = [(3, "u", "x" * 200), (1, "u", "x" * 200), (2, None, None), (4, "u", ""), (5, "u", "é" * 60_000)]
    pages = spark.createDataFrame(rows, "id long, url string, html string")
    found = {r.id: r for r in warc.round_trip(pages, "id", "url", "html").collect()}
    assert {i: (r.payload_bytes, r.record_type, r.refers_to) for i, r in found.items()} == {
        1: (200, "response", None), 3: (200, "revisit", 1), 2: (0, "response", None),
        4: (0, "response", None), 5: (120_000, "response", None),
    }


def test_pipeline_keeps_clean_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR)
        assert after.columns == docs.columns, name
        kept = {r.doc_id for r in after.select("doc_id").collect()}
        given = {r.doc_id: r.text for r in before.select("doc_id", "text").collect()}
        assert kept < given.keys() or kept == set(given), name
        if name == "language":
            assert all(not re.search(r"[^\W\d_]", given[i] or "") for i in given.keys() - kept)
        if name == "exact":
            texts = [re.sub(r"[\x20\x09-\x0D]", "", given[i] or "") for i in kept]
            assert len(texts) == len(set(texts))
            assert {re.sub(r"[\x20\x09-\x0D]", "", t or "") for t in given.values()} == set(texts)
        before = spark.createDataFrame(after.collect(), docs.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == kept


def test_null_and_repeated_ids_lose_no_other_text(spark):
    item = "If Anna buys 12 apples and 5 pears at the market on Monday, how many pieces of fruit does she carry home?"
    one, two, three = ("".join(f"{w}{i} " for i in range(40)) for w in ("red", "blue", "green"))
    rows = [(None, one), (None, two), (None, two), (4, three), (4, item), (4, one + " "), (None, item)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, level int")
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    kept = exact_dedup.drop_exact_duplicates(docs, "doc_id", "text")
    assert kept.columns == docs.columns
    assert sorted(r.text.strip() for r in kept.collect()) == sorted({t.strip() for _, t in rows})
    kept = simhash.drop_near_duplicates(docs.filter("text != ''"), "doc_id", "text")
    assert {r.text.strip() for r in kept.collect()} == {t.strip() for _, t in rows}
    kept = decontamination.drop_contaminated(docs, "doc_id", "text", items, "item_id", "text")
    assert sorted(r.text for r in kept.collect()) == sorted(t for _, t in rows if t != item)


def test_language_stage_keeps_columns_of_any_name(spark):
    docs = table(spark, SF_DIR, "documents")
    plain = corpus_pipeline.language(spark, docs, SF_DIR)
    own = docs.selectExpr("*", "'mine' AS lang_pred", "7 AS score", "1 AS row")
    kept = corpus_pipeline.language(spark, own, SF_DIR)
    assert kept.columns == own.columns
    assert {(r.lang_pred, r.score, r.row) for r in kept.collect()} == {("mine", 7, 1)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in plain.collect())
