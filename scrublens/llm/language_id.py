"""Language identification with one bit-sliced Bloom filter for all languages.

The filter is an array of words. Bit l of a word belongs to language l, so the AND of the
words at the hash positions of an n-gram gives, in one go, all languages that contain it.
A document's n-grams are looked up, the bits counted for each language, and each count
freed of the part that false positives explain: with n n-grams, h hits and a false positive
rate f, an estimate of the share that is truly contained is ``(h/n - f) / (1 - f)``. The
language with the greatest share decides; the share is the score.

N-grams are runs of ``GRAM`` characters over the letters of a text, words being divided by
one blank. A language contains those that make up at least ``MIN_RATE`` of its training
n-grams, counted over all training documents, which bounds the filter: no language can
have more than ``1 / MIN_RATE`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GRAM = 3  # three code points of 21 bits fill a 64-bit number, so n-grams never collide
MIN_RATE = 2e-5
HASHES = 4
BITS_PER_GRAM = 16
UNKNOWN = "und"
_SLICE = 1 << 20  # characters looked at together
#: Odd multipliers for the hash positions.
_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64
)


# --- n-grams ----------------------------------------------------------------

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point its lower case if that is one letter, itself if it is another
    letter, 0 for all else."""
    if not _LETTERS:
        codes = np.zeros(0x110000, np.uint64)
        for code in range(0x110000):
            char = chr(code)
            if char.isalpha():
                lower = char.lower()
                codes[code] = ord(lower) if len(lower) == 1 else code
        _LETTERS.append(codes)
    return _LETTERS[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of the texts, one after the other, and the number of each text's."""
    joined = "\0\0".join(texts) + "\0\0"
    codes = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    lengths = np.fromiter((len(text) + 2 for text in texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    text_of = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    begins = np.zeros(len(codes), bool)
    begins[ends - lengths] = True
    letter = codes != 0
    after_letter = np.concatenate([[False], letter[:-1]]) & ~begins
    # Of a run of other characters the first stays, as the blank; a text's last is one.
    kept = letter | after_letter
    codes, text_of = codes[kept], text_of[kept]
    if not len(codes):
        return codes, np.zeros(len(texts), np.int64)
    first = np.concatenate([[True], text_of[1:] != text_of[:-1]])
    before = np.concatenate([[np.uint64(0)], codes[:-1]])
    before[first] = 0
    after = np.concatenate([codes[1:], [np.uint64(0)]])
    middle = codes != 0
    found = (before << np.uint64(42)) | (codes << np.uint64(21)) | after
    return found[middle], np.bincount(text_of[middle], minlength=len(texts))


def _slices(texts: list[str]) -> Iterator[tuple[list[str], list[int]]]:
    """The texts in lists of about ``_SLICE`` characters, with their numbers. A longer
    text comes in parts, cut before a character that is no letter, else anywhere."""
    part, numbers, size = [], [], 0
    for number, text in enumerate(texts):
        while text:
            end = len(text)
            if end > _SLICE:
                end = _SLICE
                while end > _SLICE // 2 and text[end].isalpha():
                    end -= 1
            part.append(text[:end])
            numbers.append(number)
            size += end
            text = text[end:]
            if size >= _SLICE:
                yield part, numbers
                part, numbers, size = [], [], 0
    if part:
        yield part, numbers


# --- learning ---------------------------------------------------------------


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, gram, n`` over all documents with a language. Counts are added up within
    each task first, so the shuffle carries n-grams and not texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for lang, part in batch.groupby("lang", sort=False):
                for texts, _ in _slices(part["text"].tolist()):
                    more = np.unique(grams(texts)[0], return_counts=True)
                    totals[lang] = _added(totals.get(lang), more)
            if sum(len(found) for found, _ in totals.values()) > 2_000_000:
                yield from _flat(totals)
                totals = {}
        yield from _flat(totals)

    named = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).na.drop()
    counted = named.mapInPandas(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _added(old, new):
    if old is None:
        return new
    keys, where = np.unique(np.concatenate([old[0], new[0]]), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, where, np.concatenate([old[1], new[1]]))
    return keys, sums


def _flat(totals) -> Iterator[pd.DataFrame]:
    for lang, (found, n) in totals.items():
        yield pd.DataFrame({"lang": lang, "gram": found.astype(np.int64), "n": n})


@dataclass(frozen=True)
class Filter:
    """``words[s, i]``: the bits of languages 64 s to 64 s + 63 at position i."""

    langs: tuple[str, ...]
    fallback: str
    words: np.ndarray
    false_rates: np.ndarray

    def positions(self, found: np.ndarray) -> np.ndarray:
        shift = np.uint64(64 - int(self.words.shape[1]).bit_length() + 1)
        mixed = found ^ (found >> np.uint64(31))
        return (mixed[None, :] * _ODD[:, None]) >> shift

    def hits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text its hits by language, and its number of n-grams."""
        found, counts = grams(texts)
        hits = np.zeros((len(texts), len(self.langs)), np.int64)
        if len(found):
            at = self.positions(found)
            some = np.flatnonzero(counts)
            starts = (np.cumsum(counts) - counts)[some]
            for s, words in enumerate(self.words):
                all_of = words[at[0]]
                for more in at[1:]:
                    all_of &= words[more]
                for bit in range(min(64, len(self.langs) - 64 * s)):
                    held = ((all_of >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)
                    hits[some, 64 * s + bit] = np.add.reduceat(held, starts)
        return hits, counts

    def decide(self, hits: np.ndarray, counts: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score for each row of hits."""
        if not self.langs:
            return [UNKNOWN] * len(counts), np.zeros(len(counts))
        share = hits / np.maximum(counts, 1)[:, None]
        share = np.clip((share - self.false_rates) / (1 - self.false_rates), 0, 1)
        best = share.argmax(axis=1)
        score = share[np.arange(len(best)), best]
        lang = np.where(score > 0, np.array(self.langs, object)[best], self.fallback)
        return np.where(counts > 0, lang, UNKNOWN).tolist(), np.where(counts > 0, score, 0.0)


def build_filter(counts: DataFrame, min_rate: float = MIN_RATE) -> Filter:
    """The filter from n-gram counts. What reaches the driver is bounded: one row for each
    language, and at most ``1 / min_rate`` n-grams for each."""
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    sizes = {row.lang: row.total for row in totals.collect()}
    langs = tuple(sorted(sizes))
    frequent = counts.join(F.broadcast(totals), "lang").filter(F.col("n") >= F.col("total") * min_rate)
    pairs = frequent.select("lang", "gram").toPandas()
    number = {lang: i for i, lang in enumerate(langs)}
    of = pairs["lang"].map(number).to_numpy(np.int64)
    found = pairs["gram"].to_numpy(np.int64).astype(np.uint64)
    entries = max(1, np.bincount(of).max() if len(of) else 1)
    size = 1 << max(10, int(np.ceil(np.log2(entries * BITS_PER_GRAM))))
    words = np.zeros((max(1, -(-len(langs) // 64)), size), np.uint64)
    fallback = max(langs, key=lambda lang: sizes[lang]) if langs else UNKNOWN
    built = Filter(langs, fallback, words, np.zeros(len(langs)))
    at = built.positions(found)
    for i in range(len(langs)):
        bit = np.uint64(1) << np.uint64(i % 64)
        words[i // 64, at[:, of == i].ravel()] |= bit
    full = [((words[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(langs))]
    return Filter(langs, fallback, words, np.array(full) ** HASHES)


# --- deciding ---------------------------------------------------------------


def predicted(docs: DataFrame, text_col: str, model: Filter) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``. Looks at the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.StructType().add("lang", "string").add("score", "double"))
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            texts = [text or "" for text in batch.tolist()]
            hits = np.zeros((len(texts), len(own.langs)), np.int64)
            counts = np.zeros(len(texts), np.int64)
            for part, numbers in _slices(texts):
                more, n = own.hits(part)
                np.add.at(hits, numbers, more)
                np.add.at(counts, numbers, n)
            lang, score = own.decide(hits, counts)
            yield pd.DataFrame({"lang": lang, "score": score})

    found = docs.withColumn("_found", identify(F.col(text_col)))
    return found.select(
        *docs.columns, F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score")
    )


def identify_languages(
    docs: DataFrame, text_col: str, lang_col: str, train: Column, min_rate: float = MIN_RATE
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), learned from the rows for which
    ``train`` holds and whose text and language are not null.

    A text that is null or has no letter gets ``und`` and 0, as does every text if nothing
    could be learned. A text none of whose n-grams is known gets the language with most
    training n-grams, and 0; among equal scores the first language by name wins. Repeated
    rows are learned from as often as they occur. An empty table gives no row.
    """
    return predicted(docs, text_col, build_filter(gram_counts(docs.filter(train), text_col, lang_col), min_rate))
