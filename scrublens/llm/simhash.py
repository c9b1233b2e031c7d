"""Near duplicates by SimHash and a generalised pigeonhole search.

A fingerprint has 64 bits. Two fingerprints link if they differ in at most ``radius`` bits.
The bits are dealt into parts, bits that tend to agree together into one part. If part i
has a threshold t_i >= -1 and the thresholds add up to ``radius - parts + 1``, then of any
two fingerprints that link, some part differs in at most t_i bits (-1: never looked at). So
each part is probed with the values within its threshold, and every pair found is verified.

How many parts there are and how the thresholds fall is settled by dynamic programming
over estimates that cover all fingerprints: the probes a part needs at a threshold, and the
candidates it brings, from the share of ones of each bit and the number of fingerprints.
Whatever it settles on, the same links are found.

Copies share a fingerprint and are one entry of the search, however many they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrublens.llm.common import keep_rows, row_key, written
from scrublens.llm.components import components

BITS = 64
RADIUS = 4
WORDS = 4
SEED = 42
_STEP = 1 << 15  # shingles whose bits are counted together
#: A candidate costs about as much as this many probes, which are dealt out and sorted.
_CANDIDATE_COST = 0.2


# --- fingerprints -----------------------------------------------------------


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Over the shingles of ``words`` words, A-Z lower-cased, a bit for each position that
    is set in over half of their hashes. Fewer words are one shingle; none give 0."""
    import xxhash

    if not text:
        return 0
    parts = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not parts:
        return 0
    line = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    n = max(1, len(parts) - words + 1)
    last = ends[min(words, len(parts)) - 1 :][:n]
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, n, _STEP):
        pairs = zip(begins[at : at + _STEP].tolist(), last[at : at + _STEP].tolist())
        found = [digest(line[a:b], SEED) for a, b in pairs][: n - at]
        octets = np.array(found, np.uint64).view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view(np.uint64)[0])


_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> DataFrame:
    """``id, fp`` for each row; ``fp`` holds the bits as a signed whole number."""

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.fromiter((fingerprint(t, words) for t in texts), np.uint64, len(texts))
            yield pd.Series(found.view(np.int64))

    return docs.select(F.col(id_col).alias("id"), hashed(F.col(text_col)).alias("fp"))


# --- parts and thresholds ---------------------------------------------------


@dataclass(frozen=True)
class Part:
    """Bits of a fingerprint that are probed together, and within how many of them."""

    bits: tuple[int, ...]
    threshold: int


def bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and for each two bits how many have both. Each task
    sends one matrix of 64 x 64, and these are added up before the driver sees them."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = np.zeros((BITS, BITS))
        rows = 0
        for batch in batches:
            octets = batch["fp"].to_numpy(np.int64).view(np.uint8).reshape(-1, 8)
            ones = np.unpackbits(octets, axis=1, bitorder="little").astype(np.float32)
            for at in range(0, len(ones), 1 << 20):  # sums stay exact
                step = ones[at : at + (1 << 20)]
                both += step.T @ step
            rows += len(ones)
        cells = np.concatenate([both.ravel(), [rows]]).astype(np.int64)
        yield pd.DataFrame({"cell": np.arange(len(cells)), "n": cells})

    parts = prints.select("fp").mapInPandas(count, "cell long, n long")
    found = parts.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    cells = np.zeros(BITS * BITS + 1)
    cells[found["cell"].to_numpy()] = found["n"].to_numpy()
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def _grouped_bits(rows: int, both: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Bits in ``parts`` groups of about equal size; each takes in turn the bit that is
    correlated most with those it has."""
    ones = np.diag(both) / max(rows, 1)
    spread = np.sqrt(np.maximum(ones * (1 - ones), 1e-12))
    related = np.abs(both / max(rows, 1) - np.outer(ones, ones)) / np.outer(spread, spread)
    free = list(range(BITS))
    groups = []
    for i in range(parts):
        size = BITS // parts + (i < BITS % parts)
        group = [free.pop(0)]
        while len(group) < size:
            best = max(free, key=lambda bit: (related[bit, group].sum(), -bit))
            free.remove(best)
            group.append(best)
        groups.append(tuple(sorted(group)))
    return groups


def _near_share(ones: np.ndarray, threshold: int) -> float:
    """Estimated share of pairs that differ in at most ``threshold`` of these bits."""
    differ = 2 * ones * (1 - ones)
    chances = np.zeros(len(ones) + 1)
    chances[0] = 1.0
    for p in differ:
        chances[1:] = chances[1:] * (1 - p) + chances[:-1] * p
        chances[0] *= 1 - p
    return float(chances[: threshold + 1].sum())


def plan_parts(rows: int, both: np.ndarray, radius: int = RADIUS) -> list[Part]:
    """The parts and thresholds of least estimated cost."""
    ones = np.diag(both) / max(rows, 1)
    best: tuple[float, list[Part]] | None = None
    for parts in range(2, radius + 2):
        groups = _grouped_bits(rows, both, parts)

        def cost(group: tuple[int, ...], t: int) -> float:
            if t < 0:
                return 0.0
            probes = sum(comb(len(group), k) for k in range(t + 1))
            near = _near_share(ones[list(group)], t)
            return rows * probes + _CANDIDATE_COST * rows * rows * near

        # chosen[s]: least cost and thresholds of the parts so far, adding up to s - parts.
        chosen: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for group in groups:
            nexts: dict[int, tuple[float, tuple[int, ...]]] = {}
            for total, (paid, picked) in chosen.items():
                for t in range(-1, radius + 1):
                    option = (paid + cost(group, t), (*picked, t))
                    if total + t not in nexts or option < nexts[total + t]:
                        nexts[total + t] = option
            chosen = nexts
        paid, picked = chosen[radius - parts + 1]
        if best is None or paid < best[0]:
            best = paid, [Part(g, t) for g, t in zip(groups, picked)]
    return best[1]


def _value(fp: Column, bits: tuple[int, ...]) -> Column:
    mask = sum(1 << bit for bit in bits)
    return fp.bitwiseAND(F.lit(mask - (1 << BITS) if mask >> 63 else mask))


def _flips(part: Part) -> list[int]:
    """Masks that change at most ``threshold`` of the part's bits."""
    masks = [
        sum(1 << bit for bit in chosen)
        for k in range(part.threshold + 1)
        for chosen in combinations(part.bits, k)
    ]
    return [mask - (1 << BITS) if mask >> 63 else mask for mask in masks]


def _key(number: int, value: Column) -> Column:
    return F.struct(F.lit(number).alias("part"), value.alias("value"))


def _probes(number: int, part: Part) -> Column:
    """The values of the part within its threshold of a's."""
    own = _value(F.col("a"), part.bits)
    flips = F.array(*(F.lit(mask).cast("long") for mask in _flips(part)))
    return F.transform(flips, lambda mask: _key(number, own.bitwiseXOR(mask)))


def links(prints: DataFrame, parts: list[Part], radius: int = RADIUS) -> DataFrame:
    """All pairs ``a < b`` of the different fingerprints that differ in at most ``radius``
    bits. A probe meets an entry by an equi-join on the part and its value; the pair is
    verified where it is found, so candidates are neither written nor shuffled."""
    used = [(i, part) for i, part in enumerate(parts) if part.threshold >= 0]
    entries = F.array(*(_key(i, _value(F.col("b"), part.bits)) for i, part in used))
    probes = F.concat(*(_probes(i, part) for i, part in used))
    index = prints.select(F.col("fp").alias("b")).select("b", F.inline(entries))
    asked = prints.select(F.col("fp").alias("a")).select("a", F.inline(probes))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    same = (F.col("p.part") == F.col("e.part")) & (F.col("p.value") == F.col("e.value"))
    met = asked.alias("p").join(index.alias("e"), same & (F.col("a") < F.col("b")) & near)
    return met.select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str, text_col: str, words: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """One row for each row of ``docs``: the id, its ``fingerprint`` (16 hexadecimal
    digits) and ``component_id``, the smallest id that can be reached by links.

    A text without words, null included, has the fingerprint zero and links like any
    other. Rows that repeat an id are each hashed and linked; a null id is reported with
    its component but never stands for one that has other ids. An empty table gives no
    row; other columns are not looked at.
    """
    prints = written(fingerprints(docs, id_col, text_col, words))
    different = written(
        prints.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    )
    rows, both = bit_counts(different)
    pairs = links(different, plan_parts(rows, both, radius), radius)
    groups = components(pairs)
    grouped = different.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    firsts = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    of_print = written(grouped.join(firsts, "component").select("fp", "component_id"))
    return prints.join(of_print, "fp").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def drop_near_duplicates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component (null before all
    others), with all their columns. Rows are told apart by id and text."""
    keyed = docs.withColumn("_row", row_key(id_col, text_col))
    found = near_duplicates(keyed, "_row", text_col)
    dropped = found.filter("_row != component_id").select("_row").distinct()
    return keep_rows(keyed, dropped, "_row", "left_anti").drop("_row")
