"""Fingerprints of texts from the chunks that their own content cuts.

A gear hash runs over a text: each character adds its random number to the shifted hash, and
the last ``WINDOW`` characters decide its top bits. Where these are zero a chunk may end. The
sizes are normalised: below the usual size more bits have to be zero than beyond it, so
sizes gather round the usual one; none is under ``LEAST`` but at the end of the text, none over
``MOST``. An insertion moves the boundaries next to it and no others.

A fingerprint is the set of the chunks' digests, each with its length. What share of a
document is contained in another is the length of the chunks they share, over that of all
its own.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 16  # characters, a power of two
LEAST, USUAL, MOST = 6, 16, 64
EARLY_BITS, LATE_BITS = 5, 3  # zeros wanted below and beyond the usual size
SEED = 11
#: Characters hashed at once. Any value gives the same boundaries.
STEP = 1 << 20

Chunks = dict[int, int]  # digest, length


def gear(points: np.ndarray) -> np.ndarray:
    """A random number for each code point (mixing steps and constants of SplitMix64)."""
    x = points.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gear_hashes(points: np.ndarray) -> np.ndarray:
    """The gear hash after each character: the sum of the last ``WINDOW`` numbers, each
    shifted by its distance. Spans are doubled, so each takes a few additions."""
    hashes = gear(points)
    span = 1
    while span < WINDOW:
        wider = hashes.copy()
        wider[span:] += hashes[:-span] << np.uint64(span)
        hashes, span = wider, 2 * span
    return hashes


def _ends(text: str, start: int) -> tuple[list[int], list[int]]:
    """Where a chunk may end early, and where late, after ``start``."""
    early, late = [], []
    for at in range(start, len(text), STEP):
        # The hash of the first character looks back, not before the text.
        back = max(0, at - WINDOW + 1)
        piece = text[back : at + STEP].encode("utf-32-le", "surrogatepass")
        hashes = gear_hashes(np.frombuffer(piece, np.uint32))[at - back :]
        fits = np.flatnonzero(hashes < np.uint64(1 << (64 - LATE_BITS)))
        late.append(fits + (at + 1))
        early.append(late[-1][hashes[fits] < np.uint64(1 << (64 - EARLY_BITS))])
    never = [1 << 62]
    return np.concatenate([*early, never]).tolist(), np.concatenate([*late, never]).tolist()


def boundaries(text: str, start: int = 0) -> list[int]:
    """The ends of the chunks of ``text`` from ``start``, itself 0 or a boundary."""
    early, late = _ends(text, start)
    found = []
    while start < len(text):
        end = early[bisect_left(early, start + LEAST)]
        if end >= start + USUAL:
            end = min(late[bisect_left(late, start + USUAL)], start + MOST)
        start = min(end, len(text))
        found.append(start)
    return found


def chunks(text: str, ends: list[int]) -> Chunks:
    digest, start, found = xxhash.xxh64_intdigest, 0, {}
    for end in ends:
        found[digest(text[start:end].encode("utf-8", "surrogatepass"), SEED)] = end - start
        start = end
    return found


def encode(found: Chunks) -> str:
    """The set as text: for each chunk, by digest, its digest and length, in base 64."""
    lines = np.zeros(len(found), [("digest", ">u8"), ("length", "u1")])
    lines["digest"] = np.fromiter(found.keys(), np.uint64, len(found))
    lines["length"] = np.fromiter(found.values(), np.uint8, len(found))
    lines = lines[np.argsort(lines["digest"])]
    return base64.b64encode(lines.tobytes()).decode("ascii")


def decode(fingerprint: str) -> Chunks:
    lines = np.frombuffer(base64.b64decode(fingerprint), [("digest", ">u8"), ("length", "u1")])
    return dict(zip(lines["digest"].tolist(), lines["length"].tolist()))


def containment(own: Chunks, other: Chunks) -> float:
    """The share of ``own``, by length, that ``other`` has too. Nothing is in nothing only."""
    if not own:
        return 0.0 if other else 1.0
    return sum(own[digest] for digest in own.keys() & other.keys()) / sum(own.values())


def edited_text(text: str, other: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``other``."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def shape(text: str) -> tuple[list[int], Chunks]:
    """Where the chunks of a text end, and their set."""
    ends = boundaries(text)
    return ends, chunks(text, ends)


def compare(text: str, ends: list[int], own: Chunks, after: str, after_chunks: Chunks) -> tuple:
    """What the operator says of a text and the text after it, beside the id."""
    edited = edited_text(text, after)
    # Boundaries depend on what is before them, so those of the part that is kept stay.
    kept = ends[: bisect_right(ends, len(text) - len(text) // 2)]
    edited_ends = kept + boundaries(edited, kept[-1] if kept else 0)
    edited_chunks = chunks(edited, edited_ends)
    return (
        len(text),
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        encode(own),
        encode(edited_chunks),
        containment(own, edited_chunks),
        containment(own, after_chunks),
    )


# --- on tables ----------------------------------------------------------------


def fingerprints(docs: DataFrame, text_col: str, name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text as column ``name`` (replaced if there is
    one). A null or empty text has the empty fingerprint. Rows are taken one by one."""

    @F.pandas_udf("string")
    def fingerprint(texts):
        return texts.map(lambda text: encode(chunks(text, boundaries(text))))

    return docs.withColumn(name, fingerprint(F.coalesce(F.col(text_col), F.lit(""))))


def compare_with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The next document is that with the next smaller id, after the last the first again; null
    ids come last. Rows that share an id are ordered by a hash of their texts, and rows that
    agree in both are next to each other. A null text counts as empty. A single row is its own
    next. An empty table gives no row. Other columns, whatever their names, are not read.

    Texts are shuffled once. A first pass over the ids alone cuts them into ranges, one for
    each shuffle partition, and the driver keeps two ids for each. The first document of the
    range that comes next is sent to the end of each range as well, so each partition is
    read as a stream with one document in hand.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = rows.select("id").repartitionByRange(count, F.col("id").desc_nulls_last())
    spans = (
        ids.groupBy(F.col("id").isNull().alias("none"), F.spark_partition_id().alias("part"))
        .agg(F.min("id").alias("least"), F.max("id").alias("most"))
        .collect()
    )
    # Ranges in ascending order; null ids make one of their own, before the others.
    ranges = sorted((s for s in spans if not s.none), key=lambda span: -span.part)
    lows = [span.least for span in ranges]
    known = [span.most for span in ranges]  # the documents that are first in their range
    none = len(ranges) < len(spans)
    heads = [None] * none + known
    if not heads:
        return spark.createDataFrame([], _schema(docs, id_col))
    kind = docs.schema[id_col].dataType
    bucket = _bucket(F.col("id"), lows, kind) + int(none)
    bucket = F.when(F.col("id").isNull(), 0).otherwise(bucket).cast("int")
    tie = F.xxhash64("text")
    real = rows.select(bucket.alias("bucket"), F.lit(False).alias("ghost"), "id", tie.alias("tie"), "text")
    # After range k comes range k - 1, after range 0 the last.
    wanted = F.col("id").isin(known) if known else F.lit(False)
    wanted = wanted | F.col("id").isNull() if none else wanted
    head = F.min_by(F.struct("tie", "text"), "tie").alias("head")
    ghosts = (
        real.filter(wanted)
        .groupBy("id", "bucket")
        .agg(head)
        .select(
            ((F.col("bucket") + 1) % len(heads)).alias("bucket"),
            F.lit(True).alias("ghost"),
            "id",
            "head.tie",
            "head.text",
        )
    )
    dealt = real.unionByName(ghosts).repartitionById(count, F.col("bucket"))
    dealt = dealt.sortWithinPartitions("bucket", "ghost", F.col("id").desc_nulls_last(), "tie")
    schema = _schema(docs, id_col)
    return dealt.select("ghost", "id", "text").mapInArrow(_runner(id_col), schema)


def _schema(docs: DataFrame, id_col: str) -> str:
    kind = docs.schema[id_col].dataType.simpleString()
    return (
        f"`{id_col}` {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )


def _bucket(key: Column, lows: list, kind) -> Column:
    """How many of ``lows``, ascending, are at most ``key``, less one: a binary search."""
    table = F.array(*(F.lit(low).cast(kind) for low in lows))
    steps = F.sequence(F.lit(1), F.lit(max(1, len(lows).bit_length())))
    start = F.struct(F.lit(0).alias("low"), F.lit(len(lows)).alias("high"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        over = F.coalesce(F.get(table, middle) <= key, F.lit(False))
        low = F.when(over & (state["low"] < state["high"]), middle).otherwise(state["low"])
        high = F.when(over, state["high"]).otherwise(middle)
        return F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"))

    return F.aggregate(steps, start, halve, lambda state: state["low"])


def _runner(id_col: str):
    names = [
        id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        "near_next",
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row before: its id, its text and the shape of that
        lines: list[tuple] = []
        size = 0

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*lines))
            arrays = [pa.array(columns[0], kind), *map(pa.array, columns[1:])]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            kind = batch.schema.field("id").type
            for ghost, key, text in zip(*batch.columns):
                text = text.as_py()
                ends, own = shape(text)
                if held is not None:
                    lines.append((held[0], *compare(*held[1:], text, own)))
                    size += len(held[1])
                    if size > 1 << 22:
                        yield flush(kind)
                        lines, size = [], 0
                # A range ends with the first row of another one, which begins nothing here.
                held = None if ghost.as_py() else (key.as_py(), text, ends, own)
        if lines:
            yield flush(kind)

    return run
