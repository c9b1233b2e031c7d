"""Language-model scores by deleted interpolation.

The probability of a word after another is a mixture of three estimates: the bigram's and
the unigram's relative frequency and the uniform distribution over the vocabulary and one
unknown word. The weights depend on how often the context was seen, in buckets of powers of
two. They are learned by expectation-maximisation on held-out counts: one part of the
training documents is set aside, estimates come from the others, and the weights are those
under which the bigrams set aside are most probable. The model then takes its frequencies
from all training documents.

Documents are dealt into blocks of at most ``BLOCK`` tokens. A block asks for the counts of
its different words, then of its different bigrams. It does so in packets, one for each range
of words or bigrams that it meets: sorted, delta-coded and compressed, first with the block's own
counts and then, after all counts of the range are summed, to be answered in the same order.
Words are numbered on the way, so bigrams are pairs of numbers and counted exactly. The number
of ranges grows with the data: a task holds the sums of one range, or one block. Everything
is counted over all documents; what is sent to the driver (numbers of a few cells) is bounded, the
model's tables are never broadcast, and a step's tables are removed when the next one is written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrublens.llm.common import removed
from scrublens.llm.common import written as written_table

BLOCK = 1 << 18
#: A range is of about so many bytes of text, or bigrams of blocks.
WORD_RANGE, PAIR_RANGE = 1 << 24, 1 << 21
#: Blocks to a task that puts answers to them.
_TOGETHER = 8
BEGIN, END = b"  ", b" "  # not words, as words have no blank
BUCKETS = 48
STEPS = 200
#: For the weights, the ratio of two estimates is taken to 1/RATIO of a power of two.
RATIO = 4
_FEW = 1e-6

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

#: Blocks to a row group of a written table, which is what a reader holds.
_GROUP = 16
#: Rows of a batch handed to Spark.
_BATCH = 64


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers, none negative, in the bytes that they need, compressed."""
    parts = []
    for array in arrays:
        array = np.ascontiguousarray(array, "<u8")
        width = (int(array.max(initial=0)).bit_length() + 7) // 8
        parts.append(np.array([len(array), width], "<u8").tobytes())
        parts.append(array.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    return zstandard.compress(b"".join(parts), 3)


def _unpacked(data: bytes) -> list[np.ndarray]:
    raw, at, arrays = zstandard.decompress(data), 0, []
    while at < len(raw):
        count, width = np.frombuffer(raw, "<u8", 2, at).tolist()
        at += 16
        array = np.zeros((count, 8), np.uint8)
        array[:, :width] = np.frombuffer(raw, np.uint8, count * width, at).reshape(width, count).T
        arrays.append(array.reshape(-1).view("<i8"))
        at += count * width
    return arrays


def written(df: DataFrame, group_rows: int | None = None) -> DataFrame:
    return written_table(df, group_rows, free_shuffles=True)


class _Blocks:
    """Gathers documents into blocks of ``most`` tokens; a long one is cut into several."""

    def __init__(self, number: int, most: int, ranges: int) -> None:
        self.number, self.most, self.ranges = number, most, ranges
        self.clear()

    def clear(self) -> None:
        self.words: dict[bytes, int] = {}
        self.stream: list[np.ndarray] = []
        self.parts: list[tuple] = []  # row, id, tokens, 1: keep, 2: tune, 0: neither
        self.size = 0

    def add(self, row: int, tokens: list[bytes], kind: int, own) -> Iterator[tuple]:
        """``tokens`` from the context of the first one on, of the document with id ``own``."""
        at = 0
        while at < len(tokens) - 1:
            part = tokens[at : at + self.most - self.size + 1]
            words = self.words
            self.stream.append(np.array([words.setdefault(w, len(words)) for w in part], np.int64))
            self.parts.append((row, own, len(part) - 1, kind))
            self.size += len(part) - 1
            at += len(part) - 1
            if self.size >= self.most:
                yield from self.close()

    def close(self) -> Iterator[tuple]:
        """The block itself, and what it asks about its words: block, range, how many bigrams or words,
        packed numbers, words, ids. Its words are numbered by range, then as they sort."""
        if not self.parts:
            return
        rows, ids, size, kind = zip(*self.parts)
        ranged = [(zlib.crc32(word) % self.ranges, word) for word in self.words]
        order = sorted(range(len(ranged)), key=ranged.__getitem__)
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        stream = number[np.concatenate(self.stream)]
        begin = [number[self.words[BEGIN]]] if BEGIN in self.words else []
        data = _packed(stream, size, kind, rows, begin)
        block = _Block(data)
        keep, tune = block.of_words(1), block.of_words(2)
        yield self.number, -1, len(block.first), data, None, ids
        at = 0
        for ranged_to, some in groupby((ranged[i] for i in order), key=lambda pair: pair[0]):
            own = [word for _, word in some]
            upto = at + len(own)
            counts = _packed(keep[at:upto], tune[at:upto])
            yield self.number, ranged_to, len(own), counts, zstandard.compress(b"\n".join(own), 3), None
            at = upto
        self.number += 1
        self.clear()


class _Block:
    """What a block holds, from its packed numbers: the bigrams ``first``, ``second`` of its words'
    numbers, and ``uses``, the bigram of each token."""

    def __init__(self, data: bytes) -> None:
        stream, self.size, self.kind, self.row, self.begin = _unpacked(data)
        ends = np.cumsum(self.size + 1)
        seconds = np.ones(len(stream), bool)
        seconds[ends - self.size - 1] = False
        at = np.flatnonzero(seconds)
        self.kinds = np.repeat(self.kind, self.size)
        self.tokens = stream[at]
        self.many = int(stream.max(initial=-1)) + 1
        pairs, self.uses = np.unique(stream[at - 1] << 32 | self.tokens, return_inverse=True)
        self.first, self.second = pairs >> 32, pairs & 0xFFFFFFFF

    def of_words(self, kind: int) -> np.ndarray:
        return np.bincount(self.tokens[self.kinds == kind], minlength=self.many)

    def of_pairs(self, kind: int) -> np.ndarray:
        return np.bincount(self.uses[self.kinds == kind], minlength=len(self.first))

    def order(self, number: np.ndarray, ranges: int, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bigrams by range and code: their order, ranges and codes. ``number`` is that of each word
        in all blocks, at most ``top``. Whatever a bigram's first word, its second words are spread over
        all ranges, and the other way round; in a range, the code alone tells bigrams apart."""
        first, second = number[self.first], number[self.second]
        ranged = (first % ranges * 40503 + second) % ranges
        code = first * (top // ranges + 1) + second // ranges
        order = np.lexsort((code, ranged))
        return order, ranged[order], code[order]


def _lines(batches: Iterator) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _made(df: DataFrame, function, schema: str, *fixed) -> DataFrame:
    """Rows from rows, as tuples, a few at a time."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(kinds)
        some = []

        def batch() -> pa.RecordBatch:
            columns = [pa.array(values, field.type) for values, field in zip(zip(*some), wanted)]
            return pa.RecordBatch.from_arrays(columns, schema=wanted)

        for line in function(batches, *fixed):
            some.append(line)
            if len(some) >= _BATCH:
                yield batch()
                some = []
        if some:
            yield batch()

    from pyspark.sql.types import StructType

    kinds = StructType.fromDDL(schema)
    return df.mapInArrow(run, schema)


def _dealt(df: DataFrame, key: str, many: int, *order: str) -> DataFrame:
    """``df`` with the rows of a key in one of ``many`` partitions, in order."""
    to = F.pmod(F.xxhash64(key), F.lit(many)) if key == "block" else F.pmod(key, F.lit(many))
    return df.repartitionById(many, to.cast("int")).sortWithinPartitions(key, *order)


def _blocks(batches: Iterator, most: int, ranges: int) -> Iterator[tuple]:
    row = TaskContext.get().partitionId() << 33
    made = _Blocks(row, most, ranges)
    for own, text, kind in _lines(batches):
        tokens = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
        yield from made.add(row, [BEGIN, *tokens, END], kind, own)
        row += 1
    yield from made.close()


def _count_words(batches: Iterator, ranges: int) -> Iterator[tuple]:
    """Answers to the packets of ``range, phase, block, data, words``, sorted: in phase 0 they are
    summed, in phase 1 answered with the words' numbers and counts. And a line of totals."""
    for ranged, lines in groupby(_lines(batches), key=lambda line: line[0]):
        places: dict[bytes, int] = {}
        counts = np.zeros((2, 1024), np.int64)  # keep, tune
        for _, phase, block, data, words in lines:
            words = zstandard.decompress(words).split(b"\n")
            if phase == 0:
                at = [places.setdefault(word, len(places)) for word in words]
                if len(places) > counts.shape[1]:
                    counts = np.pad(counts, ((0, 0), (0, 2 * len(places) - counts.shape[1])))
                counts[:, at] += _unpacked(data)
            else:
                at = np.array([places[word] for word in words])
                keep, tune = counts[:, at]
                yield ranged, block, _packed(at * ranges + ranged, keep, keep + tune), *[None] * 7
        keep, train = counts[0], counts.sum(axis=0)
        end = places.get(END)
        ends = (0, 0) if end is None else (int(keep[end]), int(train[end]))
        numbers = keep.sum(), train.sum(), (keep > 0).sum(), (train > 0).sum(), *ends
        yield ranged, None, None, *map(int, numbers), len(places) * ranges


def _numbered(batches: Iterator) -> Iterator[tuple]:
    """Blocks with the answers on their words, from ``block, range, n, data, id``, sorted."""
    for block, lines in groupby(_lines(batches), key=lambda line: line[0]):
        _, _, n, data, ids = next(lines)
        answers = [_unpacked(line[3]) for line in lines]
        yield block, n, data, _packed(*map(np.concatenate, zip(*answers))), ids


def _ask_pairs(batches: Iterator, ranges: int, top: int) -> Iterator[tuple]:
    for block, data, words in _lines(batches):
        made = _Block(data)
        order, ranged, code = made.order(_unpacked(words)[0], ranges, top)
        keep, tune = made.of_pairs(1)[order], made.of_pairs(2)[order]
        cuts = np.flatnonzero(np.diff(ranged, prepend=-1, append=ranges))
        for a, b in zip(cuts[:-1], cuts[1:]):
            where, own = int(ranged[a]), code[a:b]
            yield where, 1, block, _packed(np.diff(own, prepend=0))
            learned = np.flatnonzero(keep[a:b] + tune[a:b])
            if len(learned):
                counts = keep[a:b][learned], tune[a:b][learned]
                yield where, 0, block, _packed(np.diff(own[learned], prepend=0), *counts)


class _Sums:
    """Sums of counts by code. New ones are merged when they are as many as the old ones."""

    def __init__(self) -> None:
        self.codes, self.counts = np.zeros(0, np.int64), np.zeros((2, 0), np.int64)
        self.new: list[list[np.ndarray]] = []
        self.many = 0

    def add(self, codes: np.ndarray, keep: np.ndarray, tune: np.ndarray) -> None:
        self.new.append([codes, keep, tune])
        self.many += len(codes)
        if self.many > max(len(self.codes), 1 << 18):
            self.merge()

    def merge(self) -> None:
        lines = [[self.codes, *self.counts], *self.new]
        codes, *counts = (np.concatenate(column) for column in zip(*lines))
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        starts = np.flatnonzero(np.diff(codes, prepend=-1))
        self.codes = codes[starts]
        if len(starts):
            self.counts = np.stack([np.add.reduceat(count[order], starts) for count in counts])
        self.new, self.many = [], 0

    def of(self, codes: np.ndarray) -> np.ndarray:
        if self.new:
            self.merge()
        if not len(self.codes):
            return np.zeros((2, len(codes)), np.int64)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.counts[:, at], 0)


def _count_pairs(batches: Iterator) -> Iterator[tuple]:
    for ranged, lines in groupby(_lines(batches), key=lambda line: line[0]):
        sums = _Sums()
        for _, phase, block, data in lines:
            codes, *counts = _unpacked(data)
            codes = np.cumsum(codes)
            if phase == 0:
                sums.add(codes, *counts)
            else:
                keep, tune = sums.of(codes)
                yield ranged, block, _packed(keep, keep + tune)


def _answered(batches: Iterator, ranges: int, top: int) -> Iterator[tuple]:
    """Blocks with the counts of their words and bigrams, from ``block, range, data, words, id``."""
    for _, lines in groupby(_lines(batches), key=lambda line: line[0]):
        _, _, data, words, ids = next(lines)
        number, *of_words = _unpacked(words)
        answers = [_unpacked(line[2]) for line in lines]
        order, _, _ = _Block(data).order(number, ranges, top)
        found = []
        for counts in map(np.concatenate, zip(*answers)):
            found.append(np.empty_like(counts))
            found[-1][order] = counts
        yield data, _packed(*of_words, *found), ids


def _estimates(block: _Block, word: np.ndarray, pair: np.ndarray, begun: int, total: int, vocabulary: int):
    """Bucket of the context, and the three estimates, for each bigram of a block, from the
    counts of its words and bigrams. ``begun`` is that of the context that begins a document."""
    first, second = block.first, block.second
    # Only the beginning of a text is no second word of any bigram; it may also be a context
    # in a block that goes on with a cut document.
    before = np.where(np.isin(first, block.begin), begun, word[first])
    bucket = np.frexp(before.astype(float))[1]
    unigram = word[second] / max(total, 1)
    bigram = pair / np.maximum(before, 1)
    uniform = np.full(len(first), 1 / (vocabulary + 1))
    return bucket, np.stack([uniform, unigram, bigram])


def learned_weights(cells: np.ndarray) -> np.ndarray:
    """Weights by bucket of the context's count: one row for each, three columns. ``cells``:
    bucket, the three estimates up to a factor, and how often. Expectation-maximisation;
    a little of a count is given to each weight, so none is zero. Buckets without counts
    take the weights of all together; without any context there is no bigram estimate."""
    bucket, chance, often = cells[:, 0].astype(int), cells[:, 1:4], cells[:, 4]

    def maximise(rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
        weights = begin
        for _ in range(STEPS):
            parts = chance[rows] * weights
            parts *= (often[rows] / parts.sum(axis=1))[:, None]
            sums = parts.sum(axis=0) + _FEW * begin
            new = sums / sums.sum()
            if np.abs(new - weights).max() < 1e-9:
                return new
            weights = new
        return weights

    whole = np.full(3, 1 / 3)
    if len(cells):
        whole = np.maximum(maximise(np.ones(len(cells), bool), whole), 1e-9)
    weights = np.tile(whole / whole.sum(), (BUCKETS + 1, 1))
    for b in np.unique(bucket):
        found = np.maximum(maximise(bucket == b, weights[b]), 1e-9)
        weights[b] = found / found.sum()
    weights[0, :2] += weights[0, 2] / 2
    weights[0, 2] = 0
    return weights / weights.sum(axis=1, keepdims=True)


def _cells(answered: DataFrame, begun: int, total: int, vocabulary: int) -> np.ndarray:
    """The held-out bigrams counted by bucket and by the ratios of their estimates. All are
    counted; the number of cells is bounded by the resolution of the ratios."""

    def run(batches: Iterator) -> Iterator[tuple]:
        for data, counts in _lines(batches):
            block, (word, _, pair, _) = _Block(data), _unpacked(counts)
            often = block.of_pairs(2)
            some = often > 0
            bucket, chance = _estimates(block, word, pair, begun, total, vocabulary)
            ratio = chance[1:, some] / chance[0, some]
            with np.errstate(divide="ignore"):
                steps = np.where(ratio > 0, np.round(np.log2(ratio) * RATIO), -9999).astype(int)
            frame = pd.DataFrame(
                {"bucket": bucket[some], "one": steps[0], "two": steps[1], "often": often[some]}
            )
            sums = frame.groupby(["bucket", "one", "two"], as_index=False).sum()
            yield from sums.itertuples(index=False, name=None)

    counted = _made(answered.select("data", "counts"), run, "bucket int, one int, two int, often long")
    rows = counted.groupBy("bucket", "one", "two").agg(F.sum("often").alias("often")).toPandas()
    rows = rows.sort_values(["bucket", "one", "two"])

    def chance(steps: pd.Series) -> np.ndarray:
        return np.where(steps > -9999, np.exp2(steps.to_numpy(float) / RATIO), 0.0)

    return np.column_stack(
        [rows["bucket"], np.ones(len(rows)), chance(rows["one"]), chance(rows["two"]), rows["often"]]
    )


def _exchanged(rows: DataFrame, most: int, word_ranges: int):
    """Totals, and the blocks with the counts of their words and bigrams: ``data, counts, id``."""
    ids = f"id array<{rows.schema['id'].dataType.simpleString()}>"
    made = written(
        _made(
            rows.select("id", "text", "kind"),
            _blocks,
            f"block long, range int, n long, data binary, words binary, {ids}",
            most,
            word_ranges,
        ),
        _GROUP,
    )
    phase = F.explode(F.array(F.lit(0), F.lit(1))).alias("phase")
    asked = made.filter("range >= 0").select("range", phase, "block", "data", "words")
    asked = asked.withColumn("data", F.when(F.col("phase") == 0, F.col("data")))
    totals = "keep long, train long, keep_types long, train_types long, keep_docs long, train_docs long, top long"
    found = written(
        _made(
            _dealt(asked, "range", word_ranges, "phase", "block"),
            _count_words,
            f"range int, block long, data binary, {totals}",
            word_ranges,
        )
    )
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in found.columns[3:9]]
    of = found.filter("block IS NULL").agg(*sums, F.coalesce(F.max("top"), F.lit(1)).alias("top")).first()
    bodies = made.filter("range < 0")
    held = bodies.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs")).first()
    tasks, pair_ranges = held.blocks // _TOGETHER + 1, held.pairs // PAIR_RANGE + 1

    nothing = F.lit(None)
    both = bodies.select("block", "range", "n", "data", "id").unionByName(
        found.filter("block IS NOT NULL").select(
            "block", "range", nothing.cast("long").alias("n"), "data", nothing.cast(ids[3:]).alias("id")
        )
    )
    schema = f"block long, n long, data binary, words binary, {ids}"
    numbered = written(_made(_dealt(both, "block", tasks, "range"), _numbered, schema), _GROUP)
    removed(made, found)

    asked = _made(
        numbered.select("block", "data", "words"),
        _ask_pairs,
        "range long, phase int, block long, data binary",
        pair_ranges,
        of.top,
    )
    found = written(
        _made(
            _dealt(asked, "range", pair_ranges, "phase", "block"),
            _count_pairs,
            "range long, block long, data binary",
        )
    )
    both = numbered.select("block", F.lit(-1).cast("long").alias("range"), "data", "words", "id").unionByName(
        found.select("block", "range", "data", nothing.cast("binary").alias("words"), nothing.cast(ids[3:]).alias("id"))
    )
    schema = f"data binary, counts binary, {ids}"
    dealt = _dealt(both, "block", tasks, "range")
    answered = written(_made(dealt, _answered, schema, pair_ranges, of.top), _GROUP)
    removed(numbered, found)
    return of, answered


def score_texts(
    docs: DataFrame, id_col: str, text_col: str, train: Column, tune: Column
) -> DataFrame:
    """One row for each row of ``docs``: the id, ``n_tokens``, ``n_known`` (tokens that
    occur in training documents), ``train_tokens``, ``base_score`` (log10 probability of the
    text under its unigrams, each count raised by a half) and ``score`` (under the model).

    Tokens are words, A-Z lower-cased, and one end for each text; null counts as empty, which
    is the end alone. The model learns from rows for which ``train`` holds; of these, those
    for which ``tune`` holds are the held-out ones of the weights. Without training rows
    every word is unknown; without held-out rows the three estimates weigh the same.
    Repeated rows count as often as they occur and are each scored. An empty table gives no
    row; other columns are not looked at.
    """
    kind = F.when(~F.coalesce(train, F.lit(False)), 0).when(F.coalesce(tune, F.lit(False)), 2)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        kind.otherwise(1).alias("kind"),
    )
    kind_of = rows.schema["id"].dataType.simpleString()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    of, answered = _exchanged(rows, BLOCK, size // WORD_RANGE + 1)
    weights = learned_weights(_cells(answered, of.keep_docs, of.keep, of.keep_types))
    total, types, begun = of.train, of.train_types, of.train_docs

    def run(batches: Iterator) -> Iterator[tuple]:
        for data, counts, ids in _lines(batches):
            block, (_, word, _, pair) = _Block(data), _unpacked(counts)
            bucket, chance = _estimates(block, word, pair, begun, total, types)
            model = np.log10((weights[bucket].T * chance).sum(axis=0))
            count = word[block.second]
            base = np.log10((count + 0.5) / (total + 0.5 * (types + 1)))
            starts = np.cumsum(block.size) - block.size
            each = ((count > 0).astype(np.int64), base, model)
            sums = (np.add.reduceat(values[block.uses], starts).tolist() for values in each)
            yield from zip(block.row.tolist(), ids, block.size.tolist(), *sums)

    parts = _made(
        answered, run, f"row long, id {kind_of}, n long, known long, base double, model double"
    )
    # A document that was cut is in several blocks.
    sums = parts.groupBy("row").agg(
        F.first("id").alias("id"),
        F.sum("n").alias("n_tokens"),
        F.sum("known").alias("n_known"),
        F.sum("base").alias("base_score"),
        F.sum("model").alias("score"),
    )
    return sums.select(
        F.col("id").alias(id_col),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
