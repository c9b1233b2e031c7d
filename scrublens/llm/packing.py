"""Pack documents into training sequences of a fixed window by sum of squares.

Each task packs the documents of its partition as they come. A document is cut into full
windows and a rest. A rest goes to the fill level (including level 0, a new window) for
which the sum of the squares of the numbers of partially filled windows per level becomes
smallest, so no level piles up and most levels find their complement. The numbers stand in
an array with one entry per level; a window that is full leaves it. When the partition
ends, the windows that are still open are poured together, which cuts documents once more
and leaves at most one window per partition short of its length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024

Piece = tuple[int, int, int]  # document number, start, length


class SumOfSquares:
    """The open windows of one task. ``place`` and ``finish`` return the windows they
    close, each a list of pieces in their order."""

    def __init__(self, window: int = WINDOW) -> None:
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(window + 1)]

    def level(self, size: int) -> int:
        """The level to place ``size`` at: least sum of squares, the fuller level in a tie."""
        counts, last = self.counts, self.window - size
        # Moving a window from h to h + size: (N[h] - 1)^2 - N[h]^2 + (N[h+size] + 1)^2 - N[h+size]^2.
        after = 2 * counts[size:] + 1
        after[-1] = 0  # a full window is no longer counted
        before = 1 - 2 * counts[: last + 1]
        before[0] = 0  # new windows are not counted
        change = after + before
        change[1:][counts[1 : last + 1] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def place(self, piece: Piece) -> list[list[Piece]]:
        size = piece[2]
        if size == self.window:
            return [[piece]]
        at = self.level(size)
        pieces = self.open[at].pop() if at else []
        if at:
            self.counts[at] -= 1
        pieces.append(piece)
        if at + size == self.window:
            return [pieces]
        self.open[at + size].append(pieces)
        self.counts[at + size] += 1
        return []

    def finish(self) -> list[list[Piece]]:
        """Pour the open windows together and close them."""
        left = [piece for level in reversed(self.open) for pieces in level for piece in pieces]
        self.__init__(self.window)
        closed: list[list[Piece]] = []
        current, room = [], self.window
        for document, start, length in left:
            while length:
                part = min(length, room)
                current.append((document, start, part))
                start, length, room = start + part, length - part, room - part
                if not room:
                    closed.append(current)
                    current, room = [], self.window
        return [*closed, current] if current else closed


class Encoder:
    """Token ids of a text as bytes, four to an id, little-endian.

    The vocabulary splits words at white space, so a single space between two other
    characters begins a new unit. Units recur, and their ids are remembered, up to
    ``MEMORY`` of them; the table is then begun anew. Long units go to the tokenizer
    itself, others to a faster reader of the same vocabulary. That reader knows no added
    tokens, so a text that holds one goes to the tokenizer whole.
    """

    MEMORY = 400_000
    LONG = 200

    def __init__(self, name: str) -> None:
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        added = sorted({t.content for t in self.whole.get_added_tokens_decoder().values() if t.content})
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.short = tiktoken.Encoding(
            name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.known = _Units(self)

    def unit(self, text: str) -> bytes:
        if len(text) > self.LONG:
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.short.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if self.added and self.added.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.known) > self.MEMORY:
            self.known.clear()
        if _SPACES.search(text):
            first, *others = _BETWEEN.split(text)
        else:
            first, *others = text.split(" ")
        return self.unit(first) + b"".join(map(self.known.__getitem__, others))


_SPACES = re.compile(r"\s\s")
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


class _Units(dict):
    """Ids of units that follow a space."""

    def __init__(self, encoder: Encoder) -> None:
        super().__init__()
        self.encoder = encoder

    def __missing__(self, unit: str) -> bytes:
        ids = self[unit] = self.encoder.unit(" " + unit)
        return ids


def pack(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    tokenizer: str = "byte_bpe_50k",
    end_id: int = 0,
    window: int = WINDOW,
    with_ids: bool = False,
) -> DataFrame:
    """Sequences of at most ``window`` token ids, one row per piece: the id, ``start`` and
    ``length`` of the piece in the document's ids, ``ids_crc32``, ``doc_tokens``, and its
    ``sequence_id`` and ``offset`` there; with ``with_ids`` also the ``ids`` themselves.

    A document's ids are those of its whole text and ``end_id``; a null text counts as
    empty and gives ``end_id`` alone. Rows that repeat a document are packed once for each
    row. Ids may be null or of any type and other columns are not looked at. An empty
    table gives no row. There is no shuffle; a task keeps the ids of the batch at hand and
    of its open windows, a few for each fill level.
    """
    numbers = "".join(f", {name} long" for name in _NUMBERS)
    schema = f"row {docs.schema[id_col].dataType.simpleString()}{numbers}, ids array<int>"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encode = _encoder(tokenizer)
        packer = SumOfSquares(window)
        number = TaskContext.get().partitionId() << 33
        ending = np.array([end_id], "<u4").tobytes()
        # Rests in open windows: id, ids of the rest, where it starts, ids of the document,
        # and how many of its ids are not yet in a closed window.
        held: dict[int, list] = {}
        count = 0
        arrow = None

        def line(row, ids: bytes, start: int, total: int, offset: int) -> tuple:
            shown = np.frombuffer(ids, "<i4") if with_ids else None
            return row, start, len(ids) // 4, zlib.crc32(ids), total, number, offset, shown

        def rows(closed: list[list[Piece]]) -> Iterator[tuple]:
            nonlocal number
            for pieces in closed:
                offset = 0
                for document, start, length in pieces:
                    row, rest, begin, total, left = held[document]
                    part = rest[4 * (start - begin) : 4 * (start - begin + length)]
                    yield line(row, part, start, total, offset)
                    offset += length
                    held[document][4] = left - length
                    if left == length:
                        del held[document]
                number += 1

        def table(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [()] * len(arrow)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

        for batch in batches:
            if arrow is None:
                arrow = pa.schema(
                    [pa.field("row", batch.schema.field(0).type)]
                    + [(n, pa.int64()) for n in _NUMBERS]
                    + [("ids", pa.list_(pa.int32()))]
                )
            done: list[tuple] = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = (encode(text) if text else b"") + ending
                total = len(ids) // 4
                begin = total - total % window
                for start in range(0, begin, window):
                    done.append(line(row, ids[4 * start : 4 * (start + window)], start, total, 0))
                    number += 1
                if begin < total:
                    held[count] = [row, ids[4 * begin :], begin, total, total - begin]
                    done += rows(packer.place((count, begin, total - begin)))
                    count += 1
                if len(done) > 5000:
                    yield table(done)
                    done = []
            yield table(done)
        if arrow is not None:
            yield table(list(rows(packer.finish())))

    picked = docs.select(F.col(id_col).alias("row"), F.col(text_col).alias("text"))
    packed = picked.mapInArrow(run, schema).withColumnRenamed("row", id_col)
    return packed if with_ids else packed.drop("ids")


_NUMBERS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str) -> Encoder:
    """One per Python worker: its table of units serves all tasks the worker runs."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]
