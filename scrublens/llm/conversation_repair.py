"""Broken conversations brought into a legal order of turns at least cost.

A legal conversation is empty, or an optional system turn and then user and assistant turns in
pairs. A row is kept, given another role or deleted, and empty turns are inserted. The edits of
a conversation are a derivation: the item (i, state) says that the rows from i on can be
brought to an end from that state of the automaton, and an edit of row i - 1, or an
insertion, deduces one item from another. Knuth's generalisation of Dijkstra's algorithm finds
the lightest derivation: an agenda gives out the least item, which is final then, until the
goal, (0, start), is final.

An item weighs (cost, rows used, edits). A deduction adds to the cost or, if it costs nothing,
to the rows used, so it always weighs more than what it comes from; and since it puts one
letter before the edits, lighter premises never give a heavier conclusion. Rows used are the
same for all derivations of one item, so the least cost wins and then the least edits.

A conversation over several partitions, or of very many rows, is cut into segments. For each
two states a segment has its lightest derivation, and these are the axioms of a second
hypergraph, whose deductions have two premises: neighbouring spans that meet in a state.
Equal spans, states and costs exclude that the edits of one begin those of the other, so
joining them keeps their order too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrublens.llm.common import SPACE, written

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
ENDS = (START, ASSISTANT)
#: From each state, the state that a turn of each role initial leads to.
NEXT = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
#: The role of a turn that may always come next; no state has two.
GIVEN = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
SEGMENT = 256  # rows
LONG = 1024  # rows of a conversation that a task holds at once; more go by segments

EDITS = {"K": "keep", "R": "rerole", "I": "insert", "D": "delete"}

Value = tuple[int, int, str]  # cost, rows (or segments) used, edits


def lightest(
    axioms: Iterable[tuple], deduce: Callable[[tuple, Value, dict], Iterable[tuple]], goal=None
) -> dict:
    """The final values (with what they were deduced from) of all items, or of those that are
    final when ``goal`` is. ``axioms`` and ``deduce`` give (value, item, premises); ``deduce``
    sees an item that has become final and the values of all that are."""
    agenda = list(axioms)
    heapify(agenda)
    final: dict = {}
    while agenda:
        value, item, premises = heappop(agenda)
        if item in final:
            continue
        final[item] = value, premises
        if item == goal:
            break
        for found in deduce(item, value, final):
            heappush(agenda, found)
    return final


@cache
def _edits_into(state: int, initial: str, fault: int) -> tuple[tuple[int, str, int], ...]:
    """From which states a row leads to ``state``: (state, edit, cost)."""
    found = [(state, "D", DELETE)]
    if fault in (BLANK, DUPLICATE):
        return tuple(found)
    short = CUT_SHORT if fault == TRUNCATED else 0
    for before, leads in NEXT.items():
        if leads.get(initial) == state:
            found.append((before, "K", short))
        elif leads[GIVEN[before][0]] == state:
            found.append((before, "R", REROLE + short))
    return tuple(found)


@cache
def _inserts_into(state: int) -> tuple[int, ...]:
    return tuple(before for before in NEXT if NEXT[before][GIVEN[before][0]] == state)


def _rows_from(codes: list[tuple[str, int]], ends: Iterable[int], goal=None) -> dict:
    """The lightest derivations over rows (initial of the role, fault) that end in ``ends``."""
    count = len(codes)

    def deduce(item: tuple, value: Value, final: dict) -> Iterator[tuple]:
        row, state = item
        cost, used, edits = value
        for before in _inserts_into(state):
            if (row, before) not in final:
                yield (cost + INSERT, used, "I" + edits), (row, before), ()
        if row:
            for before, letter, price in _edits_into(state, *codes[row - 1]):
                if (row - 1, before) not in final:
                    yield (cost + price, used + 1, letter + edits), (row - 1, before), ()

    return lightest([((0, 0, ""), (count, end), ()) for end in ends], deduce, goal)


def repair_rows(codes: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and edits of the cheapest repair of a conversation; of equal costs, the edits that
    come first in ASCII order."""
    (cost, _, edits), _ = _rows_from(codes, ENDS, (0, START))[0, START]
    return cost, edits


def segment_matrix(codes: list[tuple[str, int]]) -> tuple[list[int | None], list[str | None]]:
    """Costs and edits from each state before a segment to each after it."""
    costs: list[int | None] = [None] * STATES**2
    edits: list[str | None] = [None] * STATES**2
    for end in range(STATES):
        for (row, state), (value, _) in _rows_from(codes, [end]).items():
            if row == 0:
                costs[state * STATES + end], edits[state * STATES + end] = value[0], value[2]
    return costs, edits


def join_segments(matrices: list[tuple[list, list]]) -> list[tuple[int, int]]:
    """The states before and after each segment in the lightest derivation of all."""
    above: dict[tuple[int, int], tuple] = {}  # span: the span it is in, its middle

    def halve(low: int, high: int) -> None:
        if high - low > 1:
            middle = (low + high) // 2
            for part in ((low, middle), (middle, high)):
                above[part] = (low, high, middle)
                halve(*part)

    count = len(matrices)
    halve(0, count)
    goal = (0, count, START, STATES)
    axioms = [
        ((costs[at], 1, edits[at]), (i, i + 1, *divmod(at, STATES)), ())
        for i, (costs, edits) in enumerate(matrices)
        for at in range(STATES**2)
        if costs[at] is not None
    ]

    def deduce(item: tuple, value: Value, final: dict) -> Iterator[tuple]:
        low, high, first, last = item
        if (low, high) == (0, count):
            if first == START and last in ENDS:
                yield (value[0], value[1] + 1, value[2]), goal, (item,)
            return
        over = above[low, high]
        for state in range(STATES):
            if low == over[0]:
                left, right = item, (over[2], over[1], last, state)
            else:
                left, right = (over[0], over[2], state, first), item
            if left in final and right in final:
                (cost, used, edits), (more, more_used, more_edits) = final[left][0], final[right][0]
                joined = (over[0], over[1], left[2], right[3])
                if joined not in final:
                    yield (cost + more, used + more_used, edits + more_edits), joined, (left, right)

    final = lightest(axioms, deduce, goal)
    chosen, stack = [], [goal]
    while stack:
        item = stack.pop()
        premises = final[item][1]
        if premises:
            stack.extend(reversed(premises))
        else:
            chosen.append(item[2:])
    return chosen


def edited(rows: Iterable[tuple], edits: str, state: int = START) -> Iterator[tuple]:
    """Each edit, the turn number of its row, and the role and text it leaves (null where the
    row is deleted). ``rows`` begin with turn number, role and text."""
    ahead = iter(rows)
    for letter in edits:
        if letter == "I":
            role = GIVEN[state]
            state = NEXT[state][role[0]]
            yield letter, None, role, ""
            continue
        turn, role, text = next(ahead)[:3]
        if letter == "D":
            yield letter, turn, None, None
            continue
        role = GIVEN[state] if letter == "R" else role
        state = NEXT[state][role[0]]
        yield letter, turn, role, text


# --- on tables ----------------------------------------------------------------


def damaged(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows with faults put in: by a checksum of conversation and turn, one in twenty is
    dropped, one emptied, one loses its sentence ends, one is repeated and one gets the role
    ``user``. Null roles, texts and parts of the checksum are one space. Of a dropped row its
    conversation and turn stay, with ``present`` false. Other columns go."""
    blank = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col(conv_col).cast("string"), blank),
        F.lit(":"),
        F.coalesce(F.col(turn_col).cast("string"), blank),
    )
    fault = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce(F.col(text_col), blank), F.coalesce(F.col(role_col), blank)
    rows = turns.select(
        F.col(conv_col),
        F.col(turn_col),
        F.when(fault == 4, "user").when(fault != 0, role).alias(role_col),
        F.when(fault == 1, "")
        .when(fault == 2, F.regexp_replace(text, "[.!?]", ""))
        .when(fault != 0, text)
        .alias(text_col),
        (fault != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


_REPORT = {
    "gaps": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(),
    "illegal": pa.int64(), "cost": pa.int64(), "audit": pa.string(), "repaired_sha256": pa.string(),
}
_REPAIRED = {
    "position": pa.int64(), "edit": pa.string(), "turn": pa.int64(), "role": pa.string(),
    "text": pa.string(),
}
_ROW = {"turn": pa.int64(), "role": pa.string(), "text": pa.string(), "fault": pa.int32(), "mark": pa.binary()}
_PLACE = {"part": pa.int32(), "at": pa.int64(), "present": pa.bool_()}


def repair(
    turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """One row per conversation: its id, ``gaps`` in its turn numbers, rows that are ``blank``,
    ``duplicate`` or ``truncated`` (the first of these that holds), ``illegal`` neighbours,
    ``cost`` and ``audit`` of the cheapest repair and ``repaired_sha256`` of what it leaves.

    Rows are ordered by turn (null first; a whole number, anything else counts as null in
    ``gaps``), then by role and by a digest of role and text. A null role or text is one space.
    Null conversations are one conversation. If there is a boolean column ``present``, rows
    where it is false are no rows, but their conversation has a line. Repeated rows are
    duplicates of the first. An empty table gives no row; other columns are not read.

    Rows are shuffled once, by range, so a long conversation lies in several partitions. A
    partition finishes the conversations that it has whole. Others go on by segments; in
    the end one task reads such a conversation as a stream, since its digest is that of its
    whole text, and holds its edits, a letter for each row.
    """
    return _repaired(turns, conv_col, turn_col, role_col, text_col, "report")


def repaired_turns(
    turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """The repaired conversations: a row for each edit, in order of ``position``, with ``edit``
    (keep, rerole, insert, delete), ``turn`` (null if inserted), and the ``role`` and ``text``
    that stay (null if deleted). Else as ``repair``; conversations without rows have none."""
    return _repaired(turns, conv_col, turn_col, role_col, text_col, "turns")


def _repaired(
    turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, want: str
) -> DataFrame:
    conv_type = turns.schema[conv_col].dataType.simpleString()
    found = written(_pass(_marked(turns, conv_col, turn_col, role_col, text_col), conv_type, want))
    columns = list(_REPORT if want == "report" else _REPAIRED)
    whole = found.filter("kind = 'done'").select("conv", *columns)
    cut = found.filter("kind = 'row'").select("conv", *_ROW, *_PLACE)
    rest = _by_segments(cut, conv_type, want)
    return whole.unionByName(rest).withColumnRenamed("conv", conv_col)


def _marked(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows with the faults that show without other rows, sorted over the partitions."""
    blank = F.lit(" ")
    present = F.col("present") if "present" in turns.columns else F.lit(True)
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("order"),
        F.coalesce(F.col(role_col), blank).alias("role"),
        F.coalesce(F.col(text_col), blank).alias("text"),
        F.coalesce(present, F.lit(True)).alias("present"),
    )
    rows = rows.withColumns({c: F.when(F.col("present"), F.col(c)) for c in ("role", "text")})
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    is_blank = ~F.col("text").rlike(f"[^{SPACE}]")
    ended = F.col("text").rlike(rf"[.!?][{SPACE}]*+\z")
    rows = rows.select(
        "conv",
        "order",
        F.col("order").try_cast("long").alias("turn"),
        "role",
        "text",
        F.when(is_blank, BLANK).when(~ended, TRUNCATED).otherwise(NO_FAULT).alias("fault"),
        F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 16).alias("mark"),
        "present",
        F.monotonically_increasing_id().alias("copy"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv", "order", "role", "mark", "copy")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("order", "copy")
    return rows.withColumn("part", F.spark_partition_id())


def _ddl(fields: dict[str, pa.DataType]) -> str:
    names = {
        pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary",
        pa.bool_(): "boolean", pa.list_(pa.int64()): "array<long>",
        pa.list_(pa.string()): "array<string>", pa.list_(pa.int32()): "array<int>",
    }
    return ", ".join(f"{name} {names[kind]}" for name, kind in fields.items())


class _Batches:
    """Rows gathered into record batches of bounded size."""

    def __init__(self, conv: pa.DataType, fields: dict[str, pa.DataType]) -> None:
        self.schema = pa.schema([("conv", conv), *fields.items()])
        self.rows: list[dict] = []
        self.size = 0

    def add(self, row: dict) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += 100 + len(row.get("text") or "")
        if self.size > 1 << 22:
            yield self.rest()

    def rest(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pylist(self.rows, self.schema)
        self.rows, self.size = [], 0
        return batch


def _lines(rows: list[tuple], edits: str, state: int = START) -> str:
    left = edited(rows, edits, state)
    return "\n".join(f"{role}:{text}" for letter, _, role, text in left if letter != "D")


def _gaps(turns: list[int]) -> int:
    return max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _done(conv: object, rows: list[tuple], want: str) -> Iterator[dict]:
    """The result for a whole conversation of rows (turn, role, text, fault, mark)."""
    seen: set[bytes] = set()
    faults = []
    for _, _, _, fault, mark in rows:
        faults.append(DUPLICATE if fault != BLANK and mark in seen else fault)
        seen.add(mark)
    codes = [(row[1][:1], fault) for row, fault in zip(rows, faults)]
    cost, edits = repair_rows(codes)
    if want == "report":
        yield {
            "conv": conv,
            "gaps": _gaps([row[0] for row in rows if row[0] is not None]),
            "blank": faults.count(BLANK),
            "duplicate": faults.count(DUPLICATE),
            "truncated": faults.count(TRUNCATED),
            "illegal": _illegal([initial for initial, _ in codes]),
            "cost": cost,
            "audit": edits,
            "repaired_sha256": hashlib.sha256(_lines(rows, edits).encode()).hexdigest(),
        }
    else:
        for position, (letter, turn, role, text) in enumerate(edited(rows, edits)):
            yield {
                "conv": conv, "position": position, "edit": EDITS[letter], "turn": turn,
                "role": role, "text": text,
            }


def _pass(rows: DataFrame, conv_type: str, want: str) -> DataFrame:
    """What a partition finishes (``done``), and the rows it leaves to the segments (``row``):
    those of its first and last conversation, which others may have more rows of, and of long
    ones, so that no task holds many rows."""
    fields = {"kind": pa.string(), **(_REPORT if want == "report" else _REPAIRED), **_ROW, **_PLACE}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        nothing = object()
        conv: object = nothing
        held: list[dict] = []
        passing = True  # the rows of this conversation go to the segments
        at = 0

        def done() -> Iterator[dict]:
            names = ("turn", "role", "text", "fault", "mark")
            rows = [tuple(row[name] for name in names) for row in held if row["present"]]
            return ({"kind": "done", **line} for line in _done(conv, rows, want))

        for batch in batches:
            out = out or _Batches(batch.schema.field("conv").type, fields)
            for row in batch.to_pylist():
                row["kind"], row["at"] = "row", at
                at += 1
                if conv is nothing or row["conv"] != conv:
                    if conv is not nothing:
                        if not passing:
                            for line in done():
                                yield from out.add(line)
                        passing = False
                    conv, held = row["conv"], []
                held.append(row)
                if passing or len(held) > LONG:
                    passing = True
                    for line in held:
                        yield from out.add(line)
                    held = []
        if out is not None:
            for line in held:
                yield from out.add(line)
            yield out.rest()

    return rows.mapInArrow(run, f"conv {conv_type}, {_ddl(fields)}")


def _by_segments(rows: DataFrame, conv_type: str, want: str) -> DataFrame:
    """Conversations that no task has whole."""
    place = F.struct("part", "at")
    firsts = (
        rows.filter("present")
        .groupBy("conv", "mark")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.col("conv").alias("same_conv"), F.col("mark").alias("same_mark"), "first")
    )
    same = F.col("conv").eqNullSafe(F.col("same_conv")) & (F.col("mark") == F.col("same_mark"))
    again = F.col("first").isNotNull() & (place != F.col("first"))
    fault = F.when(again & (F.col("fault") != BLANK), DUPLICATE).otherwise(F.col("fault"))
    rows = rows.join(firsts, same, "left").select(
        "conv", "part", "at", F.floor(F.col("at") / SEGMENT).alias("segment"), "turn", "role", "text",
        fault.cast("int").alias("fault"), "present",
    )
    fields = {
        "part": pa.int32(), "at": pa.int64(), "turns": pa.list_(pa.int64()),
        "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()),
        "faults": pa.list_(pa.int32()), "costs": pa.list_(pa.int64()),
        "edits": pa.list_(pa.string()),
    }

    def measure(table: pa.Table) -> pa.Table:
        lines = sorted(table.to_pylist(), key=lambda row: row["at"])
        own = [row for row in lines if row["present"]]
        costs, edits = segment_matrix([(row["role"][:1], row["fault"]) for row in own])
        found = {
            "conv": lines[0]["conv"], "part": lines[0]["part"], "at": lines[0]["at"],
            "turns": [row["turn"] for row in own], "roles": [row["role"] for row in own],
            "texts": [row["text"] for row in own], "faults": [row["fault"] for row in own],
            "costs": costs, "edits": edits,
        }
        schema = pa.schema([("conv", table.schema.field("conv").type), *fields.items()])
        return pa.Table.from_pylist([found], schema)

    segments = written(
        rows.groupBy("conv", "part", "segment").applyInArrow(measure, f"conv {conv_type}, {_ddl(fields)}")
    )

    def choose(table: pa.Table) -> pa.Table:
        lines = sorted(table.to_pylist(), key=lambda line: (line["part"], line["at"]))
        chosen = join_segments([(line["costs"], line["edits"]) for line in lines])
        picked = [
            {"part": line["part"], "at": line["at"], "enters": a, "leaves": b}
            for line, (a, b) in zip(lines, chosen)
        ]
        kinds = {"part": pa.int32(), "at": pa.int64(), "enters": pa.int32(), "leaves": pa.int32()}
        return pa.Table.from_pylist(picked, pa.schema(list(kinds.items())))

    states = (
        segments.select("conv", "part", "at", "costs", "edits")
        .groupBy("conv")
        .applyInArrow(choose, "part int, at long, enters int, leaves int")
    )
    settled = segments.join(states, ["part", "at"])
    cell = F.col("enters") * STATES + F.col("leaves")
    settled = settled.select(
        "conv", "part", "at", "turns", "roles", "texts", "faults", "enters",
        F.get("costs", cell).alias("cost"), F.get("edits", cell).alias("audit"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv", "part", "at")]
    settled = settled.repartition("conv").sortWithinPartitions(*order)
    names = _REPORT if want == "report" else _REPAIRED

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, whole = None, None
        for batch in batches:
            out = out or _Batches(batch.schema.field("conv").type, names)
            for i in range(batch.num_rows):
                line = {name: batch[name][i].as_py() for name in batch.schema.names}
                if whole is None or whole.conv != line["conv"]:
                    if whole is not None and want == "report":
                        yield from out.add(whole.report())
                    whole = _Whole(line["conv"])
                for row in whole.take(line, want):
                    yield from out.add(row)
        if whole is not None:
            if want == "report":
                yield from out.add(whole.report())
            yield out.rest()

    return settled.mapInArrow(read, f"conv {conv_type}, {_ddl(names)}")


class _Whole:
    """A conversation read segment by segment."""

    def __init__(self, conv: object) -> None:
        self.conv = conv
        self.digest = hashlib.sha256()
        self.any_line = False
        self.audit: list[str] = []
        self.cost = self.position = self.illegal = self.different = 0
        self.faults = [0] * 4
        self.least = self.most = None
        self.last_initial = None

    def take(self, line: dict, want: str) -> Iterator[dict]:
        rows = list(zip(line["turns"], line["roles"], line["texts"]))
        if want == "turns":
            for letter, turn, role, text in edited(rows, line["audit"], line["enters"]):
                yield {
                    "conv": self.conv, "position": self.position, "edit": EDITS[letter],
                    "turn": turn, "role": role, "text": text,
                }
                self.position += 1
            return
        self.audit.append(line["audit"])
        self.cost += line["cost"]
        if line["audit"].strip("D"):
            text = _lines(rows, line["audit"], line["enters"])
            self.digest.update(("\n" * self.any_line + text).encode())
            self.any_line = True
        for fault in line["faults"]:
            self.faults[fault] += 1
        turns = [turn for turn in line["turns"] if turn is not None]
        if turns:
            # Turns come in order, so only the last one so far may come again.
            self.different += len(set(turns)) - (turns[0] == self.most)
            self.least = turns[0] if self.least is None else self.least
            self.most = turns[-1]
        initials = [role[:1] for role in line["roles"]]
        before = [] if self.last_initial is None else [self.last_initial]
        self.illegal += _illegal(before + initials)
        self.last_initial = initials[-1] if initials else self.last_initial

    def report(self) -> dict:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.different
        return {
            "conv": self.conv,
            "gaps": gaps,
            "blank": self.faults[BLANK],
            "duplicate": self.faults[DUPLICATE],
            "truncated": self.faults[TRUNCATED],
            "illegal": self.illegal,
            "cost": self.cost,
            "audit": "".join(self.audit),
            "repaired_sha256": self.digest.hexdigest(),
        }
