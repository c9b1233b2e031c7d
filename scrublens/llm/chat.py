"""Conversations brought into a legal order of roles at least cost, then rendered.

The legal orders are those of an automaton: a system turn may open a conversation, a user
turn follows, and user and assistant take turns until an assistant turn ends it. A row may be
kept, merged into the turn before it, given another role, or come after an empty turn that is
inserted; each has a cost, and dynamic programming finds the cheapest way through.

A row is a matrix of costs from state to state, and the matrix of a stretch of rows is the
product (minimum and sum) of theirs. So a conversation is not collected anywhere: rows are
sorted by range, a long conversation over many partitions; each partition sends the matrix of
the conversation it begins with and of the one it ends with, and learns from them in which
state it starts and with which it has to end. That is a few numbers for each partition,
whatever the rows. Then each partition traces the cheapest way through its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrublens.llm.common import lower_ascii, written

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: After each state the roles a new turn may have (as the states they lead to).
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, INSERT, RELABEL, NAME = 2, 3, 4, 1  # NAME: a role to a row that has none known
NEVER = 1 << 40

#: Names that stand for a role; any other, and null, is unknown.
NAMES = {
    "system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "prompter": USER,
    "assistant": ASSISTANT, "bot": ASSISTANT, "gpt": ASSISTANT, "model": ASSISTANT,
}

Move = tuple[int, str, int]  # cost, action, role of an empty turn inserted first (0: none)


def _moves(role: int) -> dict[tuple[int, int], Move]:
    """The cheapest move of a row of ``role`` (0: unknown) for each two states. Of moves of
    equal cost: kept, relabelled, merged, inserted, in this order."""
    found: dict[tuple[int, int], Move] = {}

    def offer(before: int, after: int, move: Move) -> None:
        if (before, after) not in found or move[0] < found[before, after][0]:
            found[before, after] = move

    for before in range(STATES):
        for after in range(1, STATES):
            own = after == role
            cost = 0 if own else NAME if not role else RELABEL
            action = "keep" if own else "relabel"
            if after in LEGAL[before]:
                offer(before, after, (cost, action, 0))
            if before == after:
                offer(before, after, (cost + MERGE, "merge", 0))
            for first in LEGAL[before]:
                if after in LEGAL[first]:
                    offer(before, after, (cost + INSERT, action, first))
    return found


MOVES = [_moves(role) for role in range(STATES)]
COSTS = np.array(
    [[[m.get((a, b), (NEVER,))[0] for b in range(STATES)] for a in range(STATES)] for m in MOVES]
)
#: Cost of ending in a state: an empty assistant turn after a user's; both after a system's.
ENDING = np.array([0, 2 * INSERT, INSERT, 0])


def stretch(codes: np.ndarray) -> np.ndarray:
    """Costs from state to state of a stretch of rows."""
    total = np.where(np.eye(STATES, dtype=bool), 0, NEVER)
    if len(codes) < 64:
        for code in codes:
            total = (total[:, :, None] + COSTS[code][None]).min(axis=1)
        return np.minimum(total, NEVER)
    parts = COSTS[codes]
    while len(parts) > 1:
        last = parts[-1:] if len(parts) % 2 else parts[:0]
        left, right = parts[: len(parts) // 2 * 2 : 2], parts[1::2]
        both = np.minimum((left[:, :, :, None] + right[:, None]).min(axis=2), NEVER)
        parts = np.concatenate([both, last])
    return parts[0]


def trace(codes: np.ndarray, first: int, ends: np.ndarray) -> list[int]:
    """The states after each row of the cheapest way from state ``first``, if ending in a
    state costs ``ends``. Of equal ways, the one with the smallest last states."""
    cost = np.full(STATES, NEVER)
    cost[first] = 0
    came = np.zeros((len(codes), STATES), np.int8)
    for i, code in enumerate(codes):
        all_ways = cost[:, None] + COSTS[code]
        came[i] = all_ways.argmin(axis=0)
        cost = np.minimum(all_ways.min(axis=0), NEVER)
    state = int((cost + ends).argmin())
    states = []
    for i in range(len(codes) - 1, -1, -1):
        states.append(state)
        state = int(came[i, state])
    return states[::-1]


def _runs(conv: pd.Series) -> list[tuple[int, int]]:
    """Begin and end of each conversation in a frame sorted by ``conv``, names without null."""
    if not len(conv):
        return []
    names = conv.to_numpy()
    new = np.ones(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    begins = np.flatnonzero(new)
    return list(zip(begins.tolist(), [*begins[1:].tolist(), len(conv)]))


def _entries(parts: list[dict]) -> dict[int, dict]:
    """For each partition, from the matrices of its first and its last conversation: the
    state it begins with, and the cost of each state at its end. Partitions come in order;
    where one conversation spans several, its states are settled over all of them."""
    found = {part["part"]: {"first": START, "ends": ENDING, "last": True} for part in parts}
    at = 0
    while at < len(parts):
        chain = [at]
        while chain[-1] + 1 < len(parts):
            left, right = parts[chain[-1]], parts[chain[-1] + 1]
            if left["last"] != right["first"] or (len(chain) > 1 and left["many"] > 1):
                break
            chain.append(chain[-1] + 1)
            if right["many"] > 1:
                break
        if len(chain) == 1:
            at += 1
            continue
        matrices = [
            np.array(parts[i]["last_matrix" if i == at else "first_matrix"]).reshape(STATES, STATES)
            for i in chain
        ]
        # ends[k]: the least cost from each state at the end of chain[k] to the end.
        ends = [ENDING]
        for matrix in reversed(matrices[1:]):
            ends.append((matrix + ends[-1][None, :]).min(axis=1))
        ends.reverse()
        state = START
        for k, i in enumerate(chain):
            own = found[parts[i]["part"]]
            if k:
                own["first"] = state
            if k < len(chain) - 1:
                own["ends"], own["last"] = ends[k], False
            state = int((matrices[k][state] + ends[k]).argmin())
        at = chain[-1]
    return found


def repair(
    turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """One row for each row of ``turns``: conversation, turn, ``position`` (grows within a
    conversation), ``role`` (the repaired one), ``action`` (``keep``, ``relabel``, ``merge``),
    ``inserted`` (role of an empty turn put before it, else null), ``closing`` (role or roles
    of the empty turns that end the conversation after it, else null) and ``rendered``. The
    ``rendered`` of a conversation, in the order of ``position``, make up its text in ChatML.
    A text cannot begin or end a turn: its ``<|im_`` is rendered as ``< |im_``.

    Rows are ordered by turn (null first), then by role and text; rows that are repeated
    whole are turns of their own, to be merged. Null conversations are one conversation. A
    null text counts as empty; an unknown or null role may become any. An empty table gives
    no row; other columns are not looked at.
    """
    known = F.create_map(*(F.lit(x) for pair in NAMES.items() for x in pair))
    role = lower_ascii(F.trim(F.coalesce(F.col(role_col), F.lit(""))))
    # pandas makes whole numbers with nulls among them fractions, so it gets names instead.
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.element_at(known, role), F.lit(0)).cast("int").alias("code"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        _name(turns, conv_col).alias("name"),
    )
    # Rows that agree whole share a key. Texts travel once, to meet the rows of their key,
    # and with them the conversation and turn as they were.
    whole = F.struct("name", _name(turns, turn_col).alias("turn"), "code", "text")
    rows = rows.withColumn("key", F.unhex(F.md5(F.to_json(whole))))
    texts = rows.select("key", "conv", "turn", "text").dropDuplicates(["key"])
    order = ["conv", "turn", "code", "key"]
    light = rows.drop("text").withColumn("copy", F.monotonically_increasing_id())
    light = light.repartitionByRange(*order, "copy").sortWithinPartitions(*order)
    light = written(
        light.drop("copy", "conv", "turn")
        .withColumn("position", F.monotonically_increasing_id())
        .withColumn("part", F.spark_partition_id())
    )
    shared = turns.sparkSession.sparkContext.broadcast(_entries(_boundaries(light)))
    schema = (
        "key binary, position long, state int, action string, inserted int, first boolean, "
        "last boolean"
    )

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("position", ignore_index=True)
        entry = shared.value[int(frame["part"].iloc[0])]
        runs = _runs(frame["name"])
        code = frame["code"].to_numpy()
        states, actions, inserted = [], [], []
        first, last = np.zeros(len(frame), bool), np.zeros(len(frame), bool)
        for i, (begin, end) in enumerate(runs):
            before = entry["first"] if i == 0 else START
            final = i == len(runs) - 1
            own = trace(code[begin:end], before, entry["ends"] if final else ENDING)
            first[begin] = before == START
            last[end - 1] = not final or entry["last"]
            for kind, state in zip(code[begin:end], own):
                _, action, empty = MOVES[kind][before, state]
                states.append(state)
                actions.append(action)
                inserted.append(empty)
                before = state
        return frame[["key", "position"]].assign(
            state=states, action=actions, inserted=inserted, first=first, last=last
        )

    found = light.groupBy("part").applyInPandas(run, schema)
    return _rendered(found.join(texts, "key"), conv_col, turn_col)


def _name(rows: DataFrame, name: str) -> Column:
    """A column's values as text, one for each, and never null."""
    value = F.col(name)
    binary = dict(rows.dtypes)[name] == "binary"
    text = F.hex(value) if binary else value.cast("string")
    return F.coalesce(F.concat(F.lit("="), text), F.lit("null"))


def _boundaries(rows: DataFrame) -> list[dict]:
    """Of each partition, in order: how many conversations it has, the first and the last
    one, and the matrices of these two."""
    schema = (
        "part int, position long, many long, first string, last string, "
        "first_matrix array<long>, last_matrix array<long>"
    )

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("position", ignore_index=True)
        runs = _runs(frame["name"])
        code = frame["code"].to_numpy()
        first, last = (stretch(code[a:b]).ravel().tolist() for a, b in (runs[0], runs[-1]))
        line = (
            int(frame["part"].iloc[0]), int(frame["position"].iloc[0]), len(runs),
            frame["name"].iloc[0], frame["name"].iloc[-1], first, last,
        )
        columns = "part position many first last first_matrix last_matrix".split()
        return pd.DataFrame([line], columns=columns)

    found = rows.select("part", "position", "name", "code").groupBy("part").applyInPandas(run, schema)
    return [row.asDict() for row in sorted(found.collect(), key=lambda row: row.position)]


def _rendered(rows: DataFrame, conv_col: str, turn_col: str) -> DataFrame:
    names = F.array(*map(F.lit, ("", *ROLES)))
    nothing, ends = F.lit(""), F.lit("<|im_end|>\n")
    last_state = F.when(F.col("last"), F.col("state")).otherwise(ASSISTANT)

    def role(state: Column) -> Column:
        return F.element_at(names, state + 1)

    def begins(name: Column) -> Column:
        return F.concat(F.lit("<|im_start|>"), name, F.lit("\n"))

    def empty(name: Column) -> Column:
        return F.concat(begins(name), ends)

    # Whether a turn is over is known to the row after it, which writes its end.
    over = F.when(F.col("first"), nothing).otherwise(ends)
    added = F.when(F.col("inserted") > 0, empty(role(F.col("inserted")))).otherwise(nothing)
    start = F.concat(over, added, begins(role(F.col("state"))))
    end = F.concat(
        F.when(F.col("last"), ends).otherwise(nothing),
        F.when(last_state == SYSTEM, empty(F.lit("user"))).otherwise(nothing),
        F.when(last_state <= USER, empty(F.lit("assistant"))).otherwise(nothing),
    )
    closing = F.when(last_state == USER, F.lit("assistant")).when(
        last_state == SYSTEM, F.lit("user,assistant")
    )
    return rows.select(
        F.col("conv").alias(conv_col),
        F.col("turn").alias(turn_col),
        "position",
        role(F.col("state")).alias("role"),
        "action",
        F.when(F.col("inserted") > 0, role(F.col("inserted"))).alias("inserted"),
        closing.alias("closing"),
        F.concat(
            F.when(F.col("action") == "merge", nothing).otherwise(start),
            F.replace(F.col("text"), F.lit("<|im_"), F.lit("< |im_")),
            F.lit("\n"),
            end,
        ).alias("rendered"),
    )
