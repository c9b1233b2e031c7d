"""Repair and trie of conversations against plain definitions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from scrublens.llm import conversation_repair as cr
from scrublens.llm import conversation_trie as ct
from scrublens.llm import queries
from scrublens.llm.common import table
from scrublens.llm.radix_tree import Direct, Indexed, RadixTree, Sorted
from tests.conftest import SF_DIR

NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
ROLE = {"": "user", "s": "user", "u": "assistant", "a": "user"}


@pytest.fixture
def partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 11)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield 11
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# --- repair -----------------------------------------------------------------


def plain_best(codes):
    """All ways through, the least (cost, edits) for each last role."""

    def with_inserts(ways):
        for _ in range(4):
            for last, (cost, edits) in list(ways.items()):
                for role in NEXT[last].keys() & set("ua"):
                    way = (cost + 2, edits + "I")
                    ways[role] = min(way, ways.get(role, way))
        return ways

    ways = with_inserts({"": (0, "")})
    for initial, fault in codes:
        after = {}
        for last, (cost, edits) in ways.items():
            options = [(last, cost + 3, "D")]
            if fault not in (1, 2):
                short = int(fault == 3)
                options += [(r, cost + 2 + short, "R") for r in NEXT[last] if r in "ua"]
                options += [(r, cost + short, "K") for r in NEXT[last] if r == initial]
            for role, price, letter in options:
                way = (price, edits + letter)
                after[role] = min(way, after.get(role, way))
        ways = with_inserts(after)
    return min(ways[last] for last in ("", "a") if last in ways)


def plain_repair(rows):
    """The contract, row by row."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if value is None else value for value in (role, text))
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        role = "user" if fault == 4 else role
        convs[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    found = []
    for conv, own in convs.items():
        digests = {m: hashlib.sha256(f"{len(m[1])}:{m[1]}{m[2]}".encode()).digest() for m in own}
        own.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], digests[m]))
        seen, codes = set(), []
        for _, role, text in own:
            left = text.strip(" \t\n\v\f\r")
            fault = 1 if not left else 2 if (role, text) in seen else 3 if left[-1] not in ".!?" else 0
            seen.add((role, text))
            codes.append((role[:1], fault))
        cost, audit = plain_best(codes)
        last, ahead, lines = "", iter(own), []
        for letter in audit:
            role, text = (ROLE[last], "") if letter == "I" else next(ahead)[1:]
            if letter == "D":
                continue
            role = ROLE[last] if letter == "R" else role
            last = role[0]
            lines.append(f"{role}:{text}")
        turns = [m[0] for m in own if m[0] is not None]
        faults = [fault for _, fault in codes]
        found.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            faults.count(1), faults.count(2), faults.count(3),
            sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(found, key=repr)


def odd_turns():
    dice = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "", "User", None]
    texts = [None, "", " \n", "a.", "b", "c!", " x? ", "longer " * 500 + "."]
    texts += [f"w{i}." for i in range(200)]
    rows = [
        (dice.choice([None, *[7] * 8, 8, 9, 2**60]), dice.choice([None, *range(700)]),
         dice.choice(roles), dice.choice(texts))
        for _ in range(3000)
    ]
    return [*rows, *rows[:5]]


def test_agenda_like_all_ways():
    dice = random.Random(1)
    for _ in range(600):
        codes = [(dice.choice(["s", "u", "a", "t", ""]), dice.choice([0, 0, 1, 2, 3])) for _ in range(dice.randint(0, 8))]
        assert cr.repair_rows(codes) == plain_best(codes)
        cuts = sorted(dice.randint(0, len(codes)) for _ in range(3))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        matrices = [cr.segment_matrix(part) for part in parts]
        at = [a * cr.STATES + b for a, b in cr.join_segments(matrices)]
        joined = (sum(m[0][i] for m, i in zip(matrices, at)), "".join(m[1][i] for m, i in zip(matrices, at)))
        assert joined == plain_best(codes)


def test_legal_conversations_stay():
    assert cr.repair_rows([("s", 0), ("u", 0), ("a", 0)]) == (0, "KKK")
    assert cr.repair_rows([]) == (0, "")
    assert cr.repair_rows([("u", 0)]) == (2, "KI")
    assert cr.repair_rows([("s", 0)]) == (3, "D")


def test_repair_over_whole_table(spark):
    rows = list(map(tuple, table(spark, SF_DIR, "conversations").collect()))
    found = queries.op12_conversation_repair(spark, SF_DIR)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_repair(rows)


@pytest.mark.parametrize("long, segment", [(1024, 256), (5, 3)])
def test_repair_of_odd_and_hot_conversations(spark, partitions, monkeypatch, long, segment):
    """One conversation holds most rows and lies over many partitions."""
    monkeypatch.setattr(cr, "LONG", long)
    monkeypatch.setattr(cr, "SEGMENT", segment)
    rows = odd_turns()
    schema = "conv_id long, turn long, role string, text string, part int, mark string, conv int"
    turns = spark.createDataFrame([(*row, 1, "m", 2) for row in rows], schema)
    names = ("conv_id", "turn", "role", "text")
    broken = cr.damaged(turns, *names)
    want = plain_repair(rows)
    assert sorted(map(tuple, cr.repair(broken, *names).collect()), key=repr) == want
    lines = defaultdict(list)
    for row in sorted(cr.repaired_turns(broken, *names).collect(), key=lambda r: r.position):
        lines[row.conv_id].append(row)
    letters = {word: letter for letter, word in cr.EDITS.items()}
    for conv, *_, audit, digest in want:
        assert "".join(letters[r.edit] for r in lines[conv]) == audit
        left = "\n".join(f"{r.role}:{r.text}" for r in lines[conv] if r.edit != "delete")
        assert hashlib.sha256(left.encode()).hexdigest() == digest


def test_repair_of_nothing_and_of_text_ids(spark):
    names = ("conv_id", "turn", "role", "text")
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair(empty, *names).count() == 0
    named = spark.createDataFrame([("x", "one", "user", "a."), ("x", "2", "user", "a.")], "conv_id string, turn string, role string, text string")
    found = cr.repair(named, *names).first()
    assert (found.conv_id, found.gaps, found.duplicate, found.audit) == ("x", 0, 1, "KDI")


# --- trie -------------------------------------------------------------------


def test_radix_tree_like_a_dict():
    dice = random.Random(4)
    tree, plain = RadixTree(), defaultdict(list)
    for i in range(4000):
        width = (3, 12, 40, 256)[i % 4]  # children of the node after the first byte
        key = bytes([width % 256, dice.randrange(width), *dice.choices(b"ab", k=dice.randint(0, 4))])[dice.random() < 0.01 :]
        tree.insert(key, i)
        plain[key].append(i)
    assert all(tree.get(key) == values for key, values in plain.items())
    assert tree.get(b"abababababab") is None
    layouts, stack = set(), [tree.root]
    while stack:
        node = stack.pop()
        kids = [child for _, child in node.children.items()]
        layouts.add((type(node.children), getattr(node.children, "room", 256)))
        assert len(kids) == len(node.children) and [k.path[0] for k in kids] == sorted(k.path[0] for k in kids)
        assert node is tree.root or node.values is not None or len(kids) > 1
        stack += kids
    assert layouts == {(Sorted, 4), (Sorted, 16), (Indexed, 48), (Direct, 256)}


def plain_trie(sequences):
    members, ending = defaultdict(list), defaultdict(list)
    for conv in sorted(sequences):
        turns = sequences[conv]
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
        ending[turns].append(conv)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * words
    found = [
        (own[0], len(node), members[node[:-1]][0] if node else None, len(own), len(kids[node]),
         leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, ending[node])).encode()).hexdigest())
        for node, own in members.items()
    ]
    return sorted(found, key=repr)


def ordered(rows):
    """Turns of each conversation, those that share a number by their id."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            words = len(re.findall(r"[^\x20\x09-\x0D]+", text))
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            convs[conv].append(((turn is not None, turn or 0, name, words), (role, text)))
    return {conv: tuple(t for _, t in sorted(own)) for conv, own in convs.items()}


def test_trie_over_whole_table(spark, partitions):
    own = ordered(map(tuple, table(spark, SF_DIR, "conversations").collect()))
    rebuilt = {}
    for conv, turns in own.items():
        head = zlib.crc32(str(conv).encode()) % 4
        rebuilt[conv] = own.get(conv - conv % 20, ())[:head] + turns[head:]
    found = queries.op13_conversation_trie(spark, SF_DIR)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_trie(rebuilt)


def test_trie_of_odd_and_hot_conversations(spark, partitions, monkeypatch):
    """A common opening, very many copies, conversations within each other, nulls."""
    monkeypatch.setattr(ct, "CHUNK", 7)
    dice = random.Random(5)
    rows = []
    for conv in range(-30, 300):
        opening = [("system", "be good"), ("user", "hi there you")] if conv % 3 else []
        rest = [(dice.choice(["user", None]), dice.choice("abc")) for _ in range(dice.randint(0, 4))]
        turns = [("user", "a copy")] * 3 if conv % 4 == 0 else opening + rest or [(None, None)]
        rows += [(conv, i or None, role, text) for i, (role, text) in enumerate(turns)]
    rows += [(1000, i, "user", "w" * (i % 3)) for i in range(400)]
    rows += [(1001, i, "user", "w" * (i % 3)) for i in range(399)]
    rows += [(None, 1, "user", "x"), (5, 1, "user", "tie"), (5, 1, "user", "tie"), (2, 0, "u", "l " * 9000)]
    schema = "conv_id long, turn long, role string, text string, key int, part int"
    turns = spark.createDataFrame([(*row, 1, 2) for row in rows], schema)
    sequences = ct.turn_sequences(turns, "conv_id", "turn", "role", "text")
    found = ct.prefix_trie(sequences)
    assert sorted(map(tuple, found.drop("turn").collect()), key=repr) == plain_trie(ordered(rows))
    assert found.filter("turn IS NULL").count() == 1
    none = ct.prefix_trie(sequences.limit(0))
    assert none.count() == 0 and none.columns == found.columns


def test_trie_of_turnless_conversations(spark):
    sequences = spark.createDataFrame([(4, []), (3, []), (11, [])], "conv long, turns array<string>")
    found = ct.prefix_trie(sequences).drop("turn").collect()
    assert list(map(tuple, found)) == plain_trie({4: (), 3: (), 11: ()})
