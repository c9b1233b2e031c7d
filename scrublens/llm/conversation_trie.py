"""The trie of conversation beginnings, built of adaptive radix trees.

A turn is known by a fixed-width id, ``DIGEST`` bytes of a digest of its role and text and
the number of its words, big-endian; a conversation's key is the ids of its turns in a row.
Two conversations begin with the same turns if their keys share that many whole ids, so the
nodes of the trie are the turn-aligned depths of a radix tree of the keys; where keys part
within an id there is no node.

Keys are sorted by range over the partitions, whatever turns they begin with, so a beginning
that many conversations have is spread over as many tasks as it needs. A partition builds the
tree of its own keys. A node that reaches beyond the partition lies on the way to its first
or to its last key: these few nodes (the spine) are added up between partitions by Spark,
all others are finished where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrublens.llm.common import SPACE, written
from scrublens.llm.radix_tree import Node, RadixTree, shared

DIGEST, COUNT = 16, 4
WIDTH = DIGEST + COUNT
#: Ids of conversations in one row on their way to a digest.
CHUNK = 1 << 14
_SALTS = 16

_FOUND = pa.schema(
    [
        ("kind", pa.string()), ("conv", pa.int64()), ("depth", pa.int64()),
        ("parent_conv", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
        ("turn", pa.binary()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
        ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()),
        ("part", pa.int32()), ("branch", pa.int32()), ("words", pa.int64()),
    ]
)
_FOUND_DDL = (
    "kind string, conv long, depth long, parent_conv long, node binary, parent binary, "
    "turn binary, n_convs long, n_children long, n_leaves long, saved long, ends string, "
    "part int, branch int, words long"
)
_STEM, _FIRST, _LAST = range(3)


def turn_id(role: Column, text: Column) -> Column:
    """The id of a turn as hexadecimal text; null counts as empty. Words are what white space
    divides."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * DIGEST)
    words = F.regexp_count(text, F.lit(f"[^{SPACE}]+"))
    return F.concat(digest, F.lpad(F.lower(F.hex(words.cast("long"))), 2 * COUNT, "0"))


def turn_sequences(
    turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """``conv`` (long) and ``turns``, the ids of its turns in order, for each conversation.

    Turns are ordered by number, null first, and those that share one by their id; repeated
    rows are turns of their own. Rows without a conversation (null) belong to none and give
    nothing. An empty table gives no row. Texts do not leave the scan.
    """
    ids = turns.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.struct(
            F.col(turn_col).alias("turn"),
            turn_id(F.col(role_col), F.col(text_col)).alias("id"),
        ).alias("item"),
    ).filter("conv IS NOT NULL")
    listed = ids.groupBy("conv").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return listed.select("conv", F.col("items.id").alias("turns"))


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie of ``sequences`` (``conv`` long, one row each; ``turns``, ids as
    hexadecimal text). One row per node: ``conv_id`` (the smallest conversation that begins
    with it), ``depth``, ``turn`` (id of its last turn, null for the root),
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (words that conversations beginning with a node of its subtree need not
    be read again for) and ``ends_sha256`` (of the conversations that end with it).

    Conversations without a turn end with the root. Without conversations there is no node.
    The ids of one conversation's turns are one cell of ``WIDTH`` bytes each; its texts are not.
    """
    keys = sequences.select(F.unhex(F.array_join("turns", "")).alias("key"), "conv")
    dealt = keys.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
    found = written(dealt.mapInArrow(_partition_nodes, _FOUND_DDL))
    spine = _merged(found)
    inner = found.filter("kind = 'node'")
    near = inner.filter("parent IS NOT NULL").withColumn("salt", F.pmod("conv", F.lit(_SALTS)))
    parents = spine.select(F.col("node").alias("parent"), F.col("conv").alias("above"))
    parents = parents.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))))
    near = near.join(parents, ["parent", "salt"]).withColumn("parent_conv", F.col("above"))
    whole = _named(inner.filter("parent IS NULL"))
    return whole.unionByName(_named(near)).unionByName(_named(spine))


def _named(nodes: DataFrame) -> DataFrame:
    names = {
        "conv": "conv_id", "depth": "depth", "turn": "turn", "parent_conv": "parent_conv_id",
        "n_convs": "n_convs", "n_children": "n_children", "n_leaves": "n_leaves",
        "saved": "saved_tokens", "ends": "ends_sha256",
    }
    return nodes.select(*(F.col(name).alias(alias) for name, alias in names.items()))


# --- one partition ----------------------------------------------------------


def _partition_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tree = RadixTree()
    first = last = None
    for batch in batches:
        for key, conv in zip(batch["key"], batch["conv"]):
            last = key.as_py()
            first = last if first is None else first
            tree.insert(last, conv.as_py())
    if first is None:
        return
    part = TaskContext.get().partitionId()
    rows: list[dict] = []
    for row in partition_nodes(tree, first, last):
        rows.append(row if row["kind"] == "node" else {**row, "part": part})
        if len(rows) == 4096:
            yield pa.RecordBatch.from_pylist(rows, _FOUND)
            rows = []
    yield pa.RecordBatch.from_pylist(rows, _FOUND)


def _prefix_ids(key: bytes) -> list[bytes]:
    """What stands for the beginnings of a key of 0, 1, 2, ... turns."""
    whole = hashlib.sha256()
    found = [whole.digest()[:DIGEST]]
    for at in range(0, len(key), WIDTH):
        whole.update(key[at : at + WIDTH])
        found.append(whole.copy().digest()[:DIGEST])
    return found


class _Visit:
    """A node of the tree on the way through it, and what its subtree has given so far."""

    __slots__ = ("node", "start", "tail", "met_first", "met_last", "ahead", "sums", "pending")

    def __init__(self, node: Node, start: int, tail: bytes, met_first: int, met_last: int) -> None:
        self.node, self.start, self.tail = node, start, tail
        self.met_first, self.met_last = met_first, met_last  # bytes shared with these keys
        self.ahead = [child for _, child in node.children.items()]
        self.sums = [0, 0, 0]  # conversations, leaves and saved words below
        self.pending: list[dict] = []  # finished nodes whose parent has not been met


def partition_nodes(tree: RadixTree, first: bytes, last: bytes) -> Iterator[dict]:
    """The turn-aligned nodes of a tree whose least and greatest keys are ``first`` and
    ``last``, children before parents: finished ones, and those of the spine with what is below
    them outside the spine. There is no recursion, as keys within each other may be many."""
    first_ids, last_ids = _prefix_ids(first), _prefix_ids(last)
    least: dict[int, int] = {}  # smallest conversation below a visited node
    stack = [_Visit(tree.root, 0, b"", 0, 0)]
    while stack:
        visit = stack[-1]
        end = visit.start + len(visit.node.path)
        if visit.ahead:
            child = visit.ahead.pop()
            tail = (visit.tail + visit.node.path)[-WIDTH:]
            met = (
                end + shared(child.path, key[end : end + len(child.path)]) if so_far == end else so_far
                for key, so_far in ((first, visit.met_first), (last, visit.met_last))
            )
            stack.append(_Visit(child, end, tail, *met))
            continue
        stack.pop()
        yield from _edge_nodes(visit, end, first_ids, last_ids, least)
        if stack:
            above = stack[-1]
            above.sums = [a + b for a, b in zip(above.sums, visit.sums)]
            above.pending += visit.pending
            smallest = least.pop(id(visit.node))
            least[id(above.node)] = min(smallest, least.get(id(above.node), smallest))


def _edge_nodes(
    visit: _Visit, end: int, first_ids: list[bytes], last_ids: list[bytes], least: dict[int, int]
) -> Iterator[dict]:
    """Nodes at the aligned depths on the way from a node's parent to it, from its end up."""
    node = visit.node
    convs = sorted(node.values or ())
    visit.sums[0] += len(convs)
    if convs:
        least[id(node)] = min(convs[0], least.get(id(node), convs[0]))
    smallest = least[id(node)]
    known = visit.tail + node.path
    offset = end - len(known)
    stop = visit.start if node.path else -1  # the root has no way to it
    for at in range(end - end % WIDTH, stop, -WIDTH):
        turn = known[at - WIDTH - offset : at - offset] if at else None
        words = int.from_bytes(turn[DIGEST:], "big") if turn else 0
        ending = convs if at == end else []
        depth = at // WIDTH
        row = {"conv": smallest, "depth": depth, "turn": turn, "n_convs": visit.sums[0]}
        on_first, on_last = at <= visit.met_first, at <= visit.met_last
        if on_first or on_last:
            ids = first_ids if on_first else last_ids
            name = {"node": ids[depth], "parent": ids[depth - 1] if depth else None}
            for child in visit.pending:
                yield {**child, "parent": ids[depth]}
            branch = _STEM if on_first and on_last else _FIRST if on_first else _LAST
            below = {
                "n_children": len(visit.pending),
                "n_leaves": visit.sums[1],
                "saved": visit.sums[2],
            }
            yield {"kind": "spine", **row, **name, **below, "branch": branch, "words": words}
            for i in range(0, len(ending), CHUNK):
                chunk = ",".join(map(str, ending[i : i + CHUNK]))
                yield {"kind": "ends", "node": ids[depth], "n_children": i, "ends": chunk}
            visit.pending = []
        else:
            for child in visit.pending:
                yield {**child, "parent_conv": smallest}
            visit.sums[1] += not visit.pending
            visit.sums[2] += (visit.sums[0] - 1) * words
            done = {
                "n_children": len(visit.pending),
                "n_leaves": visit.sums[1],
                "saved": visit.sums[2],
                "ends": hashlib.sha256(",".join(map(str, ending)).encode()).hexdigest(),
            }
            visit.pending = [{"kind": "node", **row, **done}]


# --- between partitions -----------------------------------------------------


def _merged(found: DataFrame) -> DataFrame:
    """The nodes of the spine, each once. What a node adds to those above it (itself as a
    leaf, its saved words) is known when its parts are together; it is added once, in the
    first partition that has the node, to all spine nodes above it there."""
    parts = found.filter("kind = 'spine'")
    nodes = parts.groupBy("node").agg(
        F.min("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.min("turn").alias("turn"),
        F.min("words").alias("words"),
        F.min("conv").alias("conv"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.min("part").alias("owner"),
    )
    nodes = written(nodes)
    kids = nodes.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("kids"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    nodes = (
        nodes.join(kids, "node", "left")
        .withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
        .join(parents, "parent", "left")
    )
    own = nodes.select(
        "node",
        F.col("owner").alias("part"),
        (F.col("n_children") == 0).cast("long").alias("own_leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved"),
    )
    down = F.col("depth").desc()
    whole = Window.partitionBy("part").orderBy(down).rangeBetween(Window.unboundedPreceding, 0)
    branch = Window.partitionBy("part", "branch").orderBy(down).rangeBetween(Window.unboundedPreceding, 0)

    def below(name: str) -> Column:
        value = F.coalesce(F.col(name), F.lit(0))
        return F.when(F.col("branch") == _STEM, F.sum(value).over(whole)).otherwise(
            F.sum(value).over(branch)
        )

    sums = (
        parts.join(own, ["node", "part"], "left")
        .select(
            "node",
            (F.col("n_leaves") + below("own_leaf")).alias("n_leaves"),
            (F.col("saved") + below("own_saved")).alias("saved"),
        )
        .groupBy("node")
        .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    )
    chunks = found.filter("kind = 'ends'").select("node", "part", F.col("n_children").alias("at"), "ends")
    chunks = chunks.repartition("node").sortWithinPartitions("node", "part", "at")
    ends = chunks.select("node", "ends").mapInArrow(_digests, "node binary, ends string")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return (
        nodes.join(sums, "node")
        .join(ends, "node", "left")
        .withColumn("ends", F.coalesce("ends", nothing))
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for the sorted rows of each node, read as a stream."""
    schema = pa.schema([("node", pa.binary()), ("ends", pa.string())])
    node, whole = None, hashlib.sha256()
    for batch in batches:
        for key, chunk in zip(batch["node"].to_pylist(), batch["ends"].to_pylist()):
            if key != node:
                if node is not None:
                    yield pa.RecordBatch.from_pylist([{"node": node, "ends": whole.hexdigest()}], schema)
                node, whole = key, hashlib.sha256(chunk.encode())
            else:
                whole.update(("," + chunk).encode())
    if node is not None:
        yield pa.RecordBatch.from_pylist([{"node": node, "ends": whole.hexdigest()}], schema)
