"""An adaptive radix tree: byte keys, path compression, and nodes that grow with their children.

A node has one of four layouts: up to 4 or 16 children as sorted bytes beside them, up to 48
through an index of all 256 bytes, beyond that one place for each byte. Bytes that a node's
keys share up to where they part (or one of them ends) are held once, as its path.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

_NONE = 255  # no child, in the index of a layout of 48


class Sorted:
    """Children beside their sorted bytes."""

    def __init__(self, room: int) -> None:
        self.room = room
        self.keys = bytearray()
        self.nodes: list[Node] = []

    def get(self, byte: int) -> Node | None:
        at = bisect_left(self.keys, byte)
        return self.nodes[at] if at < len(self.keys) and self.keys[at] == byte else None

    def full(self) -> bool:
        return len(self.nodes) == self.room

    def put(self, byte: int, node: Node) -> None:
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.nodes[at] = node
        else:
            self.keys.insert(at, byte)
            self.nodes.insert(at, node)

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.keys, self.nodes)

    def __len__(self) -> int:
        return len(self.nodes)


class Indexed:
    """Children in order of arrival, and for each byte the place of its child."""

    room = 48

    def __init__(self) -> None:
        self.places = bytearray([_NONE]) * 256
        self.nodes: list[Node] = []

    def get(self, byte: int) -> Node | None:
        place = self.places[byte]
        return None if place == _NONE else self.nodes[place]

    def full(self) -> bool:
        return len(self.nodes) == self.room

    def put(self, byte: int, node: Node) -> None:
        if self.places[byte] == _NONE:
            self.places[byte] = len(self.nodes)
            self.nodes.append(node)
        else:
            self.nodes[self.places[byte]] = node

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, self.nodes[place]) for byte, place in enumerate(self.places) if place != _NONE)

    def __len__(self) -> int:
        return len(self.nodes)


class Direct:
    """A place for each byte."""

    def __init__(self) -> None:
        self.nodes: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def full(self) -> bool:
        return False

    def put(self, byte: int, node: Node) -> None:
        self.nodes[byte] = node

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, node) for byte, node in enumerate(self.nodes) if node is not None)

    def __len__(self) -> int:
        return sum(node is not None for node in self.nodes)


def _larger(children: Sorted | Indexed) -> Sorted | Indexed | Direct:
    if isinstance(children, Indexed):
        wider: Sorted | Indexed | Direct = Direct()
    else:
        wider = Sorted(16) if children.room == 4 else Indexed()
    for byte, node in children.items():
        wider.put(byte, node)
    return wider


class Node:
    """``path`` leads to the node from the byte that its parent holds for it, that byte
    included; ``values`` are those of the key that ends here."""

    __slots__ = ("path", "children", "values")

    def __init__(self, path: bytes) -> None:
        self.path = path
        self.children: Sorted | Indexed | Direct = Sorted(4)
        self.values: list | None = None

    def add(self, node: Node) -> None:
        if self.children.get(node.path[0]) is None and self.children.full():
            self.children = _larger(self.children)
        self.children.put(node.path[0], node)


def shared(a: bytes, b: bytes) -> int:
    """How many bytes two texts have in common at their beginning."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:  # a[:low] == b[:low]; they part before high or there
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTree:
    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, key: bytes, value: object) -> None:
        """Add ``value`` to those of ``key``."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = Node(key[at:])
                node.add(child)
            same = shared(child.path, key[at : at + len(child.path)])
            if same < len(child.path):
                # The paths part inside the child's: a node comes to stand there.
                fork = Node(child.path[:same])
                child.path = child.path[same:]
                fork.add(child)
                node.add(fork)
                child = fork
            node, at = child, at + same
        if node.values is None:
            node.values = []
        node.values.append(value)

    def get(self, key: bytes) -> list | None:
        """The values of ``key``, None if it was not inserted."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None or not key.startswith(child.path, at):
                return None
            node, at = child, at + len(child.path)
        return node.values
