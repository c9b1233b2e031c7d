"""Judge URLs by allow and block entries held in a trie.

The entries form one trie: reversed host labels (``org``, ``example``, ...) lead to a node
per host, path segments lead on from there. A URL walks down its host once and takes the
deepest host with a fitting path entry; within a host the longest path wins. So an entry
for a subdomain outranks one for its parent domain, and among entries of one host the
longer path outranks the shorter. Of two entries for the same host and path, block wins.

The trie is broadcast. It is built from a list in the driver's memory, whose size is
checked against ``MAX_RULE_BYTES`` before anything is sent.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrublens.llm.common import lower_ascii

#: Bound on the text of all entries together, and with it on the broadcast trie.
MAX_RULE_BYTES = 64 * 1024 * 1024

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``action`` for the host, its subdomains, and paths that start with ``path``."""

    action: str
    host: str
    path: str = "/"

    def __post_init__(self) -> None:
        if self.action not in (ALLOW, BLOCK):
            raise ValueError(f"an entry is {ALLOW!r} or {BLOCK!r}, not {self.action!r}")
        if self.path and not self.path.startswith("/"):
            raise ValueError(f"a path starts with '/': {self.path!r}")

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass
class _Node:
    """A place in the trie. ``ends`` holds the entries that end here: the begun last
    segment of the path, the name and the action, longest first."""

    below: dict[str, _Node] = field(default_factory=dict)
    ends: list[tuple[str, str, str]] = field(default_factory=list)
    any_path: tuple[str, str] | None = None
    paths: _Node | None = None


class Trie:
    def __init__(self, rules: Iterable[Rule]) -> None:
        self.root = _Node()
        for rule in sorted(rules, key=lambda r: (r.name, r.action != BLOCK)):
            self._add(rule)

    def _add(self, rule: Rule) -> None:
        node = self.root
        for label in reversed(rule.host.split(".")):
            node = node.below.setdefault(label, _Node())
        if not rule.path:
            node.any_path = node.any_path or (rule.name, rule.action)
            return
        node.paths = node = node.paths or _Node()
        *whole, begun = rule.path[1:].split("/")
        for segment in whole:
            node = node.below.setdefault(segment, _Node())
        if all(end[0] != begun for end in node.ends):
            node.ends.append((begun, rule.name, rule.action))
            node.ends.sort(key=lambda end: -len(end[0]))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """Name and action of the entry that decides, or None if no entry fits."""
        hosts = []
        node = self.root
        for label in reversed(host.split(".")):
            node = node.below.get(label)
            if node is None:
                break
            hosts.append(node)
        for node in reversed(hosts):
            found = self._in_paths(node.paths, path) or node.any_path
            if found:
                return found
        return None

    @staticmethod
    def _in_paths(node: _Node | None, path: str) -> tuple[str, str] | None:
        if node is None or not path.startswith("/"):
            return None
        best = None
        rest = path[1:].split("/")
        for depth, segment in enumerate(rest):
            last = segment if depth == len(rest) - 1 else segment + "/"
            for begun, name, action in node.ends:
                if last.startswith(begun):
                    best = name, action
                    break
            node = node.below.get(segment) if depth < len(rest) - 1 else None
            if node is None:
                break
        return best


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path. The host follows the first ``://`` up to ``/``, ``?``, ``#`` or the
    end, with A-Z lower-cased; the path goes on up to ``?``, ``#`` or the end. Both are
    empty for a null URL and for one without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, n), F.lit("")) for n in (1, 2))
    return lower_ascii(host), path


def judge_urls(
    urls: DataFrame,
    id_col: str,
    url_col: str,
    rules: Sequence[Rule],
    default: str = ALLOW,
) -> DataFrame:
    """One row for each row of ``urls``: the id, ``host``, ``path``, the name of the
    deciding ``rule`` (null if none fits) and the ``verdict`` (then ``default``).

    Works row by row: repeated rows and ids get a row each, null ids stay null, an empty
    table gives none, and other columns are not looked at.
    """
    size = sum(len(rule.name.encode()) for rule in rules)
    if size > MAX_RULE_BYTES:
        raise ValueError(f"{size} bytes of entries; a broadcast trie holds {MAX_RULE_BYTES}")
    trie = urls.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def decide(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        find = trie.value.find
        for hosts, paths in parts:
            found = [find(h, p) or (None, default) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    host, path = url_parts(F.col(url_col))
    parted = urls.select(F.col(id_col), host.alias("host"), path.alias("path"))
    judged = parted.withColumn("_found", decide("host", "path"))
    return judged.select(id_col, "host", "path", "_found.rule", "_found.verdict")
