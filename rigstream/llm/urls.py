"""URL filters: allow and block entries in a trie over reversed host labels and path segments.

An entry is a host and a path prefix. It fits its host and every subdomain, when the path of the
url starts with the entry's path. The longest entry that fits decides, allow before block when the
same entry is in both lists. The list is compiled once and broadcast; its size is that of the list,
checked against ``MAX_BYTES``.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from
there up to ``?``, ``#`` or the end. A null url, or one without ``://``, has an empty host and path
and gets the default verdict with a null rule. Empty tables stay empty, repeated rows are judged
each, and input columns named like a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField

from rigstream.llm.common import map_rows

MAX_BYTES = 64 * 1024 * 1024
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """An entry of the list: ``host`` in lower case, ``path`` empty or starting with ``/``."""

    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


class Node:
    """A node of the trie: next labels or segments, and the entries that end here."""

    __slots__ = ("down", "paths", "rule", "parts")

    def __init__(self):
        self.down: dict[str, Node] = {}
        #: root of the path trie of the host that ends here
        self.paths: Node | None = None
        #: the entry whose last segment is complete here
        self.rule: Rule | None = None
        #: entries that end inside a segment: (beginning of the segment, entry), longest first
        self.parts: list[tuple[str, Rule]] = []


class UrlTrie:
    """Host labels from the right lead to a path trie, path segments lead to entries."""

    def __init__(self, rules: list[Rule]):
        self.root = Node()
        for rule in sorted(rules, key=lambda r: r.allow):  # an allow entry replaces the same block entry
            self._add(rule)

    def _add(self, rule: Rule) -> None:
        node = self.root
        for label in reversed(rule.host.split(".")):
            node = node.down.setdefault(label, Node())
        node.paths = node = node.paths or Node()
        *whole, last = rule.path.split("/")
        for segment in whole:
            node = node.down.setdefault(segment, Node())
        if last:
            kept = [p for p in node.parts if p[0] != last]
            node.parts = sorted([*kept, (last, rule)], key=lambda p: -len(p[0]))
        else:
            node.rule = rule

    def judge(self, host: str, path: str) -> Rule | None:
        """The longest entry that fits; of equally long ones, that with the longer host."""
        best, node = None, self.root
        for label in reversed(host.split(".")):
            node = node.down.get(label)
            if node is None:
                break
            if node.paths is not None:
                found = self._in_paths(node.paths, path)
                if found and (best is None or len(found.name) >= len(best.name)):
                    best = found
        return best

    @staticmethod
    def _in_paths(node: Node, path: str) -> Rule | None:
        best = node.rule
        *whole, last = path.split("/")
        for segment in whole:  # a separator stands behind each of these
            best = next((rule for begin, rule in node.parts if segment.startswith(begin)), best)
            node = node.down.get(segment)
            if node is None:
                return best
            best = node.rule or best
        return next((rule for begin, rule in node.parts if last.startswith(begin)), best)


def host_of(url: Column) -> Column:
    """The host of a url, empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")), *LOWER)


def path_of(url: Column) -> Column:
    """The path of a url, empty if there is none."""
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def filter_urls(pages: DataFrame, rules: list[Rule], default_allow: bool = True, url: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` (allow or block)."""
    if sum(len(r.name) for r in rules) > MAX_BYTES:
        raise ValueError("the list is too large to broadcast; split it by host")
    shared = pages.sparkSession.sparkContext.broadcast([(r.host, r.path, r.allow) for r in rules])
    fallback = "allow" if default_allow else "block"
    columns = [c for c in pages.columns if c.lower() not in ("host", "path")]
    parted = pages.select(*columns, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    # one column holds both parts, so that they go through the trie together; a host has no slash
    parted = parted.withColumn("rule", F.concat("host", "path"))

    def step(parts: pa.Array) -> list[pa.Array]:
        if "_trie" not in shared.__dict__:
            shared._trie = UrlTrie([Rule(*r) for r in shared.value])
        cut = [x.partition("/") for x in parts.to_pylist()]
        found = [shared._trie.judge(host, slash + rest) for host, slash, rest in cut]
        return [
            pa.array([r.name if r else None for r in found], pa.string()),
            pa.array([("allow" if r.allow else "block") if r else fallback for r in found], pa.string()),
        ]

    return map_rows(parted, [StructField("rule", StringType()), StructField("verdict", StringType())], "rule", step)
