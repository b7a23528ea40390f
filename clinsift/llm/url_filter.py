"""URL filter: a trie over reversed host labels and path segments, longest match first.

A rule is a host, a path prefix and a verdict.  It fits its host and all subdomains if the
URL's path starts with the rule's.  The rules become tries of at most ``BLOCK`` rules each;
a trie has a bounded size, is broadcast, and every URL walks it once.  More rules than that
are walked block by block, the best match so far going along, so any number of rules gives
the same result as one trie.

Which rule wins: the one with more host labels, then the longer path; between an allow and
a block entry for the same host and path, the block entry.

Defined cases: a null URL or one without ``://`` has empty host and path and is judged like
any other (an empty host fits no rule but that of an empty host).  A URL no rule fits gets
the default verdict and a null rule.  Rows are never dropped, repeated rows stay, an empty
table gives an empty result.  Columns called like an output column are replaced, other
columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCKED = "allow", "block"
BLOCK = 200_000  # rules in one broadcast trie: some 100 MB of Python objects at most
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    def __str__(self) -> str:
        return self.host + self.path


@dataclass
class Node:
    """A host label or path segment; ``tails`` are rules that end within a segment."""

    children: dict[str, Node] = field(default_factory=dict)
    paths: Node | None = None
    tails: dict[str, Rule] = field(default_factory=dict)

    def down(self, label: str) -> Node:
        return self.children.setdefault(label, Node())


def _keep(tails: dict[str, Rule], tail: str, rule: Rule) -> None:
    old = tails.get(tail)
    if old is None or rule.verdict == BLOCKED:
        tails[tail] = rule


def build(rules: Sequence[Rule]) -> Node:
    """A trie of host labels from the right, below each host one of path segments."""
    root = Node()
    for rule in rules:
        node = root
        for label in reversed(rule.host.split(".")):
            node = node.down(label)
        node.paths = node.paths or Node()
        *whole, tail = rule.path.split("/")
        node = node.paths
        for segment in whole:
            node = node.down(segment)
        _keep(node.tails, tail, rule)
    return root


def _longest_path(node: Node, path: str) -> Rule | None:
    """The rule with the longest path that ``path`` starts with."""
    found = None
    segments = path.split("/")
    for i, segment in enumerate(segments):
        tails = [t for t in node.tails if segment.startswith(t)] if node.tails else ()
        if tails:
            found = node.tails[max(tails, key=len)]
        following = node.children.get(segment) if i + 1 < len(segments) else None
        if following is None:
            break
        node = following
    return found


def longest(root: Node, host: str, path: str) -> tuple[int, Rule] | None:
    """Number of host labels and rule of the longest match."""
    found, node = None, root
    for depth, label in enumerate(reversed(host.split(".")), 1):
        node = node.children.get(label)
        if node is None:
            break
        if node.paths is not None and (rule := _longest_path(node.paths, path)):
            found = depth, rule
    return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path; both empty without ``://``."""
    safe = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(safe, _PARTS, 1), _UPPER, _LOWER)
    return host, F.regexp_extract(safe, _PARTS, 2)


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    url: str = "url",
    default: str = ALLOW,
    block: int = BLOCK,
) -> DataFrame:
    """``pages`` with host, path, rule and verdict of every URL."""
    host, path = host_and_path(F.col(url))
    out = pages.withColumns({"host": host, "path": path})
    context = pages.sparkSession.sparkContext
    best = F.struct(
        F.lit(0).alias("depth"),
        F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("verdict"),
        F.lit(0).alias("size"),
    )
    for start in range(0, len(rules), block):
        trie = context.broadcast(build(rules[start : start + block]))

        @F.pandas_udf("depth int, rule string, verdict string, size int")
        def walk(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            for hosts, paths in batches:
                found = [longest(trie.value, h, p) for h, p in zip(hosts, paths, strict=True)]
                yield pd.DataFrame(
                    [
                        (m[0], str(m[1]), m[1].verdict, len(m[1].path)) if m else (0, None, None, 0)
                        for m in found
                    ],
                    columns=["depth", "rule", "verdict", "size"],
                )

        out = out.withColumns({"_best": best, "_new": walk("host", "path")})
        rank = lambda c: F.struct(F.col(c).depth, F.col(c).size, F.col(c).verdict == BLOCKED)
        better = F.col("_best.rule").isNull() | (
            F.col("_new.rule").isNotNull() & (rank("_new") > rank("_best"))
        )
        out = out.withColumn("_best", F.when(better, F.col("_new")).otherwise(F.col("_best"))).drop("_new")
        best = F.col("_best")
    return out.withColumns(
        {"rule": best.rule, "verdict": F.coalesce(best.verdict, F.lit(default))}
    ).drop("_best")
