"""Allow and block rules for URLs, by a trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import map_columns

ALLOW, BLOCK = "allow", "block"
# A trie of this many rules takes a few hundred MB at most in each worker.
TRIE_RULES = 200_000


class Rule(NamedTuple):
    """``path`` begins with ``/``; a rule fits its host, all subdomains, and paths it starts."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


class _Node:
    __slots__ = ("below", "rules", "tails", "paths")

    def __init__(self):
        self.below: dict[str, _Node] = {}
        self.paths: _Node | None = None
        self.rules: Rule | None = None
        self.tails: list[tuple[str, Rule]] = []


class Trie:
    """Labels from the right, then path segments from the left.

    A whole segment is an edge; what follows a rule's last slash is the beginning
    of a segment and is kept, longest first, at the node before it. The deepest host
    decides, and on it the longest path. Of two rules for the same host and path
    the block entry holds.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root = _Node()
        for rule in rules:
            self._add(Rule(rule.host.lower(), rule.path or "/", rule.verdict))

    def _add(self, rule: Rule) -> None:
        node = self.root
        for label in reversed(rule.host.split(".")):
            node = node.below.setdefault(label, _Node())
        if node.paths is None:
            node.paths = _Node()
        node = node.paths
        *segments, tail = rule.path.split("/")[1:]
        for segment in segments:
            node = node.below.setdefault(segment, _Node())
        if tail:
            node.tails = [(t, r) for t, r in node.tails if t != tail or r.verdict == BLOCK]
            if tail not in {t for t, _ in node.tails}:
                node.tails.append((tail, rule))
            node.tails.sort(key=lambda entry: -len(entry[0]))
        elif node.rules is None or rule.verdict == BLOCK:
            node.rules = rule

    def find(self, host: str, path: str) -> Rule | None:
        if not path.startswith("/"):
            return None
        best, node = None, self.root
        segments = None
        for label in reversed(host.split(".")):
            node = node.below.get(label)
            if node is None:
                break
            if node.paths is not None:
                if segments is None:
                    segments = path.split("/")[1:]
                best = self._path(node.paths, segments) or best
        return best

    @staticmethod
    def _path(node: _Node, segments: Sequence[str]) -> Rule | None:
        best = None
        for i, segment in enumerate(segments):
            best = node.rules or best
            for tail, rule in node.tails:
                if segment.startswith(tail):
                    best = rule
                    break
            # The last segment ends without a slash, so no edge can be taken for it.
            if i == len(segments) - 1:
                break
            node = node.below.get(segment)
            if node is None:
                break
        return best


def host_and_path(url: str | None) -> tuple[str, str]:
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased; then up to ``? #``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    rest = rest.split("?", 1)[0].split("#", 1)[0]
    host, slash, path = rest.partition("/")
    if not host.islower():
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return host, slash + path


def filter_urls(
    df: DataFrame,
    rules: Sequence[Rule],
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row.

    A url that is null or has no ``://`` has an empty host and path and gets
    ``default``, as does one that no rule fits. Repeated rows are judged each, other
    columns are ignored, an empty table gives no rows. Rules are configuration, sent
    to every worker; above ``TRIE_RULES`` they are cut into slices of that size, each
    judged by a stage of workers of its own, and the best rule of all slices holds.
    """
    rules = list(rules)
    slices = [rules[i : i + TRIE_RULES] for i in range(0, len(rules), TRIE_RULES)] or [[]]
    context = df.sparkSession.sparkContext
    rows = df.select(
        F.col(id_column).alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        *[F.lit(None).cast("string").alias(c) for c in ("host", "path", "rule_host", "rule_path", "verdict")],
    )
    kind = df.schema[id_column].dataType.simpleString()
    for part in slices:
        rows = _judge(rows, context.broadcast(part), kind)
    return rows.select(
        "page_id",
        "host",
        "path",
        F.concat("rule_host", "rule_path").alias("rule"),
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )


def _judge(rows: DataFrame, shared, kind: str) -> DataFrame:
    def body():
        trie = Trie(shared.value)

        def one(batch: pa.RecordBatch) -> list:
            hosts, paths, found = [], [], []
            before = zip(*(batch.column(i).to_pylist() for i in (4, 5, 6)))
            for url, earlier in zip(batch.column(1).to_pylist(), before):
                host, path = host_and_path(url)
                hosts.append(host)
                paths.append(path)
                best = trie.find(host, path)
                if earlier[0] is not None and (best is None or _longer(Rule(*earlier), best)):
                    best = earlier
                found.append(best or (None, None, None))
            best = [pa.array([x[i] for x in found], pa.string()) for i in range(3)]
            return [
                batch.column(0), batch.column(1),
                pa.array(hosts, pa.string()), pa.array(paths, pa.string()), *best,
            ]

        return one

    columns = ", ".join(f"{c} string" for c in ("url", "host", "path", "rule_host", "rule_path", "verdict"))
    return map_columns(rows, f"page_id {kind}, {columns}", body)


def _longer(a: Rule, b: Rule) -> bool:
    key = [(r.host.count("."), len(r.path), r.verdict == BLOCK) for r in (a, b)]
    return key[0] > key[1]
