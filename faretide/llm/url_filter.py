"""Allow and block rules on URLs: a trie over reversed host labels and path segments.

A rule ``(host, path prefix)`` fits a URL whose host is the rule's or below it and whose path
begins with the rule's. Among fitting rules the one with most host labels wins, then the longest
path, then ``block``. The trie grows with the rules, whose number is checked, and is broadcast;
URLs are judged where they are read, without a shuffle.

Defined results: a NULL URL or one without ``://`` has an empty host and path, fits no rule and
gets the default verdict with a NULL rule. Repeated rows are judged each; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faretide.llm.words import received, shared

#: Rules held by every executor; more should be split by their last host labels and joined.
MAX_RULES = 1_000_000


@dataclass(frozen=True)
class Rule:
    host: str
    path: str = "/"
    verdict: str = "block"

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(slots=True)
class Node:
    """A place in the trie: labels and segments below it, and rules that end here."""

    labels: dict[str, Node] = field(default_factory=dict)
    segments: dict[str, Node] = field(default_factory=dict)
    rule: Rule | None = None
    #: rules whose last segment is cut off, as text that a path goes on with
    partial: list[tuple[str, Rule]] = field(default_factory=list)


def _segments(path: str) -> list[str]:
    """Segments with their closing slash; the last may lack it."""
    return [s for s in path.replace("/", "/\0").split("\0") if s]


def _stronger(old: Rule | None, new: Rule) -> Rule:
    return new if old is None or new.verdict == "block" else old


def build_trie(rules: Iterable[Rule]) -> Node:
    root = Node()
    for rule in rules:
        node = root
        for label in reversed(rule.host.split(".")):
            node = node.labels.setdefault(label, Node())
        parts = _segments(rule.path)
        tail = parts.pop() if parts and not parts[-1].endswith("/") else None
        for part in parts:
            node = node.segments.setdefault(part, Node())
        if tail is None:
            node.rule = _stronger(node.rule, rule)
        else:
            node.partial.append((tail, rule))
    return root


def _down(node: Node, path: str) -> Rule | None:
    """The longest rule below a host's node that the path begins with."""
    best, parts = None, _segments(path)
    for k in range(len(parts) + 1):
        best = node.rule or best
        rest = "".join(parts[k:]) if node.partial else ""
        fits = [(len(t), r.verdict == "block", r) for t, r in node.partial if rest.startswith(t)]
        node = node.segments.get(parts[k]) if k < len(parts) else None
        if fits:
            best = max(fits, key=lambda x: x[:2])[2]
        if node is None:
            return best
    return best


def find_rule(root: Node, host: str, path: str) -> Rule | None:
    node, best = root, None
    for label in reversed(host.split(".")):
        node = node.labels.get(label)
        if node is None:
            break
        best = _down(node, path) or best
    return best


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``(id_col, host, path, rule, verdict)`` for every row of ``pages``."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
    url = pages[url_col].cast("string")
    parts = pages.select(pages[id_col], url_host(url).alias("host"), url_path(url).alias("path"))
    sent = shared(pages, build_trie(rules))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = received(sent)
        for batch in batches:
            ids, hosts, paths = batch.columns
            found = [
                find_rule(trie, h, p) if h else None
                for h, p in zip(hosts.to_pylist(), paths.to_pylist(), strict=True)
            ]
            names = pa.array([r and r.name for r in found], pa.string())
            verdicts = pa.array([r.verdict if r else default for r in found], pa.string())
            yield pa.RecordBatch.from_arrays(
                [ids, hosts, paths, names, verdicts], [id_col, "host", "path", "rule", "verdict"]
            )

    kind = parts.schema[0].dataType.simpleString()
    return parts.mapInArrow(
        judge, f"`{id_col}` {kind}, host string, path string, rule string, verdict string"
    )
